"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "None"


def composite_id(*parts: Column) -> Column:
    """Parts joined by dashes. A missing part leaves its mark, so that ids stay apart; give
    timestamps as ``iso_text``."""
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    return F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(MISSING)) for c in columns])


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def hour_interval(first: Column, last: Column) -> Column:
    """``7:00 - 9:00`` for the hours 7 and 8."""
    return F.format_string("%d:00 - %d:00", first, last + 1)


def long_date(day: Column) -> Column:
    """``Monday, 01 January 2024``."""
    return F.date_format(day, "EEEE, dd MMMM yyyy")


def route_label(short_name: Column, long_name: Column) -> Column:
    return F.concat(short_name, F.lit(" - "), long_name)


def first_character(text: Column) -> Column:
    return F.substring(text, 1, 1)
