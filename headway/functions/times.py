"""Time expressions on zone-free timestamps."""

import math
from datetime import date, datetime, time

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
SECONDS_PER_DAY = 86400


def moment(value: datetime) -> Column:
    """Zone-free literal; a plain one would pass through the zones of Python and the session."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


_ZONED = r":[0-9]{2}.*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def parse_timestamp(text: Column) -> Column:
    """S3: text to a zone-free timestamp in UTC; NULL where the text is not one. Text without an
    offset is taken as it stands."""
    instant = _since_epoch(F.unix_micros(text.try_cast("timestamp")))
    return F.when(text.rlike(_ZONED), instant).otherwise(text.try_cast("timestamp_ntz"))


def parse_epoch(seconds: Column) -> Column:
    """Seconds since 1970 to a zone-free timestamp; NULL where that is out of range."""
    micros = F.round(seconds.cast("double") * 1_000_000)
    # Years 1 to 9999, which is all that a timestamp may hold here.
    known = micros.between(-62_135_596_800_000_000, 253_402_300_799_999_999)
    return _since_epoch(F.when(known, micros).try_cast("bigint"))


def parse_time(value: Column) -> Column:
    """A JSON value (variant) to a zone-free timestamp: text in ISO form, or a number of
    seconds since 1970. NULL for anything else; a text of digits is not a number."""
    kind = F.schema_of_variant(value)
    number = kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)")
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    iso = F.when(text.rlike("^[0-9]{4}-"), parse_timestamp(text))
    return F.when(number, parse_epoch(F.try_variant_get(value, "$", "double"))).otherwise(iso)


def _since_epoch(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, moment(EPOCH))


def day_start(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    """Start of the hour, without a detour through the session time zone."""
    return day_start(ts) + F.make_dt_interval(F.lit(0), F.hour(ts))


def seconds_of_day(ts: Column) -> Column:
    """Whole seconds since midnight (fractions dropped)."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def sine_time(ts: Column) -> Column:
    """Position in the day on the unit circle."""
    return F.sin(F.lit(2 * math.pi) * seconds_of_day(ts) / F.lit(SECONDS_PER_DAY))


def is_weekend(ts: Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(ts) >= 5


def is_peak(ts: Column, rule: str = "data") -> Column:
    """C4: morning or evening peak.

    ``data`` is 07:00:00-09:00:00 or 16:00:00-18:00:00, both ends included. ``forecast`` (7-9,
    17-19) and ``form`` (7-9, 16-18) look at the hour number, so 09:59 still counts.
    """
    if rule == "data":
        seconds = seconds_of_day(ts)
        return seconds.between(7 * 3600, 9 * 3600) | seconds.between(16 * 3600, 18 * 3600)
    evening = {"forecast": (17, 19), "form": (16, 18)}[rule]
    return F.hour(ts).between(7, 9) | F.hour(ts).between(*evening)


def between_times(ts: Column, day: date, start: time, end: time) -> Column:
    """on ``day`` from ``start`` to ``end``, both included.

    Written as one range over the raw column, so that the scan can skip files and row groups.
    """
    low, high = datetime.combine(day, start), datetime.combine(day, end)
    return (ts >= moment(low)) & (ts <= moment(high))


def hour_spine(day: date, start: time, end: time) -> Column:
    """Array of hours from start to end, both included; empty where end comes first."""
    hours = (datetime.combine(day, end) - datetime.combine(day, start)).total_seconds() // 3600
    first = moment(datetime.combine(day, start))
    return F.transform(
        _counted(F.lit(int(hours) + 1)), lambda i: first + F.make_dt_interval(F.lit(0), i)
    )


def time_grid(start: Column, window_minutes: int, interval_minutes: int) -> Column:
    """C17: array of start + i * interval, as many as whole intervals fit the window."""
    return F.transform(
        _counted(F.lit(window_minutes // interval_minutes)),
        lambda i: start + F.make_dt_interval(F.lit(0), F.lit(0), i * F.lit(interval_minutes)),
    )


def _counted(n: Column) -> Column:
    """[0 .. n-1], empty for n < 1 (a bare sequence would count downwards)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
        F.array().cast("array<int>")
    )
