"""Rows out of counts, arrays and calendars."""

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.bands import lookup


def repeat_rows(df: DataFrame, count: Column, position: str) -> DataFrame:
    """N copies of a row, numbered from 0; none for n < 1 or NULL."""
    numbers = F.sequence(F.lit(0), count - 1)
    return df.filter(count >= 1).select("*", F.explode(numbers).alias(position))


def with_parsed(df: DataFrame, name: str, parsed: Column) -> DataFrame:
    """Add a costly column, computed once per row.

    Filters on a plain column move below the projection that defines it, and each then computes it
    again. They do not move below a generator.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def explode_arrays(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """C11: parallel arrays to one row per element, other columns repeated."""
    rest = [name for name in df.columns if name not in arrays]
    return df.select(*rest, F.inline(F.arrays_zip(*arrays)))


def dated_schedule(timetable: DataFrame, first: date, last: date, time_of_day: str) -> DataFrame:
    """Every timetable row on every service day, with its date and time.

    ``time_of_day`` holds ``HH:mm:ss`` text; hours past 24 run into the next day. The days come
    from a generator on each row, so there is no join and nothing to broadcast.
    """
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    parts = F.split(time_of_day, ":")
    clock = F.make_dt_interval(
        F.lit(0), parts[0].cast("int"), parts[1].cast("int"), parts[2].cast("decimal(18,6)")
    )
    dated = timetable.withColumn("_clock", clock).select("*", F.explode(days).alias("service_day"))
    start = F.col("service_day").cast("timestamp_ntz")
    return dated.withColumn("timestamp", start + F.col("_clock")).drop("_clock")


def melt(
    df: DataFrame, keys: Sequence[str], labels: Mapping[str, str], kind: str, value: str
) -> DataFrame:
    """Wide to long; column names become labels."""
    long = df.unpivot(list(keys), list(labels), kind, value)
    return long.withColumn(kind, lookup(F.col(kind), dict(labels)))
