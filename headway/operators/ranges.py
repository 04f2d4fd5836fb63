"""Ranges of an order with about as many rows each, for scans that go over all rows in that order.

A scan then takes three steps: one row of results per range, a scan over these, and a scan within each range that starts
from what the ranges before it gave.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 1024


def sample_bounds(rows: DataFrame, value: Column, identity: list[Column], ranges: int = RANGES) -> Column:
    """The ends of the ranges, as a sorted array of at most ``ranges`` - 1 values of ``value``.

    They are the values of the rows with the least hashes of ``identity``, so they cut the rows into parts of about
    equal size whatever their distribution, and are the same each time they are computed. Only as many rows as
    there are ranges leave a task.
    """
    hashed = rows.select(value.alias("_value"), F.xxhash64(*identity).alias("_hash"))
    chosen = hashed.filter(F.col("_value").isNotNull()).orderBy("_hash", "_value").limit(ranges - 1)
    return chosen.agg(F.array_sort(F.collect_list("_value")).alias("bounds")).scalar()


def with_range(rows: DataFrame, value: Column, bounds: Column, into: str = "_range", ranges: int = RANGES) -> DataFrame:
    """Rows with the number of their range: how many bounds are not above the value. 0 for NULL.

    Found by halving, in plain steps and not in a lambda, so that all of it is compiled code. Each
    step refers to the one before in the same selection."""
    steps = [value.alias("_place"), bounds.alias("_bounds"), F.lit(0).alias("_at")]
    at = F.col("_at")
    for n in reversed(range(ranges.bit_length())):
        beyond = F.get("_bounds", at + ((1 << n) - 1)) <= F.col("_place")
        steps.append((at + F.when(beyond, 1 << n).otherwise(0)).alias(f"_at_{n}"))
        at = F.col(f"_at_{n}")
    return rows.select("*", *steps).select(*rows.columns, at.alias(into))
