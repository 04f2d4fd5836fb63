"""One row per key, and key checks."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row that comes first in ``order`` for every key; NULLs come first.

    Spark applies the rank limit before the shuffle as well as after it, so each map task sends one
    row per key at most, and a key that holds much of the table does not end up in one task.
    Columns that are dropped later are not read.
    """
    return _ranked(df, keys, [F.col(name).asc() for name in order])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row that comes last in ``order`` for every key; NULLs come first."""
    return _ranked(df, keys, [F.col(name).desc() for name in order])


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7: keys that occur more than once; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def new_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key that the existing table does not hold. Of several rows of a key the
    least by the other columns, in their order, is taken."""
    one = first_per_key(df, keys, [name for name in df.columns if name not in keys] or list(keys))
    return one.join(existing.select(*keys), list(keys), "left_anti").select(df.columns)
