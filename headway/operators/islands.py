"""Blocks of consecutive numbers."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def consecutive_blocks(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """First and last number of every unbroken run within a key.

    A number minus its rank stays the same within a run. Expects distinct numbers per key; for
    hours of a day a key has 24 rows at most.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(number))
    return (
        df.withColumn("_run", F.col(number) - rank)
        .groupBy(*keys, "_run")
        .agg(F.min(number).alias(f"first_{number}"), F.max(number).alias(f"last_{number}"))
        .drop("_run")
    )
