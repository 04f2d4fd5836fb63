"""Backward as-of join."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.keyed import last_per_key
from headway.operators.ranges import RANGES, sample_bounds, with_range

SALTS = 8


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
    ranges: int = RANGES,
    salts: int = SALTS,
) -> DataFrame:
    """Add to every left row the values of the right row with the latest time not after its own.

    A merge by time: both sides are dealt out by ranges of the time that hold about as many right
    rows each, and every range is read once, in order, the last right row going along. The bounds
    are right times themselves, so every range but the first begins with a right row, and none
    needs to know what came before it. A left row is tested against no right row at all, however
    many a day has. A range that holds much of the left side is spread over ``salts`` tasks, for
    which its right rows are repeated. Left rows without a time or before the first right row get
    NULLs; of equal right times the last in ``tie`` order counts.
    """
    timed = right.filter(F.col(right_on).isNotNull()).select(
        F.col(right_on).alias("_time"), *values, *[n for n in tie if n not in values]
    )
    steps = last_per_key(timed, ["_time"], list(tie) or list(values)).select(
        "_time", F.struct(*values).alias("_held")
    )
    bounds = sample_bounds(right.select(F.col(right_on).alias("_time")).distinct(), F.col("_time"), [F.col("_time")], ranges)
    nothing = F.lit(None)
    whole = left.select(F.struct(*left.columns).alias("_row")).schema["_row"].dataType
    rights = steps.select(
        "_time",
        "_held",
        nothing.cast(whole).alias("_row"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
    )
    hashed = [f.name for f in whole if "map<" not in f.dataType.simpleString()]
    kinds = steps.schema
    lefts = left.select(
        F.col(left_on).cast(kinds["_time"].dataType).alias("_time"),
        nothing.cast(kinds["_held"].dataType).alias("_held"),
        F.struct(*left.columns).alias("_row"),
        F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int").alias("_salt"),
    )
    both = with_range(lefts.union(rights), F.col("_time"), bounds, ranges=ranges)
    # Right rows come before left rows of the same time.
    in_order = (
        Window.partitionBy("_range", "_salt")
        .orderBy("_time", F.col("_row").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = both.withColumn("_held", F.last("_held", ignorenulls=True).over(in_order))
    found = merged.filter(F.col("_row").isNotNull())
    return found.select(
        *[F.col("_row").getField(f.name).alias(f.name) for f in whole],
        *[F.col("_held").getField(v).alias(v) for v in values],
    )
