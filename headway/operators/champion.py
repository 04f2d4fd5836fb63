"""Running best."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.ranges import sample_bounds, with_range

SALTS = 1024


def mark_champions(
    runs: DataFrame,
    name: str,
    score: str,
    order: Sequence[str],
    bucket: Column,
    spread: Column | None = None,
) -> DataFrame:
    """Add ``promoted``: whether a run scores strictly below every earlier run of its model name.

    A prefix minimum in three steps. ``bucket`` (for instance the day), and within it ``spread``,
    must grow with ``order``; over both together the runs are dealt out by ranges that hold about as
    many runs each, however they crowd. The best score of every range, then the best of all ranges
    before it: one row per name and range. Within a range only the runs that beat that are sorted
    and compared with each other; the others are rejected without looking further, and spread by
    salt. Runs without a score are dropped; NaN and infinity never win.
    """
    value = F.when(F.isnan(score), F.lit(None)).otherwise(F.col(score))
    scored = runs.filter(F.col(score).isNotNull())
    place = F.struct(bucket) if spread is None else F.struct(bucket, spread)
    bounds = sample_bounds(scored, place, [F.col(c) for c in (name, *order)])
    scored = with_range(scored, place, bounds, "_bucket")
    earlier = Window.partitionBy(name).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    best = (
        scored.groupBy(name, "_bucket")
        .agg(F.min(value).alias("_best"))
        .select(
            F.col(name).alias("_name"),
            F.col("_bucket").alias("_best_bucket"),
            F.min("_best").over(earlier).alias("_best_before"),
        )
    )
    same_bucket = F.col(name).eqNullSafe(F.col("_name")) & (
        F.col("_bucket") == F.col("_best_bucket")
    )
    contender = value < F.coalesce("_best_before", F.lit(float("inf")))
    salt = F.when(F.col("_contender"), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(*order), F.lit(SALTS))
    )
    within = (
        Window.partitionBy(name, "_bucket", "_salt")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    best_within = F.coalesce(F.min(value).over(within), F.lit(float("inf")))
    return (
        scored.join(best, same_bucket)
        .withColumn("_contender", F.coalesce(contender, F.lit(False)))
        .withColumn("_salt", salt)
        .withColumn("_best_within", best_within)
        .withColumn(
            "promoted", F.col("_contender") & F.coalesce(value < F.col("_best_within"), F.lit(False))
        )
        .select(*runs.columns, "promoted")
    )
