"""The feature table kept up to date from new facts (K6, Q4).

A batch adds its counts per trip and day, and per trip its first times by peak flag with its days. It
computes anew the trip-days that it has facts for; and where a late ticket changes which peak flag of
a trip comes first, all days of that trip. Of the counts before it reads the days of those alone. A
trip-day whose last ticket and reading no longer carry the same time is marked as gone.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StructField, StructType

from headway import constants as K
from headway.operators.filters import within_range_of
from headway.operators.keyed import last_per_key
from headway.plans.features import (
    days_of_counts,
    features_of_days,
    first_flag,
    merged_counts,
    trip_day_counts,
)
from headway.schemas import FEATURES, SENSOR_MESSAGE, TICKET_MESSAGE, TYPES, schema
from headway.sinks.logs import add_to_log, fold_log, fold_now, read_batch, read_log
from headway.sources.messages import decode_messages, good_rows
from headway.streaming.running import start

COUNTS = schema(
    "trip_id string, passengers_in long, school int, hospital int, timestamp timestamp_ntz, "
    "passengers_out long, reading timestamp_ntz, first_off timestamp_ntz, first_on timestamp_ntz, "
    "day date"
)
TRIPS = StructType(
    [
        *schema("trip_id string, first_off timestamp_ntz, first_on timestamp_ntz").fields,
        StructField("days", ArrayType(TYPES["date"])),
    ]
)
ROWS = StructType([*FEATURES.fields, *schema("day date, live boolean, written long").fields])
TRIP_DAY = ["trip_id", "day"]


def update_features(
    spark: SparkSession,
    folder: str,
    batch_id: int,
    tickets: DataFrame,
    sensors: DataFrame,
    trips: DataFrame,
    traffic: DataFrame,
    weather: DataFrame,
    city_events: DataFrame,
) -> None:
    """Bring the table in ``folder`` up to the facts of a batch. The other tables are taken as they
    are now: rows of untouched trip-days keep what they were built with. Repeating a batch replaces
    what it wrote."""
    # Counts and first times are read back from what is written down, so that they are made once.
    add_to_log(_as(COUNTS, trip_day_counts(tickets, sensors)), f"{folder}/counts", batch_id, "day")
    new = read_batch(spark, f"{folder}/counts", COUNTS, batch_id)
    add_to_log(_firsts(new), f"{folder}/trips", batch_id)
    firsts = read_batch(spark, f"{folder}/trips", TRIPS, batch_id)
    earlier = read_log(spark, f"{folder}/trips", TRIPS, before=batch_id)
    known = _merged_firsts(earlier.join(firsts.select("trip_id"), "trip_id", "left_semi"))
    grown = _merged_firsts(known.unionByName(firsts))
    before = known.select("trip_id", "days", first_flag().alias("_flag"))
    other = ~F.col("_flag").eqNullSafe(first_flag())
    turned = grown.drop("days").join(before, "trip_id").filter(other)
    need = new.select(*TRIP_DAY).union(turned.select("trip_id", F.explode("days"))).distinct().persist()
    try:
        stored = read_log(spark, f"{folder}/counts", COUNTS, before=batch_id)
        touched = within_range_of(stored, need, "day").join(need, TRIP_DAY, "left_semi")
        counts = merged_counts(new.unionByName(touched.select(*new.columns)))
        whole = counts.drop("first_off", "first_on").join(grown.drop("days"), "trip_id")
        rows = features_of_days(days_of_counts(whole), trips, traffic, weather, city_events)
        # One row at most of every needed trip-day, and none of others; what has no row is gone.
        live = rows.withColumns({"trip_id": F.col("trip_id_x"), "day": F.to_date("timestamp_x")})
        marked = need.join(live.withColumn("live", F.lit(True)), TRIP_DAY, "left")
        written = marked.withColumns(
            {
                "trip_id_x": F.col("trip_id"),
                "live": F.coalesce("live", F.lit(False)),
                "written": F.lit(batch_id).cast("long"),
            }
        )
        add_to_log(_as(ROWS, written), f"{folder}/features", batch_id)
    finally:
        need.unpersist()


def read_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table as the facts so far give it."""
    rows = _newest(read_log(spark, f"{folder}/features", ROWS))
    return rows.select(*K.FEATURE_COLUMNS)


def fold_features(spark: SparkSession, folder: str, upto: int) -> None:
    """Fold what batches up to a finished one have written."""
    fold_log(spark, f"{folder}/features", ROWS, _newest, upto)
    fold_log(spark, f"{folder}/trips", TRIPS, _merged_firsts, upto)
    fold_log(spark, f"{folder}/counts", COUNTS, lambda df: _as(COUNTS, merged_counts(df)), upto, "day")


def maintain_features(
    messages: DataFrame,
    others: Callable[[SparkSession], tuple[DataFrame, DataFrame, DataFrame, DataFrame]],
    folder: str,
    checkpoint: str,
    every: str | None = None,
    fold_every: int = 100,
) -> StreamingQuery:
    """Keep the feature table up to date with ticket and sensor messages. ``others`` gives trips,
    traffic, weather and city events as they are when a batch runs."""

    def facts(batch: DataFrame, topic: str, kind: StructType) -> DataFrame:
        return good_rows(decode_messages(batch.filter(F.col("topic") == topic), kind), kind)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tickets = facts(batch, "ticketing.topic", TICKET_MESSAGE)
        sensors = facts(batch, "sensors.topic", SENSOR_MESSAGE)
        update_features(spark, folder, batch_id, tickets, sensors, *others(spark))
        if fold_now(batch_id, fold_every):
            fold_features(spark, folder, batch_id - 1)

    return start(messages, each_batch, checkpoint, every)


def _as(kind: StructType, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kind.fields])


def _firsts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("trip_id").agg(
        F.min("first_off").alias("first_off"),
        F.min("first_on").alias("first_on"),
        F.collect_set("day").alias("days"),
    )


def _merged_firsts(firsts: DataFrame) -> DataFrame:
    return firsts.groupBy("trip_id").agg(
        F.min("first_off").alias("first_off"),
        F.min("first_on").alias("first_on"),
        F.array_distinct(F.flatten(F.collect_list("days"))).alias("days"),
    )


def _newest(rows: DataFrame) -> DataFrame:
    """The last written row of every trip-day, if it is not gone. A base holds no marks: nothing
    comes before it."""
    return last_per_key(rows, ["trip_id_x", "day"], ["written"]).filter("live")
