"""Occupancy of running buses."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.constants import SENSOR_ACTIVE
from headway.operators.filters import within_range_of
from headway.plans.occupancy import STOP_KEY
from headway.schemas import schema
from headway.sinks.logs import add_to_log, fold_log, fold_now, read_log
from headway.streaming.running import start

REFRESH = "5 seconds"
COUNTS = schema(
    "trip_id string, bus_id int, route string, stop_id string, timestamp timestamp_ntz, "
    "on long, off long, day date"
)
CHANGES = schema(
    "bus_id int, trip_id string, latest_timestamp timestamp_ntz, change long"
)


def movements(tickets: DataFrame, sensors: DataFrame) -> DataFrame:
    """Ticket and sensor streams as one stream of boardings and alightings."""
    off = sensors.filter(F.col("status") == SENSOR_ACTIVE).dropna(subset=STOP_KEY)
    return tickets.select(*STOP_KEY, F.lit(1).alias("on"), F.lit(0).alias("off")).union(
        off.select(*STOP_KEY, F.lit(0).alias("on"), F.lit(1).alias("off"))
    )


def track_occupancy(
    moves: DataFrame,
    folder: str,
    checkpoint: str,
    every: str | None = None,
    fold_every: int = 100,
) -> StreamingQuery:
    """Keep stop counts and occupancy changes up to date.

    A batch adds its counts by trip, bus, route, stop and time, and looks up the earlier counts of
    the same service days only. What it changes at those stops adds up to a change per bus and
    trip. Alightings count from the moment their stop has a boarding, so both counts are kept.
    Every ``fold_every`` batches the parts before become a base.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.coalesce(F.to_date("timestamp"), F.to_date(F.lit("1970-01-01")))
        counts = (
            batch.groupBy(*STOP_KEY)
            .agg(F.sum("on").alias("on"), F.sum("off").alias("off"))
            .withColumn("day", day)
            .persist()
        )
        try:
            earlier = read_log(spark, f"{folder}/counts", COUNTS, before=batch_id)
            changes = occupancy_changes(counts, earlier)
            add_to_log(counts, f"{folder}/counts", batch_id, "day")
            add_to_log(changes, f"{folder}/changes", batch_id)
            if fold_now(batch_id, fold_every):
                fold_occupancy(spark, folder, batch_id - 1)
        finally:
            counts.unpersist()

    return start(moves, each_batch, checkpoint, every)


def occupancy_changes(counts: DataFrame, earlier: DataFrame) -> DataFrame:
    """Change of the occupancy sum per bus and trip that new counts bring on top of earlier ones."""
    columns = [*STOP_KEY, "on", "off"]
    # The range of the days prunes folders before the scan, the join picks the days within it.
    days = counts.select("day").distinct()
    same_days = within_range_of(earlier, counts, "day").join(days, "day", "left_semi")
    rows = counts.select(*columns, F.lit(True).alias("new")).union(
        same_days.select(*columns, F.lit(False).alias("new"))
    )
    old = ~F.col("new")
    stops = rows.groupBy(*STOP_KEY).agg(
        F.sum("on").alias("on"),
        F.sum("off").alias("off"),
        F.coalesce(F.sum(F.when(old, F.col("on"))), F.lit(0)).alias("old_on"),
        F.coalesce(F.sum(F.when(old, F.col("off"))), F.lit(0)).alias("old_off"),
        F.bool_or("new").alias("touched"),
    )
    before = F.when(F.col("old_on") > 0, F.col("old_on") - F.col("old_off")).otherwise(F.lit(0))
    return (
        stops.filter(F.col("touched") & (F.col("on") > 0))
        .groupBy("bus_id", "trip_id")
        .agg(
            F.max("timestamp").alias("latest_timestamp"),
            F.sum(F.col("on") - F.col("off") - before).alias("change"),
        )
    )


def fold_occupancy(spark: SparkSession, folder: str, upto: int) -> None:
    """Fold what the stream has written up to a finished batch."""
    fold_log(spark, f"{folder}/counts", COUNTS, _sum_counts, upto, "day")
    fold_log(spark, f"{folder}/changes", CHANGES, _sum_changes, upto)


def _sum_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*STOP_KEY, "day").agg(F.sum("on").alias("on"), F.sum("off").alias("off"))


def _sum_changes(changes: DataFrame) -> DataFrame:
    return changes.groupBy("bus_id", "trip_id").agg(
        F.max("latest_timestamp").alias("latest_timestamp"), F.sum("change").alias("change")
    )


def read_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    """Current occupancy per bus and trip, as the batch query gives it."""
    return current_from_changes(read_log(spark, f"{folder}/changes", CHANGES))


def current_from_changes(changes: DataFrame) -> DataFrame:
    """Occupancy that the changes so far add up to."""
    return _sum_changes(changes).select(
        "bus_id",
        "trip_id",
        "latest_timestamp",
        F.greatest("change", F.lit(0)).alias("total_occupancy"),
    )
