"""Shape geometry and bus positions (Q11: D2, W2, W3, L4, F13)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway import constants as K
from headway.functions.geometry import manhattan_km
from headway.functions.texts import composite_id, iso_text
from headway.operators.filters import has_text
from headway.operators.keyed import first_per_key


def shape_points(shapes: DataFrame) -> DataFrame:
    """Points with one position per (shape, sequence). Sequence numbers are 16 bit, which bounds
    the points of a shape and so the size of every window over them."""
    return (
        shapes.groupBy("shape_id", F.col("shape_pt_sequence").alias("sequence"))
        .agg(F.min(F.struct("shape_pt_lat", "shape_pt_lon")).alias("at"))
        .select(
            "shape_id",
            "sequence",
            F.col("at.shape_pt_lat").alias("lat"),
            F.col("at.shape_pt_lon").alias("lon"),
        )
    )


def segment_lengths(shapes: DataFrame) -> DataFrame:
    """Kilometres from every point to the next one of its shape; the last has none."""
    along = Window.partitionBy("shape_id").orderBy("sequence")
    following = [F.lead(name).over(along) for name in ("lat", "lon")]
    return shape_points(shapes).withColumn(
        "km", manhattan_km(F.col("lat"), F.col("lon"), *following)
    )


def shape_ends(shapes: DataFrame) -> DataFrame:
    """L4: first and last point of every shape with two points or more."""
    point = F.struct(F.col("shape_pt_lat").alias("lat"), F.col("shape_pt_lon").alias("lon"))
    ends = shapes.groupBy("shape_id").agg(
        F.min_by(point, F.struct("shape_pt_sequence", point)).alias("origin"),
        F.max_by(point, F.struct("shape_pt_sequence", point)).alias("destination"),
        F.count("*").alias("points"),
    )
    return ends.filter("points >= 2").select(
        "shape_id",
        F.col("origin.lat").alias("origin_lat"),
        F.col("origin.lon").alias("origin_lon"),
        F.col("destination.lat").alias("destination_lat"),
        F.col("destination.lon").alias("destination_lon"),
    )


def travel_times(shapes: DataFrame, mode: str = "reference") -> DataFrame:
    """Microseconds from the start to every point at 30 km/h.

    ``reference``: for a shape of n points numbered 1..n, positions 1..n-3, where position i is
    reached after the segments 2..i+1 (the first segment, the last one and the last three points
    stay out); shapes under four points, or with a number missing, have no positions. ``full``: all
    points, each reached after the segments before it.
    """
    along = Window.partitionBy("shape_id").orderBy("sequence")
    hours = F.col("km") / K.BUS_SPEED_KMH
    micros = F.rint(hours * 3600 * 1_000_000).cast("bigint")
    points = segment_lengths(shapes).withColumn("micros", micros)
    if mode == "full":
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        return points.select(
            "shape_id",
            "sequence",
            "lat",
            "lon",
            F.coalesce(F.sum("micros").over(before), F.lit(0)).alias("elapsed"),
        )
    whole = Window.partitionBy("shape_id")
    count = F.count("*").over(whole)
    inner = F.count_if((F.col("sequence") >= 1) & (F.col("sequence") < F.col("points")))
    to_next = along.rowsBetween(Window.unboundedPreceding, 1)
    later = F.when(F.col("sequence") >= 2, F.col("micros"))
    return (
        points.withColumn("points", count)
        .withColumn("inner", inner.over(whole))
        .withColumn("elapsed", F.sum(later).over(to_next))
        .filter(
            (F.col("inner") == F.col("points") - 1)
            & F.col("sequence").between(F.lit(1), F.col("points") - 3)
        )
        .select("shape_id", "sequence", "lat", "lon", "elapsed")
    )


def first_shape_messages(predictions: DataFrame, order: Sequence[str]) -> DataFrame:
    """First message per shape that names its shape and has a readable time."""
    usable = predictions.filter(
        has_text(["shape_id"]) & F.col("timestamp").isNotNull() & (F.col("shape_id") != "nan")
    )
    return first_per_key(usable, ["shape_id"], order)


def gps_track(
    predictions: DataFrame, shapes: DataFrame, order: Sequence[str], mode: str = "reference"
) -> DataFrame:
    """Q11: bus positions of the first message of every shape. ``timestamp`` must be parsed."""
    firsts = first_shape_messages(predictions, order)
    position = F.col("position")
    return (
        travel_times(shapes, mode)
        .withColumnRenamed("sequence", "position")
        .join(firsts, "shape_id")
        .select(
            composite_id("stop_id", "route", iso_text(F.col("timestamp")), position).alias("measurement_id"),
            F.timestamp_add("MICROSECOND", F.col("elapsed"), F.col("timestamp")).alias("timestamp"),
            "stop_id",
            "route",
            "bus_id",
            "trip_id",
            "shape_id",
            F.col("stop_sequence").cast("int").alias("sequence"),
            F.col("lat").alias("latitude"),
            F.col("lon").alias("longitude"),
        )
    )
