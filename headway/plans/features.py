"""Feature table, one row per trip and day (Q3, Q4: A5-A8, J3-J8, A7, C1-C3, F1, F8, D3)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway import constants as K
from headway.functions.times import is_weekend, seconds_of_day, sine_time
from headway.operators.asof import asof_backward
from headway.operators.keyed import first_per_key

WEATHER_VALUES = ["temperature", "precipitation_probability", "weather_code"]
TRAFFIC_VALUES = ["traffic_level", "normal", "traffic"]


def ticket_features(tickets: DataFrame) -> DataFrame:
    """A5: tickets with a fare, flags and last ticket per trip and day; NULL keys are left out."""
    return _dated(tickets).groupBy("trip_id", "day").agg(
        F.count("fare").alias("passengers_in"),
        F.max("school").alias("school"),
        F.max("hospital").alias("hospital"),
        F.max("timestamp").alias("timestamp"),
    )


def sensor_features(sensors: DataFrame) -> DataFrame:
    """Readings (of any status) and last reading per trip and day."""
    return _dated(sensors).groupBy("trip_id", "day").agg(
        F.count("status").alias("passengers_out"), F.max("timestamp").alias("timestamp")
    )


def first_peak_hours(tickets: DataFrame) -> DataFrame:
    """Peak flag of a trip's earliest ticket that has one; of tickets at one time, 0 counts."""
    return (
        tickets.filter(F.col("trip_id").isNotNull())
        .groupBy("trip_id")
        .agg(_first_time(0).alias("_off"), _first_time(1).alias("_on"))
        .select("trip_id", _first_flag("_off", "_on").alias("peak_hour"))
        .filter(F.col("peak_hour").isNotNull())
    )


def _first_time(flag: int):
    """Two plain minima instead of a minimum over structs, so the aggregation hashes, not sorts."""
    return F.min(F.when(F.col("peak_hour") == flag, F.col("timestamp")))


def _first_flag(off: str, on: str):
    off, on = F.col(off), F.col(on)
    return F.when(off.isNotNull() & (on.isNull() | (off <= on)), 0).when(on.isNotNull(), 1)


def _dated(facts: DataFrame) -> DataFrame:
    return facts.withColumn("day", F.to_date("timestamp")).filter(
        F.col("trip_id").isNotNull() & F.col("day").isNotNull()
    )


def trip_day_counts(tickets: DataFrame, sensors: DataFrame) -> DataFrame:
    """What trip-days need of their tickets and readings; ``merged_counts`` adds such rows up.

    Both fact tables go through one aggregation by trip and day.
    """
    ticket_rows = _dated(tickets).select(
        "trip_id",
        "day",
        "fare",
        "school",
        "hospital",
        "peak_hour",
        "timestamp",
        F.lit(None).cast("int").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("reading"),
    )
    sensor_rows = _dated(sensors).select(
        "trip_id",
        "day",
        F.lit(None).cast("double").alias("fare"),
        *[F.lit(None).cast("int").alias(name) for name in ("school", "hospital", "peak_hour")],
        F.lit(None).cast("timestamp_ntz").alias("timestamp"),
        "status",
        F.col("timestamp").alias("reading"),
    )
    return ticket_rows.unionByName(sensor_rows).groupBy("trip_id", "day").agg(
        F.count("fare").alias("passengers_in"),
        F.max("school").alias("school"),
        F.max("hospital").alias("hospital"),
        F.max("timestamp").alias("timestamp"),
        F.count("status").alias("passengers_out"),
        F.max("reading").alias("reading"),
        _first_time(0).alias("first_off"),
        _first_time(1).alias("first_on"),
    )


def merged_counts(counts: DataFrame) -> DataFrame:
    """Counts of several lots of facts as those of all of them."""
    return counts.groupBy("trip_id", "day").agg(
        *[F.sum(n).alias(n) for n in ("passengers_in", "passengers_out")],
        *[F.max(n).alias(n) for n in ("school", "hospital", "timestamp", "reading")],
        *[F.min(n).alias(n) for n in ("first_off", "first_on")],
    )


def days_of_counts(counts: DataFrame) -> DataFrame:
    """J4 and A8, from counts whose ``first_off`` and ``first_on`` are those of the whole trip: the
    days whose last ticket and last reading carry the same time."""
    return counts.filter(F.col("timestamp") == F.col("reading")).select(
        "trip_id",
        "day",
        "timestamp",
        "passengers_in",
        "passengers_out",
        "school",
        "hospital",
        first_flag().alias("peak_hour"),
    )


def first_flag():
    """The peak flag of the earlier of two first times."""
    return _first_flag("first_off", "first_on")


def trip_days(tickets: DataFrame, sensors: DataFrame) -> DataFrame:
    """Ticket and sensor features of the trip-days whose last ticket and last reading
    carry the same time, with the trip's first peak flag.

    What leaves the counts is small, so gathering a trip's days for its first peak flag and all
    later steps move few rows.
    """
    trip = Window.partitionBy("trip_id")
    firsts = {n: F.min(n).over(trip) for n in ("first_off", "first_on")}
    return days_of_counts(trip_day_counts(tickets, sensors).withColumns(firsts))


def first_traffic(traffic: DataFrame, needed: Sequence[str] = ("traffic_level",)) -> DataFrame:
    """Earliest traffic row of every shape that has all the needed values (ties: by id)."""
    usable = traffic.dropna(subset=["timestamp", *needed])
    return first_per_key(
        usable.select("shape_id", "timestamp", "measurement_id", *TRAFFIC_VALUES),
        ["shape_id"],
        ["timestamp", "measurement_id"],
    )


def trip_traffic(days: DataFrame, trips: DataFrame, traffic: DataFrame, needed) -> DataFrame:
    """Trip-days with the traffic of their shape.

    Joining every traffic row of a shape and keeping the first afterwards would multiply the trips
    by the whole traffic history. The first row is picked per shape before, and per trip where a
    trip is listed more than once, so every join here meets one row at most. A missing shape
    matches traffic without a shape, also when the trip itself is unknown.
    """
    firsts = first_traffic(traffic, needed)
    at_shape = firsts.select(
        F.col("shape_id").alias("_shape"),
        F.struct("timestamp", "measurement_id", *TRAFFIC_VALUES).alias("_traffic"),
    )
    listed = trips.filter(F.col("trip_id").isNotNull())
    by_trip = (
        listed.select(F.col("trip_id").alias("_trip"), "shape_id")
        .join(at_shape, F.col("shape_id").eqNullSafe(F.col("_shape")), "left")
        .groupBy("_trip")
        .agg(F.min("_traffic").alias("_traffic"))
    )
    without_shape = at_shape.filter(F.col("_shape").isNull()).select("_traffic").scalar()
    chosen = F.when(F.col("_trip").isNull(), without_shape).otherwise(F.col("_traffic"))
    return (
        days.join(by_trip, F.col("trip_id") == F.col("_trip"), "left")
        .withColumn("_chosen", chosen)
        .select(*days.columns, *[F.col(f"_chosen.{name}").alias(name) for name in TRAFFIC_VALUES])
    )


def event_days(city_events: DataFrame) -> DataFrame:
    """Days with a city event, wherever and whenever on the day."""
    return city_events.select("day_event").dropna().distinct()


def build_features(
    tickets: DataFrame,
    sensors: DataFrame,
    trips: DataFrame,
    traffic: DataFrame,
    weather: DataFrame,
    city_events: DataFrame,
    columns: Sequence[str] = tuple(K.FEATURE_COLUMNS),
    only_trips: DataFrame | None = None,
) -> DataFrame:
    """Q3: the selected feature columns of every trip-day that has a value in all of them.

    With ``only_trips``, a table with a ``trip_id``, those of its trips alone. Nothing goes from
    one trip to another, so the facts of other trips are left out before they are counted.
    """
    if only_trips is not None:
        asked = only_trips.select("trip_id")
        tickets, sensors, trips = (
            df.join(asked, "trip_id", "left_semi") for df in (tickets, sensors, trips)
        )
    days = trip_days(tickets, sensors)
    return features_of_days(days, trips, traffic, weather, city_events, columns)


def features_of_days(
    trip_days: DataFrame,
    trips: DataFrame,
    traffic: DataFrame,
    weather: DataFrame,
    city_events: DataFrame,
    columns: Sequence[str] = tuple(K.FEATURE_COLUMNS),
) -> DataFrame:
    """Q3, from the trip-days on."""
    needed = [name for name in TRAFFIC_VALUES if name in columns]
    days = trip_traffic(trip_days, trips, traffic, needed)
    with_weather = asof_backward(
        days.withColumnsRenamed({"trip_id": "trip_id_x", "timestamp": "timestamp_x"}),
        weather,
        "timestamp_x",
        "hour",
        WEATHER_VALUES,
        tie=["measurement_id"],
    )
    ts = F.col("timestamp_x")
    change = F.col("passengers_in") - F.col("passengers_out")
    return (
        with_weather.join(
            event_days(city_events), F.col("day") == F.col("day_event"), "left"
        )
        .withColumns(
            {
                "event_dummy": F.col("day_event").isNotNull().cast("int"),
                "total_capacity": F.lit(K.PLACES_PER_BUS),
                "congestion_rate": change / F.lit(K.PLACES_PER_BUS),
                "seconds_from_midnight": seconds_of_day(ts),
                "weekend": is_weekend(ts).cast("int"),
                "sine_time": sine_time(ts),
            }
        )
        .select(*columns)
        .dropna()
    )
