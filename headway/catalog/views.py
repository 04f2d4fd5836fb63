"""The transit tables as views over the sample tables."""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.bands import delay_percent, fare, lookup, traffic_level
from headway.functions.times import day_start, hour_start
from headway.plans.features import build_features

PASSENGERS = {0: "adult", 1: "student", 2: "senior"}
TOPIC_OF_EVENT = {
    "click": "sensors.topic",
    "view": "gps.topic",
    "purchase": "ticketing.topic",
    "signup": "bus.passenger.predictions",
    "error": "other.topic",
}
# Order in which messages of one prediction arrive.
ARRIVAL = ["timestamp", "part", "supplier", "quantity", "price"]


def _text(column: Column) -> Column:
    return column.cast("string")


def _flag(condition: Column) -> Column:
    return condition.cast("int")


class Views:
    """Lazily defined transit tables of a folder of sample tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._samples: dict[str, DataFrame] = {}

    def sample(self, name: str) -> DataFrame:
        if name not in self._samples:
            self._samples[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._samples[name]

    @cached_property
    def events(self) -> DataFrame:
        return self.sample("events")

    def _stop_facts(self, kinds: list[str]) -> DataFrame:
        """Events of some kinds with the columns tickets and readings share."""
        ts, user, event = F.col("ts"), F.col("user_id"), F.col("event_id")
        hour = F.hour(ts)
        quarter_of_day = F.floor(hour / 6).cast("int") * 6
        return self.events.filter(F.col("event_type").isin(kinds)).select(
            _text(event).alias("event"),
            event,
            (day_start(ts) + F.make_dt_interval(F.lit(0), quarter_of_day)).alias("timestamp"),
            _text(event % 2).alias("stop_id"),
            _text(user % 25).alias("route"),
            (user % 25).cast("int").alias("bus_id"),
            _text(user).alias("trip_id"),
            _flag(hour.between(7, 9) | hour.between(16, 18)).alias("peak_hour"),
            _flag(user % 5 == 0).alias("hospital"),
            _flag(user % 4 == 0).alias("school"),
        )

    @cached_property
    def raw_tickets(self) -> DataFrame:
        passenger = lookup(F.col("event_id") % 3, PASSENGERS)
        return self._stop_facts(["purchase", "signup"]).select(
            F.col("event").alias("ticket_id"),
            "timestamp",
            "stop_id",
            "route",
            passenger.alias("passenger_type"),
            fare(passenger).alias("fare"),
            "bus_id",
            "trip_id",
            "peak_hour",
            "hospital",
            "school",
        )

    @cached_property
    def raw_sensors(self) -> DataFrame:
        return self._stop_facts(["click", "view"]).select(
            F.col("event").alias("measurement_id"),
            "timestamp",
            "stop_id",
            "route",
            _flag(F.col("event_id") % 10 != 0).alias("status"),
            F.lit(2).alias("activation_type"),
            "bus_id",
            "trip_id",
            "peak_hour",
            "hospital",
            "school",
        )

    @cached_property
    def bus(self) -> DataFrame:
        return self.sample("nation").select(
            F.col("n_nationkey").alias("bus_id"),
            (F.col("n_regionkey") * 20 + 100).alias("total_capacity"),
        )

    @cached_property
    def trips(self) -> DataFrame:
        key = F.col("c_custkey")
        shape = F.concat(F.lit("S"), _text(key % 20))
        return self.sample("customer").select(
            _text(key).alias("trip_id"),
            F.col("c_nationkey").alias("route_id"),
            F.when(key % 17 != 0, shape).alias("shape_id"),
        )

    @cached_property
    def routes(self) -> DataFrame:
        return self.sample("nation").select(
            F.col("n_nationkey").alias("route_id"),
            _text(F.col("n_nationkey")).alias("route_short_name"),
            F.col("n_name").alias("route_long_name"),
        )

    @cached_property
    def travel_times(self) -> DataFrame:
        """Measured travel times, not yet classified."""
        event, user = F.col("event_id"), F.col("user_id")
        shape = F.concat(F.lit("S"), _text(user % 20))
        return self.events.filter(F.col("event_type") == "error").select(
            _text(event).alias("measurement_id"),
            F.col("ts").alias("timestamp"),
            _text(event % 2).alias("stop_id"),
            _text(user % 25).alias("route"),
            (user % 25).cast("int").alias("bus_id"),
            _text(user).alias("trip_id"),
            F.lit(600).alias("normal"),
            (F.floor(F.col("value") * 6).cast("int") + 600).alias("traffic"),
            F.when(event % 50 != 0, shape).alias("shape_id"),
        )

    @cached_property
    def traffic(self) -> DataFrame:
        delay = delay_percent(F.col("normal"), F.col("traffic"))
        return self.travel_times.withColumn("traffic_level", traffic_level(delay))

    @cached_property
    def weather(self) -> DataFrame:
        k = F.from_json("props", "k int")["k"]
        return (
            self.events.filter(F.col("event_type") == "view")
            .select(hour_start(F.col("ts")).alias("hour"), "event_id", "value", k.alias("k"))
            .groupBy("hour")
            .agg(
                F.min("event_id").alias("measurement_id"),
                F.min_by("value", "event_id").alias("temperature"),
                F.min_by("k", "event_id").alias("k"),
            )
            .select(
                "measurement_id",
                "hour",
                "temperature",
                F.col("k").cast("double").alias("precipitation_probability"),
                (F.col("k") % 4).alias("weather_code"),
            )
        )

    @cached_property
    def weather_messages(self) -> DataFrame:
        """One message per day with the day's hours as arrays."""
        hours = F.array_sort(
            F.collect_list(
                F.struct("hour", "temperature", "precipitation_probability", "weather_code")
            )
        )
        day = day_start(F.col("hour"))
        return (
            self.weather.groupBy(day.alias("day"))
            .agg(hours.alias("hours"))
            .select(
                F.unix_date(F.to_date("day")).cast("bigint").alias("offset"),
                _text(F.col("day")).alias("timestamp"),
                F.lit(46.0).alias("latitude"),
                F.lit(11.0).alias("longitude"),
                F.col("hours.weather_code").alias("weather_code"),
                F.col("hours.precipitation_probability").alias("precipitation_probability"),
                F.col("hours.temperature").alias("temperature"),
                F.transform("hours.hour", _text).alias("hour"),
            )
        )

    @cached_property
    def city_events(self) -> DataFrame:
        """One event per part, on the first day of one of fifty weeks."""
        first = F.to_date(F.lit("2024-01-01"))
        return self.sample("part").select(
            F.col("p_partkey").alias("event_id"),
            F.col("p_name").alias("event_name"),
            F.date_add(first, (F.col("p_size") - 1) * 7).alias("day_event"),
        )

    @cached_property
    def shapes(self) -> DataFrame:
        """Thirty-two points per vector, out of its pairs of numbers."""
        numbers = F.col("embedding")
        points = F.transform(
            F.sequence(F.lit(1), F.lit(32)),
            lambda i: F.struct(
                (F.element_at(numbers, i * 2 - 1).cast("double") * 0.1 + 46).alias("lat"),
                (F.element_at(numbers, i * 2).cast("double") * 0.1 + 11).alias("lon"),
                i.alias("sequence"),
            ),
        )
        return (
            self.sample("embeddings")
            .select("vec_id", F.explode(points).alias("point"))
            .select(
                F.concat(F.lit("S"), _text(F.col("vec_id"))).alias("shape_id"),
                F.col("point.lat").alias("shape_pt_lat"),
                F.col("point.lon").alias("shape_pt_lon"),
                F.col("point.sequence").alias("shape_pt_sequence"),
            )
        )

    @cached_property
    def stops(self) -> DataFrame:
        return self.sample("supplier").select(
            F.col("s_suppkey").alias("stop_id"),
            F.col("s_name").alias("stop_name"),
            (F.col("s_nationkey").cast("double") / 100 + 46).alias("stop_lat"),
            (F.col("s_acctbal") / 10000 + 11).alias("stop_lon"),
        )

    @cached_property
    def stop_times(self) -> DataFrame:
        hour = F.lpad(_text(F.col("l_partkey") % 20 + 5), 2, "0")
        minute = F.lpad(_text(F.col("l_suppkey") % 60), 2, "0")
        clock = F.concat_ws(":", hour, minute, F.lit("00"))
        return self.sample("lineitem").select(
            _text(F.col("l_orderkey")).alias("trip_id"),
            F.col("l_suppkey").alias("stop_id"),
            F.col("l_linenumber").alias("stop_sequence"),
            clock.alias("departure_time"),
        )

    @cached_property
    def predictions(self) -> DataFrame:
        part = F.col("l_partkey")
        return self.sample("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("prediction_id"),
            F.col("l_shipdate").alias("timestamp"),
            _text(F.col("l_suppkey")).alias("stop_id"),
            _text(part % 25).alias("route"),
            (F.col("l_quantity") - 1).cast("int").alias("predicted_passengers_in"),
            (F.col("l_quantity").cast("int") % 7).alias("predicted_passengers_out"),
            F.when(part % 17 != 0, F.concat(F.lit("S"), _text(part))).alias("shape_id"),
            _text(F.col("l_orderkey")).alias("trip_id"),
            _text(F.col("l_linenumber")).alias("stop_sequence"),
            (F.col("l_suppkey") % 25).cast("int").alias("bus_id"),
            _flag(part % 2 == 0).alias("peak_hour"),
            _flag(part % 5 == 0).alias("hospital"),
            _flag(part % 4 == 0).alias("school"),
            F.col("l_returnflag").alias("traffic"),
            part.alias("part"),
            F.col("l_suppkey").alias("supplier"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
        )

    @cached_property
    def model_runs(self) -> DataFrame:
        return self.sample("orders").select(
            F.col("o_orderpriority").alias("name"),
            F.col("o_orderkey").alias("model_key"),
            (F.col("o_totalprice") / 100000).alias("accuracy"),
            F.col("o_orderdate").alias("timestamp"),
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Events as JSON messages. ``level`` is absent in some and null in others; some messages
        are no JSON."""
        event = F.col("event_id")
        level = F.when(event % 5 == 0, "null").otherwise(_text(F.floor("value")))
        value = F.concat(
            F.lit('{"user":"'),
            _text(F.col("user_id")),
            F.lit('","kind":"'),
            F.col("event_type"),
            F.lit('"'),
            F.when(event % 3 != 0, F.concat(F.lit(',"level":'), level)).otherwise(F.lit("")),
            F.lit("}"),
        )
        return self.events.select(
            lookup(F.col("event_type"), TOPIC_OF_EVENT).alias("topic"),
            (F.col("user_id") % 4).cast("int").alias("partition"),
            event.alias("offset"),
            F.when(event % 97 == 0, F.concat(F.lit("not json {"), _text(event)))
            .otherwise(value)
            .alias("value"),
        )

    @cached_property
    def feature_table(self) -> DataFrame:
        return self.features_of(None)

    def features_of(self, only_trips: DataFrame | None) -> DataFrame:
        """The feature table, or its part for some trips."""
        return build_features(
            self.raw_tickets,
            self.raw_sensors,
            self.trips,
            self.traffic,
            self.weather,
            self.city_events,
            only_trips=only_trips,
        )
