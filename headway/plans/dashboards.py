"""Reports on congestion, routes and traffic (Q5-Q9, Q16)."""

from collections.abc import Sequence
from datetime import date, time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway import constants as K
from headway.functions.bands import congestion_color, traffic_code
from headway.functions.texts import hour_interval, long_date, route_label
from headway.functions.times import between_times, hour_spine, hour_start
from headway.operators.expand import melt
from headway.operators.filters import filter_choices
from headway.operators.islands import consecutive_blocks
from headway.operators.keyed import first_per_key

HOURS = list(range(24))


def trip_routes(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Trips with the names of their route: the two dimensions meet before any fact table."""
    return trips.select("trip_id", "route_id", "shape_id").join(
        routes.select("route_id", "route_short_name", "route_long_name"), "route_id"
    )


def _with_route(features: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """J9."""
    named = trip_routes(trips, routes).select(F.col("trip_id").alias("trip_id_x"), "route_short_name")
    return features.join(named, "trip_id_x")


# Congestion (Q5, Q6)


def congestion_by_route(features: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Q5: complete (time, congestion, traffic, route) rows."""
    return (
        _with_route(features.filter(F.col("congestion_rate").isNotNull()), trips, routes)
        .select("timestamp_x", "congestion_rate", "traffic_level", "route_short_name")
        .dropna()
    )


def traffic_by_route(features: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """K5: the traffic table. It has its own name: under the name of the congestion table each
    refresh would replace the other's columns."""
    return (
        _with_route(features, trips, routes)
        .select("timestamp_x", "traffic_level", "route_short_name")
        .dropna()
    )


def route_dates(congestion: DataFrame) -> DataFrame:
    """The dates each route has rows for."""
    return congestion.select("route_short_name", F.to_date("timestamp_x").alias("day")).distinct()


def hourly_congestion(congestion: DataFrame) -> DataFrame:
    """Mean congestion by route, date and hour."""
    ts = F.col("timestamp_x")
    return congestion.groupBy(
        "route_short_name", F.to_date(ts).alias("day"), F.hour(ts).alias("hour")
    ).agg(F.avg("congestion_rate").alias("congestion_rate"))


def suggest_buses(hourly: DataFrame, threshold: float = K.CONGESTED_HOUR_MEAN) -> DataFrame:
    """Q6: one bus for every unbroken block of hours above the threshold."""
    busy = hourly.filter(F.col("congestion_rate") > threshold)
    blocks = consecutive_blocks(busy, ["route_short_name", "day"], "hour")
    return blocks.select(
        "route_short_name",
        "day",
        long_date(F.col("day")).alias("date"),
        "first_hour",
        hour_interval(F.col("first_hour"), F.col("last_hour")).alias("time_interval"),
        F.lit(1).alias("suggested_buses"),
        F.lit(f"Avg. congestion > {threshold}").alias("reason"),
    )


# Route map (Q7)


def map_trips(trips: DataFrame, routes: DataFrame, route: str | None = None) -> DataFrame:
    """L3: one trip with a shape per route; the first by route id, trip id and shape."""
    with_shape = trip_routes(trips.filter(F.col("shape_id").isNotNull()), routes)
    return first_per_key(
        filter_choices(with_shape, route_short_name=route),
        ["route_short_name"],
        ["route_id", "trip_id", "shape_id"],
    )


def latest_congestion(features: DataFrame) -> DataFrame:
    """Congestion of the last row of every trip that has one."""
    last = F.max(F.struct("timestamp_x", "congestion_rate"))
    return (
        features.filter(F.col("congestion_rate").isNotNull())
        .groupBy("trip_id_x")
        .agg(last["congestion_rate"].alias("congestion_rate"))
    )


def route_map(
    routes: DataFrame,
    trips: DataFrame,
    shapes: DataFrame,
    stop_times: DataFrame,
    stops: DataFrame,
    features: DataFrame,
    route: str | None = None,
) -> DataFrame:
    """Q7: shape points and stops of the map trip of a route, or of all routes."""
    chosen = map_trips(trips, routes, route).select("route_short_name", "trip_id", "shape_id")
    shown = chosen.select(F.col("trip_id").alias("trip_id_x"))
    latest = latest_congestion(features.join(shown, "trip_id_x", "left_semi"))
    points = (
        chosen.join(latest.withColumnRenamed("trip_id_x", "trip_id"), "trip_id", "left")
        .join(shapes, "shape_id")
        .select(
            "route_short_name",
            F.col("shape_pt_lat").alias("lat"),
            F.col("shape_pt_lon").alias("lon"),
            F.col("shape_pt_sequence").cast("int").alias("sequence"),
            F.lit(None).cast("string").alias("stop_id"),
            F.lit(None).cast("string").alias("stop_name"),
            F.lit("route").alias("point_type"),
            F.coalesce("congestion_rate", F.lit(K.DEFAULT_CONGESTION)).alias("congestion_rate"),
        )
    )
    halts = (
        chosen.join(stop_times.select("trip_id", "stop_id", "stop_sequence"), "trip_id")
        .join(stops.select("stop_id", "stop_name", "stop_lat", "stop_lon"), "stop_id")
        .select(
            "route_short_name",
            F.col("stop_lat").alias("lat"),
            F.col("stop_lon").alias("lon"),
            F.col("stop_sequence").cast("int").alias("sequence"),
            F.col("stop_id").cast("string").alias("stop_id"),
            "stop_name",
            F.lit("stop").alias("point_type"),
            F.lit(None).cast("double").alias("congestion_rate"),
        )
    )
    return points.unionByName(halts)


def in_map_order(points: DataFrame) -> DataFrame:
    """L2: by sequence; a shape point comes before a stop of the same number."""
    return points.orderBy("route_short_name", "sequence", "point_type", "lat", "lon")


def path_segments(points: DataFrame) -> DataFrame:
    """A segment from every shape point to the next, in the colour of its first point."""
    along = Window.partitionBy("route_short_name").orderBy("sequence", "lat", "lon")
    return (
        points.filter(F.col("point_type") == "route")
        .withColumn("to_lat", F.lead("lat").over(along))
        .withColumn("to_lon", F.lead("lon").over(along))
        .filter(F.col("to_lat").isNotNull())
        .select(
            "route_short_name",
            "sequence",
            F.array(F.array("lon", "lat"), F.array("to_lon", "to_lat")).alias("path"),
            congestion_color(F.col("congestion_rate")).alias("color"),
        )
    )


def path_so_far(points: DataFrame, sequence: int) -> DataFrame:
    """Shape points up to a position."""
    return points.filter((F.col("point_type") == "route") & (F.col("sequence") <= sequence))


# Passenger flow (Q8)


def hourly_counts(
    tickets: DataFrame,
    sensors: DataFrame,
    day: date,
    start: time,
    end: time,
    route: str | None = None,
    stop: str | None = None,
) -> DataFrame:
    """Boardings and alightings per hour, both tables in one aggregation."""
    columns = ["timestamp", "route", "stop_id"]
    active = sensors.filter(F.col("status") == K.SENSOR_ACTIVE)
    rows = tickets.select(*columns, F.lit(1).alias("on"), F.lit(0).alias("off")).union(
        active.select(*columns, F.lit(0).alias("on"), F.lit(1).alias("off"))
    )
    chosen = filter_choices(
        rows.filter(between_times(F.col("timestamp"), day, start, end)), route=route, stop_id=stop
    )
    return chosen.groupBy(hour_start(F.col("timestamp")).alias("hour")).agg(
        F.sum("on").alias("passengers_boarding"), F.sum("off").alias("passengers_alighting")
    )


def passenger_flow(
    tickets: DataFrame,
    sensors: DataFrame,
    day: date,
    start: time = time(6),
    end: time = time(22),
    route: str | None = None,
    stop: str | None = None,
) -> DataFrame:
    """Q8: every hour of the range with its counts; hours without rows have zeros."""
    spark = tickets.sparkSession
    spine = spark.range(1).select(F.explode(hour_spine(day, start, end)).alias("hour"))
    counts = hourly_counts(tickets, sensors, day, start, end, route, stop)
    return spine.join(counts, "hour", "left").fillna(0)


def flow_by_type(flow: DataFrame) -> DataFrame:
    """The flow with one row per hour and direction."""
    labels = {"passengers_boarding": "Boarding", "passengers_alighting": "Alighting"}
    return melt(flow, ["hour"], labels, "type", "passengers")


def flow_totals(flow: DataFrame) -> DataFrame:
    """Total and mean per direction."""
    return (
        flow_by_type(flow)
        .groupBy("type")
        .agg(F.sum("passengers").alias("total"), F.avg("passengers").alias("mean"))
    )


def flow_choices(tickets: DataFrame) -> DataFrame:
    """Routes and stops that can be chosen, in one pass over the tickets."""
    return (
        tickets.select(
            F.explode(
                F.array(
                    F.struct(F.lit("route").alias("choice"), F.col("route").alias("name")),
                    F.struct(F.lit("stop_id").alias("choice"), F.col("stop_id").alias("name")),
                )
            ).alias("option")
        )
        .select("option.*")
        .distinct()
    )


# Traffic (Q9)


def with_traffic_code(traffic: DataFrame) -> DataFrame:
    return traffic.withColumn("traffic_level", traffic_code(F.col("traffic_level")))


def traffic_by_hour(traffic: DataFrame) -> DataFrame:
    """A10: mean traffic code by route and hour of day."""
    return (
        with_traffic_code(traffic)
        .groupBy("route_short_name", F.hour("timestamp_x").alias("hour"))
        .agg(F.avg("traffic_level").alias("traffic_level"))
    )


def traffic_heatmap(traffic: DataFrame) -> DataFrame:
    """One row per route, one column per hour; the hours are known, so none are looked up."""
    return (
        traffic_by_hour(traffic)
        .groupBy("route_short_name")
        .pivot("hour", HOURS)
        .agg(F.first("traffic_level"))
    )


def traffic_trend(traffic: DataFrame, routes: Sequence[str] | None = None) -> DataFrame:
    """Mean traffic code by route and hour of the calendar."""
    if routes is not None:
        traffic = traffic.filter(F.col("route_short_name").isin(list(routes)))
    return (
        with_traffic_code(traffic)
        .groupBy("route_short_name", hour_start(F.col("timestamp_x")).alias("timestamp_hour"))
        .agg(F.avg("traffic_level").alias("traffic_level"))
    )


def route_traffic(traffic: DataFrame, newest: bool = False) -> DataFrame:
    """One traffic code per route.

    The report called "latest" shows the oldest known code, because it takes the last of rows
    sorted newest first; that is the default here. ``newest`` gives what the name says.
    """
    known = with_traffic_code(traffic).filter(F.col("traffic_level").isNotNull())
    pick = F.max if newest else F.min
    return known.groupBy("route_short_name").agg(
        pick(F.struct("timestamp_x", "traffic_level"))["traffic_level"].alias("traffic_level")
    )


def traffic_alerts(
    traffic: DataFrame, newest: bool = False, threshold: float = K.TRAFFIC_ALERT_LEVEL
) -> DataFrame:
    return route_traffic(traffic, newest).filter(F.col("traffic_level") > threshold)


# Choices (Q16)


def route_options(routes: DataFrame, trips: DataFrame, features: DataFrame) -> DataFrame:
    """Routes with feature rows; all routes with trips where no route has any. Whether any has
    is found in the same pass, over one row per route."""
    used = features.select(F.col("trip_id_x").alias("trip_id")).distinct()
    options = (
        trip_routes(trips, routes)
        .join(used.withColumn("used", F.lit(True)), "trip_id", "left")
        .groupBy("route_short_name", "route_long_name")
        .agg(F.coalesce(F.bool_or("used"), F.lit(False)).alias("used"))
    )
    gathered = options.agg(
        F.collect_list(F.struct("*")).alias("options"), F.bool_or("used").alias("any_used")
    )
    each = gathered.select("any_used", F.explode("options").alias("option"))
    return each.filter(F.col("option.used") | ~F.col("any_used")).select(
        "option.route_short_name",
        route_label(F.col("option.route_short_name"), F.col("option.route_long_name")).alias("label"),
    )


def location_features(routes: DataFrame, trips: DataFrame, features: DataFrame) -> DataFrame:
    """School and hospital flag of every route; of several pairs the greatest, else false."""
    pairs = _route_ends(features, trips, routes)
    return (
        routes.select("route_short_name")
        .distinct()
        .join(pairs, "route_short_name", "left")
        .select("route_short_name", _flag("school"), _flag("hospital"))
    )


def forecast_starts(routes: DataFrame, trips: DataFrame, features: DataFrame) -> DataFrame:
    """The flags and the last complete moment of every route that has one, in one pass over
    the feature table."""
    ends = _route_ends(features, trips, routes).filter(F.col("last").isNotNull())
    named = ends.filter(F.col("route_short_name").isNotNull())
    return named.select("route_short_name", _flag("school"), _flag("hospital"), "last")


def _flag(name: str) -> Column:
    return F.coalesce(F.col(f"pair.{name}").cast("boolean"), F.lit(False)).alias(name)


def _route_ends(features: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """The greatest pair of flags and the last complete moment of every route."""
    complete = F.col("congestion_rate").isNotNull() & F.col("traffic_level").isNotNull()
    read = ["trip_id_x", "timestamp_x", "school", "hospital", "congestion_rate", "traffic_level"]
    return (
        _with_route(features.select(*read), trips, routes)
        .groupBy("route_short_name")
        .agg(
            F.max(F.struct("school", "hospital")).alias("pair"),
            F.max(F.when(complete, F.col("timestamp_x"))).alias("last"),
        )
    )
