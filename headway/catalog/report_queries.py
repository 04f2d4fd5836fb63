"""Dashboard queries."""

from datetime import date, time

from pyspark.sql import functions as F

from headway.catalog.registry import query
from headway.catalog.sql_views import code_sql
from headway.catalog.views import Views
from headway.plans import dashboards as d

# The sample congestion rates are far below one; this threshold lets some hours through.
THRESHOLD = 0.0051


def congestion(v: Views):
    return d.congestion_by_route(v.feature_table, v.trips, v.routes)


def traffic(v: Views):
    return d.traffic_by_route(v.feature_table, v.trips, v.routes)


def _text_day(df):
    return df.withColumn("day", F.col("day").cast("string"))


@query(
    "SELECT * REPLACE (round(congestion_rate, 6) AS congestion_rate) FROM congestion", "congestion"
)
def q5_congestion_by_route(v: Views):
    return congestion(v).withColumn("congestion_rate", F.round("congestion_rate", 6))


@query("SELECT timestamp_x, traffic_level, route_short_name FROM congestion", "congestion")
def k5_traffic_by_route(v: Views):
    return traffic(v)


@query(
    """SELECT DISTINCT route_short_name, strftime(timestamp_x, '%Y-%m-%d') AS day
FROM congestion""",
    "congestion",
)
def a17_route_dates(v: Views):
    return _text_day(d.route_dates(congestion(v)))


@query(
    """SELECT route_short_name, strftime(day, '%Y-%m-%d') AS day, hour,
  round(congestion_rate, 6) AS congestion_rate FROM hourly""",
    "hourly",
)
def a9_hourly_congestion(v: Views):
    hourly = d.hourly_congestion(congestion(v))
    return _text_day(hourly).withColumn("congestion_rate", F.round("congestion_rate", 6))


@query(
    f"""SELECT route_short_name, strftime(day, '%Y-%m-%d') AS day,
  strftime(day, '%A, %d %B %Y') AS date, min(hour) AS first_hour,
  min(hour)::VARCHAR || ':00 - ' || (max(hour) + 1)::VARCHAR || ':00' AS time_interval,
  1 AS suggested_buses, 'Avg. congestion > {THRESHOLD}' AS reason
FROM (SELECT *, hour - row_number() OVER (PARTITION BY route_short_name, day ORDER BY hour) AS run
      FROM hourly WHERE congestion_rate > {THRESHOLD}::DOUBLE)
GROUP BY route_short_name, day, run""",
    "hourly",
)
def q6_suggested_buses(v: Views):
    return _text_day(d.suggest_buses(d.hourly_congestion(congestion(v)), THRESHOLD))


@query("SELECT route_short_name, trip_id, shape_id FROM map_trips", "map_trips")
def l3_map_trips(v: Views):
    return d.map_trips(v.trips, v.routes).select("route_short_name", "trip_id", "shape_id")


@query(
    "SELECT trip_id_x, round(congestion_rate, 6) AS congestion_rate FROM latest_congestion",
    "latest_congestion",
)
def w1_latest_congestion(v: Views):
    return d.latest_congestion(v.feature_table).withColumn(
        "congestion_rate", F.round("congestion_rate", 6)
    )


def route_points(v: Views, route=None):
    features = v.features_of(d.map_trips(v.trips, v.routes, route))
    return d.route_map(v.routes, v.trips, v.shapes, v.stop_times, v.stops, features, route)


_POINTS = """SELECT route_short_name, round(lat, 6) AS lat, round(lon, 6) AS lon, sequence, stop_id,
  stop_name, point_type, round(congestion_rate, 6) AS congestion_rate FROM route_points"""


def _rounded_points(points):
    return points.withColumns({n: F.round(n, 6) for n in ("lat", "lon", "congestion_rate")})


@query(_POINTS, "route_points")
def q7_route_maps(v: Views):
    return _rounded_points(route_points(v))


@query(f"{_POINTS} WHERE route_short_name = '7' ORDER BY sequence, point_type", "route_points")
def q7_route_map(v: Views):
    return d.in_map_order(_rounded_points(route_points(v, "7")))


@query(
    """SELECT route_short_name, sequence, round(lon, 6) AS from_lon, round(lat, 6) AS from_lat,
  round(to_lon, 6) AS to_lon, round(to_lat, 6) AS to_lat,
  CASE WHEN congestion_rate >= 7e-1 THEN '255,0,0' WHEN congestion_rate >= 4e-1 THEN '255,255,0'
    ELSE '0,255,0' END AS color
FROM (SELECT *, lead(lat) OVER w AS to_lat, lead(lon) OVER w AS to_lon FROM route_points
      WHERE point_type = 'route'
      WINDOW w AS (PARTITION BY route_short_name ORDER BY sequence, lat, lon))
WHERE to_lat IS NOT NULL""",
    "route_points",
)
def w5_path_segments(v: Views):
    path = F.col("path")
    return d.path_segments(route_points(v)).select(
        "route_short_name",
        "sequence",
        F.round(path[0][0], 6).alias("from_lon"),
        F.round(path[0][1], 6).alias("from_lat"),
        F.round(path[1][0], 6).alias("to_lon"),
        F.round(path[1][1], 6).alias("to_lat"),
        F.array_join(F.col("color").cast("array<string>"), ",").alias("color"),
    )


@query(
    f"{_POINTS} WHERE point_type = 'route' AND sequence <= 10",
    "route_points",
)
def w6_path_so_far(v: Views):
    return _rounded_points(d.path_so_far(route_points(v), 10))


DAY = date(2024, 1, 3)


def _flow_sql(route: str = "", start: int = 6, end: int = 22) -> str:
    def counts(table, name, extra=""):
        return f"""(SELECT date_trunc('hour', timestamp)::TIMESTAMP AS hour, count(*) AS {name}
  FROM {table} WHERE timestamp::DATE = DATE '2024-01-03'
    AND timestamp::TIME BETWEEN TIME '{start:02d}:00:00' AND TIME '{end:02d}:00:00' {extra} {route}
  GROUP BY 1)"""

    return f"""SELECT hour, coalesce(passengers_boarding, 0) AS passengers_boarding,
  coalesce(passengers_alighting, 0) AS passengers_alighting
FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-03 {start:02d}:00:00',
        TIMESTAMP '2024-01-03 {end:02d}:00:00', INTERVAL 1 HOUR)) AS hour)
LEFT JOIN {counts("raw_tickets", "passengers_boarding")} USING (hour)
LEFT JOIN {counts("raw_sensors", "passengers_alighting", "AND status = 1")} USING (hour)"""


@query(_flow_sql(), "raw_tickets", "raw_sensors")
def q8_passenger_flow(v: Views):
    return d.passenger_flow(v.raw_tickets, v.raw_sensors, DAY)


@query(_flow_sql("AND route = '7' AND stop_id = '1'", 0, 23), "raw_tickets", "raw_sensors")
def f5_flow_of_stop(v: Views):
    return d.passenger_flow(
        v.raw_tickets, v.raw_sensors, DAY, time(0), time(23), route="7", stop="1"
    )


@query(
    f"""SELECT hour, 'Boarding' AS type, passengers_boarding AS passengers FROM ({_flow_sql()})
UNION ALL
SELECT hour, 'Alighting', passengers_alighting FROM ({_flow_sql()})""",
    "raw_tickets",
    "raw_sensors",
)
def u3_flow_by_type(v: Views):
    return d.flow_by_type(d.passenger_flow(v.raw_tickets, v.raw_sensors, DAY))


@query(
    f"""SELECT 'Boarding' AS type, sum(passengers_boarding)::BIGINT AS total,
  round(avg(passengers_boarding), 6) AS mean FROM ({_flow_sql()})
UNION ALL
SELECT 'Alighting', sum(passengers_alighting)::BIGINT, round(avg(passengers_alighting), 6)
FROM ({_flow_sql()})""",
    "raw_tickets",
    "raw_sensors",
)
def a15_flow_totals(v: Views):
    flow = d.passenger_flow(v.raw_tickets, v.raw_sensors, DAY)
    return d.flow_totals(flow).withColumn("mean", F.round("mean", 6))


@query(
    """SELECT DISTINCT 'route' AS choice, route AS name FROM raw_tickets
UNION ALL SELECT DISTINCT 'stop_id', stop_id FROM raw_tickets""",
    "raw_tickets",
)
def a17_flow_choices(v: Views):
    return d.flow_choices(v.raw_tickets)


@query("SELECT max(bus_id) AS max_bus_id FROM bus", "bus")
def a17_max_bus(v: Views):
    return v.bus.agg(F.max("bus_id").alias("max_bus_id"))


_CODED = f"SELECT *, {code_sql('traffic_level')} AS code FROM congestion"


@query(
    f"""SELECT route_short_name, extract(hour FROM timestamp_x)::INTEGER AS hour,
  round(avg(code), 6) AS traffic_level FROM ({_CODED}) GROUP BY 1, 2""",
    "congestion",
)
def a10_traffic_by_hour(v: Views):
    return d.traffic_by_hour(traffic(v)).withColumn(
        "traffic_level", F.round("traffic_level", 6)
    )


_HOUR_COLUMNS = ", ".join(
    f'round(avg(code) FILTER (extract(hour FROM timestamp_x) = {h}), 6) AS "h{h}"' for h in d.HOURS
)


@query(
    f"SELECT route_short_name, {_HOUR_COLUMNS} FROM ({_CODED}) GROUP BY route_short_name",
    "congestion",
)
def a11_traffic_heatmap(v: Views):
    heatmap = d.traffic_heatmap(traffic(v))
    return heatmap.select(
        "route_short_name", *[F.round(str(h), 6).alias(f"h{h}") for h in d.HOURS]
    )


@query(
    f"""SELECT route_short_name, date_trunc('hour', timestamp_x)::TIMESTAMP AS timestamp_hour,
  round(avg(code), 6) AS traffic_level FROM ({_CODED})
WHERE route_short_name IN ('1', '2', '3', '5', '8', '13') GROUP BY 1, 2""",
    "congestion",
)
def a12_traffic_trend(v: Views):
    trend = d.traffic_trend(traffic(v), ["1", "2", "3", "5", "8", "13"])
    return trend.withColumn("traffic_level", F.round("traffic_level", 6))


def _alerts_sql(direction: str) -> str:
    return f"""SELECT route_short_name, code AS traffic_level
FROM (SELECT * FROM ({_CODED}) WHERE code IS NOT NULL QUALIFY row_number() OVER (
  PARTITION BY route_short_name ORDER BY timestamp_x {direction}, code {direction}) = 1)
WHERE code > 8e-1"""


@query(_alerts_sql(""), "congestion")
def a13_traffic_alerts(v: Views):
    return d.traffic_alerts(traffic(v))


@query(_alerts_sql("DESC"), "congestion")
def a13_newest_traffic_alerts(v: Views):
    return d.traffic_alerts(traffic(v), newest=True)


_OPTIONS = """SELECT DISTINCT route_short_name, route_short_name || ' - ' || route_long_name AS label
FROM routes JOIN trips USING (route_id)"""


@query(
    f"{_OPTIONS} WHERE trip_id IN (SELECT trip_id_x FROM feature_table)",
    "routes",
    "trips",
    "feature_table",
)
def j10_route_options(v: Views):
    return d.route_options(v.routes, v.trips, v.feature_table)


@query(_OPTIONS, "routes", "trips")
def j10_route_options_without_features(v: Views):
    return d.route_options(v.routes, v.trips, v.feature_table.filter("peak_hour > 1"))


@query(
    """SELECT r.route_short_name, coalesce(p.school = 1, false) AS school,
  coalesce(p.hospital = 1, false) AS hospital
FROM (SELECT DISTINCT route_short_name FROM routes) r
LEFT JOIN (SELECT route_short_name, f.school, f.hospital FROM feature_table f
    JOIN trips t ON f.trip_id_x = t.trip_id JOIN routes USING (route_id)
    QUALIFY row_number() OVER (PARTITION BY route_short_name
      ORDER BY f.school DESC, f.hospital DESC) = 1) p
  ON r.route_short_name = p.route_short_name""",
    "routes",
    "trips",
    "feature_table",
)
def j13_location_features(v: Views):
    return d.location_features(v.routes, v.trips, v.feature_table)
