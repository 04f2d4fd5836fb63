"""Occupancy and feature queries."""

from pyspark.sql import functions as F

from headway.catalog.registry import query
from headway.catalog.views import ARRIVAL, Views
from headway.functions import times
from headway.operators.asof import asof_backward
from headway.operators.filters import any_row, clean_names, missing_counts
from headway.operators.keyed import duplicate_keys
from headway.plans import features, occupancy
from headway.plans.demand import first_predictions
from headway.sinks.keyindex import scratch_folder
from headway.sinks.tables import append_new_features
from headway.streaming.features import fold_features, read_features, update_features
from headway.streaming.occupancy import current_from_changes, movements, occupancy_changes

_BOARDINGS = """SELECT trip_id, bus_id, route, stop_id, timestamp, count(*) AS passengers_on
FROM raw_tickets GROUP BY ALL"""
_ALIGHTINGS = """SELECT trip_id, bus_id, route, stop_id, timestamp, count(*) AS passengers_off
FROM raw_sensors WHERE status = 1 GROUP BY ALL"""
_BALANCE = f"""SELECT trip_id, bus_id, route, stop_id, timestamp, passengers_on,
  coalesce(passengers_off, 0) AS passengers_off
FROM ({_BOARDINGS}) LEFT JOIN ({_ALIGHTINGS}) USING (trip_id, bus_id, route, stop_id, timestamp)"""
_OCCUPANCY = f"""SELECT bus_id, trip_id, max(timestamp) AS latest_timestamp,
  greatest(sum(passengers_on - passengers_off), 0)::BIGINT AS total_occupancy
FROM ({_BALANCE}) GROUP BY bus_id, trip_id"""


@query(_BOARDINGS, "raw_tickets")
def a1_boarding_counts(v: Views):
    return occupancy.boarding_counts(v.raw_tickets)


@query(_ALIGHTINGS, "raw_sensors")
def a2_alighting_counts(v: Views):
    return occupancy.alighting_counts(v.raw_sensors)


@query(_BALANCE, "raw_tickets", "raw_sensors")
def j1_stop_balance(v: Views):
    return occupancy.stop_balance(v.raw_tickets, v.raw_sensors)


@query(_OCCUPANCY, "raw_tickets", "raw_sensors")
def q1_current_occupancy(v: Views):
    return occupancy.current_occupancy(v.raw_tickets, v.raw_sensors)


@query(
    f"""SELECT bus_id, trip_id, latest_timestamp, total_occupancy, total_capacity,
  round(total_occupancy::DOUBLE / total_capacity * 100, 6) AS occupancy_percentage
FROM ({_OCCUPANCY}) JOIN bus USING (bus_id)""",
    "raw_tickets",
    "raw_sensors",
    "bus",
)
def q2_bus_occupancy(v: Views):
    current = occupancy.current_occupancy(v.raw_tickets, v.raw_sensors)
    return occupancy.bus_occupancy(current, v.bus).withColumn(
        "occupancy_percentage", F.round("occupancy_percentage", 6)
    )


@query(
    """SELECT trip_id, strftime(timestamp, '%Y-%m-%d') AS day, count(fare) AS passengers_in,
  max(school) AS school, max(hospital) AS hospital, max(timestamp) AS timestamp
FROM raw_tickets GROUP BY trip_id, strftime(timestamp, '%Y-%m-%d')""",
    "raw_tickets",
)
def a5_ticket_features(v: Views):
    return features.ticket_features(v.raw_tickets).withColumn("day", F.col("day").cast("string"))


@query(
    """SELECT trip_id, strftime(timestamp, '%Y-%m-%d') AS day, count(status) AS passengers_out,
  max(timestamp) AS timestamp
FROM raw_sensors GROUP BY trip_id, strftime(timestamp, '%Y-%m-%d')""",
    "raw_sensors",
)
def a6_sensor_features(v: Views):
    return features.sensor_features(v.raw_sensors).withColumn("day", F.col("day").cast("string"))


@query(
    """SELECT trip_id, peak_hour FROM raw_tickets
QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY timestamp, peak_hour) = 1""",
    "raw_tickets",
)
def a8_first_peak_hours(v: Views):
    return features.first_peak_hours(v.raw_tickets)


@query(
    """SELECT trip_id, strftime(t.day, '%Y-%m-%d') AS day, t.last AS timestamp, passengers_in,
  passengers_out, peak_hour
FROM (SELECT trip_id, timestamp::DATE AS day, count(fare) AS passengers_in, max(timestamp) AS last
      FROM raw_tickets GROUP BY 1, 2) t
JOIN (SELECT trip_id, timestamp::DATE AS day, count(status) AS passengers_out,
        max(timestamp) AS last FROM raw_sensors GROUP BY 1, 2) s USING (trip_id, day, last)
LEFT JOIN (SELECT trip_id, peak_hour FROM raw_tickets
      QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY timestamp, peak_hour) = 1)
  USING (trip_id)""",
    "raw_tickets",
    "raw_sensors",
)
def j4_trip_days(v: Views):
    return features.trip_days(v.raw_tickets, v.raw_sensors).select(
        "trip_id",
        F.col("day").cast("string").alias("day"),
        "timestamp",
        "passengers_in",
        "passengers_out",
        "peak_hour",
    )


@query(
    """SELECT t.trip_id, t.ticket_id, tr.traffic_level, tr.normal, tr.traffic
FROM raw_tickets t LEFT JOIN trips USING (trip_id)
LEFT JOIN traffic tr ON trips.shape_id IS NOT DISTINCT FROM tr.shape_id
QUALIFY row_number() OVER (PARTITION BY t.ticket_id ORDER BY tr.timestamp, tr.measurement_id) = 1""",
    "raw_tickets",
    "trips",
    "traffic",
)
def j6_trip_traffic(v: Views):
    rows = v.raw_tickets.select("trip_id", "ticket_id")
    return features.trip_traffic(rows, v.trips, v.traffic, ["traffic_level"])


@query(
    """SELECT event_id, temperature, precipitation_probability, weather_code
FROM events ASOF LEFT JOIN weather ON ts >= hour""",
    "weather",
)
def j7_weather_asof(v: Views):
    return asof_backward(
        v.events.select("event_id", "ts"),
        v.weather,
        "ts",
        "hour",
        features.WEATHER_VALUES,
        tie=["measurement_id"],
    ).drop("ts")


@query(
    """SELECT event_id, (EXISTS (SELECT 1 FROM city_events WHERE day_event = ts::DATE))::INTEGER
  AS event_dummy FROM events""",
    "city_events",
)
def j8_event_days(v: Views):
    days = features.event_days(v.city_events)
    return v.events.join(days, F.to_date("ts") == F.col("day_event"), "left").select(
        "event_id", F.col("day_event").isNotNull().cast("int").alias("event_dummy")
    )


def rounded_features(v: Views):
    return v.feature_table.withColumns(
        {name: F.round(name, 6) for name in ("sine_time", "congestion_rate")}
    )


_ROUNDED = """SELECT * REPLACE (round(sine_time, 6) AS sine_time,
  round(congestion_rate, 6) AS congestion_rate) FROM feature_table"""


@query(_ROUNDED, "feature_table")
def q3_feature_table(v: Views):
    return rounded_features(v)


@query(
    """SELECT trip_id_x, timestamp_x, traffic_level, normal, traffic, passengers_in,
  passengers_out, 400 AS total_capacity, seconds_from_midnight
FROM (SELECT t.trip_id AS trip_id_x, t.last AS timestamp_x, tr.traffic_level, tr.normal, tr.traffic,
    passengers_in, passengers_out, tr.timestamp AS traffic_time, tr.measurement_id AS traffic_id,
    (extract(hour FROM t.last) * 3600 + extract(minute FROM t.last) * 60
      + floor(extract(second FROM t.last)))::INTEGER AS seconds_from_midnight
  FROM (SELECT trip_id, timestamp::DATE AS day, count(fare) AS passengers_in,
          max(timestamp) AS last FROM raw_tickets GROUP BY 1, 2) t
  JOIN (SELECT trip_id, timestamp::DATE AS day, count(status) AS passengers_out,
          max(timestamp) AS last FROM raw_sensors GROUP BY 1, 2) s USING (trip_id, day, last)
  LEFT JOIN trips USING (trip_id)
  LEFT JOIN traffic tr ON trips.shape_id IS NOT DISTINCT FROM tr.shape_id)
WHERE traffic_level IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY trip_id_x, timestamp_x
  ORDER BY traffic_time, traffic_id) = 1""",
    "raw_tickets",
    "raw_sensors",
    "trips",
    "traffic",
)
def f1_selected_features(v: Views):
    columns = [
        "trip_id_x",
        "timestamp_x",
        "traffic_level",
        "normal",
        "traffic",
        "passengers_in",
        "passengers_out",
        "total_capacity",
        "seconds_from_midnight",
    ]
    return features.build_features(
        v.raw_tickets, v.raw_sensors, v.trips, v.traffic, v.weather, v.city_events, columns
    )


@query(
    f"""SELECT * FROM ({_ROUNDED}) WHERE school = 0""",
    "feature_table",
)
def k6_new_features(v: Views):
    """The rows with a school are in the table already."""
    table = rounded_features(v)
    return append_new_features(table, table.filter("school = 1"))


@query(_ROUNDED, "feature_table")
def k6_features_in_steps(v: Views):
    """What the stream does: three batches of facts that share trips and days, in no order of time,
    the first two folded; the same rows as from all facts at once."""
    folder = scratch_folder(v.spark)
    for n in range(3):
        tickets = v.raw_tickets.filter(F.col("ticket_id").cast("long") % 3 == n)
        sensors = v.raw_sensors.filter(F.col("measurement_id").cast("long") % 5 % 3 == n)
        others = (v.trips, v.traffic, v.weather, v.city_events)
        update_features(v.spark, folder, n, tickets, sensors, *others)
        if n == 1:
            fold_features(v.spark, folder, 1)
    found = read_features(v.spark, folder)
    return found.withColumns({c: F.round(c, 6) for c in ("sine_time", "congestion_rate")})


@query(
    """SELECT prediction_id, count(*) AS copies FROM predictions GROUP BY prediction_id
HAVING count(*) > 1""",
    "predictions",
)
def k7_duplicate_keys(v: Views):
    return duplicate_keys(v.predictions, ["prediction_id"])


@query(
    """SELECT event_id,
  (extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
    + floor(extract(second FROM ts)))::INTEGER AS seconds,
  round(sin(2 * pi() * (extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
    + floor(extract(second FROM ts))) / 86400), 6) AS sine_time,
  isodow(ts) >= 6 AS weekend,
  date_trunc('second', ts)::TIME BETWEEN TIME '07:00:00' AND TIME '09:00:00'
    OR date_trunc('second', ts)::TIME BETWEEN TIME '16:00:00' AND TIME '18:00:00' AS peak_data,
  hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 AS peak_forecast,
  hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 16 AND 18 AS peak_form,
  date_trunc('hour', ts)::TIMESTAMP AS hour
FROM events"""
)
def c1_time_features(v: Views):
    ts = F.col("ts")
    return v.events.select(
        "event_id",
        times.seconds_of_day(ts).alias("seconds"),
        F.round(times.sine_time(ts), 6).alias("sine_time"),
        times.is_weekend(ts).alias("weekend"),
        *[times.is_peak(ts, rule).alias(f"peak_{rule}") for rule in ("data", "forecast", "form")],
        times.hour_start(ts).alias("hour"),
    )


@query(
    """SELECT count(*) FILTER (level IS NULL) AS level, count(*) FILTER (kind IS NULL) AS kind
FROM messages""",
    "messages",
)
def f11_missing_counts(v: Views):
    value = F.when(F.col("event_id") % 5 != 0, F.floor("value"))
    return missing_counts(v.events.select(value.alias("level"), F.col("event_type").alias("kind")))


@query("SELECT * FROM first_predictions", "first_predictions")
def d1_first_predictions(v: Views):
    return first_predictions(v.predictions, ARRIVAL)


@query(_OCCUPANCY, "raw_tickets", "raw_sensors")
def x2_occupancy_in_two_steps(v: Views):
    """What the stream does, on two halves of the facts that share stops and days."""

    def counts(half: int):
        tickets = v.raw_tickets.filter(F.col("ticket_id").cast("long") % 3 % 2 == half)
        sensors = v.raw_sensors.filter(F.col("measurement_id").cast("long") % 3 % 2 == half)
        moves = movements(tickets, sensors).groupBy(*occupancy.STOP_KEY)
        summed = moves.agg(F.sum("on").alias("on"), F.sum("off").alias("off"))
        return summed.withColumn("day", F.to_date("timestamp"))

    first, second = counts(0), counts(1)
    changes = occupancy_changes(first, first.limit(0)).union(occupancy_changes(second, first))
    return current_from_changes(changes)


@query("SELECT count(*) > 0 AS found FROM events WHERE value > 10 HAVING count(*) > 0")
def a19_any_row(v: Views):
    return any_row(v.events, F.col("value") > 10)


@query(
    """SELECT event_id AS "event id", event_type AS kind FROM events WHERE event_type = 'error'"""
)
def f12_clean_names(v: Views):
    odd = v.events.filter("event_type = 'error'").select(
        F.col("event_id").alias(' "event id" '), F.col("event_type").alias("' kind'")
    )
    return clean_names(odd)
