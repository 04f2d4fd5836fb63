"""Message, merge, demand, geometry, traffic and weather queries."""

from datetime import date

from pyspark.sql import functions as F

from headway.catalog.registry import query
from headway.catalog.sql_views import level_sql
from headway.catalog.views import ARRIVAL, Views
from headway.functions import texts, times
from headway.functions.bands import traffic_code
from headway.operators import merge
from headway.operators.expand import dated_schedule, explode_arrays
from headway.operators.filters import split_required
from headway.operators.sampling import sample_by_gap
from headway.plans import demand, tracks, weather
from headway.plans import traffic as traffic_plan
from headway.schemas import TICKET_MESSAGE, schema
from headway.sinks.keyindex import add_keys, first_ever, fold_keys, scratch_folder
from headway.sinks.tables import (
    BATCH,
    missing_rows,
    prediction_log,
    read_parts,
    to_messages,
    write_part,
)
from headway.sources import messages as m

FIRSTS = schema(f"trip_id string, prediction_id long, {BATCH} int")

# Messages


@query(
    """SELECT ticket_id, timestamp, stop_id, route, passenger_type, fare, bus_id, trip_id,
  peak_hour, hospital, school FROM raw_tickets""",
    "raw_tickets",
)
def s1_parsed_messages(v: Views):
    sent = v.raw_tickets.withColumn("timestamp", texts.iso_text(F.col("timestamp")))
    return m.parse_messages(to_messages(sent, "ticketing.topic"), TICKET_MESSAGE)


@query(
    """SELECT event_id, CASE WHEN event_id % 7 = 1 THEN ts - INTERVAL 2 HOUR
  WHEN event_id % 7 <> 0 THEN ts END AS timestamp FROM events"""
)
def s3_ingested_times(v: Views):
    kind, plain = F.col("event_id") % 7, F.col("ts").cast("string")
    text = (
        F.when(kind == 0, "soon")
        .when(kind == 1, F.concat(plain, F.lit("+02:00")))
        .when(kind == 2, F.concat(plain, F.lit("Z")))
        .otherwise(plain)
    )
    return v.events.select("event_id", times.parse_timestamp(text).alias("timestamp"))


@query(
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts)::TIMESTAMP
  WHEN 1 THEN date_trunc('second', ts)::TIMESTAMP END AS timestamp FROM events"""
)
def s4_parsed_times(v: Views):
    """Among the unreadable ones: digits as a text, a number beyond all dates, a truth value."""
    quoted = F.format_string('"%s"', texts.iso_text(F.col("ts")))
    seconds = F.timestamp_diff("SECOND", times.moment(times.EPOCH), F.col("ts"))
    unreadable = F.array(*[F.lit(x) for x in ('"2025"', "9999999999999999", "true", '"noon"')])
    json = (
        F.when(F.col("event_id") % 3 == 0, quoted)
        .when(F.col("event_id") % 3 == 1, seconds.cast("string"))
        .otherwise(unreadable[(F.floor(F.col("event_id") / 3) % 4).cast("int")])
    )
    parsed = times.parse_time(F.try_parse_json(json))
    return v.events.select("event_id", parsed.alias("timestamp"))


@query(
    """SELECT topic, "offset", CASE topic WHEN 'sensors.topic' THEN 'sensors'
    WHEN 'gps.topic' THEN 'gps' WHEN 'ticketing.topic' THEN 'tickets' ELSE 'passengers' END
    AS collection,
  CASE topic WHEN 'ticketing.topic' THEN 'ticket_id'
    WHEN 'bus.passenger.predictions' THEN 'prediction_id' ELSE 'measurement_id' END AS unique_field
FROM messages WHERE topic <> 'other.topic'""",
    "messages",
)
def s7_routed_messages(v: Views):
    return m.route_topics(v.messages).select("topic", "offset", "collection", "unique_field")


@query(
    """SELECT topic, "offset" FROM messages WHERE "offset" > 500 ORDER BY "offset" LIMIT 10""",
    "messages",
)
def s9_message_page(v: Views):
    cursor = v.messages.select("topic", "partition").distinct().withColumn("offset", F.lit(500))
    return m.read_page(v.messages, cursor, limit=10).select("topic", "offset")


@query(
    """SELECT topic, partition, "offset" FROM (
  SELECT topic, (event % 4)::INTEGER AS partition, event // 4 AS "offset" FROM (
    SELECT *, "offset" AS event FROM messages WHERE topic = 'gps.topic'))
WHERE "offset" > CASE partition WHEN 0 THEN 40 WHEN 1 THEN 90 WHEN 2 THEN 20 ELSE -1 END
ORDER BY "offset", partition LIMIT 25 OFFSET 25""",
    "messages",
)
def s9_page_over_partitions(v: Views):
    """The second page of a topic whose partitions repeat each other's offsets; one is not yet read."""
    event = F.col("offset")
    messages = v.messages.filter("topic = 'gps.topic'").select(
        "topic", (event % 4).cast("int").alias("partition"), F.floor(event / 4).alias("offset")
    )
    places = messages.select("topic", "partition").distinct().filter("partition < 3")
    read = F.when(F.col("partition") == 0, 40).when(F.col("partition") == 1, 90).otherwise(20)
    cursor = places.withColumn("offset", read.cast("long"))
    first = m.read_page(messages, cursor, limit=25)
    return m.read_page(messages, m.next_cursor(first, cursor), limit=25)


@query(
    """SELECT "offset", topic FROM messages QUALIFY row_number() OVER (ORDER BY "offset" DESC) <= 100
ORDER BY "offset" """,
    "messages",
)
def l1_recent_messages(v: Views):
    return m.recent_messages(v.messages, ["offset"]).select("offset", "topic")


@query(
    """SELECT prediction_id, timestamp FROM (SELECT * FROM predictions
  QUALIFY row_number() OVER (ORDER BY prediction_id DESC, part DESC, price DESC) <= 100)
WHERE route = '7'""",
    "predictions",
)
def f2_recent_for_route(v: Views):
    order = ["prediction_id", "part", "price"]
    return m.recent_for_route(v.predictions, "7", order).select("prediction_id", "timestamp")


_MESSAGE_FIELDS = schema("user string, kind string, level int")


@query(
    'SELECT "offset", "user", kind, CASE WHEN has_level THEN level::INTEGER END AS level '
    "FROM messages WHERE is_json",
    "messages",
)
def x8_decoded_messages(v: Views):
    return m.parse_messages(v.messages, _MESSAGE_FIELDS, ["offset"])


@query(
    """SELECT "offset", 'not json {' || "offset"::VARCHAR AS value FROM messages WHERE NOT is_json""",
    "messages",
)
def x8_rejected_messages(v: Views):
    return m.split_messages(v.messages, _MESSAGE_FIELDS)[1].select("offset", "value")


@query(
    """SELECT prediction_id, part FROM predictions WHERE shape_id IS NULL""",
    "predictions",
)
def f9_rejected_predictions(v: Views):
    return split_required(v.predictions, ["shape_id"])[1].select("prediction_id", "part")


# Merges


@query(
    """SELECT prediction_id, route, price FROM first_predictions
WHERE prediction_id NOT IN (SELECT prediction_id FROM predictions WHERE traffic = 'R')""",
    "predictions",
    "first_predictions",
)
def k2_inserted_if_absent(v: Views):
    existing = v.predictions.filter("traffic = 'R'").select("prediction_id")
    fresh = merge.insert_if_absent(v.predictions, existing, "prediction_id", ARRIVAL)
    return fresh.select("prediction_id", "route", "price")


@query(
    """SELECT * REPLACE (timestamp + INTERVAL 90 DAY AS timestamp) FROM first_predictions
WHERE prediction_id NOT IN (SELECT prediction_id FROM predictions WHERE traffic = 'R')""",
    "predictions",
    "first_predictions",
)
def k2_known_at_other_times(v: Views):
    """Whole new rows; known keys come again months after the times that the table has them at."""
    later = v.predictions.withColumn("timestamp", F.col("timestamp") + F.expr("interval 90 days"))
    return missing_rows(later, v.predictions.filter("traffic = 'R'"), "prediction_id", ARRIVAL)


@query(
    """SELECT trip_id, prediction_id FROM predictions QUALIFY row_number() OVER (PARTITION BY trip_id
  ORDER BY timestamp, part, supplier, quantity, price) = 1""",
    "predictions",
)
def x4_first_ever_in_steps(v: Views):
    """What the stream does: the first prediction of every trip, in three batches that meet trips of
    earlier ones again, against the index of the trips seen before; the first two are folded."""
    folder = scratch_folder(v.spark)
    order = ["timestamp", "part", "supplier", "quantity", "price"]
    ends = [F.lit(f"{year}-01-01").cast("timestamp_ntz") for year in (1994, 1996, 2100)]
    for n, end in enumerate(ends):
        batch = v.predictions.filter(F.col("timestamp") < end)
        batch = batch if n == 0 else batch.filter(F.col("timestamp") >= ends[n - 1])
        fresh = first_ever(batch, "trip_id", order, f"{folder}/trips", n)
        write_part(fresh.select("trip_id", "prediction_id"), f"{folder}/table", n)
        found = read_parts(v.spark, f"{folder}/table", FIRSTS)
        add_keys(found.filter(F.col(BATCH) == n), "trip_id", f"{folder}/trips", n)
        if n == 1:
            fold_keys(v.spark, f"{folder}/trips", 1)
    return found.select("trip_id", "prediction_id")


@query(
    """SELECT "user", arg_max(kind, "offset") AS kind,
  (max({'o': "offset", 'l': level}) FILTER (has_level)).l AS level
FROM messages WHERE is_json GROUP BY "user" """,
    "messages",
)
def k3_upserted_documents(v: Views):
    return merge.upsert_latest(v.messages, "user", ["offset"], ["kind", "level"])


@query(
    """SELECT "user", arg_max(kind || '2', "offset") AS kind FROM messages WHERE is_json
GROUP BY "user" """,
    "messages",
)
def k3_repeated_names(v: Views):
    """Messages that carry a field twice; the last one counts."""
    name = F.regexp_extract("value", '"kind":"([a-z]+)"', 1)
    second = F.format_string('"kind":"%s2",', name)
    again = F.concat(F.regexp_replace("value", "}$", ","), F.regexp_replace(second, ",$", "}"))
    doubled = v.messages.withColumn("value", F.when(name != "", again).otherwise(F.col("value")))
    return merge.upsert_latest(doubled, "user", ["offset"], ["kind"])


@query(
    """SELECT route_short_name, strftime(timestamp_x, '%Y-%m-%d %H:%M:%S') AS timestamp,
  peak_hour = 1 AS peak_hour, round(sine_time, 6) AS sine_time, temperature,
  precipitation_probability, weather_code, traffic_level, event_dummy = 1 AS event_dummy,
  school = 1 AS school, hospital = 1 AS hospital, weekend = 1 AS weekend,
  round(congestion_rate, 6) AS prediction
FROM (SELECT f.* REPLACE (CASE traffic_level WHEN 'no traffic/low' THEN 0 WHEN 'medium' THEN 1
    WHEN 'heavy' THEN 2 ELSE 3 END AS traffic_level), trip_id_x AS route_short_name
  FROM feature_table f)""",
    "feature_table",
)
def k8_prediction_log(v: Views):
    rows = v.feature_table.select(
        F.col("trip_id_x").alias("route_short_name"),
        F.col("timestamp_x").alias("timestamp"),
        *["peak_hour", "temperature", "precipitation_probability", "weather_code"],
        *["event_dummy", "school", "hospital", "weekend"],
        F.round("sine_time", 6).alias("sine_time"),
        traffic_code(F.col("traffic_level")).alias("traffic_level"),
        F.round("congestion_rate", 6).alias("prediction"),
    )
    return prediction_log(rows).drop("created_at")


@query(
    """SELECT 'model.train.topic' AS topic,
  '{"model_key":' || model_key::VARCHAR || ',"name":"' || name || '"}' AS value FROM model_runs""",
    "model_runs",
)
def k9_sent_messages(v: Views):
    return to_messages(v.model_runs, "model.train.topic", ["model_key", "name"])


@query(
    """SELECT "user" AS key, field, arg_max(value, "offset") AS value FROM (
  SELECT "offset", "user", 'user' AS field, "user" AS value FROM messages WHERE is_json
  UNION ALL SELECT "offset", "user", 'kind', kind FROM messages WHERE is_json
  UNION ALL SELECT "offset", "user", 'level', coalesce(level, '\\N') FROM messages
  WHERE is_json AND has_level) GROUP BY ALL""",
    "messages",
)
def x6_upsert_in_two_steps(v: Views):
    """What the archive stream does, on two halves of the messages; an explicit null is a value."""

    def fields(part):
        return merge.latest_fields(merge.message_fields(part, F.lit("user"), ["offset"]))

    odd = F.col("offset") % 2 == 1
    both = fields(v.messages.filter(odd)).unionByName(fields(v.messages.filter(~odd)))
    latest = merge.latest_fields(both).select("key", "field", "value", "position.offset")
    return latest.select("key", "field", F.coalesce("value", F.lit("\\N")).alias("value"))


# Demand


_CARRIED = "stop_id, route, bus_id, trip_id, peak_hour, hospital, school"
_PREFIX = """stop_id || '-' || route || '-' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S') || '-'
    || prediction_id::VARCHAR || '-' || n::VARCHAR"""


@query(
    f"""SELECT {_PREFIX} AS ticket_id, timestamp, {_CARRIED},
  CASE n % 3 WHEN 0 THEN 'adult' WHEN 1 THEN 'student' ELSE 'senior' END AS passenger_type,
  CASE n % 3 WHEN 0 THEN 2.5::DOUBLE WHEN 1 THEN 1.25::DOUBLE ELSE 1::DOUBLE END AS fare
FROM (SELECT *, unnest(range(predicted_passengers_in)) AS n FROM first_predictions)""",
    "first_predictions",
)
def q10_tickets(v: Views):
    return demand.expand_counts(v.predictions, ARRIVAL)[0]


@query(
    f"""SELECT {_PREFIX} AS measurement_id, timestamp, {_CARRIED}, 1 AS status,
  2 AS activation_type
FROM (SELECT *, unnest(range(predicted_passengers_out)) AS n FROM first_predictions)""",
    "first_predictions",
)
def q10_sensors(v: Views):
    return demand.expand_counts(v.predictions, ARRIVAL)[1]


@query(
    """SELECT trip_id, stop_id, stop_sequence, departure_time,
  strftime(day, '%Y-%m-%d') AS service_day,
  (day + to_hours(departure_time[1:2]::INTEGER) + to_minutes(departure_time[4:5]::INTEGER))
    ::TIMESTAMP AS timestamp
FROM stop_times, (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-07',
  INTERVAL 1 DAY)) AS day)""",
    "stop_times",
)
def j16_dated_departures(v: Views):
    dated = dated_schedule(v.stop_times, date(2024, 1, 1), date(2024, 1, 7), "departure_time")
    return dated.withColumn("service_day", F.col("service_day").cast("string"))


# Geometry


@query("SELECT shape_id, sequence, round(km, 6) AS km FROM segments", "segments")
def w2_segment_lengths(v: Views):
    return tracks.segment_lengths(v.shapes).select(
        "shape_id", "sequence", F.round("km", 6).alias("km")
    )


@query(
    """SELECT shape_id, round(arg_min(shape_pt_lat, shape_pt_sequence), 6) AS origin_lat,
  round(arg_min(shape_pt_lon, shape_pt_sequence), 6) AS origin_lon,
  round(arg_max(shape_pt_lat, shape_pt_sequence), 6) AS destination_lat,
  round(arg_max(shape_pt_lon, shape_pt_sequence), 6) AS destination_lon
FROM shapes GROUP BY shape_id HAVING count(*) >= 2""",
    "shapes",
)
def l4_shape_ends(v: Views):
    ends = tracks.shape_ends(v.shapes)
    return ends.select(
        "shape_id", *[F.round(c, 6).alias(c) for c in ends.columns if c != "shape_id"]
    )


_FIRST_OF_SHAPE = """SELECT * FROM predictions WHERE shape_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY shape_id
      ORDER BY timestamp, part, supplier, quantity, price, prediction_id) = 1"""
_SHAPE_ORDER = [*ARRIVAL, "prediction_id"]


@query(f"SELECT shape_id, prediction_id, price FROM ({_FIRST_OF_SHAPE})", "predictions")
def d2_first_messages(v: Views):
    firsts = tracks.first_shape_messages(v.predictions, _SHAPE_ORDER)
    return firsts.select("shape_id", "prediction_id", "price")


# Times are compared by the second: the last digit of a cosine may differ between engines.
_MICROS = "round_even(km / 30 * 3600 * 1000000, 0)::BIGINT"


@query(
    f"""SELECT m.shape_id, m.stop_id || '-' || m.route || '-'
    || strftime(m.timestamp, '%Y-%m-%dT%H:%M:%S') || '-' || g.sequence::VARCHAR AS measurement_id,
  m.stop_sequence::INTEGER AS sequence, round(g.lat, 6) AS latitude, round(g.lon, 6) AS longitude,
  date_trunc('second', m.timestamp + to_microseconds(g.elapsed))::TIMESTAMP AS timestamp
FROM ({_FIRST_OF_SHAPE}) m
JOIN (SELECT shape_id, sequence, lat, lon, sum(CASE WHEN sequence >= 2 THEN {_MICROS} END)
        OVER (PARTITION BY shape_id ORDER BY sequence
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 FOLLOWING)::BIGINT AS elapsed,
        count(*) OVER (PARTITION BY shape_id) AS points
      FROM segments) g USING (shape_id)
WHERE g.sequence BETWEEN 1 AND g.points - 3""",
    "predictions",
    "segments",
)
def q11_gps_track(v: Views):
    track = tracks.gps_track(v.predictions, v.shapes, _SHAPE_ORDER)
    return track.select(
        "shape_id",
        "measurement_id",
        "sequence",
        F.round("latitude", 6).alias("latitude"),
        F.round("longitude", 6).alias("longitude"),
        F.date_trunc("second", "timestamp").cast("timestamp_ntz").alias("timestamp"),
    )


@query(
    f"""SELECT m.shape_id, g.sequence AS point,
  date_trunc('second', m.timestamp + to_microseconds(coalesce(g.elapsed, 0)))::TIMESTAMP
  AS timestamp
FROM ({_FIRST_OF_SHAPE}) m
JOIN (SELECT shape_id, sequence, sum({_MICROS}) OVER (PARTITION BY shape_id ORDER BY sequence
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::BIGINT AS elapsed
      FROM segments) g USING (shape_id)""",
    "predictions",
    "segments",
)
def w3_full_track(v: Views):
    track = tracks.gps_track(v.predictions, v.shapes, _SHAPE_ORDER, mode="full")
    return track.select(
        "shape_id",
        F.element_at(F.split("measurement_id", "-"), -1).cast("int").alias("point"),
        F.date_trunc("second", "timestamp").cast("timestamp_ntz").alias("timestamp"),
    )


# Traffic


@query(
    f"""SELECT measurement_id, normal, traffic, {level_sql('normal', 'traffic')} AS traffic_level
FROM travel_times WHERE shape_id IS NOT NULL""",
    "travel_times",
)
def q12_classified_traffic(v: Views):
    """Replies of measurements without a shape lack the time in traffic."""
    duration = F.format_string('"duration":{"value":%d}', "normal")
    delayed = F.format_string(',"duration_in_traffic":{"value":%d}', "traffic")
    reply = F.concat(
        F.lit('{"rows":[{"elements":[{'),
        duration,
        F.when(F.col("shape_id").isNotNull(), delayed).otherwise(""),
        F.lit("}]}]}"),
    )
    replies = v.travel_times.select("measurement_id", reply.alias("reply"))
    return traffic_plan.classify_traffic(traffic_plan.read_replies(replies))


@query(
    """SELECT traffic_level, CASE traffic_level WHEN 'no traffic/low' THEN 0 WHEN 'medium' THEN 1
  WHEN 'heavy' THEN 2 WHEN 'severe/standstill' THEN 3 END AS code, count(*) AS rows
FROM traffic GROUP BY 1, 2""",
    "traffic",
)
def c6_traffic_codes(v: Views):
    return (
        v.traffic.withColumn("code", traffic_code(F.col("traffic_level")))
        .groupBy("traffic_level", "code")
        .agg(F.count("*").alias("rows"))
    )


@query(
    """SELECT stop_id || '-' || route || '-' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S') || '-'
    || prediction_id::VARCHAR AS measurement_id, shape_id, traffic AS traffic_level
FROM (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY shape_id
      ORDER BY timestamp, part, supplier, quantity, price, prediction_id) = 1)""",
    "predictions",
)
def d2_stated_traffic(v: Views):
    stated = traffic_plan.stated_traffic(v.predictions, _SHAPE_ORDER)
    return stated.select("measurement_id", "shape_id", "traffic_level")


# Weather


@query(
    """SELECT hour, temperature, precipitation_probability, weather_code,
  date_trunc('day', hour)::TIMESTAMP AS timestamp FROM weather""",
    "weather",
)
def q13_weather_rows(v: Views):
    rows = weather.weather_rows(v.weather_messages)
    return rows.drop("latitude", "longitude")


@query(
    """SELECT hour, temperature, precipitation_probability, weather_code FROM weather
WHERE hour::DATE = (SELECT max(hour)::DATE FROM weather)""",
    "weather",
)
def k4_weather_snapshot(v: Views):
    rows = weather.weather_snapshot(v.weather_messages, ["offset"])
    return rows.drop("latitude", "longitude", "timestamp")


_FAULTS = {
    1: "latitude:missing",
    2: "arrays:length",
    3: "temperature:number",
    4: "precipitation_probability:range",
    5: "weather_code:number",
    6: "hour:missing",
}


def faulty_messages(v: Views):
    """Weather messages as JSON with a fault that depends on the day: a field left out, a shorter
    array, a text among numbers, a value out of range, a fraction for a code, no array at all."""
    kind = F.col("offset") % 7
    field = lambda name, text: F.concat(F.lit(f'"{name}":'), text)
    array = lambda column: F.concat(F.lit("["), F.array_join(column, ","), F.lit("]"))
    numbers = lambda name: F.transform(name, lambda x: x.cast("string"))
    hours = F.transform("hour", lambda h: F.concat(F.lit('"'), h, F.lit('"')))
    hour_array = F.when(kind == 2, array(F.slice(hours, 2, 100))).otherwise(array(hours))
    parts = [
        F.when(kind != 1, field("latitude", F.lit("46.0"))),
        field("longitude", F.lit("11.0")),
        field("timestamp", F.concat(F.lit('"'), F.col("timestamp"), F.lit('"'))),
        field("hour", F.when(kind == 6, F.lit('"noon"')).otherwise(hour_array)),
        field("temperature", array(F.when(kind == 3, F.transform(numbers("temperature"), lambda t: F.lit('"warm"'))).otherwise(numbers("temperature")))),
        field(
            "precipitation_probability",
            array(F.transform("precipitation_probability", lambda p: (p + F.when(kind == 4, 101).otherwise(0)).cast("string"))),
        ),
        field("weather_code", array(F.when(kind == 5, F.transform(numbers("weather_code"), lambda c: F.lit('"x"'))).otherwise(numbers("weather_code")))),
    ]
    value = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return v.weather_messages.select("offset", value.alias("value"))


@query(
    """SELECT day, CASE day % 7 """
    + " ".join(f"WHEN {kind} THEN '{text}'" for kind, text in _FAULTS.items())
    + """ END AS reason
FROM (SELECT DISTINCT (hour::DATE - DATE '1970-01-01')::BIGINT AS day FROM weather)
WHERE day % 7 <> 0""",
    "weather",
)
def f10_rejected_weather(v: Views):
    _, rejected = weather.check_weather(weather.decode_weather(faulty_messages(v), keep=["offset"]))
    return rejected.select(F.col("offset").alias("day"), "reason")


@query(
    "SELECT hour, temperature, weather_code FROM weather",
    "weather",
)
def c11_exploded_arrays(v: Views):
    arrays = ["hour", "temperature", "weather_code"]
    rows = explode_arrays(v.weather_messages.select("offset", *arrays), arrays)
    return rows.withColumn("hour", times.parse_timestamp(F.col("hour"))).drop("offset")


# Each moment points to the first one more than six hours later; the kept ones are a chain.
@query(
    """WITH RECURSIVE moments AS (SELECT DISTINCT user_id, ts FROM events),
following AS (
  SELECT user_id, ts, min(ts) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN
    INTERVAL '6 hours 1 microsecond' FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ts FROM moments),
chain AS (
  SELECT user_id, min(ts) AS ts FROM moments
  WHERE ts > TIMESTAMP '2024-01-01 06:00:00' GROUP BY user_id
  UNION ALL
  SELECT c.user_id, f.next_ts FROM chain c JOIN following f
    ON c.user_id = f.user_id AND c.ts = f.ts WHERE f.next_ts IS NOT NULL)
SELECT user_id, ts FROM chain"""
)
def w8_sampled_moments(v: Views):
    return sample_by_gap(v.events, "user_id", "ts", start="2024-01-01 00:00:00")
