"""The same views in SQL, for checking results against another engine."""

_DAY_PART = "(date_trunc('day', ts) + to_hours((extract(hour FROM ts)::INTEGER // 6) * 6))::TIMESTAMP"
_PEAK = (
    "((extract(hour FROM ts) BETWEEN 7 AND 9) OR (extract(hour FROM ts) BETWEEN 16 AND 18))::INTEGER"
)
_HOUR = "date_trunc('hour', ts)::TIMESTAMP"


def level_sql(normal: str, traffic: str) -> str:
    delay = f"(({traffic} - {normal})::DOUBLE / nullif({normal}, 0) * 100)"
    return (
        f"CASE WHEN {delay} <= 10 THEN 'no traffic/low' WHEN {delay} <= 30 THEN 'medium' "
        f"WHEN {delay} < 100 THEN 'heavy' WHEN {delay} IS NOT NULL THEN 'severe/standstill' END"
    )


def code_sql(level: str) -> str:
    return (
        f"CASE {level} WHEN 'no traffic/low' THEN 0 WHEN 'medium' THEN 1 WHEN 'heavy' THEN 2 "
        "WHEN 'severe/standstill' THEN 3 END"
    )


_STOP_COLUMNS = f"""{_DAY_PART} AS timestamp, (event_id % 2)::VARCHAR AS stop_id,
    (user_id % 25)::VARCHAR AS route, (user_id % 25)::INTEGER AS bus_id,
    user_id::VARCHAR AS trip_id, {_PEAK} AS peak_hour,
    (user_id % 5 = 0)::INTEGER AS hospital, (user_id % 4 = 0)::INTEGER AS school"""

# name -> (views it is based on, query)
VIEWS: dict[str, tuple[list[str], str]] = {
    "raw_tickets": (
        [],
        f"""SELECT event_id::VARCHAR AS ticket_id,
    CASE event_id % 3 WHEN 0 THEN 'adult' WHEN 1 THEN 'student' ELSE 'senior' END AS passenger_type,
    CASE event_id % 3 WHEN 0 THEN 2.5::DOUBLE WHEN 1 THEN 1.25::DOUBLE ELSE 1::DOUBLE END AS fare,
    {_STOP_COLUMNS} FROM events WHERE event_type IN ('purchase', 'signup')""",
    ),
    "raw_sensors": (
        [],
        f"""SELECT event_id::VARCHAR AS measurement_id, (event_id % 10 <> 0)::INTEGER AS status,
    2 AS activation_type, {_STOP_COLUMNS} FROM events WHERE event_type IN ('click', 'view')""",
    ),
    "bus": (
        [],
        "SELECT n_nationkey AS bus_id, 100 + 20 * n_regionkey AS total_capacity FROM nation",
    ),
    "trips": (
        [],
        """SELECT c_custkey::VARCHAR AS trip_id, c_nationkey AS route_id,
    CASE WHEN c_custkey % 17 <> 0 THEN 'S' || (c_custkey % 20)::VARCHAR END AS shape_id
    FROM customer""",
    ),
    "routes": (
        [],
        """SELECT n_nationkey AS route_id, n_nationkey::VARCHAR AS route_short_name,
    n_name AS route_long_name FROM nation""",
    ),
    "travel_times": (
        [],
        """SELECT event_id::VARCHAR AS measurement_id, ts AS timestamp,
    (event_id % 2)::VARCHAR AS stop_id, (user_id % 25)::VARCHAR AS route,
    (user_id % 25)::INTEGER AS bus_id, user_id::VARCHAR AS trip_id, 600 AS normal,
    600 + floor(6 * value)::INTEGER AS traffic,
    CASE WHEN event_id % 50 <> 0 THEN 'S' || (user_id % 20)::VARCHAR END AS shape_id
    FROM events WHERE event_type = 'error'""",
    ),
    "traffic": (
        ["travel_times"],
        f"SELECT *, {level_sql('normal', 'traffic')} AS traffic_level FROM travel_times",
    ),
    "weather": (
        [],
        f"""SELECT min(event_id) AS measurement_id, {_HOUR} AS hour,
    arg_min(value, event_id) AS temperature,
    arg_min(json_extract_string(props, '$.k')::INTEGER, event_id)::DOUBLE AS precipitation_probability,
    arg_min(json_extract_string(props, '$.k')::INTEGER, event_id) % 4 AS weather_code
    FROM events WHERE event_type = 'view' GROUP BY {_HOUR}""",
    ),
    "city_events": (
        [],
        """SELECT p_partkey AS event_id, p_name AS event_name,
    DATE '2024-01-01' + (p_size - 1) * 7 AS day_event FROM part""",
    ),
    "shapes": (
        [],
        """SELECT 'S' || vec_id::VARCHAR AS shape_id,
    embedding[2 * i - 1]::DOUBLE * 1e-1 + 46 AS shape_pt_lat,
    embedding[2 * i]::DOUBLE * 1e-1 + 11 AS shape_pt_lon, i::INTEGER AS shape_pt_sequence
    FROM embeddings, range(1, 33) AS numbers(i)""",
    ),
    "stops": (
        [],
        """SELECT s_suppkey AS stop_id, s_name AS stop_name,
    s_nationkey::DOUBLE / 100 + 46 AS stop_lat, s_acctbal / 10000 + 11 AS stop_lon FROM supplier""",
    ),
    "stop_times": (
        [],
        """SELECT l_orderkey::VARCHAR AS trip_id, l_suppkey AS stop_id,
    l_linenumber AS stop_sequence,
    printf('%02d:%02d:00', l_partkey % 20 + 5, l_suppkey % 60) AS departure_time FROM lineitem""",
    ),
    "predictions": (
        [],
        """SELECT l_orderkey * 10 + l_linenumber AS prediction_id, l_shipdate AS timestamp,
    l_suppkey::VARCHAR AS stop_id, (l_partkey % 25)::VARCHAR AS route,
    (l_quantity - 1)::INTEGER AS predicted_passengers_in,
    l_quantity::INTEGER % 7 AS predicted_passengers_out,
    CASE WHEN l_partkey % 17 <> 0 THEN 'S' || l_partkey::VARCHAR END AS shape_id,
    l_orderkey::VARCHAR AS trip_id, l_linenumber::VARCHAR AS stop_sequence,
    (l_suppkey % 25)::INTEGER AS bus_id, (l_partkey % 2 = 0)::INTEGER AS peak_hour,
    (l_partkey % 5 = 0)::INTEGER AS hospital, (l_partkey % 4 = 0)::INTEGER AS school,
    l_returnflag AS traffic, l_partkey AS part, l_suppkey AS supplier, l_quantity AS quantity,
    l_extendedprice AS price FROM lineitem""",
    ),
    "model_runs": (
        [],
        """SELECT o_orderpriority AS name, o_orderkey AS model_key,
    o_totalprice / 100000 AS accuracy, o_orderdate AS timestamp FROM orders""",
    ),
    "messages": (
        [],
        """SELECT CASE event_type WHEN 'click' THEN 'sensors.topic' WHEN 'view' THEN 'gps.topic'
    WHEN 'purchase' THEN 'ticketing.topic' WHEN 'signup' THEN 'bus.passenger.predictions'
    ELSE 'other.topic' END AS topic, (user_id % 4)::INTEGER AS partition, event_id AS "offset",
    event_id % 97 <> 0 AS is_json, user_id::VARCHAR AS user, event_type AS kind,
    event_id % 3 <> 0 AS has_level,
    CASE WHEN event_id % 5 <> 0 THEN floor(value)::BIGINT::VARCHAR END AS level FROM events""",
    ),
    # One row per trip-day, joined the long way: every traffic row of a shape, then the first kept.
    "feature_table": (
        ["raw_tickets", "raw_sensors", "trips", "traffic", "weather", "city_events"],
        f"""SELECT trip_id_x, timestamp_x, peak_hour,
    sin(2 * pi() * seconds / 86400) AS sine_time, temperature, precipitation_probability,
    weather_code, traffic_level, event_dummy, (passengers_in - passengers_out)::DOUBLE / 400
    AS congestion_rate, school, hospital, (isodow(timestamp_x) >= 6)::INTEGER AS weekend
    FROM (
      SELECT t.trip_id AS trip_id_x, t.last AS timestamp_x, t.passengers_in, t.school, t.hospital,
        s.passengers_out, p.peak_hour, tr.traffic_level, tr.timestamp AS traffic_time,
        tr.measurement_id AS traffic_id, w.temperature, w.precipitation_probability,
        w.weather_code, (t.day IN (SELECT day_event FROM city_events))::INTEGER AS event_dummy,
        extract(hour FROM t.last) * 3600 + extract(minute FROM t.last) * 60
          + floor(extract(second FROM t.last)) AS seconds
      FROM (SELECT trip_id, timestamp::DATE AS day, count(fare) AS passengers_in,
              max(school) AS school, max(hospital) AS hospital, max(timestamp) AS last
            FROM raw_tickets GROUP BY 1, 2) t
      JOIN (SELECT trip_id, timestamp::DATE AS day, count(status) AS passengers_out,
              max(timestamp) AS last
            FROM raw_sensors GROUP BY 1, 2) s
        ON t.trip_id = s.trip_id AND t.day = s.day AND t.last = s.last
      LEFT JOIN (SELECT trip_id, peak_hour FROM raw_tickets WHERE peak_hour IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY timestamp, peak_hour) = 1) p
        ON t.trip_id = p.trip_id
      LEFT JOIN trips ON t.trip_id = trips.trip_id
      LEFT JOIN traffic tr ON trips.shape_id IS NOT DISTINCT FROM tr.shape_id
      ASOF LEFT JOIN weather w ON t.last >= w.hour
    )
    WHERE peak_hour IS NOT NULL AND temperature IS NOT NULL AND weather_code IS NOT NULL
      AND precipitation_probability IS NOT NULL AND traffic_level IS NOT NULL
      AND school IS NOT NULL AND hospital IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY trip_id_x, timestamp_x
      ORDER BY traffic_time, traffic_id) = 1""",
    ),
    "congestion": (
        ["feature_table", "trips", "routes"],
        """SELECT f.timestamp_x, f.congestion_rate, f.traffic_level, r.route_short_name
    FROM feature_table f JOIN trips t ON f.trip_id_x = t.trip_id
    JOIN routes r ON t.route_id = r.route_id WHERE f.congestion_rate IS NOT NULL""",
    ),
    "map_trips": (
        ["trips", "routes"],
        """SELECT route_short_name, trip_id, shape_id FROM trips JOIN routes USING (route_id)
    WHERE shape_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY route_short_name
      ORDER BY route_id, trip_id, shape_id) = 1""",
    ),
    "latest_congestion": (
        ["feature_table"],
        """SELECT trip_id_x, congestion_rate FROM feature_table WHERE congestion_rate IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY trip_id_x ORDER BY timestamp_x DESC) = 1""",
    ),
    "route_points": (
        ["map_trips", "latest_congestion", "shapes", "stop_times", "stops"],
        """SELECT m.route_short_name, s.shape_pt_lat AS lat, s.shape_pt_lon AS lon,
      s.shape_pt_sequence AS sequence, NULL::VARCHAR AS stop_id, NULL::VARCHAR AS stop_name,
      'route' AS point_type, coalesce(l.congestion_rate, 3e-1) AS congestion_rate
    FROM map_trips m JOIN shapes s USING (shape_id)
    LEFT JOIN latest_congestion l ON l.trip_id_x = m.trip_id
    UNION ALL
    SELECT m.route_short_name, st.stop_lat, st.stop_lon, x.stop_sequence, st.stop_id::VARCHAR,
      st.stop_name, 'stop', NULL FROM map_trips m JOIN stop_times x USING (trip_id)
    JOIN stops st USING (stop_id)""",
    ),
    "first_predictions": (
        ["predictions"],
        """SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY prediction_id
      ORDER BY timestamp, part, supplier, quantity, price) = 1""",
    ),
    "hourly": (
        ["congestion"],
        """SELECT route_short_name, timestamp_x::DATE AS day,
      extract(hour FROM timestamp_x)::INTEGER AS hour, avg(congestion_rate) AS congestion_rate
    FROM congestion GROUP BY 1, 2, 3""",
    ),
    "segments": (
        ["shapes"],
        """SELECT *, abs(next_lat - lat) * 111.32::DOUBLE
        + abs(next_lon - lon) * 111.32::DOUBLE * cos(radians((lat + next_lat) / 2)) AS km
    FROM (SELECT shape_id, shape_pt_sequence AS sequence, shape_pt_lat AS lat, shape_pt_lon AS lon,
        lead(shape_pt_lat) OVER w AS next_lat, lead(shape_pt_lon) OVER w AS next_lon
      FROM shapes WINDOW w AS (PARTITION BY shape_id ORDER BY shape_pt_sequence))""",
    ),
}


def with_views(body: str, *names: str) -> str:
    """The query with the views it needs, and theirs, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for base in VIEWS[name][0]:
            add(base)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} AS (\n    {VIEWS[name][1]}\n)" for name in ordered)
    return f"WITH {parts}\n{body}"
