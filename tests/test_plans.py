"""Plans on hand-written rows, and the shape of their physical plans."""

import json
from datetime import date, datetime, time, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.plans import dashboards, demand, features, model, occupancy, tracks, traffic, weather
from headway.sinks.tables import append_new_features
from headway.sources import tables
from headway.sources.messages import broker_options

T0 = datetime(2025, 5, 16, 8)
SAMPLES = Path("/root/testdata/sf0.001")


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def table(spark, schema, *dicts):
    return spark.createDataFrame([[d.get(n) for n in schema.names] for d in dicts], schema)


def stop(**extra):
    base = {"trip_id": "t", "bus_id": 1, "route": "5", "stop_id": "s", "timestamp": T0}
    return base | {"peak_hour": 0, "hospital": 0, "school": 0} | extra


def tickets(spark, *dicts):
    numbered = [{"ticket_id": f"k{n}", "fare": 2.5} | stop(**d) for n, d in enumerate(dicts)]
    return table(spark, schemas.TICKETS, *numbered)


def sensors(spark, *dicts):
    numbered = [{"measurement_id": f"m{n}", "status": 1} | stop(**d) for n, d in enumerate(dicts)]
    return table(spark, schemas.SENSORS, *numbered)


# Occupancy


def test_occupancy_cases(spark):
    on = [{}, {}, {"stop_id": "s2"}, {"bus_id": 2}, {"bus_id": 3, "route": None}]
    off = [
        {},
        {"status": 0},
        *[{"bus_id": 2}] * 4,  # more out than in
        {"bus_id": 3, "route": None},  # missing parts do not match
        {"bus_id": 4},  # nobody boarded here
        {"stop_id": "s9"},
    ]
    current = occupancy.current_occupancy(tickets(spark, *on), sensors(spark, *off))
    assert rows(current.select("bus_id", "total_occupancy")) == [(1, 2), (2, 0), (3, 1)]
    balance = occupancy.stop_balance(tickets(spark, *on), sensors(spark, *off))
    assert balance.agg(F.sum("passengers_off")).first()[0] == 5


def test_occupancy_percentage(spark):
    current = spark.createDataFrame(
        [(1, "t", T0, 7), (9, "t", T0, 7)],
        "bus_id int, trip_id string, latest_timestamp timestamp_ntz, total_occupancy long",
    )
    bus = spark.createDataFrame([(1, 400, 27), (2, 0, 0)], schemas.BUS)
    share = occupancy.bus_occupancy(current, bus)
    assert [(r.bus_id, r.occupancy_percentage) for r in share.collect()] == [
        (1, pytest.approx(1.75))
    ]
    empty = spark.createDataFrame([(1, 0, 0)], schemas.BUS)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        occupancy.bus_occupancy(current, empty).collect()
    skipped = occupancy.bus_occupancy(current, empty, skip_empty_capacity=True)
    assert skipped.first().occupancy_percentage is None


# Features


def feature_inputs(spark, **changes):
    parts = {
        "tickets": [{}, {}, {"fare": None}],
        "sensors": [{}, {"status": 0}],
        "trips": [{"trip_id": "t", "route_id": 1, "shape_id": "S"}],
        "traffic": [{"measurement_id": "1", "timestamp": T0, "traffic_level": "medium", "shape_id": "S"}],
        "weather": [
            {"measurement_id": 1, "hour": T0, "temperature": 20.0, "precipitation_probability": 5.0, "weather_code": 3}
        ],
        "city_events": [],
    } | changes
    return [
        tickets(spark, *parts["tickets"]),
        sensors(spark, *parts["sensors"]),
        table(spark, schemas.TRIPS, *parts["trips"]),
        table(spark, schemas.TRAFFIC, *parts["traffic"]),
        table(spark, schemas.WEATHER, *parts["weather"]),
        table(spark, schemas.CITY_EVENTS, *parts["city_events"]),
    ]


def built(spark, **changes):
    return features.build_features(*feature_inputs(spark, **changes)).collect()


def test_feature_row(spark):
    (row,) = built(spark)
    assert row.congestion_rate == 0.0  # two fares in, two readings of any status out
    assert (row.traffic_level, row.temperature, row.event_dummy, row.weekend) == ("medium", 20.0, 0, 0)
    assert row.sine_time == pytest.approx(0.8660254)


def test_features_of_some_trips(spark):
    """The same rows as picked from the whole table, with each trip's own first peak flag."""
    facts = [{"trip_id": t, "timestamp": T0 + timedelta(days=d), "peak_hour": p} for t, d, p in (("t", 0, 1), ("t", 1, 0), ("u", 0, 0), (None, 0, 0))]
    listed = [{"trip_id": t, "route_id": 1, "shape_id": "S"} for t in "tuw"]
    parts = feature_inputs(spark, tickets=facts, sensors=facts, trips=listed)
    asked = spark.createDataFrame([("t",), ("t",), ("w",), (None,)], "trip_id string")
    whole = features.build_features(*parts)
    some = features.build_features(*parts, only_trips=asked)
    assert rows(some) == rows(whole.filter("trip_id_x = 't'")) != rows(whole)
    assert len(rows(some)) == 2


def test_last_times_must_agree(spark):
    later = {"timestamp": T0 + timedelta(seconds=1)}
    assert built(spark, sensors=[later]) == []
    assert len(built(spark, sensors=[{}, later], tickets=[{}, later])) == 1


def test_missing_keys_are_left_out(spark):
    assert len(built(spark, tickets=[{}, {"trip_id": None}, {"timestamp": None}])) == 1


@pytest.mark.parametrize(
    "trips",
    [
        [{"trip_id": "t", "route_id": 1, "shape_id": None}],  # listed without a shape
        [{"trip_id": "other", "route_id": 1, "shape_id": "S"}],  # not listed at all
    ],
)
def test_missing_shape_meets_missing_shape(spark, trips):
    lone = {"measurement_id": "2", "timestamp": T0, "traffic_level": "heavy", "shape_id": None}
    known = {"measurement_id": "1", "timestamp": T0, "traffic_level": "medium", "shape_id": "S"}
    (row,) = built(spark, trips=trips, traffic=[known, lone])
    assert row.traffic_level == "heavy"
    assert built(spark, trips=trips, traffic=[known]) == []


def test_trip_without_a_route_keeps_its_shape(spark):
    known = {"measurement_id": "1", "timestamp": T0, "traffic_level": "medium", "shape_id": "S"}
    trips = [{"trip_id": "t", "route_id": None, "shape_id": "S"}]
    (row,) = built(spark, trips=trips, traffic=[known])
    assert row.traffic_level == "medium"


def test_unmatched_shape_drops_the_trip(spark):
    lone = {"measurement_id": "2", "timestamp": T0, "traffic_level": "heavy", "shape_id": None}
    assert built(spark, traffic=[lone]) == []


def test_first_traffic_row_with_a_level(spark):
    def at(minutes, name, level):
        moment = T0 + timedelta(minutes=minutes)
        return {"measurement_id": name, "timestamp": moment, "traffic_level": level, "shape_id": "S"}

    history = [at(0, "1", None), at(2, "2", "heavy"), at(1, "4", "medium"), at(1, "3", "severe/standstill")]
    (row,) = built(spark, traffic=history)
    assert row.traffic_level == "severe/standstill"
    columns = ["trip_id_x", "timestamp_x", "traffic_level", "normal"]
    assert features.build_features(*feature_inputs(spark, traffic=history), columns).isEmpty()


def test_trip_listed_twice_keeps_the_earliest_traffic(spark):
    trips = [{"trip_id": "t", "route_id": 1, "shape_id": s} for s in ("S", "R", "Q")]
    history = [
        {"measurement_id": "1", "timestamp": T0, "traffic_level": "medium", "shape_id": "S"},
        {"measurement_id": "2", "timestamp": T0 - timedelta(1), "traffic_level": "heavy", "shape_id": "R"},
    ]
    (row,) = built(spark, trips=trips, traffic=history)
    assert row.traffic_level == "heavy"


def test_event_days_do_not_multiply(spark):
    events = [{"event_id": n, "day_event": T0.date()} for n in range(3)]
    (row,) = built(spark, city_events=events)
    assert row.event_dummy == 1


def test_no_weather_before_the_trip_drops_it(spark):
    late = {"measurement_id": 1, "hour": T0 + timedelta(hours=1), "temperature": 20.0}
    assert built(spark, weather=[late]) == []


def test_first_peak_flag(spark):
    def peak(trip, *pairs):
        return [
            {"trip_id": trip, "peak_hour": p, "timestamp": T0 + timedelta(minutes=m)}
            for m, p in pairs
        ]

    df = tickets(
        spark,
        *peak("a", (0, None), (1, 1), (2, 0)),
        *peak("b", (1, 1), (1, 0)),
        *peak("c", (1, None)),
        *peak("d", (1440, 1), (2000, 0)),
    )
    assert rows(features.first_peak_hours(df)) == [("a", 1), ("b", 0), ("d", 1)]


def test_append_again_adds_nothing(spark):
    fresh = features.build_features(*feature_inputs(spark))
    assert append_new_features(fresh, spark.createDataFrame([], fresh.schema)).count() == 1
    assert append_new_features(fresh, fresh).isEmpty()


# Dashboards


def test_suggestions_need_more_than_the_threshold(spark):
    hourly = spark.createDataFrame(
        [("5", date(2025, 5, 16), h, r) for h, r in [(7, 1.2), (8, 1.1), (9, 1.0), (10, 2.0)]],
        "route_short_name string, day date, hour int, congestion_rate double",
    )
    found = dashboards.suggest_buses(hourly).select("date", "time_interval", "reason")
    day, reason = "Friday, 16 May 2025", "Avg. congestion > 1.0"
    assert rows(found) == [(day, "10:00 - 11:00", reason), (day, "7:00 - 9:00", reason)]


def traffic_rows(spark, *triples):
    return spark.createDataFrame(
        [(T0 + timedelta(hours=h), level, route) for route, h, level in triples],
        "timestamp_x timestamp_ntz, traffic_level string, route_short_name string",
    )


def test_alerts_look_at_the_oldest_known_level(spark):
    df = traffic_rows(
        spark,
        ("5", 0, "unheard of"),
        ("5", 1, "heavy"),
        ("5", 2, "no traffic/low"),
        ("8", 0, "no traffic/low"),
        ("8", 1, "severe/standstill"),
    )
    assert rows(dashboards.traffic_alerts(df)) == [("5", 2)]
    assert rows(dashboards.traffic_alerts(df, newest=True)) == [("8", 3)]


def test_heatmap_has_a_column_for_every_hour(spark):
    df = traffic_rows(spark, ("5", 0, "medium"), ("5", 0, "heavy"), ("8", 1, "heavy"))
    heatmap = dashboards.traffic_heatmap(df)
    assert heatmap.columns == ["route_short_name", *map(str, range(24))]
    five = {r.route_short_name: r for r in heatmap.collect()}["5"]
    assert (five["8"], five["9"]) == (1.5, None)


def test_flow_fills_empty_hours(spark):
    on = tickets(spark, {}, {"timestamp": datetime(2025, 5, 16, 22)}, {"route": "8"})
    off = sensors(spark, {}, {"status": 0}, {"timestamp": datetime(2025, 5, 16, 22, 0, 0, 500000)})
    flow = dashboards.passenger_flow(on, off, date(2025, 5, 16), route="5")
    got = {r.hour.hour: (r.passengers_boarding, r.passengers_alighting) for r in flow.collect()}
    assert len(got) == 17
    assert (got[8], got[22], got[9]) == ((1, 1), (1, 0), (0, 0))
    short = dashboards.passenger_flow(on, off, date(2025, 5, 16), time(7), time(8))
    assert rows(dashboards.flow_by_type(short).filter("passengers > 0").drop("hour")) == [
        ("Alighting", 1),
        ("Boarding", 2),
    ]


def network(spark):
    routes = table(
        spark,
        schemas.ROUTES,
        *[{"route_id": n, "route_short_name": str(n), "route_long_name": f"Line {n}"} for n in (1, 2)],
    )
    trips = table(
        spark,
        schemas.TRIPS,
        {"route_id": 1, "trip_id": "b", "shape_id": "S"},
        {"route_id": 1, "trip_id": "a", "shape_id": None},
        {"route_id": 2, "trip_id": "c", "shape_id": "S"},
    )
    return routes, trips


def feature_rows(spark, *dicts):
    return table(spark, schemas.FEATURES, *[{"timestamp_x": T0} | d for d in dicts])


def test_route_options_fall_back(spark):
    routes, trips = network(spark)
    some = feature_rows(spark, {"trip_id_x": "c"})
    assert rows(dashboards.route_options(routes, trips, some)) == [("2", "2 - Line 2")]
    for none in (feature_rows(spark), feature_rows(spark, {"trip_id_x": "unknown"})):
        assert dashboards.route_options(routes, trips, none).count() == 2


def test_forecast_starts_take_complete_moments(spark):
    routes = spark.createDataFrame([(1, "1"), (2, "2"), (3, None)], "route_id int, route_short_name string").withColumn("route_long_name", F.lit("x"))
    trips = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "trip_id string, route_id int").withColumn("shape_id", F.lit("S"))
    found = [("a", T0, 0, 1, 0.1, "low"), ("a", T0 + timedelta(days=2), 1, 0, None, "low"), ("b", T0, 1, 1, 0.1, None), ("c", T0, 1, 1, 0.1, "low")]
    features_ = spark.createDataFrame(found, "trip_id_x string, timestamp_x timestamp_ntz, school int, hospital int, congestion_rate double, traffic_level string")
    assert rows(dashboards.forecast_starts(routes, trips, features_)) == [("1", True, False, T0)]


def test_location_features_default_to_false(spark):
    routes, trips = network(spark)
    pairs = feature_rows(
        spark,
        {"trip_id_x": "a", "school": 0, "hospital": 1},
        {"trip_id_x": "b", "school": 1, "hospital": 0},
    )
    got = dashboards.location_features(routes, trips, pairs)
    assert rows(got) == [("1", True, False), ("2", False, False)]


def test_route_map(spark):
    routes, trips = network(spark)
    shapes = spark.createDataFrame(
        [("S", 46.0 + n, 11.0, n) for n in (1, 2, 3)], schemas.SHAPES
    )
    stop_times = table(spark, schemas.STOP_TIMES, {"trip_id": "b", "stop_id": 7, "stop_sequence": 2})
    stops = table(spark, schemas.STOPS, {"stop_id": 7, "stop_name": "Park", "stop_lat": 46.5, "stop_lon": 11.5})
    latest = [
        {"trip_id_x": "b", "congestion_rate": 0.9},
        {"trip_id_x": "b", "timestamp_x": T0 + timedelta(1), "congestion_rate": 0.5},
        {"trip_id_x": "b", "timestamp_x": T0 + timedelta(2), "congestion_rate": None},
    ]
    parts = (routes, trips, shapes, stop_times, stops, feature_rows(spark, *latest))
    one = dashboards.in_map_order(dashboards.route_map(*parts, route="1")).collect()
    assert [(r.sequence, r.point_type, r.congestion_rate) for r in one] == [
        (1, "route", 0.5),
        (2, "route", 0.5),
        (2, "stop", None),
        (3, "route", 0.5),
    ]
    two = dashboards.route_map(*parts, route="2")
    assert {r.congestion_rate for r in two.collect()} == {0.3}
    segments = dashboards.path_segments(dashboards.route_map(*parts, route="1")).collect()
    assert [(s.sequence, s.color) for s in segments] == [(1, [255, 255, 0]), (2, [255, 255, 0])]
    assert segments[0].path == [[11.0, 47.0], [11.0, 48.0]]
    assert dashboards.path_so_far(dashboards.route_map(*parts), 2).count() == 4


# Demand, tracks, traffic, weather


def predictions(spark, *dicts):
    base = {"timestamp": "2025-05-16T08:00:00", "stop_id": "s", "route": "5", "bus_id": 1}
    df = table(spark, schemas.PREDICTION_MESSAGE, *[base | d for d in dicts])
    return df.withColumn("offset", F.monotonically_increasing_id())


def test_expand_counts(spark):
    df = predictions(
        spark,
        {"prediction_id": 1, "predicted_passengers_in": 4, "predicted_passengers_out": 0},
        {"prediction_id": 1, "predicted_passengers_in": 9},
        {"prediction_id": None, "predicted_passengers_in": 9},
        {"prediction_id": 2, "predicted_passengers_in": -1, "predicted_passengers_out": 2},
    )
    sold, seen = demand.expand_counts(df, ["offset"])
    assert sold.count() == 4
    assert sold.select("ticket_id").distinct().count() == 4
    assert sold.agg(F.sum("fare")).first()[0] == 2.5 + 1.25 + 1.0 + 2.5
    assert rows(seen.select("measurement_id", "status", "activation_type")) == [
        ("s-5-2025-05-16T08:00:00-2-0", 1, 2),
        ("s-5-2025-05-16T08:00:00-2-1", 1, 2),
    ]


def test_a_ticket_costs_no_rule_of_its_prediction(spark):
    """What is done per passenger (above the generator) joins two texts and looks up two places of
    constant arrays: no formatting of missing parts, no comparing of names."""
    df = predictions(spark, {"prediction_id": 1, "predicted_passengers_in": 4, "predicted_passengers_out": 1})
    for made in demand.expand_counts(df, ["offset"]):
        per_row = made._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
        assert not any(word in per_row for word in ("concat_ws", "coalesce", "CASE"))
    sold = demand.expand_counts(df, ["offset"])[0]
    assert rows(sold.select("passenger_type", "fare")) == [("adult", 2.5), ("adult", 2.5), ("senior", 1.0), ("student", 1.25)]


def line(spark, name, numbers):
    """Points a tenth of a degree apart going north."""
    return spark.createDataFrame([(name, 46 + n / 10, 11.0, n) for n in numbers], schemas.SHAPES)


def seconds(points):
    return round(points * 11.132 / 30 * 3600)


@pytest.mark.parametrize(
    "numbers, positions",
    [
        ([1, 2, 3], []),
        ([1, 2, 3, 4], [1]),
        ([1, 2, 3, 4, 5, 6], [1, 2, 3]),
        ([1, 2, 4, 5, 6], []),  # a number is missing
        ([0, 1, 2, 3, 4], [1, 2]),
    ],
)
def test_reference_track(spark, numbers, positions):
    found = tracks.travel_times(line(spark, "S", numbers)).orderBy("sequence").collect()
    assert [r.sequence for r in found] == positions
    assert [round(r.elapsed / 1e6) for r in found] == [seconds(i) for i in positions]


def test_full_track(spark):
    found = tracks.travel_times(line(spark, "S", [1, 2, 4]), "full").orderBy("sequence").collect()
    assert [round(r.elapsed / 1e6) for r in found] == [0, seconds(1), seconds(3)]


def test_track_starts_at_the_first_message(spark):
    df = predictions(
        spark,
        {"prediction_id": 0, "shape_id": ""},
        {"prediction_id": 1, "shape_id": "S", "timestamp": None},
        {"prediction_id": 2, "shape_id": "S", "stop_sequence": "3"},
        {"prediction_id": 3, "shape_id": "S", "timestamp": "2025-05-16T20:00:00"},
        {"prediction_id": 4, "shape_id": "nan"},
        {"prediction_id": 5, "shape_id": "R"},
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    (row,) = tracks.gps_track(df, line(spark, "S", [1, 2, 3, 4]), ["offset"]).collect()
    assert round((row.timestamp - T0).total_seconds()) == seconds(1)
    assert (row.sequence, row.latitude) == (3, 46.1)
    assert row.measurement_id == "s-5-2025-05-16T08:00:00-1"


def test_shape_ends_need_two_points(spark):
    shapes = line(spark, "S", [3, 1, 2]).union(line(spark, "R", [1]))
    assert rows(tracks.shape_ends(shapes)) == [("S", 46.1, 11.0, 46.3, 11.0)]


def test_replies(spark):
    def reply(normal=None, delayed=None):
        element = {}
        if normal is not None:
            element["duration"] = {"value": normal}
        if delayed is not None:
            element["duration_in_traffic"] = {"value": delayed}
        return json.dumps({"rows": [{"elements": [element]}]})

    replies = [reply(660, 749), reply(100), reply(), '{"rows":[]}', "junk", reply(0, 5)]
    df = spark.createDataFrame(list(enumerate(replies)), "n int, reply string")
    levels = traffic.classify_traffic(traffic.read_replies(df))
    assert rows(levels) == [(0, 660, 749, "medium")]


def test_stated_traffic(spark):
    df = predictions(
        spark,
        {"prediction_id": 1, "shape_id": "S", "traffic": "heavy"},
        {"prediction_id": 2, "shape_id": "S", "traffic": "medium"},
        {"prediction_id": 3, "shape_id": None, "traffic": "medium"},
    )
    stated = traffic.stated_traffic(df, ["offset"])
    assert rows(stated.select("shape_id", "traffic_level", "normal")) == [
        ("S", "heavy", None),
        (None, "medium", None),
    ]


def forecast(**changes):
    base = {
        "measurement_id": "1",
        "timestamp": "2025-05-16T00:00",
        "latitude": 46.0,
        "longitude": 11.0,
        "weather_code": [1, 999],
        "precipitation_probability": [0.0, 100.0],
        "temperature": [20.0, -3.5],
        "hour": ["2025-05-16T00:00", "2025-05-16T01:00"],
    }
    return base | changes


SIZES = "arrays:length"
RANGE = "precipitation_probability:range"
NUMBERS = "temperature:number"


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({}, None),
        *[({n: None}, f"{n}:missing") for n in weather.REQUIRED],
        ({"hour": ["2025-05-16T00:00"]}, SIZES),
        ({"weather_code": []}, SIZES),
        ({"latitude": float("nan")}, "latitude:number"),
        ({"longitude": float("nan")}, "longitude:number"),
        ({"temperature": [20.0, None]}, NUMBERS),
        ({"precipitation_probability": [-0.1, 5.0]}, RANGE),
        ({"precipitation_probability": [100.1, 5.0]}, RANGE),
        ({"precipitation_probability": [None, 5.0]}, RANGE),
        ({"temperature": [None], "precipitation_probability": [-1.0]}, SIZES),
        ({"temperature": [None, 1.0], "precipitation_probability": [-1.0, 1.0]}, NUMBERS),
    ],
)
def test_weather_rules(spark, changes, reason):
    df = table(spark, schemas.WEATHER_MESSAGE, forecast(**changes))
    good, bad = weather.check_weather(df)
    assert (good.count(), [r.reason for r in bad.collect()]) == (
        (1, []) if reason is None else (0, [reason])
    )


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({}, None),
        ({"temperature": [20.5, "warm"]}, NUMBERS),
        ({"weather_code": [1, "x"]}, "weather_code:number"),
        ({"precipitation_probability": ["much", 1.0]}, RANGE),
        ({"latitude": "north"}, "latitude:missing"),
        ({"hour": "noon"}, "hour:missing"),
        ({"hour": ["2025-05-16T00:00"]}, SIZES),
    ],
)
def test_wrong_types_in_weather_messages_get_a_reason(spark, changes, reason):
    message = json.dumps(forecast(**changes) | {"timestamp": "2025-05-16T08:00:00"})
    frame_ = spark.createDataFrame([(message,), ("no json",)], "value string")
    good, bad = weather.check_weather(weather.decode_weather(frame_))
    expected = sorted([*([reason] if reason else []), "timestamp:missing"])
    assert (good.count(), sorted(r.reason for r in bad.collect())) == (int(not reason), expected)


def test_weather_snapshot_is_the_last_valid_message(spark):
    messages = [forecast(), forecast(hour=["2025-05-17T00:00", "2025-05-17T01:00"]), forecast(hour=[])]
    df = table(spark, schemas.WEATHER_MESSAGE, *messages).withColumn(
        "offset", F.monotonically_increasing_id()
    )
    found = weather.weather_snapshot(df, ["offset"]).orderBy("hour").collect()
    assert [(r.hour, r.temperature) for r in found] == [
        (datetime(2025, 5, 17), 20.0),
        (datetime(2025, 5, 17, 1), -3.5),
    ]
    assert weather.weather_snapshot(df.filter("offset < 0"), ["offset"]).isEmpty()


# Model


@pytest.fixture(scope="module")
def training(spark):
    """Congestion that follows the inputs, with a little noise."""
    n = F.col("id")
    return spark.range(600).select(
        F.concat(F.lit("t"), n).alias("trip_id_x"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), n.cast("int"))).alias("timestamp_x"),
        (n % 2).cast("short").alias("peak_hour"),
        F.sin(n / 24).alias("sine_time"),
        (n % 30).cast("double").alias("temperature"),
        (n % 101).cast("double").alias("precipitation_probability"),
        (n % 5).cast("short").alias("weather_code"),
        F.when(n % 3 == 0, "heavy").otherwise("medium").alias("traffic_level"),
        F.lit(0).cast("short").alias("event_dummy"),
        ((n % 2) / 4 + F.sin(n / 24) / 8 + F.when(n % 3 == 0, 0.25).otherwise(0) + (n % 7) / 1000).alias("congestion_rate"),
        (n % 4 == 0).cast("short").alias("school"),
        (n % 5 == 0).cast("short").alias("hospital"),
        F.lit(0).cast("short").alias("weekend"),
    )


def test_split_is_stable_and_about_seventy_to_thirty(spark, training):
    rows_ = model.model_table(training)
    assert 0.62 < model.training_rows(rows_).count() / 600 < 0.78
    again = model.model_table(training.repartition(7).limit(600))
    assert rows(rows_.select("trip_id_x", "share")) == rows(again.select("trip_id_x", "share"))


@pytest.mark.parametrize("kind", ["boosted", "tree"])
def test_model_beats_the_mean(spark, training, kind):
    trained = (
        model.train_boosted(training, rounds=8, depth=4) if kind == "boosted" else model.train_tree(training)
    )
    tested = model.test_rows(model.model_table(training))
    error = model.rmse(model.score(trained, tested), "congestion_rate", "prediction").first().rmse
    spread = tested.agg(F.stddev_pop("congestion_rate")).first()[0]
    assert error < spread / 2
    ranking = model.feature_importance(trained, training).collect()
    assert len(ranking) == 10
    assert {r.feature for r in ranking[:3]} == {"peak_hour", "sine_time", "traffic_level"}
    assert [r.importance for r in ranking] == sorted((r.importance for r in ranking), reverse=True)


def test_unknown_traffic_level_drops_the_column(spark, training):
    odd = training.withColumn(
        "traffic_level", F.when(F.col("temperature") == 3, "odd").otherwise(F.col("traffic_level"))
    )
    trained = model.train_tree(odd)
    assert "traffic_level" not in trained.stages[0].getInputCols()


def test_gap_in_test_rows_only(spark, training):
    shares = model.model_table(training).select("trip_id_x", "timestamp_x", "share")
    odd = training.join(shares, ["trip_id_x", "timestamp_x"]).withColumn(
        "traffic_level", F.when(F.col("share") >= 95, "odd").otherwise(F.col("traffic_level"))
    )
    trained = model.train_tree(odd.drop("share"))
    assert "traffic_level" not in trained.stages[0].getInputCols()
    tested = model.test_rows(model.model_table(odd.drop("share")))
    assert model.score(trained, tested).filter("prediction is null").isEmpty()


def test_gap_in_a_row_scored_later(spark, training):
    trained = model.train_tree(training)
    table = model.model_table(training).withColumn("temperature", F.lit(None).cast("double"))
    assert model.score(trained, table).filter("prediction is not null").count() == table.count()


def test_split_statistics(spark, training):
    trained = model.train_tree(training, depth=3)
    found = {r.feature: r for r in model.split_statistics(trained, training).collect()}
    assert len(found) == 10 and sum(r.weight for r in found.values()) <= 7
    n = model.training_rows(model.model_table(training)).count()
    assert max(r.total_cover for r in found.values()) >= n
    assert all(r.gain * r.weight == pytest.approx(r.total_gain) for r in found.values())


def test_forecast_grid_units(spark):
    flags = spark.createDataFrame([("5", True, False)], "route_short_name string, school boolean, hospital boolean")
    start = F.lit(datetime(2025, 5, 16, 18, 55)).cast("timestamp_ntz")

    def grid(**unit):
        return model.forecast_grid(flags, start, 30, 5, 20, 40, 1, 2, True, **unit).orderBy("timestamp").collect()

    found = grid()
    assert [r.timestamp.minute for r in found] == [55, 0, 5, 10, 15, 20]
    assert found[0].precipitation_probability == 0.4
    assert grid(precipitation_unit="percent")[0].precipitation_probability == 40.0
    assert (found[0].peak_hour, found[0].school, found[0].hospital, found[0].event_dummy) == (1, 1, 0, 1)


def test_forecast_status(spark):
    df = spark.createDataFrame([("5", 0.9), ("5", 0.7), ("8", 0.1)], "route_short_name string, prediction double")
    status = model.forecast_status(df).select("route_short_name", "status")
    assert rows(status) == [("5", "High"), ("8", "Low")]


# Sources


def test_csv_goes_by_position(spark, tmp_path):
    bom = "﻿"
    (tmp_path / "buses.csv").write_text(f"{bom}number,places,seats\n1,400,27\n2,400,\n")
    assert rows(tables.read_dimension(spark, "bus", str(tmp_path / "buses.csv"))) == [
        (1, 400, 27),
        (2, 400, None),
    ]
    (tmp_path / "events.csv").write_text(
        "event_id;event_name;day;start_time;end_time;location;latitude;longitude\n"
        '7;Dance, "late";2025-05-16;20:30;23:00;Hall, Main Street;46.1;11.2\n'
    )
    (event,) = tables.read_dimension(spark, "events", str(tmp_path / "events.csv")).collect()
    assert (event.day_event, event.location_event) == (date(2025, 5, 16), "Hall, Main Street")
    (tmp_path / "trips.txt").write_text(
        "a,b,c,d,e,f,g\n1,s,t1,Centre,0,S,1\n1,s,t2,\"Home, \"\"sweet\"\"\",1,,1\n"
    )
    trips = tables.read_dimension(spark, "trips", str(tmp_path / "trips.txt")).orderBy("trip_id")
    assert [(t.direction_id, t.trip_headsign, t.shape_id) for t in trips.collect()] == [
        (False, "Centre", "S"),
        (True, 'Home, "sweet"', None),
    ]


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "buses.csv").write_text("bus_id,total_capacity,seats\nmany,400,27\n")
    with pytest.raises(Exception):
        tables.read_dimension(spark, "bus", str(tmp_path / "buses.csv")).collect()


def test_day_range_reads_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(10).withColumn("day", F.date_add(F.lit(date(2025, 5, 1)), F.col("id").cast("int"))).write.partitionBy("day").parquet(path)
    found = tables.read_days(spark, path, "2025-05-03", "2025-05-04")
    assert found.count() == 2
    assert "PartitionFilters: [isnotnull(day" in plan(found)


def test_reader_options():
    options = broker_options("broker:9092", ["a", "b"])
    assert (options["subscribe"], options["startingOffsets"]) == ("a,b", "earliest")
    assert (options["maxOffsetsPerTrigger"], options["failOnDataLoss"]) == ("10000", "false")
    read = tables.database_options("url", "raw_tickets", "timestamp", "2025-01-01", "2025-02-01")
    assert (read["numPartitions"], read["partitionColumn"]) == ("10", "timestamp")


# Physical plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def views(spark):
    if not SAMPLES.exists():
        pytest.skip("no sample tables")
    from headway.catalog.views import Views

    return Views(spark, str(SAMPLES))


def test_feature_plan(views):
    text = plan(views.feature_table)
    assert "Python" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # Tickets and sensors meet in a union under one aggregation, not in a join. The other union
    # is that of forecast intervals.
    assert text.count("functions=[partial_count(fare") == 1
    assert text.count("Union") == 2


def test_occupancy_plan_joins_only_the_buses(views):
    current = occupancy.current_occupancy(views.raw_tickets, views.raw_sensors)
    assert "Join" not in plan(current)
    assert plan(current).count("Exchange") == 2


def test_flow_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "tickets")
    tickets(spark, {}).write.parquet(path)
    sensors(spark, {}).write.parquet(path + "_s")
    on, off = spark.read.parquet(path), spark.read.parquet(path + "_s")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = plan(
            dashboards.hourly_counts(on, off, date(2025, 5, 16), time(6), time(22), route="5")
        )
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert text.count("GreaterThanOrEqual(timestamp,2025-05-16T06:00)") == 2
    assert text.count("EqualTo(route,5)") == 2
    assert "fare" not in text
