"""Operators: the cases a plain version gets wrong, with rows written out by hand."""

import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators import expand, filters, merge
from headway.operators.asof import asof_backward
from headway.operators.champion import mark_champions
from headway.operators.islands import consecutive_blocks
from headway.operators.keyed import duplicate_keys, first_per_key, last_per_key, new_rows
from headway.operators.ranges import sample_bounds, with_range
from headway.operators.sampling import sample_by_gap
from headway.sinks.tables import (
    append_new_features,
    missing_rows,
    prediction_log,
    to_messages,
)
from headway.sources.messages import (
    latest_message,
    next_cursor,
    read_page,
    recent_for_route,
    recent_messages,
    route_topics,
    split_messages,
)
from headway.schemas import schema

T0 = datetime(2025, 5, 16)


def at(hours):
    return T0 + timedelta(hours=hours)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def frame(spark, data, columns):
    return spark.createDataFrame(data, columns)


# Keys


def test_first_and_last_per_key_keep_whole_rows(spark):
    df = frame(
        spark,
        [("a", 2, None), ("a", 1, "x"), (None, 1, "n"), (None, 0, "m")],
        "k string, o int, v string",
    )
    assert rows(first_per_key(df, ["k"], ["o"])) == [("a", 1, "x"), (None, 0, "m")]
    assert rows(last_per_key(df, ["k"], ["o"])) == [("a", 2, None), (None, 1, "n")]


def test_duplicate_keys(spark):
    df = frame(spark, [("a",), ("a",), ("b",)], "k string")
    assert rows(duplicate_keys(df, ["k"])) == [("a", 2)]


def test_new_rows_twice_adds_nothing(spark):
    columns = "trip_id_x string, timestamp_x timestamp_ntz, v int"
    table = frame(spark, [("a", at(0), 1)], columns)
    fresh = frame(spark, [("a", at(0), 2), ("a", at(1), 3), ("a", at(1), 3)], columns)
    added = append_new_features(fresh, table)
    assert rows(added) == [("a", at(1), 3)]
    assert append_new_features(fresh, table.union(added)).isEmpty()
    assert rows(new_rows(fresh, table, ["trip_id_x"])) == []


# As-of join


def asof(spark, left, right):
    lefts = frame(spark, [(m,) for m in left], "ts timestamp_ntz")
    rights = frame(spark, right, "hour timestamp_ntz, id int, v string")
    return asof_backward(lefts, rights, "ts", "hour", ["v"], tie=["id"])


def test_asof_bounds_ties_and_gaps(spark):
    right = [(at(6), 1, "six"), (at(7), 2, "seven"), (at(7), 3, "seven b"), (at(60), 4, "late")]
    left = [at(5.9), at(6), at(6.99), at(7), at(30), at(59.99), at(60), at(500)]
    expected = [None, "six", "six", "seven b", "seven b", "seven b", "late", "late"]
    assert rows(asof(spark, left, right)) == rows(
        frame(spark, list(zip(left, expected)), "ts timestamp_ntz, v string")
    )


def test_asof_without_right_rows(spark):
    assert rows(asof(spark, [at(1)], [])) == [(at(1), None)]


def test_asof_keeps_null_times(spark):
    assert rows(asof(spark, [None], [(at(1), 1, "one"), (None, 2, "none")])) == [(None, None)]


moments = st.integers(min_value=0, max_value=200)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(moments, min_size=1, max_size=20), st.lists(moments, max_size=12))
def test_asof_equals_search(spark, left, right):
    rights = [(at(h), n, str(n)) for n, h in enumerate(right)]

    def best(hour):
        before = [(h, n) for n, h in enumerate(right) if h <= hour]
        return str(max(before)[1]) if before else None

    expected = sorted([(at(h), best(h)) for h in left], key=repr)
    assert rows(asof(spark, [at(h) for h in left], rights)) == expected


def test_asof_with_many_right_rows_on_one_day(spark):
    """Every second of a day twice on the right, the left side crowded into one minute and salted."""
    day = F.lit("2025-05-16").cast("timestamp_ntz")
    right = spark.range(100_000).select(
        (day + F.expr("make_dt_interval(0, 0, 0, id div 2 * 1.5)")).alias("hour"),
        F.col("id").cast("int").alias("n"),
        F.when(F.col("id") % 10 != 1, F.col("id")).alias("v"),
    )
    left = spark.range(20_000).select(
        "id", (day + F.expr("make_dt_interval(0, 12, 0, (id % 600) / 10.0)")).alias("ts")
    )
    joined = asof_backward(left, right, "ts", "hour", ["v"], tie=["n"])
    step = F.floor((F.lit(43200) + (F.col("id") % 600) / 10) / 1.5)
    last = step * 2 + 1
    expected = left.select("id", "ts", F.when(last % 10 != 1, last).alias("v"))
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    plan = joined._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "Join" not in plan
    assert "SinglePartition" not in plan.split("Subqueries")[0].split("Subquery ")[0]


@pytest.mark.parametrize("ranges", [1, 2, 5])
def test_asof_over_few_ranges(spark, ranges):
    lefts = frame(spark, [(at(h / 3),) for h in range(100)] + [(None,)], "ts timestamp_ntz")
    rights = frame(spark, [(at(h), h, str(h)) for h in range(3, 30, 4)], "hour timestamp_ntz, id int, v string")
    found = asof_backward(lefts, rights, "ts", "hour", ["v"], ["id"], ranges=ranges, salts=2)
    best = [max((x for x in range(3, 30, 4) if x <= h / 3), default=None) for h in range(100)]
    expected = [(at(h / 3), None if b is None else str(b)) for h, b in enumerate(best)]
    assert rows(found) == sorted([*expected, (None, None)], key=repr)


def test_ranges_hold_equal_shares(spark):
    """Also of values that crowd together; equal values share a range."""
    df = spark.range(20_000).select((F.col("id") * F.col("id") * F.col("id")).alias("n"))
    placed = with_range(df, F.col("n"), sample_bounds(df, F.col("n"), [F.col("n")], 16), ranges=16)
    sizes = [r["count"] for r in placed.groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 20_000 / 4
    ordered = placed.groupBy("_range").agg(F.min("n").alias("a"), F.max("n").alias("b")).orderBy("_range").collect()
    assert all(x.b < y.a for x, y in zip(ordered, ordered[1:]))


# Blocks, champions, sampling


def test_consecutive_blocks(spark):
    df = frame(spark, [("r", 7), ("r", 8), ("r", 10), ("s", 7)], "k string, hour int")
    blocks = consecutive_blocks(df, ["k"], "hour")
    assert rows(blocks) == [("r", 10, 10), ("r", 7, 8), ("s", 7, 7)]
    assert consecutive_blocks(df.filter("hour > 20"), ["k"], "hour").isEmpty()


def champions(spark, data, bucket="1"):
    runs = frame(spark, data, "name string, score double, n int")
    marked = mark_champions(runs, "name", "score", ["n"], F.expr(bucket))
    found = {(r.name, r.n): r.promoted for r in marked.collect()}
    spread = mark_champions(runs, "name", "score", ["n"], F.expr(bucket), F.col("n"))
    assert found == {(r.name, r.n): r.promoted for r in spread.collect()}
    return found


@pytest.mark.parametrize("bucket", ["1", "n", "n div 2"])
def test_champions(spark, bucket):
    nan, inf = float("nan"), float("inf")
    data = [("a", s, n) for n, s in enumerate([inf, nan, 0.5, 0.5, 0.7, nan, 0.4, 0.45, 0.1])]
    data += [("b", 9.0, 0), (None, 3.0, 0), (None, 4.0, 1), ("c", None, 0)]
    marks = champions(spark, data, bucket)
    promoted = {key for key, value in marks.items() if value}
    assert promoted == {("a", 2), ("a", 6), ("a", 8), ("b", 0), (None, 0)}
    assert None not in marks.values()
    assert ("c", 0) not in marks


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=40), st.integers(1, 7))
def test_champions_equal_running_minimum(spark, scores, size):
    marks = champions(spark, [("a", float(s), n) for n, s in enumerate(scores)], f"n div {size}")
    expected = [all(s < earlier for earlier in scores[:n]) for n, s in enumerate(scores)]
    assert [marks["a", n] for n in range(len(scores))] == expected


def sampled(spark, hours, start=T0, key="a"):
    df = frame(spark, [(key, at(h)) for h in hours], "key string, ts timestamp_ntz")
    kept = sample_by_gap(df, "key", "ts", start.isoformat(sep=" "))
    return sorted((r.ts - T0).total_seconds() / 3600 for r in kept.collect())


def test_sampling_bounds(spark):
    second = 1 / 3600
    assert sampled(spark, [6]) == []
    assert sampled(spark, [6 + second]) == [pytest.approx(6 + second)]
    assert sampled(spark, [7, 7, 13, 13 + second, 14]) == [7, pytest.approx(13 + second)]
    assert sampled(spark, [], start=T0) == []


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(0, 6000), max_size=60))
def test_sampling_equals_loop(spark, minutes):
    kept, last = [], 0
    for minute in sorted(minutes):
        if minute > last + 360:
            last = minute
            kept.append(minute)
    assert [round(h * 60) for h in sampled(spark, [m / 60 for m in minutes])] == kept


@pytest.mark.parametrize("chunk_slots, per_group, seed", [(2, 2, 0), (3, 4, 1), (16, 64, 2)])
def test_sampling_of_timelines_without_silence(spark, chunk_slots, per_group, seed):
    """One key that is busy over many chunks and groups of them, beside others with silences."""
    rng = random.Random(seed)
    second, moments = timedelta(seconds=1), {}
    for key, mean in (("busy", 40), ("even", 60), ("calm", 500)):
        now, moments[key] = T0 + timedelta(minutes=7), []
        while now < T0 + timedelta(hours=12):
            moments[key].append(now)
            now += second * (60 if key == "even" else rng.expovariate(1 / mean))
    df = frame(spark, [(k, m) for k, times in moments.items() for m in times], "key string, ts timestamp_ntz")
    kept = sample_by_gap(df, "key", "ts", T0.isoformat(sep=" "), 240, chunk_slots, per_group)
    expected = []
    for key, times in moments.items():
        last = T0
        for m in times:
            if m > last + 240 * second:
                last = m
                expected.append((key, m))
    assert rows(kept) == rows(frame(spark, expected, "key string, ts timestamp_ntz"))
    with pytest.raises(ValueError):
        sample_by_gap(df, "key", "ts", chunk_slots=1)


# Expansion


def test_repeat_rows(spark):
    df = frame(spark, [("a", -1), ("b", 0), ("c", 1), ("d", 2), ("e", None)], "k string, n int")
    copies = expand.repeat_rows(df, F.col("n"), "i").select("k", "i")
    assert rows(copies) == [("c", 0), ("d", 0), ("d", 1)]


def test_explode_arrays(spark):
    df = frame(spark, [("a", [1, 2], ["x", None]), ("b", [], [])], "k string, n array<int>, t array<string>")
    assert rows(expand.explode_arrays(df, ["n", "t"])) == [("a", 1, "x"), ("a", 2, None)]


def test_dated_schedule(spark):
    df = frame(spark, [("t", "07:30:00"), ("u", "25:10:00")], "trip string, clock string")
    dated = expand.dated_schedule(df, date(2025, 5, 16), date(2025, 5, 17), "clock")
    assert rows(dated.select("trip", "timestamp")) == [
        ("t", at(7.5)),
        ("t", at(31.5)),
        ("u", datetime(2025, 5, 17, 1, 10)),
        ("u", datetime(2025, 5, 18, 1, 10)),
    ]


# Filters


def test_choices(spark):
    df = frame(spark, [("5", "1"), ("5", "2"), ("8", "1")], "route string, stop_id string")
    assert filters.filter_choices(df, route="All", stop_id=None).count() == 3
    assert rows(filters.filter_choices(df, route="5", stop_id="1")) == [("5", "1")]


def test_required_fields(spark):
    df = frame(spark, [("a", "b"), ("", "b"), (None, "b"), ("a", None)], "x string, y string")
    good, bad = filters.split_required(df, ["x", "y"])
    assert rows(good) == [("a", "b")]
    assert bad.count() == 3


def test_complete_columns(spark):
    df = frame(
        spark, [(1, 1.0, "a"), (None, float("nan"), "b")], "some int, number double, full string"
    )
    assert filters.complete_columns(df) == ["full"]
    assert filters.missing_counts(df).first().asDict() == {"some": 1, "number": 1, "full": 0}


def test_clean_names(spark):
    df = frame(spark, [(1, 2)], [' "a" ', "'b'"])
    assert filters.clean_names(df).columns == ["a", "b"]


def test_any_row(spark):
    df = spark.range(100)
    assert filters.any_row(df, F.col("id") > 50).count() == 1
    assert filters.any_row(df, F.col("id") > 500).isEmpty()


# Merges


def test_insert_if_absent(spark):
    incoming = frame(
        spark,
        [("a", 1, 0, "d1"), ("b", 2, 2, "d1"), ("b", 3, 1, "d1"), (None, 4, 0, "d2")],
        "id string, v int, o int, day string",
    )
    existing = frame(spark, [("a", "d1"), ("z", "d0")], "id string, day string")
    fresh = merge.insert_if_absent(incoming, existing, "id", ["o"])
    assert rows(fresh) == [("b", 3, 1, "d1")]


def test_known_keys_at_any_time_are_not_added_again(spark):
    kind = "id string, timestamp timestamp_ntz, o int"
    table = frame(spark, [("A", datetime(2025, 1, 1), 0), ("B", datetime(2025, 1, 1), 0)], kind)
    batch = frame(
        spark, [("A", None, 1), ("B", datetime(2025, 3, 1), 2), ("C", None, 3)], kind
    )
    assert [r.id for r in missing_rows(batch, table, "id", ["o"]).collect()] == ["C"]


def test_range_of_another_table_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(20).withColumn("day", (F.col("id") % 10).cast("int")).write.partitionBy(
        "day"
    ).parquet(path)
    wanted = frame(spark, [(3,), (5,)], "day int")
    found = filters.within_range_of(spark.read.parquet(path), wanted, "day")
    assert {r.day for r in found.collect()} == {3, 4, 5}
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in scan and "Subquery" in scan.split("PartitionFilters: [")[1][:120]
    assert filters.within_range_of(spark.read.parquet(path), wanted.limit(0), "day").isEmpty()


def upserted(spark, *values):
    df = frame(spark, list(enumerate(values)), "offset long, value string")
    return rows(merge.upsert_latest(df, "id", ["offset"], ["x", "y"]))


def test_upsert(spark):
    result = upserted(
        spark,
        '{"id":"a","x":1,"y":"p"}',
        '{"id":"a","x":2}',
        '{"id":"b","x":5,"y":{"z":[1]}}',
        '{"id":"b","x":null}',
        '{"x":9}',
        "[1]",
        "junk",
    )
    assert result == [("a", "2", "p"), ("b", None, '{"z":[1]}')]


def test_last_of_a_repeated_name_counts(spark):
    text = '{"id":"a","x":1,"y":"p","x":2}'
    assert upserted(spark, text) == [("a", "2", "p")]
    df = frame(spark, [(0, text)], "offset long, value string")
    fields = merge.message_fields(df, F.lit("id"), ["offset"])
    assert [r.value for r in fields.filter("field = 'x'").collect()] == ["2"]


def test_upsert_in_two_steps_equals_one(spark):
    values = [(n, f'{{"id":"{n % 3}","x":{n},"y":{n if n % 2 else "null"}}}') for n in range(12)]
    df = frame(spark, values, "offset long, value string")

    def fields(part):
        return merge.message_fields(part, F.lit("id"), ["offset"])

    early = merge.latest_fields(fields(df.filter("offset < 7")))
    both = merge.latest_fields(early.unionByName(fields(df.filter("offset >= 7"))))
    assert rows(both) == rows(merge.latest_fields(fields(df)))


# Messages


def test_recent_messages_cut_before_the_filter(spark):
    data = [(n, "5" if n < 50 else "8") for n in range(200)]
    df = frame(spark, data, "offset long, route string")
    order = ["offset"]
    assert [r.offset for r in recent_messages(df, order).collect()] == list(range(100, 200))
    assert latest_message(df, order).first().offset == 199
    assert recent_for_route(df, "5", order).isEmpty()
    assert recent_for_route(df, "8", order).count() == 100
    assert recent_messages(df.filter("offset < 0"), order).isEmpty()


def test_recent_messages_go_by_the_time_of_the_broker(spark):
    data = [(datetime(2025, 1, 1, 5 - p, n), p, n) for p in (0, 1) for n in range(3)]
    df = frame(spark, data, "sent_at timestamp, partition int, offset long")
    assert [(r.partition, r.offset) for r in recent_messages(df, limit=4).collect()] == [
        (1, 2), (0, 0), (0, 1), (0, 2)
    ]


def test_pages_over_two_partitions_lose_nothing(spark):
    data = [("t", 0, n) for n in range(5)] + [("t", 1, n) for n in range(20)]
    df = frame(spark, data, "topic string, partition int, offset long")
    cursor, seen = df.limit(0), []
    for _ in range(9):
        page = read_page(df, cursor, limit=3)
        seen += [tuple(r) for r in page.collect()]
        cursor = spark.createDataFrame(next_cursor(page, cursor).collect(), df.schema)
    assert sorted(seen) == data
    assert rows(cursor) == [("t", 0, 4), ("t", 1, 19)]
    assert read_page(df, cursor).isEmpty()


def test_routing(spark):
    df = frame(spark, [("gps.topic",), ("model.train.topic",)], "topic string")
    assert rows(route_topics(df)) == [("gps.topic", "gps", "measurement_id")]


def test_split_messages(spark):
    values = ['{"a":1}', '{"a":"x"}', "junk", "", None, "{}", '{"a":2,"b":3}']
    df = frame(spark, [(v,) for v in values], "value string")
    good, bad = split_messages(df, schema("a int"))
    assert rows(good) == [(1,), (2,), (None,)]
    assert rows(bad.select("value")) == rows(
        frame(spark, [('{"a":"x"}',), ("junk",), ("",), (None,)], "value string")
    )


def test_sent_messages_can_be_read_back(spark):
    df = frame(spark, [("m", 0.5, 7)], "model_key string, accuracy double, timestamp long")
    message = to_messages(df, "model.train.topic").first()
    assert message.value == '{"model_key":"m","accuracy":0.5,"timestamp":7}'


def test_prediction_log_types(spark):
    df = frame(
        spark,
        [(5, T0, 1, 0.5, 20, 10.0, "3", 2, 0, True, 0, 1, 0.25)],
        "route_short_name int, timestamp timestamp_ntz, peak_hour int, sine_time double, "
        "temperature int, precipitation_probability double, weather_code string, "
        "traffic_level int, event_dummy int, school boolean, hospital int, weekend int, "
        "prediction double",
    )
    row = prediction_log(df).first()
    assert row.created_at is not None
    assert (row.route_short_name, row.timestamp) == ("5", "2025-05-16 00:00:00")
    assert (row.peak_hour, row.weather_code, row.weekend) == (True, 3, True)
