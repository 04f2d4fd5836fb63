"""Streams over files: the streamed result equals the batch result, repeats change nothing."""

import json
import os
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.operators.merge import upsert_latest
from headway.operators.sampling import sample_by_gap
from headway.plans.occupancy import current_occupancy
from headway.sinks.keyindex import add_keys, first_ever, fold_keys, known_keys
from headway.sinks.logs import add_to_log, fold_log, read_log
from headway.sinks.tables import BATCH, read_parts, read_version, write_part, write_version
from headway.sources.messages import file_stream, parse_messages
from headway.streaming.archive import archive, fold_archive, read_archive
from headway.streaming.champion import current_champion, decide_champions
from headway.plans.features import build_features
from headway.streaming.features import (
    fold_features,
    maintain_features,
    read_features,
    update_features,
)
from headway.streaming.ingest import (
    first_of_shape,
    first_seen,
    ingest_first_ever,
    ingest_once,
    ingest_tickets_and_sensors,
)
from headway.streaming.occupancy import (
    fold_occupancy,
    movements,
    read_occupancy,
    track_occupancy,
)
from headway.streaming.running import run_until_any_ends, start
from headway.streaming.weather import replace_weather, sample_stream

TS = datetime(2025, 5, 16, 8)


def ticket(n, bus=1, trip="t1", stop="s1", minutes=0, **extra):
    return {
        "ticket_id": f"k{n}",
        "timestamp": (TS + timedelta(minutes=minutes)).isoformat(),
        "stop_id": stop,
        "route": "5",
        "passenger_type": "adult",
        "fare": 2.5,
        "bus_id": bus,
        "trip_id": trip,
        "peak_hour": 1,
        "hospital": 0,
        "school": 0,
    } | extra


def sensor(n, status=1, **extra):
    row = ticket(n, **extra)
    del row["ticket_id"], row["passenger_type"], row["fare"]
    return row | {"measurement_id": f"m{n}", "status": status, "activation_type": 2}


class Topic:
    """A folder of JSON-lines files; each send is one file."""

    def __init__(self, folder):
        self.folder, self.offset, self.files = folder, 0, 0
        folder.mkdir()

    def send(self, topic, *values):
        lines = []
        for value in values:
            text = value if isinstance(value, str) else json.dumps(value)
            lines.append(
                json.dumps({"topic": topic, "partition": 0, "offset": self.offset, "value": text})
            )
            self.offset += 1
        path = self.folder / f"{self.files:05d}.json"
        path.write_text("\n".join(lines) + "\n")
        # Files are read in the order of their times.
        os.utime(path, (1_700_000_000 + self.files,) * 2)
        self.files += 1


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


def stream(spark, topic):
    return file_stream(spark, str(topic.folder), max_files=1)


def finish(*queries):
    for query in queries:
        query.awaitTermination(120)
        assert query.exception() is None
        assert not query.isActive


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_ingest_appends_good_rows_and_keeps_rejects(spark, topic, tmp_path):
    topic.send("ticketing.topic", ticket(1), "not json", ticket(2, fare="much"))
    topic.send("sensors.topic", sensor(1), ticket(3))
    topic.send("ticketing.topic", ticket(4, timestamp="tomorrow"))
    out, checkpoints = str(tmp_path / "out"), str(tmp_path / "checkpoints")
    finish(*ingest_tickets_and_sensors(lambda _: stream(spark, topic), out, checkpoints))
    tickets = spark.read.parquet(f"{out}/raw_tickets")
    assert rows(tickets.select("ticket_id", "timestamp")) == [("k1", TS), ("k4", None)]
    rejects = spark.read.parquet(f"{out}/raw_tickets_rejects")
    assert [r.value[:8] for r in rejects.orderBy("offset").collect()] == ["not json", '{"ticket']
    assert spark.read.parquet(f"{out}/raw_sensors").count() == 2

    # A restart reads nothing twice, and new messages only add.
    finish(*ingest_tickets_and_sensors(lambda _: stream(spark, topic), out, checkpoints))
    assert spark.read.parquet(f"{out}/raw_tickets").count() == 2
    topic.send("ticketing.topic", ticket(5))
    finish(*ingest_tickets_and_sensors(lambda _: stream(spark, topic), out, checkpoints))
    assert spark.read.parquet(f"{out}/raw_tickets").count() == 3


def test_ingest_once_lets_the_first_message_win(spark, topic, tmp_path):
    table = str(tmp_path / "gps")

    def existing(session):
        if not Path(table).exists():
            return session.createDataFrame([], schemas.GPS)
        return session.read.schema(schemas.GPS).parquet(table)

    def append(df):
        df.write.mode("append").parquet(table)

    def run(checkpoint):
        gps = ingest_once(
            stream(spark, topic),
            schemas.GPS_MESSAGE,
            "measurement_id",
            existing,
            append,
            str(tmp_path / f"{checkpoint}_rejects"),
            str(tmp_path / checkpoint),
        )
        finish(gps)
        return rows(existing(spark).select("measurement_id", "bus_id"))

    def gps(name, bus, minutes=0):
        moment = (TS + timedelta(minutes=minutes)).isoformat()
        return {"measurement_id": name, "bus_id": bus, "timestamp": moment}

    topic.send("gps.topic", gps("a", 1), gps("a", 2), gps(None, 3), "junk", gps("b", 4, 5))
    topic.send("gps.topic", gps("b", 5, 5), gps("c", 6, 600))
    expected = [("a", 1), ("b", 4), ("c", 6)]
    assert run("one") == expected
    rejected = spark.read.parquet(str(tmp_path / "one_rejects")).orderBy("offset")
    assert [r.reason for r in rejected.collect()] == ["measurement_id: missing", "undecodable"]
    # With the checkpoint lost all messages come again, and add nothing.
    assert run("two") == expected


def test_all_queries_stop_when_one_fails(spark, topic, tmp_path):
    topic.send("t", "x")
    spark.streams.resetTerminated()

    def fail(batch, batch_id):
        raise ValueError("no table")

    def wait(batch, batch_id):
        pass

    waiting = start(stream(spark, topic), wait, str(tmp_path / "waiting"), every="1 second")
    failing = start(stream(spark, topic), fail, str(tmp_path / "failing"), every="1 second")
    with pytest.raises(Exception, match="no table"):
        run_until_any_ends(spark)
    assert not waiting.isActive and not failing.isActive
    spark.streams.resetTerminated()


def test_repeated_batch_replaces_its_part(spark, tmp_path):
    table = str(tmp_path / "table")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    write_part(df, table, 7)
    write_part(df, table, 7)
    assert spark.read.parquet(table).count() == 2


def test_occupancy_stream_equals_batch(spark, topic, tmp_path):
    sent_tickets, sent_sensors = [], []

    def batch_result():
        def table(values, message_schema):
            lines = [(json.dumps(v),) for v in values]
            return parse_messages(spark.createDataFrame(lines, "value string"), message_schema)

        return rows(
            current_occupancy(
                table(sent_tickets, schemas.TICKET_MESSAGE),
                table(sent_sensors, schemas.SENSOR_MESSAGE),
            ).select("bus_id", "trip_id", "latest_timestamp", "total_occupancy")
        )

    def run():
        messages = stream(spark, topic)
        tickets = parse_messages(
            messages.filter("topic = 'ticketing.topic'"), schemas.TICKET_MESSAGE
        )
        sensors = parse_messages(messages.filter("topic = 'sensors.topic'"), schemas.SENSOR_MESSAGE)
        folder = str(tmp_path / "occupancy")
        finish(
            track_occupancy(movements(tickets, sensors), folder, str(tmp_path / "checkpoint"))
        )
        return rows(read_occupancy(spark, folder))

    steps = [
        # An alighting before its stop has a boarding, another bus, a missing route.
        ([ticket(1), ticket(2, stop="s2", minutes=5)], [sensor(1, minutes=9, stop="s3")]),
        ([ticket(3, minutes=9, stop="s3"), ticket(4, bus=2)], [sensor(2), sensor(3, status=0)]),
        ([ticket(5, bus=3, route=None)], [sensor(4, bus=3, route=None)]),
        # More alightings than boardings: the sum is cut off at zero, but remembered below it.
        ([], [sensor(n, bus=2) for n in range(10, 14)]),
        ([ticket(n, bus=2) for n in range(6, 8)], []),
        ([ticket(9, minutes=24 * 60)], [sensor(20, minutes=24 * 60)]),
    ]
    for step, (new_tickets, new_sensors) in enumerate(steps):
        if step in (3, 5):
            before = rows(read_occupancy(spark, str(tmp_path / "occupancy")))
            finished = max(
                int(p.name.split("=")[1])
                for p in (tmp_path / "occupancy" / "changes" / "parts").glob(f"{BATCH}=*")
            )
            fold_occupancy(spark, str(tmp_path / "occupancy"), finished)
            assert rows(read_occupancy(spark, str(tmp_path / "occupancy"))) == before
        sent_tickets += new_tickets
        sent_sensors += new_sensors
        if new_tickets:
            topic.send("ticketing.topic", *new_tickets)
        if new_sensors:
            topic.send("sensors.topic", *new_sensors)
        assert run() == batch_result()


def test_archive_stream_equals_batch_upsert(spark, topic, tmp_path):
    sent = [
        {"measurement_id": "a", "speed": 1, "note": "x"},
        {"measurement_id": "a", "speed": 2},
        {"measurement_id": "b", "speed": 3, "note": "y"},
        {"speed": 4},
        {"measurement_id": "b", "note": None},
    ]
    topic.send("gps.topic", *sent[:2])
    topic.send("other.topic", {"measurement_id": "c"})
    topic.send("gps.topic", *sent[2:], "junk")
    table = str(tmp_path / "archive")
    finish(archive(stream(spark, topic), table, str(tmp_path / "checkpoint")))
    names = ["speed", "note"]
    streamed = rows(read_archive(spark, table, "gps", "measurement_id", names))
    assert streamed == [("a", "2", "x"), ("b", "3", None)]
    lines = [(n, json.dumps(v)) for n, v in enumerate(sent)]
    batch = spark.createDataFrame(lines, "offset long, value string")
    assert streamed == rows(upsert_latest(batch, "measurement_id", ["offset"], names))

    for upto in (0, 1, 2):
        fold_archive(spark, table, upto)
        assert streamed == rows(read_archive(spark, table, "gps", "measurement_id", names))
    topic.send("gps.topic", {"measurement_id": "a", "note": "z"})
    finish(archive(stream(spark, topic), table, str(tmp_path / "checkpoint")))
    latest = rows(read_archive(spark, table, "gps", "measurement_id", names))
    assert latest == [("a", "2", "z"), ("b", "3", None)]


def forecast(hours, **extra):
    return {
        "measurement_id": "1",
        "timestamp": TS.isoformat(),
        "latitude": 46.0,
        "longitude": 11.0,
        "weather_code": [0] * len(hours),
        "precipitation_probability": [10.0] * len(hours),
        "temperature": [20.0] * len(hours),
        "hour": [f"2025-05-16T{h:02d}:00" for h in hours],
    } | extra


def test_weather_stream_replaces_the_snapshot(spark, topic, tmp_path):
    table, checkpoint = str(tmp_path / "weather"), str(tmp_path / "checkpoint")
    rejects = str(tmp_path / "weather_rejects")

    def run(*messages):
        topic.send("weather.topic", *messages)
        finish(replace_weather(stream(spark, topic), table, rejects, checkpoint))
        return [r.hour.hour for r in read_version(spark, table).orderBy("hour").collect()]

    assert run(forecast([1, 2])) == [1, 2]
    assert run(forecast([3, 4, 5]), forecast([6], temperature=[None]), "junk") == [3, 4, 5]
    # Nothing valid: the old snapshot stays.
    assert run(forecast([7], temperature=[1.0, 2.0])) == [3, 4, 5]
    assert run(forecast([8])) == [8]
    reasons = [r.reason for r in spark.read.parquet(rejects).orderBy("offset").collect()]
    assert reasons == ["temperature:number", "timestamp:missing", "arrays:length"]


def test_failed_load_leaves_the_old_version(spark, tmp_path):
    table = str(tmp_path / "table")
    write_version(spark.range(3), table, 1)
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_version(broken, table, 2)
    assert read_version(spark, table).count() == 3


def test_champion_stream(spark, topic, tmp_path):
    table, checkpoint = str(tmp_path / "champions"), str(tmp_path / "checkpoint")

    def run(*runs):
        topic.send(
            "model.train.topic",
            *[{"model_key": k, "accuracy": a, "timestamp": 1} for k, a in runs],
        )
        finish(
            decide_champions(
                stream(spark, topic), table, f"{table}_best", f"{table}_rejects", checkpoint
            )
        )
        return current_champion(spark, table).first()

    assert run(("m1", 0.5))["model_key"] == "m1"
    assert run(("m2", 0.5), ("m3", 0.6))["model_key"] == "m1"
    assert run(("m4", 0.4), ("m5", 0.45), ("m6", 0.3))["model_key"] == "m6"
    decided = spark.read.parquet(table).filter("promoted").orderBy("offset")
    assert [r.model_key for r in decided.collect()] == ["m1", "m4", "m6"]
    topic.send("model.train.topic", "junk")
    assert run(("m7", 0.35))["model_key"] == "m6"
    assert [r.value for r in spark.read.parquet(f"{table}_rejects").collect()] == ["junk"]


def test_old_and_unfinished_folders_do_not_disturb_readers(spark, tmp_path):
    schema = schemas.schema("id long")
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    for n in range(40):
        add_to_log(spark.range(n, n + 1), log, n)
    fold_log(spark, log, schema, lambda df: df, 29)
    fold_log(spark, log, schema, lambda df: df, 29)
    for n in (1, 2):
        write_version(spark.range(n), table, n)

    def spoil(folder):
        for file in Path(folder).rglob("*.parquet"):
            file.write_bytes(b"spoilt")

    spoil(f"{log}/parts/{BATCH}=3")
    spoil(f"{table}/version=1")
    write_version(spark.range(5), table, 3)
    (Path(table) / "version=3" / "_SUCCESS").unlink()
    assert read_version(spark, table).count() == 2
    rows_ = read_log(spark, log, schema)
    assert sorted(r.id for r in rows_.collect()) == list(range(40))
    assert len(rows_.inputFiles()) <= 8 + 10 * 8
    assert not any(f"{BATCH}=3/" in name for name in rows_.inputFiles())
    assert read_log(spark, log, schema, before=35).count() == 35


def events(spark, topic, *batches):
    for batch in batches:
        topic.send("t", *[{"key": k, "timestamp": t.isoformat()} for k, t in batch])
    schema = schemas.schema("key string, timestamp string")
    return parse_messages(stream(spark, topic), schema)


def collect_stream(df, tmp_path, name):
    query = (
        df.writeStream.format("parquet")
        .option("path", str(tmp_path / name))
        .option("checkpointLocation", str(tmp_path / f"{name}_checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    finish(query)
    return df.sparkSession.read.schema(df.schema).parquet(str(tmp_path / name))


def test_sampled_stream_equals_batch(spark, topic, tmp_path):
    """Moments in any order and any batch within the delay; a last row lets the watermark pass."""
    rng = random.Random(3)
    hours = [0, 6, 6.001, 7, 12.001, 12.002, 13, 40, 45, 46.001, 46.002, 46.002]
    moments = [("a", TS + timedelta(hours=h)) for h in hours]
    moments += [("b", TS + timedelta(hours=h)) for h in (6, 12.5)]
    moments += [("c", TS + timedelta(minutes=rng.randint(0, 4000))) for _ in range(60)]
    moments.sort(key=lambda m: m[1])
    start = TS.isoformat(sep=" ")
    batch = spark.createDataFrame(moments, "key string, timestamp timestamp_ntz")
    expected = rows(sample_by_gap(batch, "key", "timestamp", start))
    assert [t for k, t in expected if k == "b"] == [TS + timedelta(hours=12.5)]

    # Rows of up to eight hours around come in any order, so in the batch before or after.
    near = sorted(moments, key=lambda m: m[1] + timedelta(hours=rng.uniform(0, 8)))
    cuts = [near[:20], near[20:45], near[45:], [("z", TS + timedelta(days=30))]]
    stream_of = events(spark, topic, *cuts)
    streamed = collect_stream(
        sample_stream(stream_of, "key", "timestamp", start, delay="8 hours"), tmp_path, "sampled"
    )
    assert rows(streamed) == expected


def test_sampled_stream_leaves_out_what_comes_after_the_delay(spark, topic, tmp_path):
    """In the batch after, 6.5 hours is still undecided and counts; two batches later it is not."""
    hours = [(7, 30), (6.5,), (30,), (6.4,), (999,)]
    batches = [[("a", TS + timedelta(hours=h)) for h in hs] for hs in hours]
    df = sample_stream(events(spark, topic, *batches), "key", "timestamp", TS.isoformat(sep=" "))
    kept = [t for _, t in rows(collect_stream(df, tmp_path, "late"))]
    assert kept == [TS + timedelta(hours=h) for h in (6.5, 30)]


def test_first_seen_stream(spark, topic, tmp_path):
    batches = [[("a", TS), ("b", TS), ("a", TS)], [("a", TS + timedelta(minutes=1))]]
    df = first_seen(events(spark, topic, *batches), ["key"], "1 hour")
    assert rows(collect_stream(df, tmp_path, "first").select("key")) == [("a",), ("b",)]


def other_tables(spark):
    """Trips, traffic, weather and city events for the feature table."""
    day = timedelta(days=1)
    trips = [("t1", 1, "S"), ("t2", 1, "S"), ("t3", 2, None), ("t4", 2, "U")]
    traffic = [("1", TS, "S", 1, 2, "low"), ("2", TS, None, 1, 2, "medium"), ("3", TS, "U", 1, 2, "high")]
    weather = [(n, TS - 30 * day + n * timedelta(hours=7), 20.0 + n, 5.0, n) for n in range(150)]

    def table(rows_, names, kind):
        data = [dict(zip(names, row)) for row in rows_]
        return spark.createDataFrame([[d.get(n) for n in kind.names] for d in data], kind)

    return (
        table(trips, ["trip_id", "route_id", "shape_id"], schemas.TRIPS),
        table(traffic, ["measurement_id", "timestamp", "shape_id", "normal", "traffic", "traffic_level"], schemas.TRAFFIC),
        table(weather, ["measurement_id", "hour", "temperature", "precipitation_probability", "weather_code"], schemas.WEATHER),
        table([((TS + 2 * day).date(),)], ["day_event"], schemas.CITY_EVENTS),
    )


def random_facts(rng, n):
    """Tickets and readings of few trips, days and times, so that days come back and last times of
    both sides often agree."""
    out = []
    for k in range(n):
        minutes = rng.randint(-3, 3) * 1440 + rng.choice([0, 5, 9])
        common = dict(trip=rng.choice(["t1", "t2", "t3", "t4", None]), minutes=minutes, peak_hour=rng.choice([0, 1, None]))
        common["school"] = rng.randint(0, 1)
        out.append((ticket if rng.random() < 0.5 else sensor)(rng.randint(0, 10**9), **common))
    return out


def test_maintained_features_equal_a_rebuild(spark, topic, tmp_path):
    rng = random.Random(11)
    others, folder = other_tables(spark), str(tmp_path / "features")
    told = []
    for n in range(3):
        facts = random_facts(rng, 25)
        told += facts
        topic.send("ticketing.topic", *[f for f in facts if "ticket_id" in f], "not json")
        topic.send("sensors.topic", *[f for f in facts if "ticket_id" not in f])
        query = maintain_features(stream(spark, topic), lambda _: others, folder, str(tmp_path / "cp"), fold_every=2)
        finish(query)
        kinds = (schemas.TICKET_MESSAGE, "ticket_id"), (schemas.SENSOR_MESSAGE, "measurement_id")
        facts = [
            parse_messages(spark.createDataFrame([(json.dumps(f),) for f in told if name in f], "value string"), kind)
            for kind, name in kinds
        ]
        expected = rows(build_features(*facts, *others))
        found = read_features(spark, folder)
        assert found.columns == build_features(*facts, *others).columns
        assert rows(found) == expected and expected


def test_a_folder_of_a_part_is_one_file_if_small(spark, tmp_path):
    """Of 16 tasks that each hold rows of three days; before, each wrote a file to every day."""
    df = spark.range(960).repartition(16).select("id", (F.col("id") % 3).cast("int").alias("day"))
    for name, write in (("part", write_part), ("version", write_version)):
        path = str(tmp_path / name)
        write(df, path, 7, "day")
        written = spark.read.parquet(path)
        assert len(written.inputFiles()) == 3
        assert rows(written.select("id", "day")) == rows(df)


def test_a_batch_makes_its_counts_once(spark, tmp_path, monkeypatch):
    """Features, first times and needed trip-days come from the written counts: the facts are read
    for them alone, and rows of the features are made once."""
    from headway.streaming import features

    folder, made = str(tmp_path / "features"), []
    real = features.features_of_days

    def watched(*args):
        made.append(real(*args))
        return made[-1]

    monkeypatch.setattr(features, "features_of_days", watched)
    facts = [parse_messages(spark.createDataFrame([(json.dumps(r),)], "value string"), kind)
             for r, kind in ((ticket(1, trip="t1", minutes=0), schemas.TICKET_MESSAGE), (sensor(1, trip="t1", minutes=0), schemas.SENSOR_MESSAGE))]
    update_features(spark, folder, 0, *facts, *other_tables(spark))
    assert any("/counts/parts/" in f for f in made[0].inputFiles())
    assert not spark._jsc.sc().getPersistentRDDs().size()


def test_late_facts_undo_what_they_change(spark, tmp_path):
    """A late first peak flag turns all days of its trip, a later ticket takes a day away, a reading
    brings it back; days of other trips are neither read nor written."""
    others, folder = other_tables(spark), str(tmp_path / "features")
    day = 1440

    def step(n, tickets, sensors):
        made = [
            parse_messages(spark.createDataFrame([(json.dumps(r),) for r in some], "value string"), kind)
            for some, kind in ((tickets, schemas.TICKET_MESSAGE), (sensors, schemas.SENSOR_MESSAGE))
        ]
        for _ in range(2):  # a repeated batch changes nothing
            update_features(spark, folder, n, *made, *others)
        found = read_features(spark, folder)
        return sorted((r.trip_id_x, (r.timestamp_x - TS) / timedelta(days=1), r.peak_hour, r.congestion_rate * 400) for r in found.collect())

    both = [dict(trip=t, minutes=d * day) for t, d in (("t1", 1), ("t1", 2), ("t2", 1))]
    first = step(0, [ticket(n, **b) for n, b in enumerate(both)], [sensor(n, **b) for n, b in enumerate(both)])
    assert first == [("t1", 1, 1, 0), ("t1", 2, 1, 0), ("t2", 1, 1, 0)]
    late = step(1, [ticket(9, trip="t1", minutes=0, peak_hour=0)], [])
    assert late == [("t1", 1, 0, 0), ("t1", 2, 0, 0), ("t2", 1, 1, 0)]
    parts = spark.read.parquet(f"{folder}/features/parts/{BATCH}=1")
    assert {(r.trip_id_x, r.live) for r in parts.collect()} == {("t1", True), ("t1", False)}
    taken = step(2, [ticket(10, trip="t1", minutes=2 * day + 3)], [])
    assert taken == [("t1", 1, 0, 0), ("t2", 1, 1, 0)]
    assert spark.read.parquet(f"{folder}/features/parts/{BATCH}=2").count() == 1
    fold_features(spark, folder, 2)
    back = step(3, [ticket(11, trip="t1", minutes=2 * day + 3, fare=None)], [sensor(11, trip="t1", minutes=2 * day + 3)])
    assert [b[:3] for b in back] == [("t1", 1, 0), ("t1", pytest.approx(2 + 3 / day), 0), ("t2", 1, 1)]
    assert [b[3] for b in back] == pytest.approx([0, 0, 0])


def test_first_ever_stream_forgets_no_key(spark, topic, tmp_path):
    """A key of the first batch is still known in the last one, after folding and months later."""
    batches = [[(f"k{n}", TS + timedelta(days=9 * b, minutes=n)) for n in range(b, 40, 7)] for b in range(8)]
    batches[7] += [("k0", TS + timedelta(days=400)), ("new", TS), ("new", TS), (None, TS)]
    table, index = str(tmp_path / "table"), str(tmp_path / "index")
    seen = ["key", "timestamp"]
    finish(ingest_first_ever(events(spark, topic, *batches), "key", ["timestamp"], table, index, str(tmp_path / "cp"), 3))
    first = {}
    for key, moment in [row for batch in batches for row in batch]:
        if key is not None:
            first.setdefault(key, moment)
    found = read_parts(spark, table, schemas.schema(f"key string, timestamp timestamp_ntz, {BATCH} int"))
    assert rows(found.select(seen)) == sorted(first.items(), key=repr)


def test_key_index_opens_only_buckets_that_may_hold_a_key(spark, tmp_path):
    path = str(tmp_path / "index")
    for n in range(3):
        keys = spark.range(n * 1000, n * 1000 + 1000).withColumn("id", F.col("id").cast("string"))
        add_keys(keys, "id", path, n, buckets=64)
    asked = spark.createDataFrame([("5",), ("2999",), ("77777",)], "id string")
    known = known_keys(asked, "id", path, 3, buckets=64)
    assert rows(known) == [("2999",), ("5",)]
    # 192 folders are there; a key that is nowhere opens one now and then.
    assert 2 <= len({f.rsplit("/", 1)[0] for f in known.inputFiles()}) <= 4
    assert rows(known_keys(asked, "id", path, 2, buckets=64)) == [("5",)]
    fold_keys(spark, path, 1)
    again = known_keys(asked, "id", path, 3, buckets=64)
    assert rows(again) == [("2999",), ("5",)]
    assert {"base" in f for f in again.inputFiles()} == {True, False}
    # A filter that is full opens every bucket, and the answer is the same.
    add_keys(spark.range(3000, 9000).select(F.col("id").cast("string").alias("id")), "id", f"{path}2", 0, 4, 1)
    assert rows(known_keys(asked.unionByName(spark.createDataFrame([("3001",)], "id string")), "id", f"{path}2", 1, 4, 1)) == [("3001",)]
    assert known_keys(asked, "id", str(tmp_path / "none"), 1).isEmpty()


def test_a_repeated_batch_finds_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "index")
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), (None, 1)], "id string, n int")
    for _ in range(2):
        fresh = first_ever(batch, "id", ["n"], path, 4)
        assert rows(fresh) == [("a", 1), ("b", 1)]
        add_keys(fresh, "id", path, 4)
    assert first_ever(batch, "id", ["n"], path, 5).isEmpty()


def test_first_of_shape_stream(spark, topic, tmp_path):
    batches = [[("s1", TS)], [("s1", TS + timedelta(days=9)), ("s2", TS)]]
    df = first_of_shape(events(spark, topic, *batches).withColumnRenamed("key", "shape_id"))
    assert rows(collect_stream(df, tmp_path, "shapes")) == [("s1", TS), ("s2", TS)]


def test_no_parts_yet(spark, tmp_path):
    schema = schemas.schema(f"id long, {BATCH} int")
    assert read_parts(spark, str(tmp_path / "nothing"), schema).count() == 0
