"""Streams over several files give what the batch gives."""

import random
import statistics

from pyspark.sql import functions as F

from plumbline.functions.clock import instant
from plumbline.operators import sessions as N
from plumbline.sources import tables
from plumbline.sources.sinks import SnapshotStore
from plumbline.streaming import stateful, streams, trend

EVENTS = "/root/testdata/sf0.001/events.parquet"


def split_events(spark, tmp_path):
    events = spark.read.parquet(EVENTS)
    for i in range(4):
        part = events.filter((F.col("event_id") >= i * 250) & (F.col("event_id") < (i + 1) * 250))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path))
    return streams.table_stream(spark, str(tmp_path), "*.parquet", events.schema, 1), events


def test_rollup_in_batches_equals_one_pass(spark, tmp_path):
    stream, events = split_events(spark, tmp_path / "e")

    def shaped(df):
        return df.select(
            "user_id", "event_id", F.round(F.col("value") / 1000, 6).alias("score"), instant("ts").alias("at")
        )

    def parts(df):
        return streams.rollup_parts(shaped(df), "user_id", "event_id", "score", "at", late="400 days")

    running = streams.run_updates(parts(stream), "t", ["user_id", "_period"])
    got = streams.session_rollup(running, "user_id")
    want = streams.session_rollup(parts(events), "user_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    trend = N.drift_trend(shaped(events), "user_id", "event_id", "score")
    drifted = {r["user_id"]: r["z_last"] for r in trend.collect()}
    assert all(abs(drifted[r["user_id"]] - r["z_last"]) < 1e-5 for r in got.collect())


def test_drift_in_batches_equals_batch(spark, tmp_path):
    stream, events = split_events(spark, tmp_path / "e")

    def shaped(df):
        return df.select(
            F.col("user_id").alias("session"), F.col("event_id").alias("turn"),
            F.round(F.col("value") / 1000, 6).alias("score"), instant("ts").alias("at"),
        )

    got = streams.run_to_table(stateful.drift_stream(shaped(stream)), "d").collect()
    want = {r["turn"]: r["z"] for r in N.drift(shaped(events), "session", "turn", "score").collect()}
    assert len(got) == len(want) and all(abs(r["z"] - want[r["turn"]]) < 1e-4 for r in got)


def trend_by_hand(rows, idle_s):
    """``(session, turn): (z, band, run_ix, run_turns)`` of ``(session, turn, score, at seconds)``."""
    out, past = {}, {}
    for session, turn, score, at in sorted(rows, key=lambda r: (r[0], r[3], r[1])):
        held = past.get(session)
        if held is None or at - held["at"] >= idle_s:
            held = past[session] = {"scores": [], "band": None, "run": -1, "n": 0}
        band = "unknown" if score is None else "green" if score >= 0.35 else "amber" if score >= 0.2 else "red"
        if held["run"] < 0 or band != held["band"]:
            held.update(band=band, run=held["run"] + 1, n=0)
        earlier = held["scores"]
        z = 0.0
        if score is not None:
            spread = statistics.stdev(earlier) if len(earlier) >= 2 else 0.0
            z = (score - statistics.fmean(earlier)) / spread if spread > 1e-9 else 0.0
            earlier.append(score)
        held.update(at=at, n=held["n"] + 1)
        out[session, turn] = (z, band, held["run"], held["n"])
    return out


def test_trend_over_files_out_of_order_equals_batch(spark, tmp_path):
    pick, hour = random.Random(4), 3600
    rows = []
    for session in range(6):
        at = 1_700_000_000
        for turn in range(60):
            # now and then a session pauses for longer than the idle time
            at += pick.choice([0, 600, hour, 5 * hour, 5 * hour, 90 * hour])
            rows.append((session, turn, pick.choice([None, 0.1, 0.25, 0.3, 0.6, round(pick.random(), 6)]), at))
    # a row may come in a file up to ten hours after its time
    shuffled = sorted(rows, key=lambda r: r[3] + pick.randint(0, 10 * hour))
    step = len(shuffled) // 8 + 1
    schema = "session bigint, turn bigint, score double, s bigint"
    for i in range(0, len(shuffled), step):
        spark.createDataFrame(shuffled[i : i + step], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    want = trend_by_hand(rows, 72 * hour)
    closed = max(r[3] for r in rows) - 12 * hour
    for per_trigger in (1, 3):
        stream = streams.table_stream(spark, str(tmp_path / "t"), "*.parquet", spark.createDataFrame([], schema).schema, per_trigger)
        outcomes = stream.select("session", "turn", "score", F.timestamp_seconds("s").alias("at"))
        with trend.rocksdb(spark):
            got = streams.run_to_table(trend.trend_stream(outcomes, "12 hours", idle_hours=72), "t").collect()
        found = {(r.session, r.turn): (r.z, r.band, r.run_ix, r.run_turns) for r in got}
        assert len(got) == len(found) == sum(r[3] <= closed for r in rows)
        for key, row in found.items():
            assert row[1:] == want[key][1:] and abs(row[0] - want[key][0]) < 1e-5
    assert spark.conf.get(trend.PROVIDER, None) != trend.ROCKSDB


def test_join_of_streams_equals_join_of_tables(spark, tmp_path):
    """Scores in other files than their requests, early, late, twice and never."""
    pick, start = random.Random(8), 1_700_000_000
    asked = [(i if i % 13 else None, start + 300 * i) for i in range(240)]
    made = [(i, i / 1000, at + pick.choice([-60, 0, 900, 3600, 3601])) for i, at in asked if i and i % 3]
    made += [(i, -1.0, at + 30) for i, at in asked if i and i % 10 == 0]
    schemas = ("request_id bigint, s bigint", "request_id bigint, score double, s bigint")
    for name, rows, schema in zip("qs", (asked, made), schemas):
        rows = sorted(rows, key=lambda r: r[-1])
        for i in range(0, len(rows), 50):
            spark.createDataFrame(rows[i : i + 50], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def shaped(read):
        at = F.timestamp_seconds("s")
        requests = read(tmp_path / "q", schemas[0]).select("request_id", at.alias("at"))
        scores = read(tmp_path / "s", schemas[1]).select("request_id", "score", at.alias("scored_at"))
        return streams.join_scores(requests, scores, ["request_id"], "1 hour", "2 hours").select(
            "request_id", "score", F.unix_seconds("at").alias("at"), F.unix_seconds("scored_at").alias("scored_at")
        )

    def stream(path, schema):
        return streams.table_stream(spark, str(path), "*.parquet", spark.createDataFrame([], schema).schema, 1)

    got = streams.run_to_table(shaped(stream), "j").collect()
    whole = shaped(lambda path, schema: spark.read.schema(schema).parquet(str(path))).collect()
    passed = min(max(r[-1] for r in asked), max(r[-1] for r in made)) - 2 * 3600
    want = [r for r in whole if r.scored_at is not None or r.at + 3600 < passed]
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(got) == order(want) and any(r.score is None for r in got) and len(want) < len(whole)


def test_snapshot_store(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "sid int, v string")
    store = SnapshotStore(spark, str(tmp_path / "s"), rows.schema, "sid", buckets=4)

    def some(*values):
        return spark.createDataFrame(list(values), "sid int, v string")

    assert store.all().count() == 0 and store.load(3).count() == 0
    store.save(rows)
    store.save(some((3, "new"), (77, "more"), (None, "nobody")))
    assert store.load(3).collect() == [(3, "new")]
    assert store.load(5).collect() == [(5, "v5")]
    assert store.all().count() == 21
    store.delete(spark.createDataFrame([(3,), (5,), (None,)], "sid int"))
    assert store.load(3).count() == 0 and store.all().count() == 19
    before = sorted(map(tuple, store.all().collect()))
    store.compact()
    assert sorted(map(tuple, store.all().collect())) == before and len(store._commits()) == 1
    store.save(some((3, "back")))
    assert store.load(3).collect() == [(3, "back")] and store.all().count() == 20


def test_two_savers_keep_both(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "sid int, v string")
    one, two = (SnapshotStore(spark, str(tmp_path / "s"), rows.schema, "sid", buckets=2) for _ in range(2))
    one.save(rows)
    seen = two._commits()
    two._commits = lambda: seen  # the second saver starts before the first has committed
    one.save(spark.createDataFrame([(2, "b")], "sid int, v string"))
    two.save(spark.createDataFrame([(3, "c")], "sid int, v string"))
    assert sorted(map(tuple, one.all().collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_on_band_acts_on_the_given_bands(spark, tmp_path):
    rows = spark.createDataFrame([(1, "red"), (2, "green"), (3, "amber"), (4, None)], "id int, band string")
    rows.coalesce(1).write.parquet(str(tmp_path / "b"))
    stream = streams.table_stream(spark, str(tmp_path / "b"), "*.parquet", rows.schema)

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={batch_id}"))

    streams.on_band(stream, ("red", "amber"), keep, str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema("id int, band string").parquet(str(tmp_path / "out/*"))
    assert sorted(r["id"] for r in got.collect()) == [1, 3]


def test_read_interactions_is_typed(spark, tmp_path):
    (tmp_path / "log.json").write_text(
        '{"response_text":"a","support_units":[{"text":"t","speaker":"s"}],"evidence_limit":3}\n{"response_text":null}\n'
    )
    rows = tables.read_interactions(spark, str(tmp_path / "log.json"))
    assert rows.schema == tables.INTERACTION
    got = {r["response_text"]: r for r in rows.collect()}
    assert got["a"]["support_units"][0]["speaker"] == "s" and got["a"]["evidence_limit"] == 3
    assert got[None]["support_units"] is None
