import datetime
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import relational
from riskloom.streaming import responses


def test_windows(spark, tmp_path):
    src = tmp_path / "events"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(2).write.parquet(str(src))
    out = responses.per_window(responses.read_events(spark, str(src)))
    q = out.writeStream.outputMode("complete").format("memory").queryName("per_window").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select sum(n) from per_window").first()[0] == 1000


def drain(spark, df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_sessions_and_first_seen(spark, tmp_path):
    """Two users, a gap of an hour, and a repeated kind of event; a last event far ahead closes what is open."""
    rows = [(1, "2025-01-01 00:00:00", 1, "a"), (2, "2025-01-01 00:10:00", 1, "a"), (3, "2025-01-01 01:10:00", 1, "b"), (4, "2025-01-01 00:05:00", 2, "a"), (5, "2025-01-09 00:00:00", 3, "z")]
    df = spark.createDataFrame(rows, "event_id long, t string, user_id long, event_type string").selectExpr("event_id", "cast(t as timestamp_ntz) as ts", "user_id", "event_type", "0D as value", "'' as props")
    src = str(tmp_path / "events")
    df.coalesce(1).write.parquet(src)
    found = drain(spark, responses.sessions(responses.read_events(spark, src)), "sessions", "append")
    assert sorted((r["user_id"], r["n"]) for r in found if r["user_id"] < 3) == [(1, 1), (1, 2), (2, 1)]
    firsts = drain(spark, responses.first_seen(responses.read_events(spark, src)), "firsts")
    assert sorted((r["user_id"], r["event_type"]) for r in firsts) == [(1, "a"), (1, "b"), (2, "a"), (3, "z")]


def test_first_events(spark, tmp_path):
    """The stream keeps the same users and types as the table's query."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "e"))
    got = drain(spark, responses.first_seen(responses.read_events(spark, str(tmp_path / "e")), "1000 days"), "first_events")
    want = responses.first_events(events).collect()
    assert sorted((r["user_id"], r["event_type"]) for r in got) == sorted((r["user_id"], r["event_type"]) for r in want)


LOG = "site long, seq long, url string, status int, ts timestamp"


def stream(spark, batches, folder, name, **options):
    """What the stream tells of batches, each a file of its own; a response of site -1 far ahead lets the watermark pass all."""
    responses.use_rocksdb(spark)
    ahead = datetime.datetime(2100, 1, 1)
    for k, rows in enumerate([*batches, [(-1, 0, "z", 200, ahead)], [(-1, 1, "z", 200, ahead)]]):
        spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(f"{folder}/{k:04d}")
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{folder}/*")
    return sorted(tuple(r) for r in drain(spark, responses.without_repeats(log, **options), name) if r["site"] >= 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_of_a_shuffled_stream(spark, tmp_path, seed):
    """Micro-batches in any order within the delay, rows twice, nulls and ties of time: the rows of the batch operator."""
    draw = random.Random(seed)
    start = datetime.datetime(2025, 1, 1)
    rows = [(draw.randrange(4), k, draw.choice(["a", "b", None]), draw.choice([200, 301, None]), start + datetime.timedelta(minutes=k // 2)) for k in range(120)]
    want = relational.without_repeats(spark.createDataFrame(rows, LOG)).select("site", "seq", "url", "status", "ts").collect()
    draw.shuffle(rows)
    batches = [rows[k : k + 30] + draw.sample(rows, 3) for k in range(0, 120, 30)]
    assert stream(spark, batches, tmp_path / "log", f"repeats{seed}", late="2 hours") == sorted(tuple(r) for r in want)


def test_late_rows_and_quiet_sites(spark, tmp_path):
    at = lambda h, m=0: datetime.datetime(2025, 1, 1, h, m)
    batches = [
        [(1, 1, "a", 200, at(0)), (1, 2, "b", 200, at(1)), (2, 1, "a", 200, at(0))],
        [(3, 1, "x", 200, at(6))],
        [(1, 3, "c", 200, at(0, 30)), (2, 2, "b", 200, at(9))],  # the first is later than the hour allows
        [(1, 4, "c", 200, at(1, 30)), (1, 5, "d", 200, at(10))],  # late again; then after more than eight hours
        [(1, 6, "e", 200, at(11))],
    ]
    got = stream(spark, batches, tmp_path / "log", "quiet", late="1 hour", quiet=datetime.timedelta(hours=8))
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 2, "b"), (1, 6, "e")]
    got = stream(spark, batches, tmp_path / "again", "unquiet", late="1 hour")
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 2, "b"), (1, 5, "d"), (1, 6, "e"), (2, 2, "b")]
