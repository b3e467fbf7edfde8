"""Idempotent inserts: replays, concurrent writers, failures between staging and commit."""

import threading

import pytest
from pyspark.sql import functions as F

from riskloom.operators import relational
from riskloom.sources import commits

SCHEMA = "k string, v long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def held(spark, table):
    return sorted(map(tuple, commits.read_table(spark, table, SCHEMA).collect()))


@pytest.fixture
def table(tmp_path):
    return f"file://{tmp_path}/table"


def test_keys_go_in_once(spark, table):
    assert held(spark, table) == []
    assert commits.insert_new(frame(spark, ("a", 1), ("a", 2), (None, 3)), table, "k", "1")
    assert commits.insert_new(frame(spark, ("a", 9), ("b", 4)), table, "k", "2")
    assert commits.insert_new(frame(spark, ("b", 9)), table, "k", "3")
    assert held(spark, table) == [("a", 1), ("a", 2), ("b", 4)]


def test_a_replayed_batch_changes_nothing(spark, table):
    assert commits.insert_new(frame(spark, ("a", 1)), table, "k", "s-0")
    assert not commits.insert_new(frame(spark, ("a", 1), ("z", 1)), table, "k", "s-0")
    assert commits.insert_new(frame(spark), table, "k", "s-1") and not commits.insert_new(frame(spark, ("y", 1)), table, "k", "s-1")
    assert held(spark, table) == [("a", 1)]


def test_a_writer_who_comes_second(spark, table, monkeypatch):
    """Another writer commits twice between this one's staging and its claim."""
    real, others = commits.claim, [("x", ("b", 7), ("c", 7)), ("y", ("d", 8))]

    def claim(*args):
        monkeypatch.setattr(commits, "claim", real)
        for batch, *rows in others:
            assert commits.insert_new(frame(spark, *rows), table, "k", batch)
        return real(*args)

    monkeypatch.setattr(commits, "claim", claim)
    assert commits.insert_new(frame(spark, ("a", 1), ("b", 1), ("d", 1)), table, "k", "mine")
    assert held(spark, table) == [("a", 1), ("b", 7), ("c", 7), ("d", 8)]


def test_the_same_batch_from_two_writers(spark, table, monkeypatch):
    real = commits.claim

    def claim(*args):
        monkeypatch.setattr(commits, "claim", real)
        assert commits.insert_new(frame(spark, ("a", 1)), table, "k", "same")
        return real(*args)

    monkeypatch.setattr(commits, "claim", claim)
    assert not commits.insert_new(frame(spark, ("a", 1), ("b", 2)), table, "k", "same")
    assert held(spark, table) == [("a", 1)]


def test_many_writers_at_once(spark, table):
    failed = []

    def write(n):
        try:
            commits.insert_new(frame(spark, *[(f"k{(n + j) % 6}", 10 * n + j) for j in range(4)]), table, "k", f"w{n}")
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = held(spark, table)
    assert not failed and sorted(k for k, _ in got) == [f"k{j}" for j in range(6)]
    assert commits.read_state(spark, table).batches == {f"w{n}" for n in range(5)}


def test_rows_without_a_commit_are_not_seen(spark, table, monkeypatch):
    def dies(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(commits, "claim", dies)
        with pytest.raises(RuntimeError):
            commits.insert_new(frame(spark, ("a", 1)), table, "k", "1")
    assert held(spark, table) == []
    assert commits.insert_new(frame(spark, ("a", 1)), table, "k", "1") and held(spark, table) == [("a", 1)]


def test_as_a_sink_of_a_stream(spark, table, tmp_path):
    """A stream that starts again without its checkpoint replays all batches."""
    for n in range(3):
        frame(spark, ("a", n), (f"b{n}", n)).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    for _ in range(2):
        rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        q = rows.writeStream.foreachBatch(lambda df, n: commits.insert_new(df, table, "k", f"stream-{n}") and None).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
    got = held(spark, table)
    assert sorted(k for k, _ in got) == ["a", "b0", "b1", "b2"]


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([("Online", 1), ("Online", None), ("Lost", 2), (None, 3)], "status string, n long")
    x, seen = relational.observed(df, {"status": ["Online", "Offline"]}, {"total": F.sum("n")})
    x.write.parquet(str(tmp_path / "out"))
    assert relational.counts(seen) == {"rows": 4, "status=Online": 2, "status=Offline": 0, "status=other": 2, "total": 6}
