"""Calls through a landing: tries, bounds, and one call for each key whatever runs again."""

import pathlib
import time
import uuid

import pytest

from riskloom.operators import calls, scorers


class Counted:
    """A scorer that leaves a mark for each call, and tells how many of a key's calls were made before."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, page):
        at = pathlib.Path(self.folder) / str(page["id"])
        at.mkdir(parents=True, exist_ok=True)
        before = len(list(at.iterdir()))
        (at / uuid.uuid4().hex).touch()
        return self.answer(page, before)

    def answer(self, page, before):
        return page["id"] * 2

    def made(self):
        return {int(p.name): len(list(p.iterdir())) for p in pathlib.Path(self.folder).iterdir()}


class Flaky(Counted):
    def answer(self, page, before):
        if before < 2:
            raise ConnectionError("busy")
        return "12"


class Broken(Counted):
    def answer(self, page, before):
        if page["id"] == 1:
            raise TimeoutError("never")
        if page["id"] == 2:
            raise ValueError("bad request")
        return None


class Dying(Counted):
    """Ends its process' task at one key, the first time that it is asked about it."""

    def answer(self, page, before):
        if page["id"] == 7 and before == 0:
            raise KeyboardInterrupt
        return "x"


def at(tmp_path, **options):
    return calls.Landing(f"file://{tmp_path}/landed", **{"wait": (0.0, 0.0), **options})


def ids(spark, n):
    return spark.range(1, n + 1)


def test_transient_errors_are_tried_again(spark, tmp_path):
    ask = Flaky(tmp_path / "calls")
    got = calls.landed(ids(spark, 6), "id", ask, at(tmp_path), "k").collect()
    assert {r["id"]: (r["answer"], r["error"], r["tries"]) for r in got} == {k: ("12", None, 3) for k in range(1, 7)}
    assert set(ask.made().values()) == {3}


def test_errors_are_outcomes(spark, tmp_path):
    ask = Broken(tmp_path / "calls")
    df = calls.landed(ids(spark, 3), "id", ask, at(tmp_path), "k")
    want = {1: (None, "TimeoutError: never", 3), 2: (None, "ValueError: bad request", 1), 3: (None, None, 1)}
    for _ in range(2):
        assert {r["id"]: (r["answer"], r["error"], r["tries"]) for r in df.collect()} == want
    assert ask.made() == {1: 3, 2: 1, 3: 1}


def test_every_key_is_asked_once(spark, tmp_path):
    """Rows that stand twice, a plan evaluated again, a later plan over more keys; another kind is asked for itself."""
    ask, landing = Counted(tmp_path / "calls"), at(tmp_path, calls=3)
    df = calls.landed(ids(spark, 9).union(ids(spark, 4)), "id", ask, landing, "k")
    assert df.count() == 9 and df.count() == 9
    more = calls.landed(ids(spark, 12), "id", ask, landing, "k").collect()
    assert {r["id"]: r["answer"] for r in more} == {k: str(2 * k) for k in range(1, 13)}
    assert ask.made() == {k: 1 for k in range(1, 13)}
    assert calls.landed(ids(spark, 2), "id", ask, landing, "other").count() == 2 and ask.made()[1] == 2


def test_a_task_that_died_goes_on(spark, tmp_path):
    ask, landing = Dying(tmp_path / "calls"), at(tmp_path, calls=1)
    rows = lambda: calls.landed(ids(spark, 20), "id", ask, landing, "k").collect()
    with pytest.raises(Exception):
        rows()
    before = ask.made()
    assert 0 < len(before) <= 20
    assert len(rows()) == 20
    assert ask.made() == {k: 2 if k == 7 else 1 for k in range(1, 21)}


def test_calls_at_once(spark, tmp_path):
    marks = tmp_path / "now"
    marks.mkdir()

    def ask(page):
        mine = marks / uuid.uuid4().hex
        mine.touch()
        n = len(list(marks.iterdir()))
        time.sleep(0.05)
        mine.unlink()
        return n

    got = calls.landed(ids(spark, 24), "id", ask, at(tmp_path, calls=2), "k").collect()
    assert max(int(r["answer"]) for r in got) <= 2


def test_waits():
    waits = []

    def ask(_):
        raise ConnectionError

    out = calls.call(ask, {}, calls.Landing("file:///x", attempts=6, pause=waits.append))
    assert waits == [2, 2, 4, 8, 10] and out["tries"] == 6


def test_scorers_through_a_landing(spark, tmp_path):
    pages = spark.createDataFrame([(1, "<p>some words that make a page of text</p>"), (2, "<p>x</p>"), (3, None)], "id long, html string")
    ask = Flaky(tmp_path / "calls")
    got = {r["id"]: (r["class"], r["called"]) for r in scorers.score(pages, "id", "html", "software", ask, landing=at(tmp_path)).collect()}
    assert got == {1: (12, True), 2: (9, False), 3: (9, False)} and ask.made() == {1: 3}
