"""Runs of words against a search of every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from riskloom.llm import runs

SF = "/root/testdata/sf0.001"


def every_run(w, least):
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i + q - s
            if size >= max(least, 2 * q) and not any(all(w[x] == w[x + d] for x in range(s, s + size - d)) for d in range(1, q)):
                out.add((s, size, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def laid(texts):
    numbers = {x: k + 1 for k, x in enumerate(sorted({y for w in texts for y in w}))}
    ends = np.cumsum([len(w) + 1 for w in texts]) - 1
    symbols = np.zeros(int(ends[-1]) + 1, np.int64)
    for w, e in zip(texts, ends):
        symbols[e - len(w) : e] = [numbers[x] for x in w]
    return symbols, ends


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(200):
        texts = []
        for _ in range(draw.randint(1, 5)):
            w = [draw.choice("abcde"[: draw.choice([1, 2, 3, 5])]) for _ in range(draw.choice([0, 1, 2, 5, 13, 40, 90]))]
            if len(w) > 20 and draw.random() < 0.5:
                a, p = draw.randrange(len(w) - 10), 1 + draw.randrange(8)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            texts.append(w)
        least = draw.choice([2, 6, 12])
        symbols, ends = laid(texts)
        got = [tuple(r) for r in np.stack(runs.find_runs(symbols, ends, least), axis=1).tolist()]
        assert got == [(s + int(e) - len(w), n, q) for w, e in zip(texts, ends) for s, n, q in every_run(w, least)]


def test_long_chains_and_deep_repeats():
    """Places that many others pass on to, and neighbours in the suffix array that share thousands of words."""
    w = ["b"] + ["c"] * 5000 + ["a"] + [str(k % 7) for k in range(3000)] + [str(k) for k in range(1000)] * 2
    symbols, ends = laid([w, w[:50]])
    got = np.stack(runs.find_runs(symbols, ends), axis=1).tolist()
    assert [1, 5000, 1] in got and [5002, 3000, 7] in got and [8002, 2000, 1000] in got
    fib = ["a"], ["a", "b"]
    for _ in range(9):
        fib = fib[1], fib[1] + fib[0]
    symbols, ends = laid([fib[1]])
    assert [tuple(r) for r in np.stack(runs.find_runs(symbols, ends, 4), axis=1).tolist()] == every_run(fib[1], 4)


def test_minima():
    draw = np.random.default_rng(2)
    for n in (1, 15, 16, 17, 300):
        v = draw.integers(0, 50, n)
        lo = draw.integers(0, n, 400)
        hi = np.minimum(n - 1, lo + draw.integers(0, n, 400))
        assert runs.Minima(v).least(lo, hi).tolist() == [v[a : b + 1].min() for a, b in zip(lo, hi)]


def plain(doc_id, text):
    """A result row by the search of every period."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = every_run(w, 12)
    gone = {k for s, size, q in found for k in range(s + q, s + size)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, sha("".join(f"{s},{k},{q}\n" for s, k, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


@pytest.mark.parametrize("group", [60, runs.GROUP_WORDS])
def test_query_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(runs, "GROUP_WORDS", group)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len((r["text"] or "").split()) < 400]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in runs.periodic_runs(docs, plant=True).collect()}
    assert got == {plain(*r) for r in rows} and any(r[1] for r in got)


def test_edges(spark):
    t = "one two three " * 9
    rows = [(1, None), (2, ""), (3, " \n\t "), (5, t), (5, t), (None, t), (6, "a"), (7, "w " * 30_000), (8, " ".join(map(str, range(30_000))))]
    docs = spark.createDataFrame([(a, b, "k", 1, 2) for a, b in rows], "doc_id long, text string, n_runs string, start long, kind long")
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    by = {r["doc_id"]: tuple(r)[1:] for r in got}
    assert by[1] == by[2] == by[3] == (0, None, None, None, None, empty, empty)
    assert by[5] == by[None] and by[5][:5] == (1, 0, 27, 3, 9000) and by[5][6] == hashlib.sha256(b"one two three").hexdigest()
    assert by[7][:5] == (1, 0, 30_000, 1, 30_000_000) and by[8][0] == 0
    assert runs.periodic_runs(docs.limit(0)).collect() == []
