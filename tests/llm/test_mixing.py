"""The mix against its SQL and against a plain loop over documents."""

import collections
import hashlib
import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from riskloom.llm import mixing, oracles

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, key string, part long, s string, epochs long"
ROWS = [(1, None, None), (2, "", "a"), (3, "a b c", "a"), (3, "a b c", "a"), (None, "x y", "b"), (None, "x y z", "b"), (4, "w " * 20_000, "b"), (5, "# # #", None), (6, "\n \n", "é"), (7, "l\nl\nl\nm", "z")]


def edge_docs(spark):
    return spark.createDataFrame([(*r, "k", 1, "s", 0) for r in ROWS], SCHEMA)


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, x or 0) for x in r])


def plain(docs):
    """Rows of the mix by a loop."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    names = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    total = {n: sum(z for z, d in zip(sizes, docs) if d[2] == n) for n in names}
    weight = {n: mixing.WEIGHTS[k % 3] for k, n in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes)
    while True:
        level = left / (sum(weight[n] for n in free) or 1)
        above = {n for n in free if weight[n] * level > 2 * total[n] + 1e-9}
        if not above:
            break
        for n in above:
            target[n] = 2.0 * total[n]
            left -= target[n]
        free -= above
    target |= {n: weight[n] * level for n in free}

    def key(doc_id, text):
        u = (int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        lines = [x for x in (text or "").split("\n") if x]
        if not lines:
            return -math.log(u)
        symbols = sum(text.count(c) for c in mixing.SYMBOLS)
        return -math.log(u) / max(0.05, len(set(lines)) / len(lines) * (1 - 10 * symbols / len(text)))

    out = []
    for n in names:
        mine = sorted((key(i, t), (i is not None, i or 0), z, i) for (i, t, s), z in zip(docs, sizes) if s == n)
        whole = math.floor(target[n] / total[n] + 1e-9) if total[n] else 0
        budget, before = target[n] - whole * total[n], 0
        for _, _, z, i in mine:
            out.append((i, z, total[n], z * (whole + (2 * before + z <= 2 * budget + 1e-9))))
            before += z
    return target, out


def test_mix_equals_a_loop(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    for docs, df in ((ROWS, edge_docs(spark)), ([tuple(r) for r in rows], spark.read.parquet(f"{SF}/documents.parquet"))):
        target, want = plain(docs)
        got = mixing.mix(df).collect()
        assert order((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in got) == order(want)
        assert sorted(r["target"] for r in got) == pytest.approx(sorted(target[s] for _, _, s in docs))


@pytest.mark.parametrize("parts", [1, 5])
def test_mix_matches_its_sql(spark, parts):
    con = duckdb.connect()
    for df in (spark.read.parquet(f"{SF}/documents.parquet"), edge_docs(spark)):
        con.register("documents", df.toArrow())
        assert order(mixing.mix(df.repartition(parts)).collect()) == order(con.sql(oracles.MIX).fetchall())
        con.unregister("documents")


def test_targets_and_limits(spark):
    df = mixing.op11_source_mix(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source"), "doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    most = {r["source"]: r["m"] for r in df.groupBy("source").agg(F.max("size").alias("m")).collect()}
    for r in df.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("n"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect():
        assert abs(r["taken"] - r["target"]) <= most[r["source"]] / 2 and r["target"] <= 2 * r["n"] and r["over"] <= 0
    assert df.agg(F.sum("size")).first()[0] * 1.5 == pytest.approx(sum({r["source"]: r["target"] for r in df.select("source", "target").distinct().collect()}.values()))
    assert df.count() == docs.count()


def test_heavier_documents_come_first(spark):
    """Documents of weight 4 are sampled more often than those of weight 1; all have one size."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.when(F.col("id") < 3000, "x").otherwise("y").alias("source"))
    got = mixing.mix(docs, weights=(1, 8), weight=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)).filter("source_size = 6000")
    first = {r["even"]: r["m"] for r in got.groupBy((F.col("doc_id") % 2 == 0).alias("even")).agg(F.avg("epochs").alias("m")).collect()}
    assert first[True] > first[False] + 0.05


def test_nothing_to_mix(spark):
    assert mixing.mix(edge_docs(spark).limit(0)).collect() == []
    assert [tuple(r) for r in mixing.mix(edge_docs(spark).filter("doc_id = 2")).collect()] == [(2, 0, 0, 0.0, 0, 0)]


def test_many_sources(spark):
    """A source for every document: ranks, rounds and offsets hold beyond a few sources."""
    docs = spark.range(700).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 13).cast("int")).alias("text"), F.format_string("s%04d", F.col("id")).alias("source"))
    target, want = plain([tuple(r) for r in docs.collect()])
    got = mixing.mix(docs).collect()
    assert order((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in got) == order(want)
