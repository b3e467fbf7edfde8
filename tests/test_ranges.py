"""Orders over ranges, on keys that are sparse, equal or hot, against plain sorting."""

import datetime
import random

from pyspark.sql import functions as F

from riskloom.operators import captures, ranges, referrals, relational


def test_ranks(spark):
    draw = random.Random(3)
    for keys in ([draw.randrange(-(1 << 62), 1 << 62) for _ in range(500)], [draw.choice("abcdef") * draw.randint(0, 5) + str(k) for k in range(500)], [7] * 50, []):
        df = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], f"k {'string' if keys and isinstance(keys[0], str) else 'long'}, n long")
        got = ranges.ranked(df, ["k", "n"], "rank").collect()
        assert [(r["k"], r["n"]) for r in sorted(got, key=lambda r: r["rank"])] == sorted((k, n) for n, k in enumerate(keys))
        assert sorted(r["rank"] for r in got) == list(range(len(keys)))


def test_pages_of_sparse_keys(spark):
    draw = random.Random(4)
    keys = [draw.randrange(1 << 62) for _ in range(305)]
    got = captures.keyset_pages(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 30).collect()
    assert {r["k"]: r["page"] for r in got} == {k: n // 30 for n, k in enumerate(sorted(keys))}


def plain(rows):
    """Responses without repeats by a loop."""
    out = []
    for site in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == site), key=lambda r: r[1])
        out += [b for a, b in zip(own, own[1:]) if a[2] != b[2]]
    return sorted(out)


def test_a_hot_site_is_dealt_over_ranges(spark):
    """A site with most rows stands in several ranges, others share one; nulls are values like others."""
    draw = random.Random(5)
    rows = [(0, k * 10**12, draw.choice(["a", "b", None]), 200) for k in range(3000)]
    rows += [(draw.randint(1, 40), 10**7 + k, draw.choice(["a", None]), 200) for k in range(1500)]
    log = spark.createDataFrame(rows, "site long, seq long, url string, status int")
    parts = ranges.dealt(log, ["site", "seq"]).groupBy("site").agg(F.count_distinct("__part").alias("n")).collect()
    assert next(r["n"] for r in parts if r["site"] == 0) > 1
    assert sorted(map(tuple, relational.without_repeats(log).collect())) == plain(rows)
    assert relational.without_repeats(log.limit(0)).count() == 0


def test_first_rows_are_cut_before_the_shuffle(spark):
    log = spark.createDataFrame([(k % 3, k, 200 if k % 7 else 404, f"https://a.com/{k}") for k in range(200)], "site long, seq long, status int, url string")
    x = captures.scanned(log)
    assert x._jdf.queryExecution().optimizedPlan().toString().count("WindowGroupLimit") == 1
    got = {r["site"]: r for r in x.collect()}
    for site in range(3):
        own = [k for k in range(200) if k % 3 == site]
        assert got[site]["n_responses"] == len(own) and [s["seq"] for s in got[site]["scan"]] == own[:10] and got[site]["last"] == (200 if own[-1] % 7 else 404)


def test_sketches_roll_forward(spark):
    """A window over months from sketches alone; a month that is added changes nothing that was made before."""
    month = lambda k: datetime.date(2025, k, 1)
    rows = [(d, "x", r, month(k), 1, True, True) for d in (1, 2) for k in range(1, 8) for r in range(40 * k, 40 * k + 60 * d)]
    m = spark.createDataFrame(rows, "d_sec_domain_id long, destination_domain string, r_domain_id long, month date, visits long, own boolean, counted boolean")
    known = spark.range(1000).select(F.col("id").alias("domain_id"), F.when(F.col("id") % 2 == 0, 1).alias("analyst_class"), F.lit(2).alias("ml_class"))
    old, new = (referrals.referrer_sketches(x, known) for x in (m.filter("month < DATE'2025-07-01'"), m.filter("month = DATE'2025-07-01'")))
    at = lambda k: F.lit(month(k))
    for sketches, first, last in ((old, 1, 6), (old.union(new), 2, 7), (old.union(new), 7, 7)):
        got = {r["sec_domain_id"]: r["referring_sites"] for r in referrals.referring_sites(sketches, at(first), at(last)).collect()}
        for d in (1, 2):
            exact = len({r[2] for r in rows if r[0] == d and month(first) <= r[3] <= month(last) and r[2] % 2 == 0})
            assert abs(got[d] - exact) <= 0.05 * exact + 0.5
