import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import domains, relational
from riskloom.plans import capture_queries, domain_queries, queries as plans  # noqa: F401  (the first two register queries)


def test_keywords_inside_names(spark):
    """Against every pair, with keywords of one character, keywords that hold others, and characters beyond ASCII."""
    draw = random.Random(7)
    names = ["".join(draw.choice("abé-.") for _ in range(draw.randint(0, 14))) for _ in range(300)] + ["aaaaaaaa", None, "ünï-code", "😀x😀x"]
    words = ["".join(draw.choice("abé-.") for _ in range(draw.randint(1, 7))) for _ in range(60)] + ["aaaa", "a", "ï-cod", "😀x", "", None, "zzzzz"]
    n, w = (spark.createDataFrame([(x,) for x in v], f"{c} string") for v, c in ((names, "n"), (words, "w")))
    got = {tuple(r) for r in domains.keyword_hits(n, "n", w, "w").collect()}
    assert got == {(a, b, i + 1) for a in names if a for b in words if b for i in range(len(a)) if a.startswith(b, i)}


def test_keywords_are_filed_under_their_rarest_gram(spark):
    """A name costs no row for a keyword whose filed gram it lacks, and building the plan runs no job."""
    names = spark.range(500).select(F.concat(F.lit("shop"), F.col("id").cast("string")).alias("n"))
    words = spark.createDataFrame([("shopzq",), ("shop9",)], "w string")
    group = "keywords"
    spark.sparkContext.setJobGroup(group, "")
    hits = domains.keyword_hits(names, "n", words, "w")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    assert hits.count() == sum(f"shop{k}".startswith("shop9") for k in range(500))


def test_brands(spark):
    names = spark.createDataFrame([(1, "My-NETFLIX-tv.com"), (2, "short.org"), (3, None), (4, "my-netflix-tv.com")], "id long, name string")
    brands = spark.createDataFrame([(" Netflix ", True), ("short", True), ("org", False), (None, True)], "keyword string, brand boolean")
    assert {r["id"] for r in domains.brand_known(names, "name", brands).filter("brand_known").collect()} == {1, 4}
    assert {r["id"] for r in domains.brand_known(names, "name", brands, least=1).filter("brand_known").collect()} == {1, 2, 4}
    assert domains.brand_known(names, "name", brands.limit(0)).filter("brand_known").count() == 0
    assert domains.brand_known(names, "name", brands).count() == 4


SUFFIXES = ["com", "uk", "co.uk", "*.ck", "!www.ck", "dev", " GitHub.io ", ""]
HOSTS = {
    "a.b.example.com": ("com", "example.com", "a.b"),
    "example.com": ("com", "example.com", None),
    "www.x.co.uk": ("co.uk", "x.co.uk", "www"),
    "co.uk": ("co.uk", "co.uk", None),
    "a.b.c.ck": ("c.ck", "b.c.ck", "a"),
    "c.ck": ("c.ck", "c.ck", None),
    "a.www.ck": ("ck", "www.ck", "a"),
    "ck": ("", "ck", None),
    "p.q.github.io": ("github.io", "q.github.io", "p"),
    "db.intranet": ("", "intranet", "db"),
    "localhost": ("", "localhost", None),
}


def test_longest_suffix(spark):
    hosts = spark.createDataFrame([(h,) for h in [*HOSTS, "10.0.0.1", "::1", "", None, "co.uk"]], "host string")
    rules = spark.createDataFrame([(x,) for x in SUFFIXES], "suffix string")
    assert {r["host"]: tuple(r)[1:] for r in domains.by_suffix(hosts, "host", rules).collect()} == HOSTS
    assert {r["suffix"] for r in domains.by_suffix(hosts, "host", rules.limit(0)).collect()} == {""}


def test_cleaned(spark):
    """What the export leaves out: addresses, platforms and their projects, empty and null names."""
    rows = [("https://www.a.com/x", 2), ("a.com", 1), ("b.pages.dev", 3), ("pages.dev", 3), ("10.0.0.1", 3), ("http://[::1]:80/", 3), ("300.1.1.1", 6), ("c.co.uk", 4), ("http://münchen.de/x", 5), ("", 0), (None, 0)]
    df = spark.createDataFrame(rows, "url string, seen int")
    clean = {tuple(r) for r in domains.cleaned(df, "url", "seen").collect()}
    assert clean == {("a.com", 1), ("c.co.uk", 4), ("xn--mnchen-3ya.de", 5), ("1.1", 6)}
    rules = spark.createDataFrame([("com",), ("uk",), ("dev",), ("de",)], "suffix string")
    assert {tuple(r) for r in domains.cleaned(df, "url", "seen", suffixes=rules).collect()} == {("a.com", 1), ("co.uk", 4), ("xn--mnchen-3ya.de", 5), ("1", 6)}
    tlds = spark.createDataFrame([("co",), (None,)], "tld string")
    assert {r[0] for r in domains.cleaned(df, "url", "seen", tlds=tlds).collect()} == {"a.com", "c.co.uk", "xn--mnchen-3ya.de", "1.1"}
    assert {r[0] for r in domains.cleaned(df, "url", "seen", platforms=["a.com"]).collect()} >= {"pages.dev", "c.co.uk"}


def test_plans_stay_compiled(spark):
    """The generated code of the export fits into methods: nothing falls back to interpretation."""
    df = spark.createDataFrame([("https://www.a.com/x", 2)], "url string, seen int")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert domains.cleaned(df, "url", "seen").count() == 1
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_open_features(spark):
    hub = spark.createDataFrame([(1, None, True), (2, None, None), (3, False, False)], "k long, a boolean, b boolean")
    assert sorted((r["k"], r["feature"]) for r in domains.open_features(hub, ["a", "b"]).collect()) == [(1, "a"), (2, "a"), (2, "b")]
    assert sorted((r["k"], r["feature"]) for r in domains.open_features(hub.filter("k = 3"), ["a", "b"]).collect()) == [(3, "all")]


@pytest.mark.parametrize("keep", [[], ["v"]])
def test_a_key_updated_twice_is_an_error(spark, keep):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string")
    with pytest.raises(Exception, match="more than one update for key 1"):
        relational.keyed_update(base, twice, "k", ["v"], keep_old=keep).collect()
    once = spark.createDataFrame([(1, None), (2, "y")], "k long, v string")
    assert {r["k"]: r["v"] for r in relational.keyed_update(base, once, "k", ["v"], keep_old=keep).collect()} == {1: "a" if keep else None, 2: "y"}


def test_neither_side_of_an_index_is_broadcast(spark):
    """A plan's estimate doesn't see what explodes, so small tables would send all grams through the driver."""
    names = spark.range(200).select(F.concat(F.lit("building-"), F.col("id").cast("string"), F.lit(".com")).alias("n"))
    words = spark.range(300).select(F.concat(F.lit("building-"), F.col("id").cast("string")).alias("w"))
    hits = domains.keyword_hits(names, "n", words, "w")
    assert hits.count() == sum(f"building-{a}.com".startswith(f"building-{b}") for a in range(200) for b in range(300))
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 == plan.count("strategy=merge")


def test_keywords_at_the_edges_of_gram_sizes(spark):
    """Keywords a character shorter and longer than each size, some of them twice, all sharing their short grams."""
    draw = random.Random(3)
    words = ["".join(draw.choice("01") for _ in range(k)) for k in (1, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33) for _ in range(6)]
    names = [a + w + b for w in words for a, b in (("", ""), ("0", "1"), ("x-", ".y"))]
    n, w = (spark.createDataFrame([(x,) for x in v], f"{c} string") for v, c in ((names, "n"), (words + words[::2], "w")))
    got = [tuple(r) for r in domains.keyword_hits(n, "n", w, "w").collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b, i + 1) for a in names for b in words for i in range(len(a)) if a.startswith(b, i)}


@pytest.mark.parametrize("name", ["brand_domains", "brand_places", "rude_rules"])
def test_brand_queries_broadcast_no_grams(spark, name):
    plan = plans.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=merge") == 2
