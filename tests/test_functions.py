"""Boundary rows of scalar functions and rules."""

import re

import pytest
from pyspark.sql import functions as F

from riskloom.functions import pages, text as tx
from riskloom.operators import captures, domains, html_parse, relational, rules, scorers


def one(spark, f, values, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, x {kind}")
    return [r[0] for r in df.orderBy("k").select(f(F.col("x"))).collect()]


def test_duration(spark):
    cases = {None: None, "": None, "nan": None, "Missing": None, "0": 0, "12.7": 12, ".5": 0, "5.": 5, "00:03:00": 180, "03:00": 180, "01:75": 8100, "02:59": 179, "1:2:3.9": 3723, "a:b": None, "1:2:3:4": None, "-5": None, "90": 90}
    assert one(spark, tx.duration_seconds, list(cases)) == list(cases.values())


def test_hosts(spark):
    cases = {"HTTP://User@Ex.com:80/a?b#c": "ex.com", "www.x.co.uk": "www.x.co.uk", "[::1]:80": "::1", "localhost": "localhost", "": "", "a.com.": "a.com"}
    assert one(spark, tx.url_host, list(cases)) == list(cases.values())
    reg = {"a.x.co.uk": "x.co.uk", "1.2.3.4": "1.2.3.4", "a.b.foo.com": "foo.com", "localhost": "localhost"}
    assert one(spark, tx.registered_domain, list(reg)) == list(reg.values())
    assert one(spark, tx.is_hosted, ["foo.pages.dev", "a.com"]) == [True, False]
    assert one(spark, tx.domain_variants, ["https://www.A.com/x", ""]) == [["a.com", "www.a.com"], []]


def test_betting_terms(spark):
    hosts = {"888.com": 6, "x888.com": None, "a-888.net": 6, "kto": 6, "KTO.com": 6, "stake.com": 6, "stakes.com": None, "my-stake.io": 6, "my_stake.com": None, "1xbet-mirror.ru": 6, "1xbetx.com": None, "bet-at-home.com": 6}
    assert one(spark, lambda c: rules.rude_class(c, F.lit(None), []), list(hosts)) == list(hosts.values())
    assert one(spark, lambda c: rules.rude_class(c, F.lit(None), ["acme"]), ["acme-bet365.com", "ACME.tv"]) == [1, 1]
    assert one(spark, lambda c: rules.rude_class(c, F.lit(9), ["acme"]), ["acme-bet365.com"]) == [4]
    assert re.compile(rules.betting_pattern())


def test_ad_density(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (None, 10), (15, 1000), (16, 1000)], "a int, n int")
    assert [r[0] for r in df.select(rules.ad_dense(F.col("a"), F.col("n"))).collect()] == [False, True, False, False, True]


def test_updates(spark):
    base = spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (3, 7, "c")], "id int, x int, y string")
    up = spark.createDataFrame([(1, None, None), (2, 9, "z"), (8, 1, "q")], "id int, x int, y string")
    got = relational.keyed_update(base, up, "id", ["x", "y"], keep_old=["y"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, None, "a"), (2, 9, "z"), (3, 7, "c")]


def test_pages(spark):
    html = "<html><head><title> A b </title><meta name='description' content='d d'></head><body><h1>One</h1><script>x</script>text of <b>page</b> 😀</body></html>"
    assert one(spark, pages.prepared_text, [html, "<p> </p>", None]) == ["TITLE: A b\nDESC: d d\nHEADINGS: One\n\nCONTENT: A b One text of page", None, None]
    uri = "<img src='data:image/png;base64,{}'>"
    scrubbed = one(spark, pages.scrub_data_uris, [uri.format("A" * 255), uri.format("A" * 256)])
    assert "AAAA" in scrubbed[0] and scrubbed[1] == "<img src='data:[base64]'>"
    assert one(spark, lambda c: pages.parked(c, F.lit("")), ["buy this domain", "word " * 130, "namecheap " + "word " * 60]) == [True, False, True]
    assert one(spark, pages.mhtml_part, ["plain", "H: 1\nContent-Type: text/html\n\n<!DOCTYPE html><p>x</p>\n------MultipartBoundary--1"]) == ["plain", "<!DOCTYPE html><p>x</p>"]


def test_parse():
    f = html_parse.page_features("<div class='ad banner'><div class='address ad'>a</div></div><iframe src='//x.doubleclick.net'></iframe><a href='http://amazon.com/?tag=1'>next</a><script type='application/ld+json'>{\"@type\": [\"Product\"]}</script><form action='/cart'></form>")
    # a product in a list of types is no product signal: the rule looks for one type as text
    assert (f["ad_slots"], f["iframes"], f["affiliate"], f["shop_signals"], f["schema_types"], f["gpt"]) == (2, 1, True, 1, 1, True)
    assert html_parse.page_features(None)["words"] == 0
    words = " ".join(f"w{k}" for k in range(60))
    assert html_parse.repetition([words, words + " more"]) == 1.0 and html_parse.repetition([words, words[::-1]]) == 0.0
    assert html_parse.repetition([words]) == 0.0 and html_parse.repetition(["a b", words, words]) == 1.0


@pytest.mark.parametrize(
    "html, field, value",
    [
        ("<link href='https://cdn.shopify.com/x.css'>", "shop_signals", 0),
        ("<img src='https://cdn.shopify.com/a'><img src='https://js.stripe.com/b'>", "shop_signals", 2),
        ('<script type="application/ld+json">{"@type": "AggregateOffer"}</script><script type="application/ld+json">{"@type":"Offer"}</script>', "shop_signals", 1),
        ("<form action='/CHECKOUT'></form><form action='/cart'></form>", "shop_signals", 1),
        ("<b class='x Btn-Buy'></b>", "shop_signals", 1),
        ("<div class='sticky'>x</div>", "sticky", False),
        ("<div class='sticky-ad'>x</div>", "sticky", False),
        ("<div style='' class='sticky ad'>x</div>", "sticky", True),
        ("<div style='POSITION : fixed'>x</div>", "sticky", True),
        ("<a href='/page/2'>next</a>", "pagination_hits", 1),
        ("<a href='/x'><b>ne</b><i>next</i></a>", "pagination_hits", 1),
        ("<a>next</a>", "pagination_hits", 0),
        ("<a rel='next' href='/y'>y</a>", "rel_next", 0),
        ("<link rel='prefetch next' href='/y'>", "rel_next", 1),
        ("<title>A</title><h1>calm</h1><h1>shocking</h1>", "clickbait", False),
        ("<title>Top 7 of it</title>", "clickbait", True),
        ("<div>you <b>x</b> may like</div>", "rec_widgets", 0),
        ("<div>you may<b>x</b> like</div><p>Around the web</p><span class='mgid'>z</span>", "rec_widgets", 2),
        ("<video autoplay muted></video>", "autoplay", True),
        ("<video autoplay></video>", "autoplay", False),
        ("<div class='my popup'></div>", "overlay", True),
        ("<script>taboola</script>", "arbitrage", True),
        ("<script src='https://x.prebid.org/a'></script>", "vendors", ["header-bidding"]),
        ("<div id='amzn_assoc_1'></div><div id='Taboola-x'></div><div data-widget-id='OB1'></div>", "total_ad_slots", 3),
        ("<ins class='a adsbygoogle'></ins><div class='ad-unit' id='ad-slot'></div>", "total_ad_slots", 3),
        ("<script src='//ads.pubmatic.com/x'></script><script src='/y'></script><img src='//criteo.com/z'>", "ad_scripts", 1),
        ("<div id='ad' class='x  y'></div>", "ad_snippets", ["ad x y"]),
        ("<script type='application/ld+json'>no json</script>", "schema_blocks", 1),
        ("<script type='application/ld+json'>no json</script>", "has_schema", False),
        ('<script type="application/ld+json">[{"@type": ["Book", "Movie"], "name": 1}, {"@type": "Book"}, 5]</script>', "schema_books", 2),
        ('<script type="application/ld+json">{"@type": "AdultEntertainment", "name": 1, "description": 1, "provider": 1}</script>', "complete_adults", True),
        ('<script type="application/ld+json">{"@type": "Book", "name": 1, "author": 1, "isbn": 1}</script>', "complete_books", False),
        ('<script type="application/ld+json">{"@type": "Movie", "name": 1, "description": 1, "image": 1, "datePublished": 1, "director": 1, "actor": 1, "genre": 1}</script>', "schema_movie_only", True),
        ("<p>one two</p><svg>three</svg><noscript>four</noscript>", "words", 2),
        ("<title>T</title><meta property='og:description' content=' D '><p>x</p>", "relevant_text", "T\n\nD\n\nT x"),
        ("<p>a  b\n\n c</p><noscript>n</noscript> 😀d", "visible_text", "a b c d"),
        ("<iframe></iframe><p>" + "w " * 500 + "</p>", "iframes_per_1k", 2.0),
    ],
)
def test_page_fields(html, field, value):
    assert html_parse.page_features(html)[field] == value


def test_policy_words(spark):
    rows = one(spark, lambda c: F.struct(*[v.alias(k) for k, v in pages.policy_flags(c).items()]), ["<a href='/TOS'>x</a>", "<p>Disclaimer</p><!-- privacy -->", "", None])
    assert [tuple(r) for r in rows] == [(True, False, False), (False, True, True), (False, False, False), (False, False, False)]


def test_captures(spark):
    texts = ["a b c", "a b c d", "x y z Welcome to nginx! ", "Not found at all here", "not found at all here", None, ""]
    assert one(spark, pages.valid_capture, texts) == [False, True, False, False, True, False, False]
    assert one(spark, tx.collapse, ["a\u00a0\u2003b \n c"]) == ["a b c"]


def test_site_status(spark):
    """Cases by hand: (chain of (status, url), final page, html) and what the rules say."""
    own, www, other = "https://a.com/x", "https://www.a.com/y", "https://b.org/z"
    plain = "<p>Welcome</p>"
    cases = [
        ([(200, own)] * 2, www, plain, ("Online", "", www, "")),
        ([(301, own), (302, own), (200, own), (404, own)], own, plain, ("Offline | Ad Sniffer", "Error[404]", None, "")),
        ([(301, own), (200, www), (404, own)], own, plain, ("Online", "", None, "Redirect same domain")),
        ([(301, own), (200, www)], www, plain, ("Online", "Redirect - same domain", www, "Redirect same domain")),
        ([(301, own), (200, other)], own, plain, ("Online", "Redirect", None, "")),
        ([(301, own)] + [(302, own)] * 10 + [(200, own)], own, plain, ("Online", "None", None, "")),
        ([(302, own)] * 12, other, plain, ("Offline | Status Checker", "Redirect", other, "")),
        ([(403, own)], www, plain, ("Offline", "Redirect", www, "")),
        ([(403, own)], own, plain, ("Offline", "Error[400-500]", None, "")),
        ([(400, own)], own, plain, ("Offline | Ad Sniffer", "Error[400]", None, "")),
        ([(200, own)], "https://alliance4creativity.com/", plain, ("Offline", "Domain Seized", None, "alliance4creativity.com")),
        ([(200, own)] * 2, own, "<script>Domain Seized</script>ok", ("Blocked", "Domain Seized", None, "Domain Seized")),
        ([(200, own)], own, "<p>buy this domain</p>", ("Offline | Status Checker", "Parking Page", "", "")),
        ([(500, own), (200, own)], own, "<p>Bad request</p>", ("Blocked", "Error[Bad Request-500]", None, "")),
        ([], own, plain, (None, None, None, None)),
    ]
    log = spark.createDataFrame([(k, n, s, u) for k, c in enumerate(cases) for n, (s, u) in enumerate(c[0])], "site long, seq long, status int, url string")
    sites = spark.createDataFrame([(k, "a.com", c[1], c[2]) for k, c in enumerate(cases)], "site long, domain string, page_url string, html string")
    got = {r["site"]: r for r in captures.site_status(log, sites).collect()}
    for k, (chain, _, _, want) in enumerate(cases):
        assert (got[k]["n_responses"], *tuple(got[k])[2:]) == (len(chain), *want), k


def test_names(spark):
    assert one(spark, captures.country, ["US", "us", "Viet Nam", "Iran, Islamic Republic of", None]) == ["United States", "us", "Vietnam", "Iran (Islamic Republic of)", None]
    assert one(spark, captures.media_type_name, [1, 17, 15, None], "int") == ["Film & TV", "invalid", "Other", "Other"]


def test_brands(spark):
    names = spark.createDataFrame([(1, "my-ACMECORP.com"), (2, "acme.com"), (3, None), (4, "x")], "id long, name string")
    brands = spark.createDataFrame([("AcmeCorp ", True), ("acme", True), ("my-acm", False), (None, True)], "keyword string, brand boolean")
    assert {r["id"] for r in domains.brand_known(names, "name", brands).filter("brand_known").collect()} == {1}
    assert domains.brand_known(names, "name", brands.limit(0)).filter("brand_known").count() == 0


def test_duplicate_updates(spark):
    base = spark.createDataFrame([(1, 5)], "id int, x int")
    up = spark.createDataFrame([(1, 6), (1, 7)], "id int, x int")
    with pytest.raises(Exception, match="more than one update"):
        relational.keyed_update(base, up, "id", ["x"]).collect()


def test_scorer(spark):
    df = spark.createDataFrame([(1, "<p>some words that make a page of text</p>"), (2, "<p>x</p>"), (3, None)], "id long, html string")
    got = {r["id"]: (r["class"], r["called"]) for r in scorers.score(df, "id", "html", "software", lambda t: t.str.len() * 0 + 12).collect()}
    assert got == {1: (12, True), 2: (9, False), 3: (9, False)}


def test_identifier():
    assert tx.safe_identifier("a_1") == "a_1"
    with pytest.raises(ValueError):
        tx.safe_identifier("a; drop")


def test_enforcement_and_graymarket(spark):
    rows = [(1, "<p>some words that make a page of text</p>", "Anime", True, 0.3, True, False), (2, "<p>x</p>", "Other", False, 0.1, False, False)]
    df = spark.createDataFrame(rows, "id long, html string, media_type string, brand_known boolean, ssl_score double, privacy boolean, terms boolean")
    got = scorers.enforcement(df, "id", lambda x: x["brand_known"].astype(int) * 3 + (x["media_type"] == "Anime") + x["blocked"]).collect()
    assert {r["id"]: (r["class"], r["called"]) for r in got} == {1: (4, True), 2: (0, False)}
    texts = spark.createDataFrame([(1, "ads", 80), (2, "bet", 80), (3, "bet", 10), (4, "", 10), (5, "?", 10)], "id long, relevant_text string, s int")
    classify = lambda t: t.map({"bet": "**Gambling & Betting**\nsure", "?": "Nonsense"})
    confirm = lambda x: x["text"].map(lambda t: "MFA." if t == "ads" else "unknow")
    got = scorers.graymarket(texts, "id", F.col("s"), classify, confirm).collect()
    und = "undeterminated"
    assert {r["id"]: (r["label"], r["asked_mfa"]) for r in got} == {1: ("mfa", True), 2: ("Gambling & Betting", True), 3: ("Gambling & Betting", False), 4: (und, False), 5: (und, False)}
