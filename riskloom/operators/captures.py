"""Operators on landed captures: response chains, bodies, popups and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import pages
from riskloom.operators import rules
from riskloom.operators.ranges import first_rows, ranked

#: Fixed values.
MEDIA_TYPES = {
    1: "Film & TV",
    3: "Anime",
    4: "Manga",
    2: "Sports",
    6: "Games",
    5: "Publishing",
    14: "Online Courses",
    8: "Music",
    9: "Adult",
    10: "News",
    13: "Content Host",
    7: "Software",
    11: "General",
    12: "Other",
    16: "Publishing",
    17: "invalid",
}
COUNTRY_ALIASES = {
    "Iran, Islamic Republic of": "Iran (Islamic Republic of)",
    "Viet Nam": "Vietnam",
    "Venezuela, Bolivarian Republic of": "Venezuela (Bolivarian Republic of)",
    "US": "United States",
    "UK": "United Kingdom",
}
SEIZED_HOST = "alliance4creativity.com"
POPUP_NOISE = ["chrome-error://chromewebdata/", "about:blank"]
SCAN = 10


def url_domain(url: Column) -> Column:
    """Host and port of the first URL in a text, '' if there is none."""
    return F.regexp_extract(url, "https?://([^/]+)", 1)


def scanned(log: DataFrame) -> DataFrame:
    """(site, n_responses, last, scan): how many responses a site has, the status of its last one, and its first SCAN (seq, status, url) in order.

    Counts and last ones are summed before the shuffle, and a task passes SCAN responses of a site on at most, so a site may have any number.
    """
    log = log.select("site", "seq", "status", "url")
    ends = log.groupBy("site").agg(F.count("*").alias("n_responses"), F.max_by("status", "seq").alias("last"))
    first = first_rows(log, "site", "seq", SCAN, "n").groupBy("site").agg(F.array_sort(F.collect_list(F.struct("seq", "status", "url"))).alias("scan"))
    return ends.join(first, "site")


def site_status(log: DataFrame, sites: DataFrame) -> DataFrame:
    """(site, n_responses, online_status, offline_type, redirect_url, status_msg) of each of sites (site, domain, page_url, html).

    log holds the responses (site, seq, status, url) that led to the page. A site's first, second and last response and whether a 200 stands
    among responses 2 to SCAN are aggregated, so a site with any number of responses is gathered nowhere. The page decides first: a seized or parked
    one, then one on another host. A redirect whose second response is no 200 ends with what the page says for the last status, unless
    that is online; else a 200 on the first response's host tells a redirect within it. A site without responses has no status.
    """
    oks = F.filter(F.slice("scan", 2, SCAN), lambda r: rules.yes(r["status"] == 200))
    x = scanned(log).withColumns({"oks": oks, "start": url_domain(F.get("scan", F.lit(0))["url"])})
    x = x.select(
        "site",
        "n_responses",
        F.get("scan", F.lit(0))["status"].alias("first"),
        F.get("scan", F.lit(1))["status"].alias("second"),
        "last",
        (F.size("oks") > 0).alias("ok"),
        F.exists("oks", lambda r: rules.yes(F.contains(url_domain(r["url"]), F.col("start")))).alias("ok_home"),
    )
    x = sites.join(x, "site", "left").withColumns({"host": url_domain(F.col("page_url")), "text": pages.body_text(F.col("html"))})
    x = x.withColumn("parked", pages.parked(F.col("text"), F.col("html")))
    first, single = F.col("first"), F.col("n_responses") == 1
    redirect, same = F.col("host") != F.col("domain"), F.contains(F.col("host"), F.col("domain"))
    target = F.when(redirect, F.col("page_url"))
    nothing = F.lit(None).cast("string")
    out = lambda status, kind, url, message: F.struct(F.lit(status).alias("online_status"), kind.alias("offline_type"), url.alias("redirect_url"), message.alias("status_msg"))
    empty = F.lit("")

    def by_html(code: Column, url: Column) -> Column:
        o = rules.html_outcome(F.col("text"), code, F.col("parked"))
        return F.struct(o["online_status"].alias("online_status"), o["offline_type"].alias("offline_type"), url.alias("redirect_url"), o["status_msg"].alias("status_msg"))

    seized = F.contains("html", F.lit("Domain Seized")) | F.contains(F.lower("html"), F.lit("no longer available due to copyright"))
    blocked = out("Blocked", F.lit("Domain Seized"), target, F.lit("Domain Seized"))
    last = by_html(F.col("last"), target)
    gone = rules.yes(F.col("second") == 200)
    redirected = (
        F.when(~gone & (last["online_status"] != "Online"), last)
        .when(F.col("ok_home") & seized, blocked)
        .when(F.col("ok_home"), out("Online", F.when(redirect & same, "Redirect - same domain").otherwise(""), target, F.lit("Redirect same domain")))
        .when(F.col("ok"), out("Online", F.lit("Redirect"), target, empty))
        .otherwise(last)
    )
    status = (
        F.when(F.contains(F.lower("page_url"), F.lit(SEIZED_HOST)), out("Offline", F.lit("Domain Seized"), nothing, F.col("host")))
        .when(F.col("parked"), out("Offline | Status Checker", F.lit("Parking Page"), empty, empty))
        .when(redirect & ~same, out("Offline | Status Checker", F.lit("Redirect"), target, empty))
        .when(single & (first > 400) & (first < 500), out("Offline", F.when(redirect, "Redirect").otherwise("Error[400-500]"), target, empty))
        .when(single, by_html(first, nothing))
        .when((first == 200) & seized, blocked)
        .when(first == 200, out("Online", empty, target, empty))
        .when((first > 299) & (first < 400), redirected)
        .when(first.isNotNull(), by_html(first, nothing))
    )
    return x.withColumn("o", status).select("site", F.coalesce("n_responses", F.lit(0).cast("long")).alias("n_responses"), "o.online_status", "o.offline_type", "o.redirect_url", "o.status_msg")


def older_status(log: DataFrame, sites: DataFrame) -> DataFrame:
    """(site, online_status, offline_type) by the older rules, which look at the first response and a page's markup only.

    A redirect that no 200 among responses 2 to SCAN follows has no status, nor has a site without responses.
    """
    x = scanned(log).withColumn("start", url_domain(F.get("scan", F.lit(0))["url"]))
    found = F.get(F.filter(F.slice("scan", 2, SCAN), lambda r: rules.yes(r["status"] == 200)), F.lit(0))
    x = x.select("site", "n_responses", F.get("scan", F.lit(0))["status"].alias("first"), F.when(found.isNotNull(), F.struct(F.contains(url_domain(found["url"]), F.col("start")).alias("home"))).alias("found"))
    x = sites.join(x, "site", "left")
    has = lambda t: F.contains("html", F.lit(t))
    out = lambda status, kind: F.struct(F.lit(status).alias("online_status"), kind.alias("offline_type"))
    code = F.concat(F.col("first").cast("string"), F.lit("]"))
    single, empty = F.col("n_responses") == 1, F.lit("")
    refused = F.when(single, has("blocked") & has("Bright Data usage policy")).otherwise(has("access was blocked as it might breach Bright Data usage policy"))
    by_html = (
        F.when(refused, out("Blocked", F.concat(F.lit("Error[BrightData-"), code)))
        .when(has("Webpage not available"), out("Offline", F.concat(F.lit("Error["), code)))
        .when(F.contains(F.lower("html"), F.lit("cloudflare")), out("Blocked", F.concat(F.lit("Error[Cloudflare-"), code)))
        .otherwise(out("Offline", F.concat(F.lit("Error["), code)))
    )
    redirected = F.when(F.col("found").isNotNull(), out("Online", F.when(F.col("found.home"), "").otherwise("Redirect")))
    first = F.col("first")
    status = F.when(single, by_html).when(first == 200, out("Online", empty)).when((first > 299) & (first < 400), redirected).when(first.isNotNull(), by_html)
    return x.withColumn("o", status).select("site", "o.online_status", "o.offline_type")


def crawl_outcome(offline_type: Column) -> Column:
    return F.coalesce(offline_type == "Redirect", F.lit(False))


def recheck(first: Column, second: Column) -> Column:
    """The second evaluation where there is one that differs."""
    return F.coalesce(second, first)


def popups(urls: Column) -> Column:
    return F.filter(urls, lambda u: ~u.isin(POPUP_NOISE))


def post_click(chain: DataFrame, clicked: DataFrame, keys: list[str]) -> DataFrame:
    """chain with post_clic: whether its URL was seen after the click, too."""
    seen = clicked.select(*keys).distinct().withColumn("__hit", F.lit(True))
    return chain.join(seen, keys, "left").withColumn("post_clic", F.col("__hit").isNotNull()).drop("__hit")


def bid(body: Column) -> dict[str, Column]:
    """Whether a body is JSON with a price, and the publisher and buyer that it names."""
    is_bid = F.coalesce(F.contains(body, F.lit('"cpm":')) & F.try_parse_json(body).isNotNull(), F.lit(False))
    name = lambda key: F.when(is_bid, F.nullif(F.regexp_extract(body, f'"{key}"\\s*:\\s*"([^"]+)"', 1), F.lit("")))
    return {"is_bid": is_bid, "publisher": name("publisher"), "buyer": name("buyer")}


def is_vast(body: Column) -> Column:
    low = F.lower(F.coalesce(body, F.lit("")))
    return F.contains(low, F.lit("vast")) & F.contains(low, F.lit("xml version"))


def bid_host(url: Column) -> dict[str, Column]:
    """The host that a bid was asked of; domain and subdomain only where it has exactly three labels."""
    host = F.regexp_extract(url, "^(?:https?://)?(?:[^@\\n]+@)?(?:www\\.)?([^:/\\n?]+)", 1)
    parts = F.split(host, "\\.")
    three = F.size(parts) == 3
    return {"full_domain": host, "domain": F.when(three, F.array_join(F.slice(parts, 2, 2), ".")), "subdomain": F.when(three, F.get(parts, F.lit(0)))}


def page_speed(payload: Column) -> dict[str, Column]:
    """Score of 100, LCP and CLS of a landed audit; 0 where it lacks them."""
    at = lambda path: F.coalesce(F.get_json_object(payload, path).try_cast("double"), F.lit(0.0))
    base = "$.lighthouseResult"
    return {"score": at(base + ".categories.performance.score") * 100, "lcp": at(base + ".audits.lcp.numericValue"), "cls": at(base + ".audits.cls.numericValue")}


def sitemap_count(xml: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit("<loc>(.*?)</loc>"), F.lit(1)))


def reversed_labels(name: Column) -> Column:
    return F.array_join(F.reverse(F.split(name, "\\.")), ".")


def age_years(day: Column, as_of: Column) -> Column:
    """Elapsed days over 365; null for a day that can't be read."""
    return F.datediff(as_of, F.to_date(F.try_to_timestamp(day, F.lit("yyyy-MM-dd")))) / 365


#: Networks of hosts that ignore complaints.
BULLETPROOF_ASNS = ["197414", "56873"]


def asn_profile(country: Column, found: Column, asn: Column, asn_date: Column, ip: Column, as_of: Column) -> dict[str, Column]:
    """Age of a network in years, kind of hosting, risk of its country, and the name that a block list is asked for; a failed lookup is a risk and tells no more."""
    known = rules.yes(found)
    return {
        "asn_age": F.when(known, age_years(asn_date, as_of)),
        "hosting_type": F.when(known, F.when(rules.yes(asn.isin(BULLETPROOF_ASNS)), "bullet-proof").otherwise("isp")),
        "is_high_risk_geo": rules.high_risk_geo(country, found),
        "block_list_name": F.when(known, F.concat(reversed_labels(ip), F.lit(".zen.spamhaus.org"))),
    }


def clean_label(answer: Column, allowed: list[str], default: str) -> Column:
    """A scorer's first line without marks, if it is a known label."""
    line = F.trim(F.regexp_replace(F.get(F.split(answer, "\\n"), F.lit(0)), "[^\\w &/]", ""))
    return F.when(line.isin(allowed), line).otherwise(default)


def country(name: Column) -> Column:
    out = name
    for alias, full in COUNTRY_ALIASES.items():
        out = F.when(name == alias, full).otherwise(out)
    return out


def media_type_name(code: Column) -> Column:
    out = F.lit("Other")
    for k, v in MEDIA_TYPES.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def keyset_pages(df: DataFrame, key: str, size: int) -> DataFrame:
    """(key, page): all rows by key in pages of size, as one pass would read them one after another.

    A page's number is the rank of its keys, which may be of any type that has an order: no task ranks all of them.
    """
    return ranked(df.select(key), [key], "__rank").select(key, F.floor(F.col("__rank") / size).alias("page"))


def by_trimmed_name(items: DataFrame, item: str, known: DataFrame, name: str, value: str) -> DataFrame:
    """items plus value of the first known row (by value) whose name equals the trimmed item; null where there is none."""
    first = known.groupBy(F.col(name).alias("__n")).agg(F.min(value).alias(value))
    return items.join(first, F.trim(F.col(item)) == F.col("__n"), "left").drop("__n")
