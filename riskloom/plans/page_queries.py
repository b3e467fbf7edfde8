"""Queries over page markup, beside their SQL; importing the module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import pages
from riskloom.operators import captures, html_parse, json_ld, relational, rules, scorers
from riskloom.plans.queries import _BODY, _S, query
from riskloom.sources.adapters import PARAGRAPH, load

_ANY = lambda text, signals: "len(list_filter([" + ", ".join("'" + x.replace("'", "''") + "'" for x in signals) + f"], lambda x: contains({text}, x))) > 0"
_SOFT = " + ".join(f"case when contains(t, '{x}') then {w} else 0 end" for x, w in pages.PARKED_SOFT.items())
_REAL = f"len(list_filter(regexp_split_to_array(t, '{_S}+'), lambda w: w <> '' and not regexp_matches(w, '[{{}};:/=\\\\]')))"
_PARKED = f"({_ANY('low', pages.PARKED_RAW)} or {_ANY('t', pages.PARKED_TEXT)} or {_SOFT} + case when {_REAL} < 50 then 2 when {_REAL} < 120 then 1 else 0 end + case when regexp_matches(low, 'height: ?100vh') then 2 else 0 end >= 3)"


@query("page_status", ["snapshots"], f"""select html_id, parked, case when contains(t, 'blocked') and contains(t, 'bright data usage policy') then 'Blocked' when contains(t, 'webpage not available') or contains(t, '404 not found') or contains(t, 'this page isn’t working') then 'Offline | Ad Sniffer'
 when contains(t, 'cloudflare') and contains(t, 'ray id') then 'Blocked' when contains(t, 'verifying you are human. this may take a few seconds') then 'Blocked' when contains(t, 'proxy authentication required') then 'Blocked' when contains(t, 'domain seized') or contains(t, 'no longer available due to copyright') then 'Offline | Ad Sniffer'
 when contains(t, 'cannot establish connection to requested target') then 'Offline | Ad Sniffer' when contains(t, 'bad request') or contains(t, 'auth failed (code: ip_forbidden)') or contains(t, 'sorry, you have been blocked') then 'Blocked'
 when code = 200 and parked then 'Offline' when code = 200 then 'Online' else 'Offline | Ad Sniffer' end as online_status, contains(low, 'terms') or contains(low, 'tos') as terms, contains(low, 'disclaimer') or contains(low, 'dmca') as dmca, contains(low, 'privacy') or contains(low, 'policy') as privacy
 from (select *, {_PARKED} as parked from (select html_id, case when html_id % 5 = 0 then 404 else 200 end as code, lower(html_content) as low, lower({_BODY}) as t from snapshots) a) b""")
def _(s, d):
    """Status, parking and policy words of each page; a fifth of the pages comes with another code than 200."""
    html = F.col("html_content")
    x = load(s, d, "snapshots").select("html_id", html, pages.body_text(html).alias("text"), F.when(F.col("html_id") % 5 == 0, 404).otherwise(200).alias("code"))
    x = x.withColumn("parked", pages.parked(F.col("text"), html))
    return x.select("html_id", "parked", rules.status_from_html(F.col("text"), F.col("code"), F.col("parked")).alias("online_status"), *[v.alias(k) for k, v in pages.policy_flags(html).items()])


@query("page_features")
def _(s, d):
    """Every DOM feature and the score; SQL has no DOM, so its fields are held against hand-made pages in the tests."""
    p = html_parse.parse_pages(load(s, d, "snapshots"), "html_id", "html_content")
    return p.withColumn("mfa_score", html_parse.mfa_score())


_TAGS = ", ".join(f"cast(len(regexp_extract_all(h, '<{t}[ >/]')) as bigint) as n_{t}" for t in ("div", "a", "img", "span", "li", "p"))


@query("tag_counts", ["snapshots"], f"select html_id, {_TAGS}, cast(len(regexp_extract_all(html_content, '<script')) as bigint) as n_script, cast(0 as bigint) as iframes from (select html_id, html_content, regexp_replace(regexp_replace(html_content, '(?s)<script.*?</script>', '', 'g'), '(?s)<!--.*?-->', '', 'g') as h from snapshots) x")
def _(s, d):
    """The counts of the one parse that regular expressions can repeat on these pages."""
    p = html_parse.parse_pages(load(s, d, "snapshots"), "html_id", "html_content")
    return p.select("html_id", "n_div", "n_a", "n_img", "n_span", "n_li", "n_p", "n_script", "iframes")


#: Rows of features that reach every step of the score.
_ROWS = "select o_orderkey as html_id, o_orderkey % 30 as ad_like, o_orderkey % 14 as iframes, o_orderkey % 5 = 0 as gpt, o_orderkey % 7 = 0 as header_bidding, o_orderkey % 11 = 0 as sticky, o_orderkey % 13 = 0 as autoplay, o_orderkey % 17 = 0 as overlay, case when o_orderkey % 3 = 0 then o_orderkey % 6 else 0 end as rec_widgets, (o_orderkey * 7) % 600 as words, o_orderkey % 8 as pagination_hits, o_orderkey % 2 as rel_next, cast(o_orderkey % 4 as double) / 8 as repetition from orders"


@query("mfa_score", None, f"""select html_id, cast(s as int) as mfa_score, s >= 65 as mfa from (select html_id, least(100, case when ad_like > 25 then 15 when ad_like > 12 then 7 else 0 end + case when iframes > 12 then 10 when iframes > 6 then 5 else 0 end + case when gpt or header_bidding then 10 else 0 end
 + case when sticky or autoplay or overlay then 10 else 0 end + case when rec_widgets > 0 then 20 else 0 end + case when rec_widgets > 3 then 5 else 0 end + case when words < 400 and ad_like > 8 then 15 when words < 250 and ad_like > 0 then 8 else 0 end
 + case when pagination_hits + 2 * rel_next > 5 then 10 when pagination_hits + 2 * rel_next > 2 then 4 else 0 end + case when repetition > 0.3 then 5 else 0 end) as s from ({_ROWS}) x) y""")
def _(s, d):
    rows = s.sql(_ROWS.replace("from orders", "from {orders}"), orders=s.read.parquet(f"{d}/orders.parquet"))
    return rows.select("html_id", html_parse.mfa_score().cast("int").alias("mfa_score"), (html_parse.mfa_score() >= scorers.MFA_THRESHOLD).alias("mfa"))


@query("graymarket_label", ["snapshots"], "select html_id, 'undeterminated' as label, false as asked_mfa from snapshots")
def _(s, d):
    """No scorer is at hand and no page scores 65: every page keeps the label that stands where none answers."""
    p = html_parse.parse_pages(load(s, d, "snapshots"), "html_id", "html_content")
    return scorers.graymarket(p, "html_id", html_parse.mfa_score())


@query("valid_captures", ["snapshots"], "select html_id, html_id % 4 > 1 as valid from snapshots")
def _(s, d):
    """Captured texts of four kinds: too short, of an empty server, and two good ones."""
    k = F.col("html_id") % 4
    text = F.when(k == 0, "only three words").when(k == 1, "hello and Welcome to nginx! on this host").otherwise(F.concat(F.lit("four words or more "), "url"))
    return load(s, d, "snapshots").select("html_id", pages.valid_capture(text).alias("valid"))


@query("snapshot_markup", ["snapshots"], "select html_id, case when html_id % 3 = 0 then html_content else '<!DOCTYPE html><html>x</html>' end as part, 'a data:[base64]) b' as scrubbed from snapshots")
def _(s, d):
    """The HTML part of MHTML snapshots (a third of them is HTML already), and markup without embedded data."""
    mhtml = F.concat(F.lit("From: x\r\nContent-Type: text/html\r\nQ: y\r\n\r\n<!DOCTYPE html><html>x</html>\r\n------MultipartBoundary--z\r\nContent-Type: image/png\r\n\r\n"), F.col("url"))
    uri = F.concat(F.lit("a data:image/png;base64,"), F.repeat(F.lit("Ab+/"), 90), F.lit(") b"))
    return load(s, d, "snapshots").select("html_id", pages.mhtml_part(F.when(F.col("html_id") % 3 == 0, F.col("html_content")).otherwise(mhtml)).alias("part"), pages.scrub_data_uris(F.when(F.col("html_id") >= 0, uri)).alias("scrubbed"))


def _per_category(text: str) -> str:
    """A column for each category of structured data: {c} its name, {of} the test for its types, {full} the one for complete entries."""
    quoted = lambda names: ", ".join(f"'{x}'" for x in sorted(names))
    return ", ".join(text.format(c=c, of=f"t in ({quoted(members)})", full=f"10 * len(list_intersect(props, [{quoted(wanted)}])) >= 8 * {len(wanted)}") for c, (members, wanted) in html_parse.SCHEMA.items())


@query("schema_metrics", ["structured_pages"], """, b as (select html_id, unnest(regexp_extract_all(html, '(?s)<script type=.application/ld.json.>(.*?)</script>', 1)) as b from structured_pages),
i as (select html_id, unnest(case when json_type(b) = 'ARRAY' then cast(json_extract(b, '$[*]') as json[]) else [cast(b as json)] end) as i from b where json_valid(b)),
o as (select html_id, json_keys(i) as props, json_extract(i, '$."@type"') as k from i where json_type(i) = 'OBJECT'),
t as (select html_id, props, json_type(k) <> 'ARRAY' as single, unnest(case when json_type(k) = 'ARRAY' then json_extract_string(k, '$[*]') else [json_extract_string(k, '$')] end) as t from o where json_type(k) in ('ARRAY', 'VARCHAR')),
c as (select html_id, count(distinct t) as schema_types, """.lstrip() + _per_category("count(*) filter ({of}) as schema_{c}, coalesce(bool_or({of} and {full}), false) as complete_{c}") + """,
  coalesce(bool_or(single and t = 'Movie' and """ + f"10 * len(list_intersect(props, {sorted(html_parse.SCHEMA['movie'][1])!r})) >= 8 * {len(html_parse.SCHEMA['movie'][1])}" + """), false) as schema_movie_only from t group by 1)
select p.html_id, cast(len(regexp_extract_all(html, '<script type=.application/ld.json.>')) as bigint) as schema_blocks, coalesce(schema_types, 0) as schema_types, coalesce(schema_types, 0) > 0 as has_schema, coalesce(schema_movie_only, false) as schema_movie_only,
""" + _per_category("coalesce(schema_{c}, 0) as schema_{c}, coalesce(complete_{c}, false) as complete_{c}") + " from structured_pages p left join c on c.html_id = p.html_id")
def _(s, d):
    """Structured data of pages that hold it as objects, as lists, with one type or several, broken, or not at all."""
    return json_ld.schema_metrics(load(s, d, "structured_pages"), "html_id", "html")


#: What each field of a page of field_pages has to be, from the remainders that the page was made of.
_N, _W = len(PARAGRAPH), len(PARAGRAPH.split())
_KIDS = "a + 2 * d + b + 2 * c + cast(e < 2 as int) + cast(g < 2 as int) + cast(a = 0 as int) + cast(b = 0 as int) + 2 * e + 1 + d"
_WANTED = {
    "max_depth": "3", "node_count": f"6 + cast(c = 1 as int) + {_KIDS}", "avg_depth": f"cast(11 + 3 * (cast(c = 1 as int) + {_KIDS}) as double) / (6 + cast(c = 1 as int) + {_KIDS})",
    "inline_scripts": "cast(a = 0 as int)", "inline_bytes": "13 * cast(a = 0 as int)", "text_length": f"case when c = 0 then 11 else 4 end + 4 * e + cast(g = 1 as int) + 13 * cast(a = 0 as int) + {_N} * (1 + d)",
    "ad_slots": "a + d", "ad_like": "a + d", "iframes": "b", "ins": "c", "amp_ads": "d", "rec_widgets": "e", "pagination_hits": "e", "rel_next": "cast(c = 1 as int)", "shop_signals": "c", "ad_scripts": "0",
    "slot_adsense_ins": "c", "slot_generic_div_class": "d", "total_ad_slots": "c + d", "schema_blocks": "0", "words": f"{_W} * (1 + d)", "long_paragraphs": "1 + d",
    "n_div": "a + d + cast(e = 0 as int) + cast(g = 0 as int) + e", "n_a": "e + cast(g = 1 as int)", "n_img": "c", "n_script": "cast(a = 0 as int) + cast(b = 0 as int)", "n_p": "1 + d", "n_link": "cast(c = 1 as int)", "n_meta": "1",
    "gpt": "a = 0", "header_bidding": "b = 0", "arbitrage": "false", "sticky": "e = 0", "autoplay": "e = 1", "overlay": "g = 0", "affiliate": "g = 1", "clickbait": "c = 0", "has_schema": "false",
    "repetition": "cast(d as double)", "text_to_html": f"cast({_N} * (1 + d) + d as double) / length(html)", "ad_to_text": f"cast(a + d as double) / ({_W} * (1 + d))", "iframes_per_1k": "b / cast(0.1 as double)",
    "main_text": f"case when d = 1 then '{PARAGRAPH}' || chr(10) || '{PARAGRAPH}' else '{PARAGRAPH}' end",
    "relevant_text": f"case when c = 0 then 'Top 7 of it' else 'Calm' end || chr(10) || chr(10) || 'D' || cast(html_id as varchar) || chr(10) || chr(10) || case when d = 1 then '{PARAGRAPH}' || chr(10) || '{PARAGRAPH}' else '{PARAGRAPH}' end",
    "mfa_score": "case when a = 0 or b = 0 then 10 else 0 end + case when e < 2 or g = 0 then 10 else 0 end + case when e > 3 then 25 when e > 0 then 20 else 0 end + case when a + d > 0 then 8 else 0 end + case when e + 2 * cast(c = 1 as int) > 5 then 10 when e + 2 * cast(c = 1 as int) > 2 then 4 else 0 end + 5 * d",
}
_LONG = {c for c in html_parse.INTS}


@query("page_fields", ["field_pages"], "select html_id, " + ", ".join(f"{f'cast({v} as bigint)' if c in _LONG else f'cast({v} as int)' if c == 'mfa_score' else v} as {c}" for c, v in _WANTED.items()) + " from field_pages")
def _(s, d):
    """Fields of the whole parse on pages that SQL can tell them of, and the score that they give."""
    p = html_parse.parse_pages(load(s, d, "field_pages"), "html_id", "html").withColumn("mfa_score", html_parse.mfa_score().cast("int"))
    return p.select("html_id", *_WANTED)


_REJECTED = ", ".join("'" + x.replace("'", "''") + "'" for x in pages.INVALID_CAPTURE)


@query("capture_parts", ["captures"], f"""select capture_id, is_bid, case when is_bid then nullif(regexp_extract(body, '"publisher"\\s*:\\s*"([^"]+)"', 1), '') end as publisher, case when is_bid then nullif(regexp_extract(body, '"buyer"\\s*:\\s*"([^"]+)"', 1), '') end as buyer,
  coalesce(contains(lower(body), 'vast') and contains(lower(body), 'xml version'), false) as is_vast, list_filter(string_split(popups, ' '), lambda x: x not in ('about:blank', 'chrome-error://chromewebdata/', '')) as popups, len(string_split(text, ' ')) >= 4 and len(list_filter([{_REJECTED}], lambda x: contains(text, x))) = 0 as valid,
  regexp_replace(part, 'data:[a-z]+/[a-z]+;base64,[A-Za-z0-9+/]+', 'data:[base64]') as part
 from (select *, coalesce(contains(body, '"cpm":') and json_valid(body), false) as is_bid, case when spot = 0 then mhtml when cut <> '' then cut else p end as part from
 (select *, regexp_extract(p, '(?s)^(.*?)(\\r?\\n------MultipartBoundary|\\r?\\n--[-=_A-Za-z0-9]{{10,}}|\\r?\\nContent-Type: image)', 1) as cut from
 (select *, substring(q, cast(case when instr(lower(q), '<!doctype') > 0 then instr(lower(q), '<!doctype') when instr(lower(q), '<html') > 0 then instr(lower(q), '<html') else 1 end as int)) as p from (select *, instr(mhtml, 'Content-Type: text/html') as spot, substring(mhtml, cast(greatest(instr(mhtml, 'Content-Type: text/html'), 1) as int)) as q from captures) a) b) c) d""")
def _(s, d):
    """What landed captures hold: bids, popups, whether the text shows a site, and the HTML part of the snapshot without embedded data."""
    x = load(s, d, "captures")
    b = captures.bid(F.col("body"))
    popups = F.filter(captures.popups(F.split("popups", " ")), lambda u: u != "")
    part = pages.scrub_data_uris(pages.mhtml_part(F.col("mhtml")))
    return x.select("capture_id", *[v.alias(k) for k, v in b.items()], captures.is_vast(F.col("body")).alias("is_vast"), popups.alias("popups"), pages.valid_capture(F.col("text")).alias("valid"), part.alias("part"))


@query("html_work_list_wide", ["hub", "wide_snapshots"], "select distinct h.sec_domain_id from hub h join wide_snapshots p on p.sec_domain_id = h.sec_domain_id where graymarket_label is null and online_status = 'Online' and redirect_domain = false and exc_domain_id is null and added > date '2025-01-01' and class_id is null")
def _(s, d):
    """WL-15 over snapshots of many domains."""
    return load(s, d, "hub").filter(relational.WORK_LISTS["WL-15"]).join(load(s, d, "wide_snapshots"), "sec_domain_id", "left_semi").select("sec_domain_id")
