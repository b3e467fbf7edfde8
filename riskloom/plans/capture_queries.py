"""Queries over landed captures, beside their SQL; importing the module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import text as tx
from riskloom.operators import captures, domains, relational, rules
from riskloom.plans.queries import query
from riskloom.session import shared_folder
from riskloom.sources import files
from riskloom.sources.adapters import load
from riskloom.streaming import responses

_HOST_OF = lambda u: f"regexp_extract({u}, 'https?://([^/]+)', 1)"
_HTML_STATUS = """case when contains(t, '404 not found') then {{'s': 'Offline | Ad Sniffer', 'k': 'Error[' || {c} || ']', 'm': ''}} when contains(t, 'cloudflare') and contains(t, 'ray id') then {{'s': 'Blocked', 'k': 'Error[Cloudflare-' || {c} || ']', 'm': 'cloudflare'}}
 when contains(t, 'domain seized') or contains(t, 'no longer available due to copyright') then {{'s': 'Offline | Ad Sniffer', 'k': 'Error[Domain Seized-' || {c} || ']', 'm': 'Domain Seized'}} when contains(t, 'bad request') then {{'s': 'Blocked', 'k': 'Error[Bad Request-' || {c} || ']', 'm': ''}}
 when {c} = '200' then {{'s': 'Online', 'k': 'None', 'm': ''}} else {{'s': 'Offline | Ad Sniffer', 'k': 'Error[' || {c} || ']', 'm': ''}} end"""
_PARKED_HERE = "(contains(t, 'buy this domain') or contains(t, 'domain seized') or contains(t, 'no longer available due to copyright'))"
_SEIZED_HERE = "(contains(html, 'Domain Seized') or contains(lower(html), 'no longer available due to copyright'))"


@query("response_status", ["response_log", "response_chain", "site_pages"], f"""select site, n as n_responses, o.s as online_status, o.k as offline_type, o.u as redirect_url, o.m as status_msg from (select *,
 case when contains(page_url, 'alliance4creativity.com') then {{'s': 'Offline', 'k': 'Domain Seized', 'u': null, 'm': host}}
  when {_PARKED_HERE} then {{'s': 'Offline | Status Checker', 'k': 'Parking Page', 'u': '', 'm': ''}}
  when not contains(host, domain) then {{'s': 'Offline | Status Checker', 'k': 'Redirect', 'u': page_url, 'm': ''}}
  when n = 1 and c[1].status > 400 and c[1].status < 500 then {{'s': 'Offline', 'k': case when r is null then 'Error[400-500]' else 'Redirect' end, 'u': r, 'm': ''}}
  when n = 1 then {{'s': h1.s, 'k': h1.k, 'u': null, 'm': h1.m}}
  when c[1].status = 200 then case when {_SEIZED_HERE} then {{'s': 'Blocked', 'k': 'Domain Seized', 'u': r, 'm': 'Domain Seized'}} else {{'s': 'Online', 'k': '', 'u': r, 'm': ''}} end
  when c[1].status between 300 and 399 then case when c[2].status <> 200 and hn.s <> 'Online' then {{'s': hn.s, 'k': hn.k, 'u': r, 'm': hn.m}}
    when len(list_filter(oks, lambda x: contains({_HOST_OF('x.url')}, {_HOST_OF('c[1].url')}))) > 0 then case when {_SEIZED_HERE} then {{'s': 'Blocked', 'k': 'Domain Seized', 'u': r, 'm': 'Domain Seized'}} else {{'s': 'Online', 'k': case when r is null then '' else 'Redirect - same domain' end, 'u': r, 'm': 'Redirect same domain'}} end
    when len(oks) > 0 then {{'s': 'Online', 'k': 'Redirect', 'u': r, 'm': ''}} else {{'s': hn.s, 'k': hn.k, 'u': r, 'm': hn.m}} end
  else {{'s': h1.s, 'k': h1.k, 'u': null, 'm': h1.m}} end as o
 from (select *, {_HTML_STATUS.format(c='cast(c[1].status as varchar)')} as h1, {_HTML_STATUS.format(c='cast(c[-1].status as varchar)')} as hn, case when host <> domain then page_url end as r, list_filter(c[2:10], lambda x: x.status = 200) as oks
  from (select p.*, e.n, e.c, {_HOST_OF('page_url')} as host, lower(regexp_replace(html, '<[^>]+>', ' ', 'g')) as t from site_pages p join (select site, count(*) as n, list(struct_pack(status := status, url := url) order by seq) as c from response_chain group by site) e on e.site = p.site) a) b) z""")
def _(s, d):
    return captures.site_status(load(s, d, "response_chain"), load(s, d, "site_pages"))


_OLD_HTML = "case when contains(lower(html), 'cloudflare') then {'s': 'Blocked', 'k': 'Error[Cloudflare-' || f || ']'} else {'s': 'Offline', 'k': 'Error[' || f || ']'} end"


@query("older_status", ["response_log", "response_chain", "site_pages"], f"""select site, o.s as online_status, o.k as offline_type from (select *, case when n = 1 then {_OLD_HTML} when c[1].status = 200 then {{'s': 'Online', 'k': ''}}
  when c[1].status between 300 and 399 then case when len(oks) > 0 then {{'s': 'Online', 'k': case when contains({_HOST_OF('oks[1].url')}, {_HOST_OF('c[1].url')}) then '' else 'Redirect' end}} end else {_OLD_HTML} end as o
 from (select p.*, e.n, e.c, cast(e.c[1].status as varchar) as f, list_filter(e.c[2:10], lambda x: x.status = 200) as oks from site_pages p join (select site, count(*) as n, list(struct_pack(status := status, url := url) order by seq) as c from response_chain group by site) e on e.site = p.site) a) b""")
def _(s, d):
    return captures.older_status(load(s, d, "response_chain"), load(s, d, "site_pages"))


@query("engaged_domains", ["hub", "engagement"], "select h.sec_domain_id, sec_domain, online_status, class_id, sec_domain_source, month, bounce_rate, pages_per_visit, avg_visit_duration from hub h join engagement e on e.sec_domain_id = h.sec_domain_id")
def _(s, d):
    h = load(s, d, "hub").select("sec_domain_id", "sec_domain", "online_status", "class_id", "sec_domain_source")
    return h.join(load(s, d, "engagement").drop("fact_id"), "sec_domain_id")


@query("popup_urls", ["response_chain"], "select seq, case when seq % 2 = 0 then [url] else [] end as urls, case when status = 404 then 'Offline' else 'Online' end as status from response_chain")
def _(s, d):
    """Popup lists with noise, and a second evaluation of the status where there is one."""
    noisy = F.array(F.lit("about:blank"), F.when(F.col("seq") % 2 == 0, F.col("url")).otherwise("chrome-error://chromewebdata/"), F.lit("about:blank"))
    again = captures.recheck(F.lit("Online"), F.when(F.col("status") == 404, "Offline"))
    return load(s, d, "response_chain").select("seq", captures.popups(noisy).alias("urls"), again.alias("status"))


@query("bid_hosts", ["response_chain"], "select seq, case when seq % 4 = 2 then 'ads.example' else 's' || cast(site as string) || '.com' end as full_domain, case when seq % 4 = 0 then 'b.com' end as domain, case when seq % 4 = 0 then 'a' end as subdomain from (select seq, site from response_chain) x where seq % 4 <> 0 union all select seq, 'a.b.com', 'b.com', 'a' from response_chain where seq % 4 = 0")
def _(s, d):
    h = captures.bid_host(F.when(F.col("seq") % 4 == 0, "https://www.a.b.com/x?y").otherwise(F.col("url")))
    return load(s, d, "response_chain").select("seq", *[c.alias(k) for k, c in h.items()])


@query("post_click", ["response_log"], "select seq, url, exists (select 1 from response_log p where p.site = r.site and p.url = r.url and p.status = 302) as post_clic from response_log r")
def _(s, d):
    log = load(s, d, "response_log")
    return captures.post_click(log, log.filter("status = 302"), ["site", "url"]).select("seq", "url", "post_clic")


@query("bids", ["response_log"], "select seq, seq % 3 = 0 as is_bid, case when seq % 3 = 0 then 'p' || cast(site as string) end as publisher, case when seq % 3 = 0 then 'b' || cast(seq as string) end as buyer, seq % 4 = 1 as is_vast from response_log")
def _(s, d):
    """Bodies are made from the log: bids, broken JSON with a price, and VAST answers."""
    site, seq = F.col("site").cast("string"), F.col("seq")
    good = F.concat(F.lit('{"cpm": 1, "publisher": "p'), site, F.lit('", "buyer": "b'), seq.cast("string"), F.lit('"}'))
    body = F.when(seq % 3 == 0, good).when(seq % 3 == 1, '{"cpm": 1,').otherwise("text")
    body = F.when(seq % 4 == 1, F.concat(body, F.lit(" "))).otherwise(body)
    vast = F.when(seq % 4 == 1, '<?XML version="1.0"?><VAST/>').otherwise(body)
    b = captures.bid(body)
    return load(s, d, "response_log").select("seq", b["is_bid"].alias("is_bid"), b["publisher"].alias("publisher"), b["buyer"].alias("buyer"), captures.is_vast(vast).alias("is_vast"))


@query("media_names", ["hub"], "select sec_domain_id, case media_type_id when 1 then 'Film & TV' when 17 then 'invalid' when 5 then 'Publishing' when 7 then 'Software' else 'Other' end as media_type, case sec_domain_id % 20 when 1 then 'Film & TV' when 2 then 'Sports' when 3 then 'Anime' when 4 then 'Manga' when 5 then 'Publishing' when 6 then 'Games' when 7 then 'Software' when 8 then 'Music' when 9 then 'Adult' when 10 then 'News' when 11 then 'General' when 13 then 'Content Host' when 14 then 'Online Courses' when 16 then 'Publishing' when 17 then 'invalid' else 'Other' end as any_media_type, array_to_string(list_reverse(string_split(sec_domain, '.')), '.') as reversed_name from hub")
def _(s, d):
    return load(s, d, "hub").select("sec_domain_id", captures.media_type_name(F.col("media_type_id")).alias("media_type"), captures.media_type_name(F.col("sec_domain_id") % 20).alias("any_media_type"), captures.reversed_labels(F.col("sec_domain")).alias("reversed_name"))


@query("keyset_pages", ["hub"], "select sec_domain_id, cast((row_number() over (order by sec_domain_id) - 1) // 30 as bigint) as page from hub where class_id = 3 and publication_status = 0")
def _(s, d):
    """All pages of 30, as the loop over them would read them."""
    return captures.keyset_pages(load(s, d, "hub").filter("class_id = 3 AND publication_status = 0"), "sec_domain_id", 30)


@query("serp_work_list", ["hub"], "select sec_domain_id, sec_domain from hub where class_id is null and added > date '2025-07-18' and google_search_results is null order by sec_domain_id limit 3000")
def _(s, d):
    """The oldest 3000 of WL-04: the limit is the feature, the order makes it repeatable."""
    h = load(s, d, "hub").filter("class_id IS NULL AND google_search_results IS NULL AND added > date'2025-07-18'")
    return h.select("sec_domain_id", "sec_domain").orderBy("sec_domain_id").limit(3000)


@query("page_speed", ["hub"], "select sec_domain_id, case when sec_domain_id % 3 = 0 then 0 else cast(sec_domain_id % 100 as double) end as score, case when sec_domain_id % 3 = 0 then 0 else cast(sec_domain_id as double) end as lcp, case when sec_domain_id % 3 = 0 or sec_domain_id % 2 = 0 then 0 else cast(0.25 as double) end as cls from hub")
def _(s, d):
    k = F.col("sec_domain_id")
    audit = F.concat(F.lit('{"lighthouseResult": {"categories": {"performance": {"score": '), ((k % 100) / 100).cast("string"), F.lit('}}, "audits": {"lcp": {"numericValue": '), k.cast("string"), F.when(k % 2 == 0, "}").otherwise('}, "cls": {"numericValue": 0.25}'), F.lit("}}}"))
    speed = captures.page_speed(F.when(k % 3 == 0, "{}").otherwise(audit))
    return load(s, d, "hub").select("sec_domain_id", F.round(speed["score"], 6).alias("score"), speed["lcp"].alias("lcp"), speed["cls"].alias("cls"))


@query("sitemaps", ["snapshots"], "select html_id, cast(html_id % 5 as int) as n_locs from snapshots")
def _(s, d):
    xml = F.concat(F.lit("<urlset>"), F.repeat(F.lit("<url><loc>a</loc></url>"), (F.col("html_id") % 5).cast("int")), F.lit("</urlset>"))
    return load(s, d, "snapshots").select("html_id", captures.sitemap_count(xml).alias("n_locs"))


@query("crawl_outcome", ["hub"], "select sec_domain_id, coalesce(case sec_domain_id % 3 when 0 then 'Redirect' when 1 then 'None' end = 'Redirect', false) as redirect_domain from hub")
def _(s, d):
    kind = F.when(F.col("sec_domain_id") % 3 == 0, "Redirect").when(F.col("sec_domain_id") % 3 == 1, "None")
    return load(s, d, "hub").select("sec_domain_id", captures.crawl_outcome(kind).alias("redirect_domain"))


@query("latest_certificate", ["certificates"], "select domain, cert_id from (select cert_id % 50 as domain, cert_id, valid_to, row_number() over (partition by cert_id % 50 order by valid_to desc nulls last, cert_id) as rn from certificates) x where rn = 1")
def _(s, d):
    c = load(s, d, "certificates").select((F.col("cert_id") % 50).alias("domain"), "cert_id", "valid_to")
    return relational.latest(c, ["domain"], [F.desc_nulls_last("valid_to"), F.col("cert_id")]).select("domain", "cert_id")


@query("certificate_days", ["certificates"], "select cert_id, cast(floor((epoch(valid_to) - epoch(valid_from)) / 86400) as bigint) as days, cast(date_diff('day', cast(valid_from as date), date '2025-01-01') as double) / 365 as age_years from certificates")
def _(s, d):
    days = F.floor((F.unix_timestamp("valid_to") - F.unix_timestamp("valid_from")) / 86400)
    age = captures.age_years(F.date_format("valid_from", "yyyy-MM-dd"), F.to_date(F.lit("2025-01-01")))
    return load(s, d, "certificates").select("cert_id", days.alias("days"), age.alias("age_years"))


@query("redirect_flow", ["hub"], "select h.sec_domain_id, exists (select 1 from hub e where e.exc_domain_id is not null and e.sec_domain = h.sec_domain) as excluded from hub h where redirect_domain = true")
def _(s, d):
    h = load(s, d, "hub")
    listed = h.filter("exc_domain_id IS NOT NULL").select("sec_domain").distinct().withColumn("hit", F.lit(True))
    return h.filter("redirect_domain = true").join(listed, "sec_domain", "left").select("sec_domain_id", F.coalesce("hit", F.lit(False)).alias("excluded"))


@query("brand_domains", ["hub", "brands"], "select sec_domain_id, exists (select 1 from brands b where b.brand and length(b.keyword) >= 6 and contains(lower(h.sec_domain), lower(trim(b.keyword)))) as brand_known from hub h")
def _(s, d):
    return domains.brand_known(load(s, d, "hub").select("sec_domain_id", "sec_domain"), "sec_domain", load(s, d, "brands")).select("sec_domain_id", "brand_known")


@query("first_wins", ["hub", "traffic_sources"], "select sec_domain_id, value, src from (select *, row_number() over (partition by sec_domain_id order by src) as rn from (select sec_domain_id, direct_share as value, 1 as src from traffic_sources union all select sec_domain_id, null, 2 from hub) u) x where rn = 1")
def _(s, d):
    """Two result sets, one row per key, the first set before the second."""
    a = load(s, d, "traffic_sources").select("sec_domain_id", F.col("direct_share").alias("value"), F.lit(1).alias("src"))
    b = load(s, d, "hub").select("sec_domain_id", F.lit(None).cast("double").alias("value"), F.lit(2).alias("src"))
    return relational.latest(a.unionByName(b), ["sec_domain_id"], [F.col("src")])


@query("wide_features", ["hub", "tree"], "select sec_domain_id, site_map_count, cast(null as boolean) as is_ecommerce from hub union all select sec_domain_id, null, is_ecommerce from tree")
def _(s, d):
    """Feature rows with different columns under one schema."""
    return load(s, d, "hub").select("sec_domain_id", "site_map_count").unionByName(load(s, d, "tree").select("sec_domain_id", "is_ecommerce"), allowMissingColumns=True)


@query("merged_features", ["hub", "tree"], "select h.sec_domain_id, cast(t.html_length as string) as html_length, cast(h.ad_count as string) as ad_count from hub h join tree t on t.sec_domain_id = h.sec_domain_id")
def _(s, d):
    """Feature maps of two sources in one, in which later keys win."""
    h = load(s, d, "hub").select("sec_domain_id", F.create_map(F.lit("html_length"), F.lit("0"), F.lit("ad_count"), F.col("ad_count").cast("string")).alias("a"))
    t = load(s, d, "tree").select("sec_domain_id", F.create_map(F.lit("html_length"), F.col("html_length").cast("string")).alias("b"))
    merged = F.map_concat(F.map_filter("a", lambda k, _: ~F.map_contains_key(F.col("b"), k)), F.col("b"))
    return h.join(t, "sec_domain_id").withColumn("m", merged).select("sec_domain_id", F.col("m")["html_length"].alias("html_length"), F.col("m")["ad_count"].alias("ad_count"))


@query("attribute_ids", ["domain_attributes"], "select domain_id as item, case when domain_id % 3 > 0 then domain_id end as domain_id from domain_attributes")
def _(s, d):
    """Ids of names with blanks around them; a third of the names is unknown."""
    a = load(s, d, "domain_attributes")
    items = a.select(F.col("domain_id").alias("item"), F.when(F.col("domain_id") % 3 == 0, "nowhere.example").otherwise(F.concat(F.lit("  "), "domain", F.lit(" "))).alias("name"))
    return captures.by_trimmed_name(items, "name", a, "domain", "domain_id").select("item", "domain_id")


@query("ssl_trust", ["hub", "certificates"], """select h.sec_domain_id, case when h.sec_domain_root is null then 0 when c.cert_id is null or (coalesce(validation_type, '') = '' and coalesce(issuer, '') = '') then 0.3 else cast(10 - least(10, case when validation_type = 'domain' then 3 else 0 end + case when lower(issuer) like '%let''s encrypt%' or lower(issuer) like '%google%' then 2 else 0 end
 + case when floor((epoch(valid_to) - epoch(valid_from)) / 86400) <= 90 then 2 else 0 end + case when (key_type = 'RSA' and key_bits < 2048) or (key_type = 'ECDSA' and key_bits < 256) then 2 else 0 end + case when policies like '%2.23.140.1.2.1%' then 2 else 0 end + case when dns_names like '%*%' then 1 else 0 end) as double) / 10 end as trust
 from hub h left join certificates c on c.cert_id = h.sec_domain_id * 2""")
def _(s, d):
    """Trust of a domain's certificate: 0.3 without one, 0 without a domain to ask for."""
    x = load(s, d, "hub").select("sec_domain_id", "sec_domain_root").join(load(s, d, "certificates"), F.col("cert_id") == F.col("sec_domain_id") * 2, "left")
    tenths = F.when(F.col("cert_id").isNull(), 7).otherwise(rules.ssl_tenths(F.col))
    return x.select("sec_domain_id", F.when(F.col("sec_domain_root").isNull(), 0.0).otherwise((10 - F.least(F.lit(10), tenths)).cast("double") / 10).alias("trust"))


@query("html_work_list", ["hub", "snapshots"], "select distinct h.sec_domain_id from hub h join snapshots p on p.sec_domain_id = h.sec_domain_id where graymarket_label is null and online_status = 'Online' and redirect_domain = false and exc_domain_id is null and added > date '2025-01-01' and class_id is null")
def _(s, d):
    """WL-15: only domains with a snapshot."""
    return load(s, d, "hub").filter(relational.WORK_LISTS["WL-15"]).join(load(s, d, "snapshots"), "sec_domain_id", "left_semi").select("sec_domain_id")


@query("certificate_work_list", ["hub", "certificates"], "select h.sec_domain_id, c.cert_id from hub h left join certificates c on c.cert_id = h.sec_domain_id where ssl_poor is null and online_status = 'Online' and class_id is null and sec_domain_root is not null")
def _(s, d):
    """WL-13: the join to certificates rules nothing out."""
    return load(s, d, "hub").filter(relational.WORK_LISTS["WL-13"]).join(load(s, d, "certificates").select("cert_id"), F.col("cert_id") == F.col("sec_domain_id"), "left").select("sec_domain_id", "cert_id")


@query("media_work_list", ["hub"], "select sec_domain_id, sec_domain from hub where media_type_id is null and online_status = 'Online' and class_id is null order by sec_domain_id desc limit 4000")
def _(s, d):
    """WL-17, the newest 4000: the limit is the feature."""
    return load(s, d, "hub").filter(relational.WORK_LISTS["WL-17"]).select("sec_domain_id", "sec_domain").orderBy(F.desc("sec_domain_id")).limit(4000)


@query("ssl_backfill_list", ["hub"], "select sec_domain_id, sec_domain_root from hub where media_type_id is not null and enforcement_id is null and sec_domain_root is not null order by sec_domain_id desc limit 7500")
def _(s, d):
    """WL-19 for batches of 1500, the newest five batches (20,000 at most): the limit is the feature."""
    return load(s, d, "hub").filter(relational.WORK_LISTS["WL-19"]).select("sec_domain_id", "sec_domain_root").orderBy(F.desc("sec_domain_id")).limit(min(5 * 1500, 20_000))


@query("address_bar_list", ["hub"], "select sec_domain_id, sec_domain, online_status, class_id, sec_domain_source from hub where class_id is null")
def _(s, d):
    return load(s, d, "hub").filter("class_id IS NULL").select("sec_domain_id", "sec_domain", "online_status", "class_id", "sec_domain_source")


@query("serp_first_page", ["hub"], "select sec_domain as domain, cast(case sec_domain_id % 3 when 0 then null else sec_domain_id % 3 end as int) as n from hub")
def _(s, d):
    """How many results the first page of a landed answer has; a third of the answers is broken."""
    url = F.struct(F.lit("https://a.example/").alias("url"))
    page = lambda *u: F.to_json(F.struct(F.array(F.struct(F.struct(F.struct(F.array(*u).alias("organic")).alias("results")).alias("content"))).alias("results")))
    k = F.col("sec_domain_id") % 3
    return load(s, d, "hub").select(F.col("sec_domain").alias("domain"), files.serp_first_page(F.when(k == 0, "[").when(k == 1, page(url)).otherwise(page(url, url))).alias("n"))


@query("serp_jobs", ["hub"], "select sec_domain as domain, cast(case sec_domain_id % 4 when 0 then null when 1 then null when 2 then 3 else 0 end as int) as n from hub")
def _(s, d):
    """Landed answers of asynchronous searches: one still runs, one is broken, the others hold three results and none."""
    k = F.col("sec_domain_id") % 4
    answer = F.when(k == 1, "{").when(k == 2, '[{"organic": [{"url": "a"}, {"url": "b"}, {}]}, {"organic": []}]').otherwise('[{"organic": []}]')
    return load(s, d, "hub").select(F.col("sec_domain").alias("domain"), files.serp_job(F.when(k == 0, "running").otherwise("ready"), answer).alias("n"))


@query("domain_forms", ["hub"], "select sec_domain_id, [sec_domain, 'www.' || sec_domain] as variants, sec_domain_id % 4 = 0 as hosted, case when sec_domain_id % 4 = 0 then 'pages.dev' when sec_domain_id % 4 = 1 then 'x' || cast(sec_domain_id as string) || '.gov.uk' else sec_domain end as registered from hub")
def _(s, d):
    """Both forms of a name; whether it stands on a hosting platform; its registered part by a list of second-level labels."""
    k = F.col("sec_domain_id")
    host = F.when(k % 4 == 0, F.concat(F.lit("a"), k.cast("string"), F.lit(".pages.dev"))).when(k % 4 == 1, F.concat(F.lit("w.x"), k.cast("string"), F.lit(".gov.uk"))).otherwise(F.concat(F.lit("m."), "sec_domain"))
    url = F.concat(F.lit(" HTTPS://www."), "sec_domain", F.lit("/p "))
    return load(s, d, "hub").select("sec_domain_id", tx.domain_variants(url).alias("variants"), tx.is_hosted(host).alias("hosted"), tx.registered_domain(host, ["gov", "co"]).alias("registered"))


@query("label_cleaning", ["tree"], "select sec_domain_id, case when graymarket_label in ('Adult Content', 'Gambling & Betting', 'Cryptocurrency Speculation', 'Supplement / Nutra') then graymarket_label else 'undeterminated' end as label from tree")
def _(s, d):
    answer = F.concat(F.lit("**"), F.coalesce("graymarket_label", F.lit("?")), F.lit("**\nbecause"))
    allowed = ["Adult Content", "Gambling & Betting", "Cryptocurrency Speculation", "Supplement / Nutra", "undeterminated"]
    return load(s, d, "tree").select("sec_domain_id", captures.clean_label(answer, allowed, "undeterminated").alias("label"))


@query("asn_profile", ["asn_lookup"], """select domain_id, case when ok then cast(date_diff('day', try_cast(asn_date as date), date '2025-01-01') as double) / 365 end as asn_age, case when ok then case when asn in ('197414', '56873') then 'bullet-proof' else 'isp' end end as hosting_type,
 not coalesce(ok, false) or coalesce(country in ('RU', 'UA', 'CN', 'MD', 'RO', 'BG', 'BZ', 'PA', 'SC'), false) as is_high_risk_geo, case when ok then array_to_string(list_reverse(string_split(ip, '.')), '.') || '.zen.spamhaus.org' end as block_list_name from asn_lookup""")
def _(s, d):
    p = captures.asn_profile(*map(F.col, ("country", "ok", "asn", "asn_date", "ip")), F.to_date(F.lit("2025-01-01")))
    return load(s, d, "asn_lookup").select("domain_id", *[c.alias(k) for k, c in p.items()])


@query("country_names", ["asn_lookup"], "select domain_id, case country when 'US' then 'United States' when 'UK' then 'United Kingdom' when 'Viet Nam' then 'Vietnam' when 'Iran, Islamic Republic of' then 'Iran (Islamic Republic of)' when 'Venezuela, Bolivarian Republic of' then 'Venezuela (Bolivarian Republic of)' else country end as country from asn_lookup")
def _(s, d):
    return load(s, d, "asn_lookup").select("domain_id", captures.country(F.col("country")).alias("country"))


@query("shingle_counts", None, "select doc_id, cast(case when len(w) < 5 then 0 else len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) end as int) as n_shingles from (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') as w from documents) x")
def _(s, d):
    docs = s.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", F.size(tx.shingles(F.coalesce("text", F.lit("")))).alias("n_shingles"))


@query("event_windows", None, "select date_trunc('day', ts) as start, event_type, count(*) as n from events group by 1, 2")
def _(s, d):
    """The windows of the stream, over the whole table at once."""
    return responses.per_window(s.read.parquet(f"{d}/events.parquet")).select(F.col("window.start").alias("start"), "event_type", "n")


@query("event_sessions", None, "select user_id, min(ts) as start, count(*) as n from (select *, sum(cast(fresh as int)) over (partition by user_id order by ts, event_id) as session from (select *, coalesce(ts - lag(ts) over (partition by user_id order by ts, event_id) > interval 30 minute, true) as fresh from events) a) b group by user_id, session")
def _(s, d):
    """The sessions of the stream, over the whole table at once."""
    return responses.sessions(s.read.parquet(f"{d}/events.parquet")).select("user_id", F.col("session_window.start").alias("start"), "n")


@query("first_events", None, "select user_id, event_type, event_id, ts from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as rn from events) x where rn = 1")
def _(s, d):
    """What the deduplicated stream keeps, over the whole table at once."""
    return responses.first_events(s.read.parquet(f"{d}/events.parquet"))


@query("repeats_stream", None, """select user_id as site, event_id as seq, event_type as url from (select *, lag(event_type) over w as prev, row_number() over w as rn from events window w as (partition by user_id order by ts, event_id)) x where rn > 1 and event_type is distinct from prev""")
def _(s, d):
    """Responses without repeats from a stream over the landed events, which is run to its end; its state and rows live in the shared folder."""
    responses.use_rocksdb(s)
    path = f"{d}/[e]vents.parquet"  # as a pattern, which a stream reads whether it is a file or a folder
    log = responses.read_events(s, path).select(F.col("user_id").alias("site"), F.col("event_id").alias("seq"), F.col("event_type").alias("url"), F.lit(200).alias("status"), "ts")
    return responses.drained(responses.without_repeats(log, late="0 seconds"), shared_folder(s, "repeats")).select("site", "seq", "url")
