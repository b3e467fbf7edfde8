"""Queries over domain names and relations of suffixes, beside their SQL; importing the module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import text as tx
from riskloom.operators import captures, domains, referrals, relational, rules
from riskloom.plans.queries import query
from riskloom.session import shared_folder
from riskloom.sources import commits, files
from riskloom.sources.adapters import load

_X = "regexp_replace(regexp_extract(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^[^/?#]*'), '^[^@]*@', '')"
_HOST = f"rtrim(lower(case when starts_with({_X}, '[') then regexp_extract({_X}, '^\\[([^\\]]*)\\]?', 1) else regexp_replace({_X}, ':\\d*$', '') end), '.')"
_OCTET = "(25[0-5]|2[0-4]\\d|1?\\d?\\d)"
_IP = f"regexp_matches(h, '^{_OCTET}(\\.{_OCTET}){{3}}$|:')"
_PLATFORMS = ", ".join(f"'{x}'" for x in tx.HOSTED_SUFFIXES)
_BY_SUFFIX = """rules as (select distinct regexp_replace(suffix, '^(\\*\\.|!)', '') as base, case when suffix like '*.%' then 1 when suffix like '!%' then -1 else 0 end as more from suffixes),
met as (select h, max(case when more >= 0 then len(string_split(base, '.')) + more end) as r, max(case when more < 0 then len(string_split(base, '.')) - 1 end) as e from hosts join rules on (h = base or ends_with(h, '.' || base)) and len(string_split(base, '.')) + more <= len(string_split(h, '.')) group by h),
cut as (select hosts.h, string_split(hosts.h, '.') as l, coalesce(e, r, 0) as n from hosts left join met on met.h = hosts.h),
named as (select h, array_to_string(l[greatest(len(l) - n, 1):], '.') as registered, array_to_string(l[len(l) - n + 1:], '.') as suffix, nullif(array_to_string(l[1:greatest(len(l) - n - 1, 0)], '.'), '') as subdomain from cut)"""


@query("suffix_domains", ["crawl_urls", "suffixes"], f", hosts as (select distinct h from (select {_HOST} as h from crawl_urls) u where h <> '' and not {_IP}), {_BY_SUFFIX} select h as host, suffix, registered, subdomain from named".lstrip())
def _(s, d):
    """Every host of the crawled URLs, cut at its longest suffix."""
    hosts = load(s, d, "crawl_urls").select(tx.ascii_host(tx.url_host(F.col("url"))).alias("host"))
    return domains.by_suffix(hosts, "host", load(s, d, "suffixes"))


@query("clean_domains", ["crawl_urls", "suffixes"], f", seen as (select {_HOST} as h, min(k) as k from crawl_urls group by 1), hosts as (select h from seen where h <> '' and not {_IP}), {_BY_SUFFIX} select registered as clean_domain, min(k) as first_seen from named join seen on seen.h = named.h where registered not in ({_PLATFORMS}) group by 1".lstrip())
def _(s, d):
    """Registered domains that were crawled, without platforms and addresses."""
    return domains.cleaned(load(s, d, "crawl_urls"), "url", "k", suffixes=load(s, d, "suffixes"))


@query("open_feature_domains", ["crawl_urls", "tld_list"], f""", seen as (select feature, {_HOST} as h, min(k) as k from (select *, unnest(list_filter([case when ssl_poor is null then 'ssl_poor' end, case when mfa_engagement is null then 'mfa_engagement' end, case when high_traffic is null then 'high_traffic' end], lambda x: x is not null)) as feature from crawl_urls) u group by 1, 2),
hosts as (select feature, k, list_filter(string_split(h, '.'), lambda x: x <> '') as l from seen where h <> '' and not {_IP}),
named as (select feature, k, array_to_string(l[greatest(len(l) - case when len(l) >= 3 and l[-2] in (select trim(lower(tld)) from tld_list) then 2 else 1 end, 1):], '.') as registered from hosts)
select feature, registered as clean_domain, min(k) as first_seen from named where registered not in ({_PLATFORMS}) group by 1, 2""".lstrip())
def _(s, d):
    """Registered domains of rows whose feature is still open, by feature, with the rule of the tld list."""
    x = domains.open_features(load(s, d, "crawl_urls"), ["ssl_poor", "mfa_engagement", "high_traffic"])
    return domains.cleaned(x, "url", "k", by=["feature"], tlds=load(s, d, "tld_list"))


@query("brand_places", ["hub", "brands"], "select distinct lower(h.sec_domain) as name, lower(trim(b.keyword)) as word, cast(instr(lower(h.sec_domain), lower(trim(b.keyword))) as int) as first_at from hub h join brands b on b.brand and contains(lower(h.sec_domain), lower(trim(b.keyword)))")
def _(s, d):
    """Which brand keywords stand in a domain name, and where first."""
    names = load(s, d, "hub").select(F.lower("sec_domain").alias("n"))
    words = load(s, d, "brands").filter("brand").select(F.lower(F.trim("keyword")).alias("w"))
    return domains.keyword_hits(names, "n", words, "w").groupBy("name", "word").agg(F.min("at").alias("first_at"))


@query("keyed_updates_keep", ["hub", "traffic_sources"], "select h.sec_domain_id, case when t.sec_domain_id % 2 = 0 then cast(t.sec_domain_id % 900 as int) else h.html_length end as html_length from hub h left join traffic_sources t on t.sec_domain_id = h.sec_domain_id")
def _(s, d):
    """An update whose nulls keep the old value: half of the new values are null."""
    k = F.col("sec_domain_id")
    new = load(s, d, "traffic_sources").select(k, F.when(k % 2 == 0, (k % 900).cast("int")).alias("html_length"))
    return relational.keyed_update(load(s, d, "hub").select("sec_domain_id", "html_length"), new, "sec_domain_id", ["html_length"], keep_old=["html_length"])


@query("insert_certificates", ["certificates"], "select cert_id % 400 as domain, cert_id, issuer from certificates where cert_id % 400 < 300 and cert_id % 3 = 0 union all select cert_id % 400, cert_id, issuer from certificates where cert_id % 400 in (select cert_id % 400 from certificates where cert_id % 3 = 1) and cert_id % 400 not in (select cert_id % 400 from certificates where cert_id % 400 < 300 and cert_id % 3 = 0) and cert_id % 3 = 1")
def _(s, d):
    """Three inserts, the last a replay of the first: the rows of a domain go in once, with the first insert that has it."""
    table = shared_folder(s, "certificates")
    c = load(s, d, "certificates").select((F.col("cert_id") % 400).alias("domain"), "cert_id", "issuer")
    first, second = c.filter("domain < 300 AND cert_id % 3 = 0"), c.filter("cert_id % 3 = 1")
    for batch, df in (("a", first), ("b", second), ("a", first)):
        commits.insert_new(df, table, "domain", batch)
    return commits.read_table(s, table, c.schema)


@query("update_counts", ["hub"], """select name, cast(n as bigint) as n from (select unnest(['rows', 'online_status=Online', 'online_status=Offline', 'online_status=Blocked', 'online_status=other', 'source=sql script', 'source=other', 'changed']) as name,
 unnest([count(*), count_if(online_status = 'Online'), count_if(online_status = 'Offline'), count_if(online_status = 'Blocked'), count_if(online_status is null or online_status not in ('Online', 'Offline', 'Blocked')), count_if(hit), count_if(not hit), count_if(c2 is distinct from class_id or hit)]) as n from (select *, coalesce(coalesce(ad_count, 0) = 0 and c2 = 3, false) as hit from
 (select *, case when media_type_id = 5 and c1 <> 10 then 10 else c1 end as c2 from (select *, case when media_type_id = 17 and (class_id is null or class_id = 9) then 11 else class_id end as c1 from hub) a) b) c) d""")
def _(s, d):
    """Counts by status and reason of the final overrides, told by the write itself."""
    hub = load(s, d, "hub")
    x = hub.select("sec_domain_id", "online_status", "class_id").join(rules.final_overrides(hub).select("sec_domain_id", "c", "source"), "sec_domain_id")
    x, seen = relational.observed(x, {"online_status": ["Online", "Offline", "Blocked"], "source": ["sql script"]}, {"changed": F.count_if(~F.col("c").eqNullSafe(F.col("class_id")))})
    x.select("sec_domain_id", "c", "source").write.parquet(shared_folder(s, "overrides"))
    return s.createDataFrame(list(relational.counts(seen).items()), "name string, n long")


@query("keyset_pages_sparse", ["hub"], "select key, cast((row_number() over (order by key) - 1) // 30 as bigint) as page from (select sec_domain || '/' || cast((sec_domain_id * 7919) % 104729 as varchar) as key from hub) x")
def _(s, d):
    """Pages of 30 over keys of text, as far apart as they come."""
    key = F.concat("sec_domain", F.lit("/"), ((F.col("sec_domain_id") * 7919) % 104729).cast("string"))
    return captures.keyset_pages(load(s, d, "hub").select(key.alias("key")), "key", 30)


_WINDOW = "date_trunc('month', max(month) - interval 5 month)"


@query("referring_sites", ["referral_traffic", "domain_attributes"], f"""select d_sec_domain_id as sec_domain_id, count(distinct r_domain_id) as exact, true as near from referral_traffic r join domain_attributes a on a.domain_id = r.r_domain_id
 where step_in_process = 2 and d_exc_domain_id is null and d_domain_id is null and (analyst_class in (1, 16) or (analyst_class is null and ml_class in (1, 3, 4, 5))) and month >= (select {_WINDOW} from referral_traffic) group by 1""")
def _(s, d):
    """The sketched number of infringing referrers beside the exact one: near means within 5 %, three standard errors, and half a referrer."""
    m = referrals.rollup(load(s, d, "referral_traffic"))
    a = load(s, d, "domain_attributes")
    first = referrals.start_month(m).scalar()
    about = referrals.referring_sites(referrals.referrer_sketches(m, a), first, m.agg(F.max("month")).scalar())
    inf = a.filter(referrals.infringing(F.col("analyst_class"), F.col("ml_class"), [1, 3, 4, 5])).select(F.col("domain_id").alias("r_domain_id"))
    exact = referrals.facts_of(m).join(inf, "r_domain_id", "left_semi").groupBy(F.col("d_sec_domain_id").alias("sec_domain_id")).agg(F.count_distinct("r_domain_id").alias("exact"))
    near = F.abs(F.col("referring_sites") - F.col("exact")) <= 0.05 * F.col("exact") + 0.5
    return exact.join(about, "sec_domain_id").select("sec_domain_id", "exact", near.alias("near"))


@query("landed_rows", ["hub"], "select sec_domain_id, sec_domain, class_id, google_search_results from hub where sec_domain_id % 2 = 0 or sec_domain_id % 3 = 0")
def _(s, d):
    """Rows that went out as delimited files in two appends, each part with its header, and came back typed, nulls included."""
    path = shared_folder(s, "rows")
    h = load(s, d, "hub").select("sec_domain_id", "sec_domain", "class_id", "google_search_results")
    files.append_csv(h.filter("sec_domain_id % 2 = 0"), path)
    files.append_csv(h.filter("sec_domain_id % 2 = 1 AND sec_domain_id % 3 = 0"), path)
    return files.read_delimited(s, path, "sec_domain_id long, sec_domain string, class_id int, google_search_results int")
