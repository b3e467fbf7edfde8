"""The registered reference operators as queries, most of them beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions import pages, text as tx
from riskloom.operators import captures, domains, referrals, relational as rel, rules, scorers
from riskloom.sources import files
from riskloom.sources.adapters import VIEWS, load, sql_with

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, views: list[str] | None = None, sql: str | None = None):
    """Registers a query and its SQL; views are the adapters that the SQL reads."""

    def add(f: Query) -> Query:
        _queries[name] = f
        if sql is not None:
            _sql[name] = sql_with(views or [], sql) if views else sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


_LISTS = " union all ".join(f"select '{n}' as work_list, sec_domain_id from hub where {p}" for n, p in rel.WORK_LISTS.items())


@query("work_lists", ["hub"], _LISTS)
def _(s, d):
    return rel.work_lists(load(s, d, "hub"))


_BET = "|".join(rf"(^|[.-]){t}[.-]|[.-]{t}$|^{t}$" if len(t) <= 3 else rf"\b{t}\b" for t in rules.BETTING_TERMS)


_BRAND = "exists (select 1 from brands b where b.brand and contains(lower(h.sec_domain), lower(b.keyword)))"


@query("rude_rules", ["hub", "brands"], f"select sec_domain_id, class_id, 'Rude Rules' as decision_source from (select sec_domain_id, cast(case when exc_domain_id is not null then 4 when {_BRAND} then 1 when regexp_matches(sec_domain, '{_BET}') then 6 end as int) as class_id from hub h where class_id is null) x where class_id is not null")
def _(s, d):
    h = load(s, d, "hub").filter("class_id IS NULL").select("sec_domain_id", "sec_domain", "exc_domain_id")
    h = domains.brand_known(h, "sec_domain", load(s, d, "brands"), least=1)
    x = h.select("sec_domain_id", rules.rude_class(F.col("sec_domain"), F.col("exc_domain_id"), F.col("brand_known")).alias("class_id"), F.lit("Rude Rules").alias("decision_source"))
    return x.filter("class_id IS NOT NULL")


@query("block_class", ["hub"], "select sec_domain_id, cast(case when redirect_domain then 2 when google_search_results <= 2 then 2 when google_search_results < 50 then 3 else 4 end as int) as class_id, 'Offline Class' as decision_source from hub where " + rel.WORK_LISTS["WL-05"])
def _(s, d):
    h = load(s, d, "hub").filter(rel.WORK_LISTS["WL-05"])
    return h.select("sec_domain_id", rules.block_class(F.col("google_search_results"), F.col("redirect_domain")).alias("class_id"), F.lit("Offline Class").alias("decision_source"))


@query("telemetry_class", ["hub"], "select sec_domain_id, c as class_id, case when c = 2 then 'LOW' end as confidence, cast(case when c = 2 then 6 end as int) as recommended_action_id, cast(case when c = 2 then 6 end as int) as justification from (select *, cast(case when google_search_results <= 2 then 2 when google_search_results < 50 then 3 else 4 end as int) as c from hub where " + rel.WORK_LISTS["WL-06"] + ") x")
def _(s, d):
    h = load(s, d, "hub").filter(rel.WORK_LISTS["WL-06"]).withColumn("c", rules.telemetry_class(F.col("google_search_results")))
    return h.select("sec_domain_id", F.col("c").alias("class_id"), F.when(F.col("c") == 2, "LOW").alias("confidence"), F.when(F.col("c") == 2, 6).alias("recommended_action_id"), F.when(F.col("c") == 2, 6).alias("justification"))


@query("telemetry_update", ["hub"], """select sec_domain_id, coalesce(c, class_id) as class_id, coalesce(case when c = 2 then 'LOW' end, confidence) as confidence, coalesce(cast(case when c = 2 then 6 end as int), justification) as justification from
 (select *, case when sec_domain_id % 5 = 0 then 'HIGH' end as confidence, cast(case when sec_domain_id % 5 = 0 then 1 end as int) as justification, cast(case when class_id is null and sec_domain_source = 'Domain Telemetry' then case when google_search_results <= 2 then 2 when google_search_results < 50 then 3 when google_search_results >= 50 then 4 end end as int) as c from hub) x""")
def _(s, d):
    """The rule's rows written over the hub; what the rule leaves open stays as it was."""
    h = load(s, d, "hub").withColumns({"confidence": F.when(F.col("sec_domain_id") % 5 == 0, "HIGH"), "justification": F.when(F.col("sec_domain_id") % 5 == 0, 1)})
    up = h.filter(rel.WORK_LISTS["WL-06"]).select("sec_domain_id", rules.telemetry_class(F.col("google_search_results")).alias("class_id"))
    up = up.withColumns({"confidence": F.when(F.col("class_id") == 2, "LOW"), "justification": F.when(F.col("class_id") == 2, 6)})
    names = ["class_id", "confidence", "justification"]
    return rel.keyed_update(h.select("sec_domain_id", *names), up, "sec_domain_id", names, keep_old=names)


_HOPS = "select * from (select *, max(bar_num) over (partition by session_id, ad_event_id, tab_num) as grp_max from address_bar) x where tab_num > 0 and landing_page is false and source_domain is distinct from bar_domain and grp_max > 0 and bar_num < grp_max"


@query("address_bar_hops", ["address_bar"], _HOPS)
def _(s, d):
    return rel.intermediate_hops(load(s, d, "address_bar"))


@query("address_bar_class", ["hub", "address_bar"], f"select sec_domain_id, 2 as class_id, 'Ad_sniffer' as decision_source from hub where class_id is null and sec_domain in (select bar_domain from ({_HOPS}) h)")
def _(s, d):
    return rel.on_address_bar(load(s, d, "hub"), load(s, d, "address_bar"))


_REF_VIEWS = ["hub", "referral_traffic", "domain_attributes", "tenants_domain", "tenants", "ad_domains", "traffic_sources"]
_VALID = "select distinct d_sec_domain_id, destination_domain from referral_traffic r where d_exc_domain_id is null and d_domain_id is null and (not exists (select 1 from ad_domains a where lower(a.ad_company_domain) = lower(r.destination_domain)) or exists (select 1 from ad_domains a where lower(a.ad_company_domain) = lower(r.destination_domain) and a.ad_company_id in (4375, 4527)))"
_BASE = f"from referral_traffic rt join ({_VALID}) vd on rt.d_sec_domain_id = vd.d_sec_domain_id join (select distinct sec_domain_id, sec_domain from hub where sec_domain_source in ('SimilarWeb', 'Ad Sniffer')) td on rt.d_sec_domain_id = td.sec_domain_id"
_WHERE = "where rt.month >= (select cast(date_trunc('month', max(month) - interval 5 month) as date) from referral_traffic) and rt.step_in_process = 2 and rt.d_exc_domain_id is null and rt.d_domain_id is null"
_INF = "(da.analyst_class in (1, 16) or (da.analyst_class is null and da.ml_class in ({})))"
_UNION = " union all ".join([
    f"select rt.d_sec_domain_id as id, sum(referred_visits) as total, 0 as inf, 0 as cust, 0 as adult {_BASE} {_WHERE} group by 1, rt.destination_domain",
    f"select rt.d_sec_domain_id, 0, sum(referred_visits), 0, 0 {_BASE} join domain_attributes da on rt.r_domain_id = da.domain_id {_WHERE} and {_INF.format('1, 3, 4, 5')} group by 1, rt.destination_domain",
    f"select rt.d_sec_domain_id, 0, 0, sum(referred_visits), 0 {_BASE} join domain_attributes da on rt.r_domain_id = da.domain_id join tenants_domain t2 on da.domain_id = t2.domain_id join tenants t on t2.tenant_id = t.tenant_id {_WHERE} and {_INF.format('1, 4, 5')} and t.customer_active group by 1, rt.destination_domain",
    f"select rt.d_sec_domain_id, 0, 0, 0, sum(referred_visits) {_BASE} join domain_attributes da on rt.r_domain_id = da.domain_id {_WHERE} group by 1, rt.destination_domain",
])
_RATIO = lambda a: f"case when sum(total) > 0 then cast((200 * sum({a}) + sum(total)) // (2 * sum(total)) as double) / 100 end"
_METRICS = f"""select h.sec_domain_id, h.sec_domain_source, h.online_status, h.google_search_results, h.exc_domain_id, h.class_id, round(avg(ts.dpr), 2) as direct_plus_referrals,
 {_RATIO('inf')} as share_infringing, {_RATIO('cust')} as share_customer, {_RATIO('adult')} as share_adult, cast(sum(total) as bigint) as total_referral_traffic, coalesce(max(sites.n), 0) as inf_referring_sites
 from ({_UNION}) cl left join (select rt.d_sec_domain_id as id, count(distinct r_domain_id) as n {_BASE} join domain_attributes da on rt.r_domain_id = da.domain_id {_WHERE} and {_INF.format('1, 3, 4, 5')} group by 1) sites on sites.id = cl.id join (select distinct sec_domain_id, direct_share + referrals_share as dpr from traffic_sources) ts on cl.id = ts.sec_domain_id join hub h on cl.id = h.sec_domain_id
 where h.class_id not in (1) or h.class_id is null group by 1, 2, 3, 4, 5, 6"""


def metrics(s: SparkSession, d: str, facts: str = "referral_traffic", monthly: DataFrame | None = None) -> DataFrame:
    v = {n: load(s, d, n) for n in _REF_VIEWS}
    return referrals.referral_metrics(monthly or referrals.rollup(load(s, d, facts)), v["hub"], v["domain_attributes"], v["tenants_domain"], v["tenants"], v["ad_domains"], v["traffic_sources"])


query("referral_metrics", _REF_VIEWS, _METRICS)(metrics)


@query("referral_metrics_spellings", [*_REF_VIEWS, "referral_spellings"], _METRICS.replace("referral_traffic r ", "referral_spellings r ").replace("referral_traffic rt ", "referral_spellings rt ").replace("from referral_traffic)", "from referral_spellings)"))
def _(s, d):
    """As referral_metrics, where a third of the domains have two spellings of their destination, with other referrers."""
    return metrics(s, d, "referral_spellings")


@query("destination_traffic", ["hub", "referral_traffic"], f"select rt.d_sec_domain_id, rt.destination_domain, cast(sum(referred_visits) as bigint) as visits, min(month) as first_seen, max(month) as last_seen from referral_traffic rt {_WHERE} group by 1, 2")
def _(s, d):
    return referrals.destination_traffic(referrals.monthly(load(s, d, "referral_traffic")))


_CANDIDATES = """select h.sec_domain_id, sec_domain_source, online_status, google_search_results, exc_domain_id, class_id, tsa.dpr, null, null, null, ra.total, null from hub h
 left join (select d_sec_domain_id as id, cast(sum(referred_visits) as bigint) as total from referral_traffic where step_in_process = 2 and d_exc_domain_id is null and d_domain_id is null group by 1) ra on ra.id = h.sec_domain_id
 left join (select sec_domain_id as id, max(direct_share + referrals_share) as dpr from traffic_sources group by 1) tsa on tsa.id = h.sec_domain_id
 where (sec_domain_source in ('SimilarWeb', 'Ad Sniffer') or decision_source = 'SimilarWeb') and class_id in (2, 3) and (first_reported >= date '2026-04-01' or first_reported is null) and (coalesce(ra.total, 0) = 0 or coalesce(tsa.dpr, 0) = 0)"""
_BOTH = f"select * from ({_METRICS}) m union all select * from ({_CANDIDATES}) c where c.sec_domain_id not in (select sec_domain_id from ({_METRICS}) k)"


@query("traffic_candidates", _REF_VIEWS, _BOTH)
def _(s, d):
    """The set that traffic_class_v2 classifies."""
    return traffic_candidates(s, d)


def traffic_candidates(s: SparkSession, d: str) -> DataFrame:
    m = referrals.rollup(load(s, d, "referral_traffic"))
    return referrals.candidates(metrics(s, d, monthly=m), referrals.without_referrals(load(s, d, "hub"), m, load(s, d, "traffic_sources")))


@query("valid_destinations", ["hub", "referral_traffic", "ad_domains"], _VALID)
def _(s, d):
    return referrals.valid_destinations(referrals.monthly(load(s, d, "referral_traffic")), load(s, d, "ad_domains"))


_STRONG = "coalesce(share_infringing > 0.5 and share_customer > 0.2 and direct_plus_referrals > 0.6, false)"
_OFF = "online_status in (" + ", ".join(f"'{x}'" for x in rules.OFFLINE) + ")"


def _ladder(two: str, special: str) -> str:
    return f"""cast(case when exc_domain_id is not null then 4 {special} when google_search_results is not null then case when google_search_results < 2 then {two}
   when {_STRONG} then case when online_status = 'Online' then case when google_search_results < 10 then {two} when google_search_results < 50 then 3 else 4 end when {_OFF} then {two} end
   when {_OFF} then 0 end
  when {_STRONG} then case when online_status = 'Online' then 3 when {_OFF} then {two} end when {_OFF} then 0 end as int)"""


@query("traffic_class_v1", _REF_VIEWS, f"select sec_domain_id, {_ladder('2', '')} as class_id from ({_METRICS}) m")
def _(s, d):
    return metrics(s, d).select("sec_domain_id", rules.traffic_class(F.col, 1).alias("class_id"))


_FACTS = "(select h.sec_domain_id as fid, direct_share, referrals_share, organic_share, display_share, t.visits from hub h left join traffic_sources f on f.sec_domain_id = h.sec_domain_id left join (select sec_domain_id, sum(traffic) as visits from dim_traffic where domain_country = 'World' group by 1) t on h.sec_domain_id = t.sec_domain_id) g"
_FP = "case when coalesce(visits > 10000000, false) then 1 when coalesce(organic_share >= 0.40, false) then 2 when coalesce(direct_share <= 0.60 and referrals_share <= 0.25 and display_share <= 0.10, false) then 3 when coalesce(direct_share <= 0.60 and referrals_share <= 0.25 and organic_share >= 0.30, false) then 4 end"
_SPECIAL = "not coalesce(total_referral_traffic > 0 and direct_plus_referrals > 0, false)"


@query("traffic_class_v2", _REF_VIEWS + ["dim_traffic"], f"""select sec_domain_id, c as class_id, cast(fp as int) as fp_reason,
 case when c = 2 then case when sp then 'MEDIUM' else 'HIGH' end when c = 3 then case when sp then 'LOW' else 'MEDIUM' end end as confidence,
 cast(case when c = 2 then case when sp then 2 else 1 end when c = 3 then case when sp then 5 else 2 end end as int) as recommended_action_id,
 cast(case when c = 2 then case when sp then 2 else 1 end when c = 3 then case when sp then 3 else 4 end end as int) as justification,
 case when sp and c in (2, 3) then 'Ad Sniffer' else 'SimilarWeb' end as decision_source
 from (select *, {_ladder('case when fp is null then 2 end', 'when sp and class_id in (2, 3) then class_id')} as c from (select m.*, {_FP} as fp, {_SPECIAL} as sp from ({_BOTH}) m left join {_FACTS} on g.fid = m.sec_domain_id) y) z where c is not null""")
def _(s, d):
    visits = load(s, d, "dim_traffic").filter("domain_country = 'World'").groupBy("sec_domain_id").agg(F.sum("traffic").alias("visits"))
    m = traffic_candidates(s, d).join(load(s, d, "traffic_sources"), "sec_domain_id", "left").join(visits, "sec_domain_id", "left")
    m = m.withColumn("fp_reason", rules.fp_reason(F.col("visits"), F.col("organic_share"), F.col("direct_share"), F.col("referrals_share"), F.col("display_share")))
    m = m.select("sec_domain_id", rules.traffic_class(F.col, 2, F.col("fp_reason")).alias("class_id"), "fp_reason", rules.special_case(F.col).alias("sp")).filter("class_id IS NOT NULL")
    return m.withColumns(rules.traffic_attributes(F.col("class_id"), F.col("sp"))).drop("sp")


@query("high_traffic", ["dim_traffic"], "select sec_domain_id, month, traffic, coalesce(traffic > 1500000, false) as high_traffic from dim_traffic t where domain_country = 'World' and month = (select max(month) from dim_traffic u where u.sec_domain_id = t.sec_domain_id and domain_country = 'World')")
def _(s, d):
    t = rel.latest_ties(load(s, d, "dim_traffic").filter("domain_country = 'World'"), "sec_domain_id", "month")
    return t.select("sec_domain_id", "month", "traffic", F.coalesce(F.col("traffic") > 1_500_000, F.lit(False)).alias("high_traffic"))


_SECS = """case when avg_visit_duration is null or avg_visit_duration = 'missing' then null when strpos(avg_visit_duration, ':') = 0 then cast(floor(try_cast(avg_visit_duration as double)) as int)
 when len(string_split(avg_visit_duration, ':')) = 2 then case when p2 >= 60 then p1 * 3600 + p2 * 60 else p1 * 60 + p2 end else p1 * 3600 + p2 * 60 + p3 end"""
_PARTS = "select *, try_cast(string_split(avg_visit_duration, ':')[1] as int) as p1, try_cast(string_split(avg_visit_duration, ':')[2] as int) as p2, try_cast(string_split(avg_visit_duration, ':')[3] as int) as p3 from engagement"


def _engaged_sql(cond: str) -> str:
    return f"select sec_domain_id, month, cast({_SECS} as int) as seconds, coalesce(bounce_rate >= 0.65 and pages_per_visit <= 3 and {_SECS} <= 180, false) as mfa_engagement from (select *, row_number() over (partition by sec_domain_id order by month desc nulls first, fact_id desc) as rn from ({_PARTS}) p where {cond}) x where rn = 1"


def _engaged(s, d, cond):
    e = rel.latest(load(s, d, "engagement").filter(cond), ["sec_domain_id"], [F.desc_nulls_first("month"), F.desc("fact_id")])
    e = e.withColumn("seconds", tx.duration_seconds(F.col("avg_visit_duration")))
    return e.select("sec_domain_id", "month", "seconds", rules.mfa_engaged(F.col("bounce_rate"), F.col("pages_per_visit"), F.col("seconds")).alias("mfa_engagement"))


_SOME, _NONE = "avg_visit_duration is not null and avg_visit_duration <> '0'", "avg_visit_duration is null or avg_visit_duration = '0'"


@query("mfa_engagement", ["engagement"], _engaged_sql(_SOME))
def _(s, d):
    return _engaged(s, d, _SOME)


@query("mfa_zero_duration", ["engagement"], _engaged_sql(_NONE))
def _(s, d):
    return _engaged(s, d, _NONE)


@query("ad_density", ["ad_slots"], "select sec_domain_id, coalesce(case when html_length = 0 then ad_count > 0 else 1000 * ad_count > 15 * html_length end, false) as ad_density from ad_slots where html_length is not null")
def _(s, d):
    a = load(s, d, "ad_slots").filter("html_length IS NOT NULL")
    return a.select("sec_domain_id", rules.ad_dense(F.col("ad_count"), F.col("html_length")).alias("ad_density"))


_MAP = "case graymarket_label " + " ".join(f"when '{k}' then {v}" for k, v in rules.LABEL_CLASS.items()) + " end"


@query("decision_tree", ["tree"], f"""select sec_domain_id, cast(case when ssl_poor and not coalesce(high_traffic, false) and graymarket_label = 'undeterminated' and coalesce(html_length, 0) < 1000 then 2
 when (coalesce(high_traffic, false) and is_ecommerce) or (coalesce(mfa_engagement, false) and (is_ecommerce or has_affiliate_handoff)) then case when graymarket_label <> 'undeterminated' then {_MAP} else 4 end
 when ad_density and tld_poor and html_length > 2000 then 3 when graymarket_label is not null then {_MAP} else 9 end as int) as class_id from tree""")
def _(s, d):
    return load(s, d, "tree").select("sec_domain_id", rules.decision_tree(F.col).alias("class_id"))


@query("confidence_matrix", ["hub"], """select h.sec_domain_id, m.confidence, m.recommended_action_id, m.justification from hub h join (values ('SimilarWeb', 2, 'HIGH', 1, 1), ('SimilarWeb', 3, 'MEDIUM', 2, 4), ('Ad Sniffer', 2, 'MEDIUM', 2, 2), ('Ad Sniffer', 3, 'LOW', 5, 3)) m(src, cls, confidence, recommended_action_id, justification) on h.sec_domain_source = m.src and h.class_id = m.cls where publication_status = 0""")
def _(s, d):
    h = load(s, d, "hub").filter(rel.WORK_LISTS["WL-21"])
    return h.withColumns(rules.confidence(F.col("sec_domain_source"), F.col("class_id"))).filter("confidence IS NOT NULL").select("sec_domain_id", "confidence", "recommended_action_id", "justification")


_SSL = """case when coalesce(validation_type, '') = '' and coalesce(issuer, '') = '' then 7 else case when validation_type = 'domain' then 3 else 0 end + case when lower(issuer) like '%let''s encrypt%' or lower(issuer) like '%google%' then 2 else 0 end + {} + case when policies like '%2.23.140.1.2.1%' then 2 else 0 end + case when dns_names like '%*%' then 1 else 0 end end"""
_SSL_FULL = _SSL.format("case when floor((epoch(valid_to) - epoch(valid_from)) / 86400) <= 90 then 2 else 0 end + case when (key_type = 'RSA' and key_bits < 2048) or (key_type = 'ECDSA' and key_bits < 256) then 2 else 0 end")
_SSL_REF = _SSL.format("case when key_type in ('RSA', 'ECDSA') then 2 else 0 end")


@query("ssl_scores", ["certificates"], f"select cert_id, cast(f as int) as tenths, cast(r as int) as tenths_as_reference, f >= 7 as ssl_poor, cast(greatest(0, least(10, 10 - f)) as double) / 10 as trust from (select cert_id, {_SSL_FULL} as f, {_SSL_REF} as r from certificates) x")
def _(s, d):
    c = load(s, d, "certificates").withColumns({"tenths": rules.ssl_tenths(F.col), "tenths_as_reference": rules.ssl_tenths(F.col, "as_reference")})
    return c.select("cert_id", "tenths", "tenths_as_reference", (F.col("tenths") >= 7).alias("ssl_poor"), (F.greatest(F.lit(0), F.least(F.lit(10), 10 - F.col("tenths"))).cast("double") / 10).alias("trust"))


_BADADS = "select distinct h.sec_domain_id from hub h join ad_chain_urls u on u.domain_id = h.domain_id join ad_url_features f on f.ad_url = u.ad_url where h.class_id = 3 and h.publication_status = 0 and (coalesce(f.ad_rendering, false) = false or coalesce(f.ad_creative, false) = false)"


@query("ad_chain_reset", ["hub", "ad_chain_urls", "ad_url_features"], f"select h.sec_domain_id, case when b.sec_domain_id is null then h.class_id end as class_id from hub h left join ({_BADADS}) b on h.sec_domain_id = b.sec_domain_id")
def _(s, d):
    h = load(s, d, "hub")
    bad = rel.without_valid_ads(h, load(s, d, "ad_chain_urls"), load(s, d, "ad_url_features")).withColumn("class_id", F.lit(None).cast("int"))
    return rel.keyed_update(h.select("sec_domain_id", "class_id"), bad, "sec_domain_id", ["class_id"])


@query("mfa_without_ads", ["hub"], "select sec_domain_id, case when hit then null else class_id end as class_id, case when hit then 'mfa_no_ads' end as decision_source from (select *, coalesce(coalesce(ad_count, 0) = 0 and class_id = 3, false) as hit from hub) x")
def _(s, d):
    hit = rules.yes((F.coalesce("ad_count", F.lit(0)) == 0) & (F.col("class_id") == 3))
    return load(s, d, "hub").select("sec_domain_id", F.when(~hit, F.col("class_id")).alias("class_id"), F.when(hit, "mfa_no_ads").alias("decision_source"))


@query("final_overrides", ["hub"], """select sec_domain_id, cast(case when hit then 9 else c2 end as int) as class_id, case when hit then 'sql script' end as decision_source from (select *, coalesce(coalesce(ad_count, 0) = 0 and c2 = 3, false) as hit from
 (select *, case when media_type_id = 5 and c1 <> 10 then 10 else c1 end as c2 from (select *, case when media_type_id = 17 and (class_id is null or class_id = 9) then 11 else class_id end as c1 from hub) a) b) c""")
def _(s, d):
    return rules.final_overrides(load(s, d, "hub")).select("sec_domain_id", F.col("c").cast("int").alias("class_id"), F.col("source").alias("decision_source"))


@query("responses_without_repeats", ["response_log"], "select site, seq, url, status from (select *, lag(url) over (partition by site order by seq) as prev, row_number() over (partition by site order by seq) as rn from response_log) x where rn > 1 and url is distinct from prev")
def _(s, d):
    return rel.without_repeats(load(s, d, "response_log"))


@query("latest_snapshot", ["snapshots"], "select sec_domain_id, html_id, url from (select *, row_number() over (partition by sec_domain_id order by html_id desc) as rn from snapshots) x where rn = 1")
def _(s, d):
    return rel.latest(load(s, d, "snapshots").select("sec_domain_id", "html_id", "url"), ["sec_domain_id"], [F.desc("html_id")])


@query("missing_certificates", ["hub"], "select sec_domain_id, regexp_replace(sec_domain_root, '^www\\.', '') as d from hub h where sec_domain_root is not null and not exists (select 1 from hub k where k.sec_domain_id % 3 = 0 and k.sec_domain = h.sec_domain_root)")
def _(s, d):
    h = load(s, d, "hub")
    known = h.filter("sec_domain_id % 3 = 0").select(F.concat(F.lit("https://www."), F.col("sec_domain"), F.lit("/x")).alias("domain"))
    return rel.missing(h, known)


@query("newest_software", ["hub"], "select sec_domain_id, sec_domain from hub where media_type_id = 7 and (class_id is null or class_id = 9) order by sec_domain_id desc limit 1000")
def _(s, d):
    """A report of the newest 1000: the limit is the feature."""
    return load(s, d, "hub").filter(rel.WORK_LISTS["WL-20"]).select("sec_domain_id", "sec_domain").orderBy(F.desc("sec_domain_id")).limit(1000)


@query("keyed_updates", ["hub", "traffic_sources"], "select h.sec_domain_id, case when t.sec_domain_id is not null then cast(round(t.direct_share * 100) as int) else h.html_length end as html_length, coalesce(case when t.organic_share > 0.3 then 5 end, h.class_id) as class_id from hub h left join traffic_sources t on h.sec_domain_id = t.sec_domain_id")
def _(s, d):
    up = load(s, d, "traffic_sources").select("sec_domain_id", F.round(F.col("direct_share") * 100).cast("int").alias("html_length"), F.when(F.col("organic_share") > 0.3, 5).alias("class_id"))
    return rel.keyed_update(load(s, d, "hub").select("sec_domain_id", "html_length", "class_id"), up, "sec_domain_id", ["html_length", "class_id"], keep_old=["class_id"])


_HOST = "rtrim(lower(regexp_replace(regexp_extract(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^[^/?#]*'), ':[0-9]*$', '')), '.')"


@query("url_parts", ["snapshots"], f"""select html_id, host, regexp_replace(host, '^www\\.', '') as canonical, split_part(host, '.', -1) as tld, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as registered,
 split_part(host, '.', -1) in ({', '.join(f"'{t}'" for t in rules_tlds)}) as tld_poor from (select html_id, {_HOST} as host from snapshots) x""" if (rules_tlds := tx.LOW_COST_TLDS) else "")
def _(s, d):
    u = load(s, d, "snapshots").select("html_id", tx.url_host(F.col("url")).alias("host"))
    return u.select("html_id", "host", tx.canonical_domain(F.col("host")).alias("canonical"), tx.tld(F.col("host")).alias("tld"), tx.registered_domain(F.col("host")).alias("registered"), tx.tld_poor(F.col("host")).alias("tld_poor"))


@query("high_risk_geo", ["asn_lookup"], "select domain_id, not coalesce(ok, false) or coalesce(country in ('RU', 'UA', 'CN', 'MD', 'RO', 'BG', 'BZ', 'PA', 'SC'), false) as is_high_risk_geo from asn_lookup")
def _(s, d):
    return load(s, d, "asn_lookup").select("domain_id", rules.high_risk_geo(F.col("country"), F.col("ok")).alias("is_high_risk_geo"))


@query("status_tally", ["hub"], "select sec_domain_source, online_status, count(*) as n, count(distinct class_id) as n_classes, cast(count_if(class_id is null) as bigint) as n_open from hub group by 1, 2")
def _(s, d):
    return load(s, d, "hub").groupBy("sec_domain_source", "online_status").agg(F.count("*").alias("n"), F.count_distinct("class_id").alias("n_classes"), F.count_if(F.col("class_id").isNull()).alias("n_open"))


@query("traffic_summary", ["dim_traffic", "traffic_sources"], "select s.sec_domain_id, cast(coalesce(sum(traffic), 0) as bigint) as visits, round(max(direct_share + referrals_share), 2) as dpr from traffic_sources s left join dim_traffic t on t.sec_domain_id = s.sec_domain_id and t.domain_country = 'World' group by 1")
def _(s, d):
    t = load(s, d, "dim_traffic").filter("domain_country = 'World'").drop("domain_country")
    x = load(s, d, "traffic_sources").join(t, "sec_domain_id", "left")
    return x.groupBy("sec_domain_id").agg(F.coalesce(F.sum("traffic"), F.lit(0)).alias("visits"), F.round(F.max(F.col("direct_share") + F.col("referrals_share")), 2).alias("dpr"))


_T = "trim(regexp_extract(html_content, '(?i)<title[^>]*>([^<]+)</title>', 1))"
_H = "list_slice(list_transform(regexp_extract_all(html_content, '(?i)<h[1-3][^>]*>([^<]+)</h[1-3]>', 1), lambda h: trim(h)), 1, 10)"


@query("semantic_content", ["snapshots"], f"select html_id, {_T} as title, array_to_string({_H}, ' | ') as headings, cast(len({_H}) as int) as n_headings from snapshots")
def _(s, d):
    h = F.col("html_content")
    return load(s, d, "snapshots").select("html_id", pages.title(h).alias("title"), F.array_join(pages.headings(h), " | ").alias("headings"), F.size(pages.headings(h)).alias("n_headings"))


def _meta_sql(name: str) -> str:
    return f"""trim(regexp_extract(html_content, '(?i)<meta[^>]*name=["'']{name}["''][^>]*content=["'']([^"''>]+)["'']', 1))"""


_DESC = f"""coalesce(nullif({_meta_sql('description')}, ''), trim(regexp_extract(html_content, '(?i)<meta[^>]*content=["'']([^"''>]+)["''][^>]*name=["'']description["'']', 1)))"""
#: Unicode white space, which RE2's \\s isn't.
_S = "[\\x09-\\x0D\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
_BODY = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html_content, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[\\x{10000}-\\x{10FFFF}]', '', 'g'), '{_S}+', ' ', 'g'))".replace("{_S}", _S)
_LABEL = lambda name, c: f"case when {c} <> '' then '{name}: ' || {c} end"
_HEAD = f"concat_ws(chr(10), {_LABEL('TITLE', _T)}, {_LABEL('DESC', _DESC)}, {_LABEL('KEYWORDS', _meta_sql('keywords'))}, {_LABEL('HEADINGS', f'array_to_string({_H}, {chr(39)} | {chr(39)})')})"
_TEXT = f"select html_id, html_content, case when length(t) > 80000 then left(t, 80000) || '... [TRUNCATED]' else nullif(t, '') end as text from (select html_id, html_content, concat_ws(chr(10) || chr(10), nullif({_HEAD}, ''), case when {_BODY} <> '' then 'CONTENT: ' || {_BODY} end) as t from snapshots) x"
_HIT = lambda patterns: "(coalesce(regexp_matches(lower(text), '{0}'), false) or coalesce(regexp_matches(lower(left(html_content, 200000)), '{0}'), false))".format("|".join(patterns))
_SHORT = f"(text is null or len(list_filter(regexp_split_to_array(text, '{_S}+'), lambda w: w <> '')) < 4)"


@query("page_text", ["snapshots"], f"select html_id, text, {_SHORT} as too_short, {_HIT(pages.PARKED)} as parked, {_HIT(pages.BLOCKED_FLAG)} as blocked from ({_TEXT}) y")
def _(s, d):
    h = F.col("html_content")
    x = load(s, d, "snapshots").select("html_id", pages.prepared_text(h).alias("text"), h.alias("html"))
    t = F.col("text")
    return x.select("html_id", t, pages.too_short(t).alias("too_short"), pages.matches_any(pages.PARKED, t, F.col("html")).alias("parked"), pages.matches_any(pages.BLOCKED_FLAG, t, F.col("html")).alias("blocked"))


@query("media_type_gate", ["snapshots"], f"select html_id, case when g then 17 else 12 end as class, not g as called from (select html_id, coalesce(len(string_split(text, ' ')), 0) < 4 as g from ({_TEXT}) y) z")
def _(s, d):
    return scorers.score(load(s, d, "snapshots"), "html_id", "html_content", "media_type")


@query("software_subtype", ["snapshots"], f"select html_id, 9 as class, not ({_SHORT} or {_HIT(pages.PARKED)} or {_HIT(pages.BLOCKED)}) as called from ({_TEXT}) y")
def _(s, d):
    return scorers.score(load(s, d, "snapshots"), "html_id", "html_content", "software")


@query("enforcement", ["snapshots"], f"select html_id, 0 as class, not ({_SHORT} or {_HIT(pages.PARKED)}) as called from ({_TEXT.replace('80000', '120000')}) y")
def _(s, d):
    x = load(s, d, "snapshots").select("html_id", F.col("html_content").alias("html"), F.lit("Other").alias("media_type"), F.lit(False).alias("brand_known"), F.lit(0.3).alias("ssl_score"), *[pages.policy_flags(F.col("html_content"))[k].alias(k) for k in ("privacy", "terms")])
    return scorers.enforcement(x, "html_id")


@query("page_text_long", ["snapshots"], f"select html_id, text from ({_TEXT.replace('80000', '120000')}) y")
def _(s, d):
    """As page_text, with the longer cut that enforcement reads."""
    return load(s, d, "snapshots").select("html_id", pages.prepared_text(F.col("html_content"), 120_000).alias("text"))


@query("serp_hosts", ["hub"], "select sec_domain as domain, case when sec_domain_id % 5 = 4 then cast(0 as bigint) else cast(2 as bigint) end as n_urls, case when sec_domain_id % 5 = 4 then cast(0 as bigint) else cast(2 as bigint) end as n_hosts from hub")
def _(s, d):
    """Landed payloads are built from the hub: two result pages, two hosts of the domain and another; every fifth is broken."""
    url = lambda p: F.struct(F.concat(F.lit(p), F.col("sec_domain"), F.lit("/x")).alias("url"))
    page = lambda *u: F.struct(F.struct(F.struct(F.array(*u).alias("organic")).alias("results")).alias("content"))
    good = F.to_json(F.struct(F.array(page(url("https://a."), F.struct(F.lit("https://other.example/").alias("url"))), page(url("http://b."))).alias("results")))
    return files.serp_hosts(load(s, d, "hub").select(F.col("sec_domain").alias("domain"), F.when(F.col("sec_domain_id") % 5 == 4, "{broken").otherwise(good).alias("payload")))


_CERTS = """select 'c' || cast(cert_id as string) as requested_domain, '1.2.3.4' as ip, 443 as port, timestamp '2025-01-02 03:04:05' as audit_created, 'leaf' as chain_hierarchy, validation_type, valid_from, valid_to,
 cast(cert_id as string) as serial_number, 'SHA256' as signature_algorithm, 'a.com' as subject_common_name, 'US' as issuer_country, issuer as issuer_organization, 'CA' as issuer_common_name, 'ab' as authority_key_identifier, 'cd' as subject_key_identifier,
 '["sign"]' as key_usage, '' as extended_key_usage, '' as crl_distribution_points, '["http://i"]' as aia_issuers, '' as aia_ocsp, '["' || dns_names || '"]' as dns_names, '["' || policies || '"]' as certificate_policies, key_type as public_key_type, key_bits as public_key_bits
 from certificates where cert_id % 4 < 2"""
_NO_EXT = ", ".join(f"null as {c}" for c in ("authority_key_identifier", "subject_key_identifier", "key_usage", "extended_key_usage", "crl_distribution_points", "aia_issuers", "aia_ocsp", "dns_names", "certificate_policies"))


@query("certificate_rows", ["certificates"], f"""{_CERTS} union all select 'c' || cast(cert_id as string), '1.2.3.4', 443, timestamp '2025-01-02 03:04:05', 'leaf', validation_type, valid_from, valid_to, cast(cert_id as string), 'SHA256', 'a.com', 'US', issuer, 'CA', {_NO_EXT}, key_type, key_bits from certificates where cert_id % 4 = 2
 union all select 'c' || cast(cert_id as string), {', '.join(['null'] * 24)} from certificates where cert_id % 4 = 3""")
def _(s, d):
    """Landed payloads are built from the view: with extensions, without them, and without certificates."""
    k, lit = F.col("cert_id"), F.lit
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    base = [
        lit("leaf").alias("chainHierarchy"), F.col("validation_type").alias("validationType"), stamp("valid_from").alias("validFrom"), stamp("valid_to").alias("validTo"), k.cast("string").alias("serialNumber"), lit("SHA256").alias("signatureAlgorithm"),
        F.struct(lit("a.com").alias("commonName")).alias("subject"), F.struct(lit("US").alias("country"), F.col("issuer").alias("organization"), lit("CA").alias("commonName")).alias("issuer"),
        F.struct(F.col("key_type").alias("type"), F.col("key_bits").alias("bits")).alias("publicKey"),
    ]
    ext = F.struct(
        lit("ab").alias("authorityKeyIdentifier"), lit("cd").alias("subjectKeyIdentifier"), F.array(lit("sign")).alias("keyUsage"), F.struct(F.array(lit("http://i")).alias("issuers")).alias("authorityInfoAccess"),
        F.struct(F.array("dns_names").alias("dnsNames")).alias("subjectAlternativeNames"), F.array("policies").alias("certificatePolicies"),
    ).alias("extensions")
    payload = lambda cert: F.to_json(F.struct(lit("1.2.3.4").alias("ip"), lit(443).alias("port"), lit("2025-01-02T03:04:05Z").alias("auditCreated"), F.array(cert).alias("certificates")))
    p = F.when(k % 4 == 3, '{"certificates": []}').when(k % 4 == 2, payload(F.struct(*base))).otherwise(payload(F.struct(*base, ext)))
    return files.certificates(load(s, d, "certificates").select(F.concat(lit("c"), "cert_id").alias("domain"), p.alias("payload")))



def flagship(s: SparkSession, d: str) -> DataFrame:
    return _queries["traffic_class_v2"](s, d)
