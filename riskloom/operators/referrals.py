"""Referral traffic metrics per secondary domain, in one pass over the monthly facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import shared_folder

APPROVED_AD_COMPANIES = [4375, 4527]


def monthly(rt: DataFrame) -> DataFrame:
    """The facts by domain, destination, referrer and month: (…, visits, own, counted).

    own tells whether a row of the group is of neither an excluded nor a known domain; counted whether one of these was seen in step 2, whose
    visits are summed. All that is asked of the facts can be asked of this. A busy domain is summed before the shuffle.
    """
    own = F.col("d_exc_domain_id").isNull() & F.col("d_domain_id").isNull()
    counted = own & F.coalesce(F.col("step_in_process") == 2, F.lit(False))
    return rt.groupBy("d_sec_domain_id", "destination_domain", "r_domain_id", "month").agg(F.sum(F.when(counted, F.col("referred_visits"))).alias("visits"), F.bool_or(own).alias("own"), F.bool_or(counted).alias("counted"))


def rollup(rt: DataFrame) -> DataFrame:
    """monthly, written once below the shared folder and read back, for plans that ask several things of it.

    So the facts are scanned, joined and shuffled once, and each question reads the columns that it needs of the groups.
    """
    m = monthly(rt)
    path = shared_folder(rt.sparkSession, "referrals")
    m.write.parquet(path)
    return rt.sparkSession.read.schema(m.schema).parquet(path)


def start_month(m: DataFrame) -> DataFrame:
    """One row: the first month of the window that ends with the latest month."""
    return m.agg(F.trunc(F.add_months(F.max("month"), -5), "month").alias("start_month"))


def facts_of(m: DataFrame) -> DataFrame:
    """Counted months within the window."""
    return m.filter("counted AND own").filter(F.col("month") >= start_month(m).scalar())


def valid_destinations(m: DataFrame, ad_domains: DataFrame) -> DataFrame:
    """Distinct (d_sec_domain_id, destination_domain) not owned by an ad company, unless that one is approved.

    EXISTS and NOT EXISTS on the same key become one left join to a pre-aggregated list.
    """
    ads = ad_domains.groupBy(F.lower("ad_company_domain").alias("ad")).agg(F.bool_or(F.col("ad_company_id").isin(APPROVED_AD_COMPANIES)).alias("approved"))
    own = m.filter("own").select("d_sec_domain_id", "destination_domain").distinct()
    return own.join(ads, F.lower("destination_domain") == F.col("ad"), "left").filter(F.col("ad").isNull() | F.col("approved")).select("d_sec_domain_id", "destination_domain")


def infringing(analyst: Column, ml: Column, ml_classes: list[int]) -> Column:
    return F.coalesce(analyst.isin(1, 16) | (analyst.isNull() & ml.isin(ml_classes)), F.lit(False))


def ratio2(a: str, b: str) -> Column:
    """a / b to two places, half up, exactly; null where b is null or 0."""
    return F.expr(f"CASE WHEN {b} > 0 THEN cast((200 * {a} + {b}) div (2 * {b}) as double) / 100 END")


def referral_metrics(m: DataFrame, hub: DataFrame, attributes: DataFrame, tenants_domain: DataFrame, tenants: DataFrame, ad_domains: DataFrame, traffic_sources: DataFrame) -> DataFrame:
    """Shares of infringing, customer and adult referrals of each domain that isn't classed as piracy, from the monthly facts.

    The four branches of a union over the same facts become conditional sums of one scan. What the
    branches' joins would multiply is kept as weights: the valid spellings of a destination and the
    active tenants of a referrer. Referrer and tenant lists join by key; AQE broadcasts them when small.
    """
    weights = valid_destinations(m, ad_domains).groupBy("d_sec_domain_id").agg(F.count("*").alias("n_valid"))
    target = hub.filter(F.col("sec_domain_source").isin("SimilarWeb", "Ad Sniffer")).select(F.col("sec_domain_id").alias("d_sec_domain_id")).distinct()
    active = tenants_domain.join(tenants.filter("customer_active"), "tenant_id").groupBy("domain_id").agg(F.count("*").alias("n_tenants"))
    refs = attributes.join(active, "domain_id", "left").select(
        F.col("domain_id").alias("r_domain_id"),
        infringing(F.col("analyst_class"), F.col("ml_class"), [1, 3, 4, 5]).alias("inf"),
        F.when(infringing(F.col("analyst_class"), F.col("ml_class"), [1, 4, 5]), F.coalesce("n_tenants", F.lit(0))).otherwise(0).alias("tenants"),
        F.lit(True).alias("known"),
    )
    facts = facts_of(m).join(target, "d_sec_domain_id", "left_semi").join(weights, "d_sec_domain_id").join(refs, "r_domain_id", "left")
    v = F.col("visits") * F.col("n_valid")
    sums = facts.groupBy("d_sec_domain_id").agg(
        F.sum(v).alias("total"),
        F.sum(F.when(F.col("inf"), v).otherwise(0)).alias("infringing"),
        F.sum(v * F.coalesce("tenants", F.lit(0))).alias("customer"),
        F.sum(F.when(F.col("known"), v).otherwise(0)).alias("adult"),
        F.count_distinct(F.when(F.col("inf"), F.col("r_domain_id"))).alias("inf_referring_sites"),  # of the domain, however many spellings and shares it has
    )
    shares = traffic_sources.select(F.col("sec_domain_id"), (F.col("direct_share") + F.col("referrals_share")).alias("dpr")).distinct().groupBy("sec_domain_id").agg(F.round(F.avg("dpr"), 2).alias("direct_plus_referrals"), F.count("*").alias("n_shares"))
    x = sums.withColumnRenamed("d_sec_domain_id", "sec_domain_id").join(shares, "sec_domain_id").join(hub.filter("class_id <> 1 OR class_id IS NULL"), "sec_domain_id")
    return x.select(
        "sec_domain_id", "sec_domain_source", "online_status", "google_search_results", "exc_domain_id", "class_id", "direct_plus_referrals",
        ratio2("infringing", "total").alias("share_infringing"), ratio2("customer", "total").alias("share_customer"), ratio2("adult", "total").alias("share_adult"),
        (F.col("total") * F.col("n_shares")).alias("total_referral_traffic"), "inf_referring_sites",
    )


#: log2 of the registers of a sketch: 4096, a standard error of 1.6 %.
SKETCH = 12


def referrer_sketches(m: DataFrame, attributes: DataFrame) -> DataFrame:
    """(sec_domain_id, month, referrers): a sketch of the infringing referrers that a domain's counted visits of a month came from.

    Sketches of a month are made once, when its facts have landed; windows merge them and read no facts. Some 4 kB for each domain and month at most.
    """
    inf = attributes.filter(infringing(F.col("analyst_class"), F.col("ml_class"), [1, 3, 4, 5])).select(F.col("domain_id").alias("r_domain_id"))
    x = m.filter("counted AND own").join(inf, "r_domain_id", "left_semi")
    return x.groupBy(F.col("d_sec_domain_id").alias("sec_domain_id"), "month").agg(F.hll_sketch_agg("r_domain_id", SKETCH).alias("referrers"))


def referring_sites(sketches: DataFrame, first: Column, last: Column) -> DataFrame:
    """(sec_domain_id, referring_sites): about how many distinct referrers the months from first to last have, from their sketches."""
    x = sketches.filter(F.col("month").between(first, last))
    return x.groupBy("sec_domain_id").agg(F.hll_sketch_estimate(F.hll_union_agg("referrers")).alias("referring_sites"))


def destination_traffic(m: DataFrame) -> DataFrame:
    """Visits and the months that they were first and last seen in, by domain and destination, the largest first."""
    x = facts_of(m).groupBy("d_sec_domain_id", "destination_domain").agg(F.sum("visits").alias("visits"), F.min("month").alias("first_seen"), F.max("month").alias("last_seen"))
    return x.orderBy(F.desc_nulls_first("visits"), "d_sec_domain_id", "destination_domain")


def without_referrals(hub: DataFrame, m: DataFrame, traffic_sources: DataFrame, since: str = "2026-04-01") -> DataFrame:
    """Rows shaped like referral_metrics for classed domains (2 or 3) that have no referred visits or no direct and referral share."""
    visits = m.filter("counted AND own").groupBy(F.col("d_sec_domain_id").alias("sec_domain_id")).agg(F.sum("visits").alias("total_referral_traffic"))
    shares = traffic_sources.filter("sec_domain_id IS NOT NULL").groupBy("sec_domain_id").agg(F.max(F.col("direct_share") + F.col("referrals_share")).alias("direct_plus_referrals"))
    h = hub.filter("(sec_domain_source IN ('SimilarWeb', 'Ad Sniffer') OR decision_source = 'SimilarWeb') AND class_id IN (2, 3)")
    h = h.filter(f"first_reported >= DATE '{since}' OR first_reported IS NULL")
    x = h.join(visits, "sec_domain_id", "left").join(shares, "sec_domain_id", "left")
    x = x.filter("coalesce(total_referral_traffic, 0) = 0 OR coalesce(direct_plus_referrals, 0) = 0")
    none = [F.lit(None).cast("double").alias(c) for c in ("share_infringing", "share_customer", "share_adult")]
    return x.select("sec_domain_id", "sec_domain_source", "online_status", "google_search_results", "exc_domain_id", "class_id", "direct_plus_referrals", *none, "total_referral_traffic", F.lit(None).cast("long").alias("inf_referring_sites"))


def candidates(metrics: DataFrame, others: DataFrame) -> DataFrame:
    """Both sets, one row per domain; the metrics come first."""
    both = metrics.withColumn("__set", F.lit(1)).unionByName(others.withColumn("__set", F.lit(2)))
    w = Window.partitionBy("sec_domain_id").orderBy("__set")
    return both.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", "__set")
