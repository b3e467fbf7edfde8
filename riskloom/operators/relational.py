"""Windows, joins and keyed updates over the hub."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from riskloom.functions.text import canonical_domain
from riskloom.operators.ranges import with_previous


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order (a group limit in the plan, no full sort)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_ties(df: DataFrame, key: str, month: str) -> DataFrame:
    """All rows of each key's latest month."""
    top = df.groupBy(key).agg(F.max(month).alias(month))
    return df.join(top, [key, month], "left_semi")


def intermediate_hops(bars: DataFrame) -> DataFrame:
    """Navigation steps that lead on: later tabs, no landing page, another domain, not the last of their group."""
    g = Window.partitionBy("session_id", "ad_event_id", "tab_num")
    x = bars.withColumn("grp_max", F.max("bar_num").over(g))
    return x.filter("tab_num > 0 AND landing_page IS FALSE AND source_domain IS DISTINCT FROM bar_domain AND grp_max > 0 AND bar_num < grp_max")


def on_address_bar(hub: DataFrame, bars: DataFrame) -> DataFrame:
    """Unclassified domains of hub that stand in the address bar as an intermediate hop, with the class they get."""
    hops = intermediate_hops(bars).select(F.col("bar_domain").alias("sec_domain")).filter("sec_domain IS NOT NULL").distinct()
    return hub.filter("class_id IS NULL").join(hops, "sec_domain", "left_semi").select("sec_domain_id", F.lit(2).alias("class_id"), F.lit("Ad_sniffer").alias("decision_source"))


def without_repeats(log: DataFrame) -> DataFrame:
    """Responses that differ from the one before, without the first of each site; a site's responses are dealt over ranges of their numbers."""
    x = with_previous(log, "site", "seq", {"url": "__prev"})
    return x.filter("NOT __first AND url IS DISTINCT FROM __prev").select(*log.columns)


def keyed_update(base: DataFrame, updates: DataFrame, key: str, columns: list[str], keep_old: list[str] = ()) -> DataFrame:
    """base with columns of updates by key; those in keep_old only where the new value isn't null.

    A key that updates holds twice ends the job with an error, since which of its rows would win is open. Unmatched rows stay as they are.
    """
    once = updates.groupBy(F.col(key).alias("__k")).agg(*[F.first(c).alias(c) for c in columns], F.count("*").alias("__n"))
    checked = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("more than one update for key "), F.col("__k").cast("string")))).otherwise(F.lit(True))
    u = once.select("__k", *[F.col(c).alias(f"__{c}") for c in columns], checked.cast("boolean").alias("__hit"))
    x = base.join(u, F.col(key) == F.col("__k"), "left")
    # Every new value asks for the check, so no plan can do without it.
    new = lambda c: F.coalesce(F.when(F.col("__hit"), F.col(f"__{c}")), F.col(c)) if c in keep_old else F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c))
    return x.select(*[new(c).alias(c) if c in columns else F.col(c) for c in base.columns])


def observed(df: DataFrame, by: dict[str, list], extra: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """df, and an observation that counts its rows while whatever action reads it: all rows, rows by value of each column of by, and extra aggregates.

    by lists the values that are told apart; rows of others, and of null, are counted together. What is observed comes with the write, without a scan of
    its own, and is summed by Spark from the tasks that succeeded. ``counts`` reads it.
    """
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    for column, values in by.items():
        known = F.coalesce(F.col(column).isin(values), F.lit(False))
        metrics += [F.count_if(F.col(column) == F.lit(v)).alias(f"{column}={v}") for v in values] + [F.count_if(~known).alias(f"{column}=other")]
    return df.observe(seen, *metrics, *[c.alias(n) for n, c in (extra or {}).items()]), seen


def counts(seen: Observation) -> dict[str, int]:
    """The observed numbers, by name; waits for the action that they come with."""
    return {k: v for k, v in seen.get.items() if v is not None}


def missing(hub: DataFrame, known: DataFrame, limit: int | None = None) -> DataFrame:
    """Domains of hub, newest first, that known holds neither with nor without www."""
    have = known.select(canonical_domain(F.col("domain")).alias("d")).distinct()
    x = hub.filter("sec_domain_root IS NOT NULL").withColumn("d", canonical_domain(F.col("sec_domain_root"))).join(have, "d", "left_anti")
    x = x.select("sec_domain_id", "d")
    return x.orderBy(F.desc("sec_domain_id")).limit(limit) if limit else x


def without_valid_ads(hub: DataFrame, urls: DataFrame, features: DataFrame) -> DataFrame:
    """Ids of unpublished advertising-class domains with an ad URL that didn't render or has no creative."""
    bad = features.filter("NOT coalesce(ad_rendering, false) OR NOT coalesce(ad_creative, false)").select("ad_url")
    hit = urls.join(bad, "ad_url", "left_semi").select("domain_id")
    return hub.filter("class_id = 3 AND publication_status = 0").join(hit, "domain_id", "left_semi").select("sec_domain_id")


WORK_LISTS = {
    "WL-01": "online_status IS NULL AND class_id IS NULL",
    "WL-02": "class_id IS NULL",
    "WL-05": "class_id IS NULL AND google_search_results IS NOT NULL AND online_status IS NOT NULL AND online_status NOT IN ('Online', 'Online-Bulk-check')",
    "WL-06": "class_id IS NULL AND sec_domain_source = 'Domain Telemetry' AND google_search_results IS NOT NULL",
    "WL-07": "class_id IS NULL AND online_status = 'Online' AND redirect_domain = false",
    "WL-08": "redirect_domain = true",
    "WL-09": "tld_poor IS NULL AND online_status = 'Online' AND redirect_domain = false",
    "WL-10": "site_map_count IS NULL AND online_status = 'Online' AND redirect_domain = false",
    "WL-11": "is_high_risk_geo IS NULL AND online_status = 'Online' AND redirect_domain = false",
    "WL-12": "ad_density IS NULL AND online_status = 'Online' AND redirect_domain = false",
    "WL-13": "ssl_poor IS NULL AND online_status = 'Online' AND class_id IS NULL AND sec_domain_root IS NOT NULL",
    "WL-14": "ssl_poor IS NULL AND online_status = 'Online' AND redirect_domain = false AND class_id IS NULL",
    "WL-15": "graymarket_label IS NULL AND online_status = 'Online' AND redirect_domain = false AND exc_domain_id IS NULL AND added > date'2025-01-01' AND class_id IS NULL",
    "WL-16": "online_status = 'Online' AND redirect_domain = false AND (tld_poor IS NULL OR site_map_count IS NULL OR is_high_risk_geo IS NULL)",
    "WL-17": "media_type_id IS NULL AND online_status = 'Online' AND class_id IS NULL",
    "WL-18": "media_type_id IS NOT NULL AND enforcement_id IS NULL AND online_status = 'Online'",
    "WL-19": "media_type_id IS NOT NULL AND enforcement_id IS NULL AND sec_domain_root IS NOT NULL",
    "WL-20": "media_type_id = 7 AND (class_id IS NULL OR class_id = 9)",
    "WL-21": "publication_status = 0 AND sec_domain_source IS NOT NULL AND class_id IS NOT NULL",
    "WL-22": "publication_status = 0 AND class_id = 3",
}


def work_lists(hub: DataFrame) -> DataFrame:
    """(work_list, sec_domain_id) of every list, from one scan."""
    lists = F.array_compact(F.array(*[F.when(F.expr(p), F.lit(n)) for n, p in WORK_LISTS.items()]))
    return hub.select(F.explode(lists).alias("work_list"), "sec_domain_id")
