"""Decision rules, each one CASE expression over its input columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values.
BETTING_TERMS = ["bet365", "betway", "1xbet", "bwin", "888", "williamhill", "stake", "betfair", "leovegas", "betsson", "10bet", "unibet", "dafabet", "parimatch", "sportingbet", "bet-at-home", "mrgreen", "casumo", "ggbet", "rivalry", "betano", "paddypower", "ladbrokes", "skybet", "betvictor", "betfred", "betclic", "marathonbet", "sbobet", "boylesports", "fonbet", "pinnacle", "betsafe", "tonybet", "interwetten", "tipico", "fanduel", "draftkings", "betmgm", "caesars", "betrivers", "pointsbet", "fanatics", "espnbet", "circa-sports", "hardrockbet", "codere", "caliente", "betcris", "bplay", "betwarrior", "playdoit", "pixbet", "apostaganha", "esportesdasorte", "betsul", "betnacional", "galerabet", "kto", "coolbet"]
OFFLINE = ["Offline", "Blocked", "Offline | Status Checker", "Offline--Bulk-check", "Offline | Ad Sniffer"]
RISK_COUNTRIES = ["RU", "UA", "CN", "MD", "RO", "BG", "BZ", "PA", "SC"]
LABEL_CLASS = {"mfa": 3, "Adult Content": 5, "Gambling & Betting": 6, "Cryptocurrency Speculation": 7, "Supplement / Nutra": 8, "undeterminated": 9}


def yes(c: Column) -> Column:
    """Three-valued condition as a plain one: null is false."""
    return F.coalesce(c, F.lit(False))


def betting_pattern(terms: list[str] = BETTING_TERMS) -> str:
    """Long terms as whole words; terms of three characters at most only as whole labels."""
    short = lambda t: f"(?:^|[.-]){t}[.-]|[.-]{t}$|^{t}$"
    return "|".join(short(re.escape(t)) if len(t) <= 3 else rf"\b{re.escape(t)}\b" for t in terms)


def rude_class(domain: Column, exc_domain_id: Column, brands: list[str] | Column) -> Column:
    """brands: a short list, or a flag that tells whether a brand stands in the domain."""
    if isinstance(brands, Column):
        brand = yes(brands)
    else:
        brand = yes(F.lower(domain).rlike("|".join(re.escape(b.lower()) for b in brands))) if brands else F.lit(False)
    return F.when(exc_domain_id.isNotNull(), 4).when(brand, 1).when(yes(domain.rlike("(?i)" + betting_pattern())), 6)


def block_class(results: Column, redirect: Column) -> Column:
    return F.when(yes(redirect), 2).when(results <= 2, 2).when(results < 50, 3).when(results >= 50, 4)


def telemetry_class(results: Column) -> Column:
    return F.when(results <= 2, 2).when(results < 50, 3).when(results >= 50, 4)


def decision_tree(c) -> Column:
    """c: gives columns by name (a DataFrame, or F.col)."""
    label, length = c("graymarket_label"), c("html_length")
    mapped = F.lit(None).cast("int")
    for name, value in LABEL_CLASS.items():
        mapped = F.when(label == name, value).otherwise(mapped)
    commercial = (yes(c("high_traffic")) & yes(c("is_ecommerce"))) | (yes(c("mfa_engagement")) & (yes(c("is_ecommerce")) | yes(c("has_affiliate_handoff"))))
    named = yes(label.isNotNull() & (label != "undeterminated"))
    return (
        F.when(yes(c("ssl_poor")) & ~yes(c("high_traffic")) & yes(label == "undeterminated") & (F.coalesce(length, F.lit(0)) < 1000), 2)
        .when(commercial, F.when(named, mapped).otherwise(4))
        .when(yes(c("ad_density")) & yes(c("tld_poor")) & yes(length > 2000), 3)
        .when(label.isNotNull(), mapped)
        .otherwise(9)
    )


def fp_reason(traffic: Column, organic: Column, direct: Column, referrals: Column, display: Column) -> Column:
    """Why a domain may be a false positive: 1 to 4, or null."""
    balanced = (direct <= 0.60) & (referrals <= 0.25)
    return F.when(yes(traffic > 10_000_000), 1).when(yes(organic >= 0.40), 2).when(yes(balanced & (display <= 0.10)), 3).when(yes(balanced & (organic >= 0.30)), 4)


def strong_referrals(inf: Column, cust: Column, dpr: Column) -> Column:
    return yes((inf > 0.5) & (cust > 0.2) & (dpr > 0.6))


def traffic_class(m, version: int = 2, fp: Column | None = None) -> Column:
    """Class from traffic metrics (m gives columns by name); version 1 has neither the FP guard nor the special case."""
    results, status, cls = m("google_search_results"), m("online_status"), m("class_id")
    online, offline = yes(status == "Online"), yes(status.isin(OFFLINE))
    strong = strong_referrals(m("share_infringing"), m("share_customer"), m("direct_plus_referrals"))
    none = F.lit(None).cast("int")
    guard = (fp.isNotNull() if fp is not None else F.lit(False)) if version == 2 else F.lit(False)
    two = F.when(guard, none).otherwise(2)
    weak = F.when(offline, 0).otherwise(none)
    known = (
        F.when(results < 2, two)
        .when(strong, F.when(online, F.when(results < 10, two).when(results < 50, 3).otherwise(4)).when(offline, two).otherwise(none))
        .otherwise(weak)
    )
    unknown = F.when(strong, F.when(online, 3).when(offline, two).otherwise(none)).otherwise(weak)
    out = F.when(m("exc_domain_id").isNotNull(), 4)
    if version == 2:
        out = out.when(special_case(m) & yes(cls.isin(2, 3)), cls)
    return out.when(results.isNotNull(), known).otherwise(unknown)


def special_case(m) -> Column:
    """No referral evidence."""
    return ~yes((m("total_referral_traffic") > 0) & (m("direct_plus_referrals") > 0))


def traffic_attributes(cls: Column, special: Column) -> dict[str, Column]:
    two, three = yes(cls == 2), yes(cls == 3)
    pick = lambda a, b, c, d: F.when(two, F.when(special, b).otherwise(a)).when(three, F.when(special, d).otherwise(c))
    return {
        "confidence": pick("HIGH", "MEDIUM", "MEDIUM", "LOW"),
        "recommended_action_id": pick(F.lit(1), F.lit(2), F.lit(2), F.lit(5)),
        "justification": pick(F.lit(1), F.lit(2), F.lit(4), F.lit(3)),
        "decision_source": F.when(special & (two | three), "Ad Sniffer").otherwise("SimilarWeb"),
    }


def confidence(source: Column, cls: Column) -> dict[str, Column]:
    """The confidence matrix; null for pairs that it doesn't hold."""
    sw, ads = source == "SimilarWeb", source == "Ad Sniffer"
    pick = lambda a, b, c, d: F.when(sw & (cls == 2), a).when(sw & (cls == 3), b).when(ads & (cls == 2), c).when(ads & (cls == 3), d)
    return {"confidence": pick("HIGH", "MEDIUM", "MEDIUM", "LOW"), "recommended_action_id": pick(1, 2, 2, 5), "justification": pick(1, 4, 2, 3)}


def ssl_tenths(c, mode: str = "full") -> Column:
    """Certificate risk in tenths; as_reference leaves out validity and takes every key for weak, as the feature once did."""
    issuer = F.lower(F.coalesce(c("issuer"), F.lit("")))
    kind = F.coalesce(c("validation_type"), F.lit(""))
    points = lambda cond, n: F.when(yes(cond), n).otherwise(0)
    rsa, ecdsa = c("key_type") == "RSA", c("key_type") == "ECDSA"
    score = points(kind == "domain", 3) + points(F.contains(issuer, F.lit("let's encrypt")) | F.contains(issuer, F.lit("google")), 2)
    if mode == "full":
        days = F.floor((F.unix_timestamp("valid_to") - F.unix_timestamp("valid_from")) / 86400)
        score = score + points(days <= 90, 2) + points((rsa & (c("key_bits") < 2048)) | (ecdsa & (c("key_bits") < 256)), 2)
    else:
        score = score + points(rsa | ecdsa, 2)
    score = score + points(F.contains(c("policies"), F.lit("2.23.140.1.2.1")), 2) + points(F.contains(c("dns_names"), F.lit("*")), 1)
    return F.when((kind == "") & (issuer == ""), 7).otherwise(score)


def ad_dense(ads: Column, length: Column) -> Column:
    """ads / length > 0.015 without dividing: ads over no length are dense, nothing over nothing is not."""
    return yes(F.when(length == 0, ads > 0).otherwise(1000 * ads > 15 * length))


def mfa_engaged(bounce: Column, pages: Column, seconds: Column) -> Column:
    return yes((bounce >= 0.65) & (pages <= 3) & (seconds <= 180))


def high_risk_geo(country: Column, found: Column) -> Column:
    """A lookup that failed counts as risk."""
    return ~yes(found) | F.when(country.isNotNull(), country.isin(RISK_COUNTRIES)).otherwise(False)


def final_overrides(hub: DataFrame) -> DataFrame:
    """Three updates in order: invalid pages, publishing sites, advertising class without ads."""
    x = hub.select("sec_domain_id", "media_type_id", "ad_count", F.col("class_id").alias("c"))
    x = x.withColumn("c", F.when((F.col("media_type_id") == 17) & (F.col("c").isNull() | (F.col("c") == 9)), 11).otherwise(F.col("c")))
    x = x.withColumn("c", F.when((F.col("media_type_id") == 5) & (F.col("c") != 10), 10).otherwise(F.col("c")))
    hit = (F.coalesce("ad_count", F.lit(0)) == 0) & yes(F.col("c") == 3)
    return x.withColumn("source", F.when(hit, "sql script")).withColumn("c", F.when(hit, 9).otherwise(F.col("c")))


def html_outcome(text: Column, code: Column, is_parked: Column) -> Column:
    """struct(online_status, offline_type, status_msg) from visible text and a response code, by the first rule that holds.

    The rule for hosts that don't resolve has the words "in html" inside its second text, as the rule was written.
    """
    t = F.lower(F.coalesce(text, F.lit("")))
    has = lambda s: F.contains(t, F.lit(s))
    shown = F.coalesce(code.cast("string"), F.lit("None"))
    error = lambda what: F.concat(F.lit(f"Error[{what}-"), shown, F.lit("]"))
    out = lambda status, kind, message="": F.struct(F.lit(status).alias("online_status"), kind.alias("offline_type"), F.lit(message).alias("status_msg"))
    plain, ok = F.concat(F.lit("Error["), shown, F.lit("]")), yes(code == 200)
    offline = "Offline | Ad Sniffer"
    return (
        F.when(has("blocked") & has("bright data usage policy"), out("Blocked", error("BrightData"), "bright data usage policy"))
        .when(has("webpage not available") | has("404 not found") | has("this page isn’t working"), out(offline, plain))
        .when((has("cloudflare") & has("ray id")) | has("verifying you are human. this may take a few seconds"), out("Blocked", error("Cloudflare"), "cloudflare"))
        .when(has("proxy authentication required"), out("Blocked", error("Proxy Authentication Required"), "proxy authentication required"))
        .when(has("domain seized") | has("no longer available due to copyright"), out(offline, error("Domain Seized"), "Domain Seized"))
        .when(has("cannot establish connection to requested target") | has("could not resolve host https in html"), out(offline, error("not resolve host")))
        .when(has("bad request"), out("Blocked", error("Bad Request")))
        .when(has("auth failed (code: ip_forbidden)"), out("Blocked", error("auth failed")))
        .when(has("sorry, you have been blocked"), out("Blocked", F.concat(F.lit("blocked-"), shown, F.lit("]"))))
        .when(ok & is_parked, out("Offline", F.lit("Parked Domain"), "parked page"))
        .when(ok, out("Online", F.lit("None")))
        .otherwise(out(offline, plain))
    )


def status_from_html(text: Column, code: Column, is_parked: Column) -> Column:
    """Online status from visible text and the last response code."""
    return html_outcome(text, code, is_parked)["online_status"]
