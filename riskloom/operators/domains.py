"""Domain names against relations of suffixes, platforms and keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import text

#: Characters of the grams under which keywords are filed: the most that a keyword has; shorter ones are filed whole.
GRAMS = (4, 8, 16)


def by_suffix(hosts: DataFrame, host: str, suffixes: DataFrame) -> DataFrame:
    """(host, suffix, registered, subdomain) for each distinct name in hosts, by the longest suffix that the relation has.

    suffixes has a column suffix of rules: a plain one (co.uk), one for all labels below a name (*.ck), or an exception to such
    a rule (!www.ck), which wins and stands for the name without its first label. A name is cut into its tails, a row a label, which meet
    the rules by a hash join. The registered name is the suffix and one label more; where no rule matches, the suffix is empty and
    the last label is registered; a name that is a suffix is its own. Null and empty names and IP addresses give no rows.
    """
    rule = F.trim(F.lower("suffix"))
    base = F.regexp_replace(rule, "^(\\*\\.|!)", "")
    more = F.when(F.startswith(rule, F.lit("*.")), 1).when(F.startswith(rule, F.lit("!")), -1).otherwise(0)
    rules = suffixes.select(base.alias("__tail"), more.alias("__more")).filter("__tail <> ''").distinct()
    names = hosts.select(F.col(host).alias("__host")).filter("__host <> ''").filter(~text.is_ip(F.col("__host"))).distinct()
    names = names.withColumn("__labels", F.split("__host", "\\."))
    tails = names.select("__host", "__labels", F.posexplode("__labels").alias("__at", "__label"))
    n = F.size("__labels")
    tails = tails.select("__host", n.alias("__n"), (n - F.col("__at")).alias("__k"), F.array_join(F.slice("__labels", F.col("__at") + 1, n), ".").alias("__tail"))
    met = tails.join(rules, "__tail").filter(F.col("__k") + F.col("__more") <= F.col("__n")).groupBy("__host").agg(F.max(F.when(F.col("__more") >= 0, F.col("__k") + F.col("__more"))).alias("__rule"), F.max(F.when(F.col("__more") < 0, F.col("__k") - 1)).alias("__exception"))
    x = names.join(met, "__host", "left").withColumn("__n", F.coalesce("__exception", "__rule", F.lit(0)))
    join = lambda a, k: F.array_join(F.slice("__labels", a, k), ".")
    rest = F.greatest(n - F.col("__n") - 1, F.lit(0))
    return x.select(
        F.col("__host").alias("host"),
        join(n - F.col("__n") + 1, F.col("__n")).alias("suffix"),
        join(rest + 1, n - rest).alias("registered"),
        F.nullif(join(F.lit(1), rest), F.lit("")).alias("subdomain"),
    )


def by_second_label(hosts: DataFrame, host: str, tlds: DataFrame) -> DataFrame:
    """(host, registered) for each distinct name: the last two labels, three where the last but one is listed in tlds (column tld)."""
    listed = tlds.select(F.trim(F.lower("tld")).alias("__label")).filter("__label <> ''").distinct().withColumn("__three", F.lit(True))
    names = hosts.select(F.col(host).alias("__host")).filter("__host <> ''").filter(~text.is_ip(F.col("__host"))).distinct()
    labels = F.filter(F.split("__host", "\\."), lambda x: x != "")
    names = names.withColumn("__labels", labels).withColumn("__label", F.when(F.size("__labels") >= 3, F.get("__labels", F.size("__labels") - 2)))
    k = F.least(F.when(F.col("__three"), 3).otherwise(2), F.size("__labels"))
    x = names.join(listed, "__label", "left").withColumn("__k", k)
    return x.select(F.col("__host").alias("host"), F.array_join(F.slice("__labels", F.size("__labels") - F.col("__k") + 1, F.col("__k")), ".").alias("registered"))


def by_heuristic(hosts: DataFrame, host: str) -> DataFrame:
    """(host, registered) for each distinct name, by the fixed multi-part suffixes."""
    names = hosts.select(F.col(host).alias("host")).filter("host <> ''").filter(~text.is_ip(F.col("host"))).distinct()
    return names.select("host", text.registered_domain(F.col("host")).alias("registered"))


def cleaned(df: DataFrame, url: str, order: str, by: list[str] = (), suffixes: DataFrame | None = None, tlds: DataFrame | None = None, platforms: list[str] = text.HOSTED_SUFFIXES) -> DataFrame:
    """(*by, clean_domain, first_seen): the registered domains of a column of URLs, and the least order that each was seen with.

    The rule is that of the tld list where there is one, else that of the suffixes, else the heuristic. IP addresses and what is
    registered with a hosting platform are left out, as are empty and null URLs; the platform itself, too. Hosts are summed up before any
    rule is asked, so a host is cut once however often it stands.
    """
    host = text.ascii_host(text.url_host(F.col(url)))
    seen = df.select(*by, host.alias("__host"), F.col(order).alias("__seen")).filter("__host <> ''").groupBy(*by, "__host").agg(F.min("__seen").alias("__seen"))
    names = by_second_label(seen, "__host", tlds) if tlds is not None else by_suffix(seen, "__host", suffixes) if suffixes is not None else by_heuristic(seen, "__host")
    names = names.filter(~F.col("registered").isin(platforms)).filter("registered <> ''")
    x = seen.join(names.select(F.col("host").alias("__host"), F.col("registered").alias("clean_domain")), "__host")
    return x.groupBy(*by, "clean_domain").agg(F.min("__seen").alias("first_seen"))


def open_features(hub: DataFrame, features: list[str]) -> DataFrame:
    """hub with a row for each of features that is still null (column feature), or one row named all for each if none of hub's rows has any."""
    open_ = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in features]))
    x = hub.withColumn("__open", open_)
    some = x.agg(F.coalesce(F.bool_or(F.size("__open") > 0), F.lit(False))).scalar()
    return x.withColumn("feature", F.explode(F.when(some, F.col("__open")).otherwise(F.array(F.lit("all"))))).drop("__open")


def grams(df: DataFrame, word: str, sizes: Column, *more: Column) -> DataFrame:
    """(word, *more, __at, __gram): every substring of one of sizes characters, with its place from 1 on."""
    x = df.select(word, *more, F.explode(F.sequence(F.lit(1), F.length(word))).alias("__at"))
    x = x.select("*", F.explode(sizes).alias("__size")).withColumn("__gram", F.substring(F.col(word), F.col("__at"), F.col("__size")))
    return x.filter(F.length("__gram") == F.col("__size")).drop("__size")


def keyword_hits(names: DataFrame, name: str, words: DataFrame, word: str) -> DataFrame:
    """(name, word, at): where keywords stand inside names; both columns are taken as they are, each value once.

    An inverted index: a keyword is filed once, under its gram of the longest size in GRAMS that it has (the whole keyword, if shorter) and that the fewest
    keywords have, with the gram's place in it. Names are cut into grams of the sizes that are filed, in one pass, and where a filed gram is met
    the keyword has to stand around it. So a name costs a row for each place of it and size, and one for each keyword filed under a gram of it. Gram sizes
    grow with the keywords, so that many numbered ones don't share the few short grams of their digits. Both sides are shuffled: a
    plan's estimate of a table doesn't see the grams that rows are cut into, and would send them through the driver to broadcast them.
    """
    return _found(names, name, words, word).distinct()


def _found(names: DataFrame, name: str, words: DataFrame, word: str) -> DataFrame:
    """The rows of keyword_hits, as often as a name stands in names."""
    words = words.select(F.col(word).alias("__word")).filter("__word <> ''").distinct()
    n = F.length("__word")
    size = F.coalesce(*[F.when(n >= k, k) for k in reversed(GRAMS)], n)
    filed = grams(words, "__word", F.array(size))
    held = filed.groupBy("__gram").agg(F.count("*").alias("__n"))
    index = filed.join(held.hint("merge"), "__gram").groupBy("__word").agg(F.min(F.struct("__n", "__gram", "__at")).alias("f")).select("__word", F.col("f.__gram").alias("__gram"), F.col("f.__at").alias("__off"))
    names = names.select(F.col(name).alias("__name")).filter("__name <> ''")
    met = grams(names, "__name", words.agg(F.collect_set(size)).scalar())  # a size in GRAMS, or less than the least: few
    at = F.col("__at") - F.col("__off") + 1
    found = met.join(index.hint("merge"), "__gram").filter((at >= 1) & (F.substring(F.col("__name"), at, F.length("__word")) == F.col("__word")))
    return found.select(F.col("__name").alias("name"), F.col("__word").alias("word"), at.alias("at"))


def brand_known(domains: DataFrame, domain: str, brands: DataFrame, least: int = 6) -> DataFrame:
    """domains plus brand_known: whether a brand keyword of least characters or more stands inside the lower-cased domain."""
    words = brands.filter(F.col("brand") & (F.length("keyword") >= least)).select(F.lower(F.trim("keyword")).alias("__w"))
    name = F.lower(F.coalesce(F.col(domain), F.lit("")))
    hit = _found(domains.select(name.alias("__d")), "__d", words, "__w").select(F.col("name").alias("__hit")).distinct()
    return domains.join(hit, name == F.col("__hit"), "left").withColumn("brand_known", F.col("__hit").isNotNull()).drop("__hit")
