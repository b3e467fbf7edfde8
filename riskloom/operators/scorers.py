"""External scorers behind deterministic gates: an interface with constant fallbacks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import pages
from riskloom.operators.calls import Ask, Landing, landed
from riskloom.operators.captures import clean_label

Scorer = Callable[[pd.Series], pd.Series]
#: What stands where no scorer answers.
FALLBACK = {"media_type": 12, "enforcement": 0, "software": 9}
GATED = {"media_type": 17, "enforcement": 0, "software": 9}


def gate(kind: str, html: Column, text: Column) -> Column:
    """Whether a page is decided without a call."""
    short = pages.too_short(text)
    if kind == "media_type":
        return F.coalesce(F.size(F.split(text, " ")), F.lit(0)) < 4
    parked = pages.matches_any(pages.PARKED, text, html)
    return short | parked | (pages.matches_any(pages.BLOCKED, text, html) if kind == "software" else F.lit(False))


def asked(ask: DataFrame, key: str, scorer: Ask, landing: Landing, kind: str) -> DataFrame:
    """(key, class, called) of pages that go to a scorer, each asked once; an error, no answer or one that is no number is the fallback."""
    done = landed(ask, key, scorer, landing, kind)
    return done.select(key, F.coalesce(F.col("answer").try_cast("int"), F.lit(FALLBACK[kind])).alias("class"), F.lit(True).alias("called"))


def score(df: DataFrame, key: str, html: str, kind: str, scorer: Scorer | Ask | None = None, calls: int | None = None, landing: Landing | None = None) -> DataFrame:
    """(key, class, called): gated pages get their fixed class, others go to the scorer or its fallback.

    calls bounds the number of concurrent scorer tasks. A scorer takes and returns a Series; with a landing it takes one page (key and text)
    as a dict, and its answers are kept there.
    """
    most = 120_000 if kind == "enforcement" else 80_000
    x = df.select(F.col(key), F.col(html).alias("html"), pages.prepared_text(F.col(html), most).alias("text"))
    x = x.withColumn("gated", gate(kind, F.col("html"), F.col("text"))).drop("html")
    if scorer is None:
        return x.select(key, F.when(F.col("gated"), GATED[kind]).otherwise(FALLBACK[kind]).alias("class"), (~F.col("gated")).alias("called"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "class": scorer(b["text"]).fillna(FALLBACK[kind]).astype("int32"), "called": True})

    ask = x.filter(~F.col("gated"))
    if landing:
        done = asked(ask.drop("gated"), key, scorer, landing, kind)
    else:
        ask = ask.repartition(calls) if calls else ask
        done = ask.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, class int, called boolean")
    return done.unionByName(x.filter("gated").select(key, F.lit(GATED[kind]).alias("class"), F.lit(False).alias("called")))


def enforcement(df: DataFrame, key: str, scorer: Callable[[pd.DataFrame], pd.Series] | Ask | None = None, calls: int | None = None, landing: Landing | None = None) -> DataFrame:
    """(key, class, called) from (key, html, media_type, brand_known, ssl_score, privacy, terms).

    The scorer takes a frame of text, media_type, brand_known, ssl_score, privacy, terms and blocked, and returns class ids; a page that is
    too short or parked is 0 without a call, and so is whatever the scorer leaves open. With a landing it takes one page as a dict of these and the key, and its
    answers are kept there.
    """
    x = df.select(key, "media_type", "brand_known", "ssl_score", "privacy", "terms", F.col("html"), pages.prepared_text(F.col("html"), 120_000).alias("text"))
    x = x.withColumns({"blocked": pages.matches_any(pages.BLOCKED_FLAG, F.col("text"), F.col("html")), "gated": gate("enforcement", F.col("html"), F.col("text"))}).drop("html")
    if scorer is None:
        return x.select(key, F.lit(FALLBACK["enforcement"]).alias("class"), (~F.col("gated")).alias("called"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "class": scorer(b.drop(columns=[key, "gated"])).fillna(FALLBACK["enforcement"]).astype("int32"), "called": True})

    ask = x.filter(~F.col("gated"))
    if landing:
        done = asked(ask.drop("gated"), key, scorer, landing, "enforcement")
    else:
        ask = ask.repartition(calls) if calls else ask
        done = ask.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, class int, called boolean")
    return done.unionByName(x.filter("gated").select(key, F.lit(GATED["enforcement"]).alias("class"), F.lit(False).alias("called")))


#: Labels that the gray market scorer may answer.
GRAYMARKET = ["Adult Content", "Gambling & Betting", "Cryptocurrency Speculation", "Supplement / Nutra", "undeterminated"]
MFA_THRESHOLD = 65


def graymarket(features: DataFrame, key: str, score: Column, classify: Scorer | None = None, confirm: Callable[[pd.DataFrame], pd.Series] | None = None, calls: int | None = None) -> DataFrame:
    """(key, label, asked_mfa) from parsed pages: mfa where confirm says so of a page with a score of 65 or more, else what classify says.

    confirm takes the frame of features with text cut to 1500 characters and answers mfa or unknow; classify takes 5000 characters. An answer's
    first line counts, without marks; anything that isn't a label is undeterminated, as is every page without a scorer.
    """
    x = features.withColumns({"asked_mfa": score >= MFA_THRESHOLD, "text": F.left("relevant_text", F.lit(5000)), "excerpt": F.left("relevant_text", F.lit(1500))})
    if classify is None and confirm is None:
        return x.select(key, F.lit("undeterminated").alias("label"), "asked_mfa")

    def line(answer: object, keep: str) -> str:
        first = (str(answer).strip().splitlines() or [""])[0]
        return re.sub(keep, "", first).strip()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            label = pd.Series(["undeterminated"] * len(b), index=b.index)
            mfa = pd.Series(False, index=b.index)
            ask = b[b["asked_mfa"]]
            if confirm is not None and len(ask):
                said = confirm(ask.drop(columns=["text"]).rename(columns={"excerpt": "text"}))
                mfa[ask.index] = [line(str(v).lower(), "[^a-z]") == "mfa" for v in said]
            rest = b[~mfa]
            if classify is not None and len(rest):
                label[rest.index] = [v if (v := line(a, r"[^\w &/]")) in GRAYMARKET else "undeterminated" for a in classify(rest["text"])]
            label[mfa] = "mfa"
            yield pd.DataFrame({key: b[key], "label": label, "asked_mfa": b["asked_mfa"]})

    x = x.repartition(calls) if calls else x
    return x.mapInPandas(run, f"{key} {features.schema[key].dataType.simpleString()}, label string, asked_mfa boolean")


def graymarket_landed(features: DataFrame, key: str, score: Column, classify: Ask, confirm: Ask, landing: Landing) -> DataFrame:
    """(key, label, asked_mfa), as graymarket, with one call for each question of each page and its answer kept.

    confirm is asked about pages with a score of 65 or more, about all features and the first 1500 characters of text; classify about the first 5000 characters of
    the pages that are left. An error or no answer is unknow for the one and undeterminated for the other.
    """
    x = features.withColumn("asked_mfa", F.coalesce(score >= MFA_THRESHOLD, F.lit(False)))
    ask = x.filter("asked_mfa").withColumn("text", F.left("relevant_text", F.lit(1500))).drop("asked_mfa", "relevant_text")
    said = landed(ask, key, confirm, landing, "mfa")
    line = F.get(F.split(F.lower(F.trim("answer")), "\n"), F.lit(0))
    mfa = said.filter(F.regexp_replace(line, "[^a-z]", "") == "mfa").select(key)
    left = x.join(mfa, key, "left_anti")
    labels = landed(left.select(key, F.left("relevant_text", F.lit(5000)).alias("text")), key, classify, landing, "graymarket")
    labels = labels.select(key, F.coalesce(clean_label(F.trim("answer"), GRAYMARKET, "undeterminated"), F.lit("undeterminated")).alias("label"))
    return x.select(key, "asked_mfa").join(labels.unionByName(mfa.withColumn("label", F.lit("mfa"))), key).select(key, "label", "asked_mfa")
