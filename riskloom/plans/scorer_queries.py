"""Queries that call scorers through a landing, beside their SQL; importing the module registers them.

The scorers are rules of the features that they are given, so that SQL can say what comes back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions import pages
from riskloom.operators import scorers
from riskloom.operators.calls import Landing
from riskloom.plans.queries import _HIT, _SHORT, _TEXT, query
from riskloom.session import shared_folder
from riskloom.sources.adapters import load


def landing(s: SparkSession) -> Landing:
    return Landing(shared_folder(s, "calls"), calls=5, wait=(0.0, 0.0))


def enforcement_rule(page: dict) -> int | None:
    """A class from all inputs; no answer for every page of a kind, an error for another."""
    if page["media_type"] == "Sports":
        return None
    if page["media_type"] == "Manga":
        raise ValueError("no class")
    return 1 + 2 * bool(page["brand_known"]) + 4 * (page["ssl_score"] >= 0.5) + 8 * bool(page["privacy"]) + 16 * bool(page["terms"]) + 32 * bool(page["blocked"])


def _varied_pages(s: SparkSession, d: str) -> DataFrame:
    k, html = F.col("html_id"), F.col("html_content")
    media = F.element_at(F.array(*map(F.lit, ("Anime", "Sports", "Manga", "Music"))), (k % 4 + 1).cast("int"))
    own = F.concat(F.when(k % 10 == 0, "").otherwise(html), F.when(k % 3 == 0, "<p>privacy</p>").otherwise(""), F.when(k % 7 == 0, "<p>terms</p>").otherwise(""), F.when(k % 9 == 0, "<p>Sorry, you have been blocked</p>").otherwise(""))
    x = load(s, d, "snapshots").select(k, own.alias("html"), media.alias("media_type"), (k % 2 == 0).alias("brand_known"), ((k % 10) / 10).alias("ssl_score"))
    return x.withColumns({n: pages.policy_flags(F.col("html"))[n] for n in ("privacy", "terms")})


_VARIED = """select html_id, case when html_id % 10 = 0 then '' else html_content end || case when html_id % 3 = 0 then '<p>privacy</p>' else '' end || case when html_id % 7 = 0 then '<p>terms</p>' else '' end || case when html_id % 9 = 0 then '<p>Sorry, you have been blocked</p>' else '' end as html_content from snapshots"""


@query("enforcement_called", ["snapshots"], f"""select html_id, cast(case when gated then 0 when html_id % 4 in (1, 2) then 0 else 1 + 2 * cast(html_id % 2 = 0 as int) + 4 * cast(html_id % 10 >= 5 as int) + 8 * cast(contains(low, 'privacy') or contains(low, 'policy') as int) + 16 * cast(contains(low, 'terms') or contains(low, 'tos') as int) + 32 * cast(blocked as int) end as int) as class, not gated as called
 from (select html_id, lower(html_content) as low, ({_SHORT} or {_HIT(pages.PARKED)}) as gated, {_HIT(pages.BLOCKED_FLAG)} as blocked from ({_TEXT.replace('80000', '120000').replace('from snapshots', f'from ({_VARIED}) v')}) y) z""")
def _(s, d):
    """Classes of pages whose text, media type, brand, certificate and policy words vary, each asked once through a landing."""
    return scorers.enforcement(_varied_pages(s, d), "html_id", enforcement_rule, landing=landing(s))


def confirm_rule(page: dict) -> str:
    return "MFA.\nsure" if page["ads"] > 2 else "unknow"


def classify_rule(page: dict) -> str | None:
    known = {"bet": "**Gambling & Betting**", "coin": "Cryptocurrency Speculation\nbecause", "pill": "Supplement / Nutra", "odd": "Nonsense"}
    if page["text"] == "down":
        raise RuntimeError("no answer")
    return known.get(page["text"])


@query("graymarket_called", ["snapshots"], """select html_id, case when asked_mfa and html_id % 6 > 2 then 'mfa' when k = 0 then 'Gambling & Betting' when k = 1 then 'Cryptocurrency Speculation' when k = 2 then 'Supplement / Nutra' else 'undeterminated' end as label, asked_mfa from (select html_id, html_id % 5 as k, (html_id * 7) % 100 >= 65 as asked_mfa from snapshots) x""")
def _(s, d):
    """Labels of pages on both sides of the score that asks for a confirmation; unknown answers, errors and silence among them."""
    k = F.col("html_id")
    text = F.element_at(F.array(*map(F.lit, ("bet", "coin", "pill", "odd", "down"))), (k % 5 + 1).cast("int"))
    x = load(s, d, "snapshots").select(k, text.alias("relevant_text"), (k % 6).alias("ads"), ((k * 7) % 100).alias("score"))
    return scorers.graymarket_landed(x, "html_id", F.col("score"), classify_rule, confirm_rule, landing(s))
