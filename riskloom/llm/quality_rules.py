"""Quality rules: base statistics and a learned decision list, in native expressions.

The statistics of a document are computed inside its own row (no shuffle): words,
symbols, repeated lines, and words in repeated 8-word windows. A decision list is
learned from labelled statistics by sequential covering: each rule grows, condition by
condition, to the threshold conjunction with the best information gain on a growing set, is
pruned from its end on a pruning set, and is kept while it is precise enough there; the
rows that it covers are taken away and the next rule grows. The list becomes one
ordered CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import table
from riskloom.llm.native import eight_hashes, once

WS = " \t\n\x0b\f\r"
WS_RUN = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Labelled rows that the list is learned from at most (those with the smallest hash of their id).
MAX_TRAIN = 12_000


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def with_signals(docs: DataFrame, text: str = "text", out: str = "signals") -> DataFrame:
    """docs plus a struct column of statistics of the whole text; a null text counts as empty.

    Fields: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper,
    n_marks, n_distinct (all long). Rows, repeated or not, are kept one to one; helper columns are
    prefixed so that columns of the input are never overwritten.
    """
    p = "__qr_"
    own = docs.columns
    t = F.col(p + "t")
    x = docs.withColumn(p + "t", F.coalesce(F.col(text), F.lit("")))
    x = x.withColumns({
        p + "words": once(F.when(_without(t, WS) == "", F.array().cast("array<string>")).otherwise(F.split(F.trim(t, F.lit(WS)), WS_RUN))),
        p + "lines": once(F.filter(F.split(t, "\n"), lambda line: _without(line, WS) != "")),
    })
    words = F.col(p + "words")
    n = F.size(words)
    x = eight_hashes(p + "words", p + "h", x)
    h = F.col(p + "h")
    x = x.withColumn(p + "s", once(F.when(F.size(F.array_distinct(h)) < F.size(h), F.array_sort(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))))
    s = F.col(p + "s")
    x = x.withColumn(p + "at", once(F.array_sort(F.transform(F.filter(s, lambda v, k: (F.get(s, k - 1)["h"] == v["h"]) | (F.get(s, k + 1)["h"] == v["h"])), lambda v: v["i"]))))
    at = F.col(p + "at")
    covered = F.aggregate(F.transform(at, lambda v, k: F.least(F.lit(WINDOW), F.get(at, k + 1) - v)), F.lit(0).cast("bigint"), lambda a, v: a + v)
    signals = F.struct(
        n.cast("bigint").alias("n_words"),
        F.length(_without(t, WS)).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(_without(t, SYMBOLS))).cast("bigint").alias("n_symbols"),
        F.size(p + "lines").cast("bigint").alias("n_lines"),
        (F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"),
        (F.length(t) - F.length(_without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).cast("bigint").alias("n_upper"),
        (F.length(t) - F.length(_without(t, "!?;:=+_@{}[]/\\~^"))).cast("bigint").alias("n_marks"),
        F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct"),
    )
    return x.select(*[F.col(f"`{c}`") for c in own], once(signals).alias(out))


def features(s: Column) -> dict[str, Column]:
    """The ratios that conditions test, from a signals struct; all defined for empty texts."""
    words = F.greatest(s["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(s["word_chars"], F.lit(1)).cast("double")
    return {
        "n_words": s["n_words"].cast("double"),
        "word_length": s["word_chars"] / words,
        "symbols_per_word": s["n_symbols"] / words,
        "dup_line_share": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)).cast("double"),
        "repeat_share": s["n_repeat_words"] / words,
        "upper_share": s["n_upper"] / chars,
        "marks_per_word": s["n_marks"] / words,
        "distinct_share": s["n_distinct"] / words,
        "words_per_line": s["n_words"] / F.greatest(s["n_lines"], F.lit(1)).cast("double"),
    }


def base_failed(s: Column) -> Column:
    """Fewer than 20 words, or over 30 % of the words in repeated windows."""
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


@dataclass
class Rule:
    """feature, '<=' or '>=', threshold: all of them hold."""

    conditions: list[tuple[str, str, float]] = field(default_factory=list)

    def mask(self, columns: dict[str, np.ndarray], n: int) -> np.ndarray:
        out = np.ones(n, bool)
        for name, op, at in self.conditions:
            out &= columns[name] <= at if op == "<=" else columns[name] >= at
        return out

    def column(self, exprs: dict[str, Column]) -> Column:
        return reduce(lambda a, b: a & b, [exprs[n] <= F.lit(at) if op == "<=" else exprs[n] >= F.lit(at) for n, op, at in self.conditions])


def _thresholds(values: np.ndarray) -> list[float]:
    return sorted({float(v) for v in np.quantile(values, np.linspace(0.0, 1.0, 33))})


def _grow(cols: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    rule, inside = Rule(), np.ones(len(bad), bool)
    while len(rule.conditions) < most:
        p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
        if not p0 or not n0:
            break
        before, best = math.log2(p0 / (p0 + n0)), (1e-9, None, None)
        for name, v in cols.items():
            for at in _thresholds(v[inside & bad]):
                for op, m in (("<=", v <= at), (">=", v >= at)):
                    m = m & inside
                    if p := int((bad & m).sum()):
                        gain = p * (math.log2(p / int(m.sum())) - before)
                        if gain > best[0]:
                            best = (gain, (name, op, at), m)
        if best[1] is None:
            break
        rule.conditions.append(best[1])
        inside = best[2]
    return rule


def _prune(rule: Rule, cols: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float]:
    """The prefix of the conditions with the best (p - n) / (p + n) on the pruning set, and its precision there."""
    best, worth, precision = rule, -2.0, 0.0
    for k in range(1, len(rule.conditions) + 1):
        r = Rule(rule.conditions[:k])
        m = r.mask(cols, len(bad))
        if m.any():
            p = float((bad & m).sum()) / float(m.sum())
            if 2 * p - 1 > worth:
                best, worth, precision = r, 2 * p - 1, p
    return best, precision


def learn_decision_list(rows: list[tuple], names: list[str], most_rules: int = 8, most_conditions: int = 4, precise: float = 0.8) -> list[Rule]:
    """Ordered rejecting rules from rows of (label, feature values); label 0 is what they cover.

    Every third row prunes, the others grow. No rows, or rows of one label only, give
    no rule, and every document is then kept.
    """
    if not rows:
        return []
    bad = np.array([r[0] == 0 for r in rows])
    cols = {n: np.array([r[k + 1] for r in rows], float) for k, n in enumerate(names)}
    third = np.arange(len(rows)) % 3 == 2
    found: list[Rule] = []
    left = np.ones(len(rows), bool)
    while len(found) < most_rules:
        g, p = left & ~third, left & third
        rule = _grow({n: v[g] for n, v in cols.items()}, bad[g], most_conditions)
        if not rule.conditions:
            break
        rule, precision = _prune(rule, {n: v[p] for n, v in cols.items()}, bad[p])
        covers = rule.mask(cols, len(rows)) & left
        if precision < precise or int(covers.sum()) < 5:
            break
        found.append(rule)
        left &= ~covers
    return found


def verdict(rules: list[Rule], s: Column) -> Column:
    """The decision list as an ordered CASE: false at the first rule that holds, else true."""
    exprs = features(s)
    out = None
    for r in rules:
        out = F.when(r.column(exprs), False) if out is None else out.when(r.column(exprs), False)
    return F.lit(True) if out is None else out.otherwise(True)


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[list[tuple], list[str]]:
    """At most max_train labelled rows with their features; base failures are left to the base rule.

    Labels null, or of an id that no document has, teach nothing.
    """
    sample = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__qr_id"), F.col("quality").alias("__qr_q"))
    sample = sample.orderBy(F.xxhash64("__qr_id"), "__qr_q").limit(max_train)
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__qr_id"))
    x = with_signals(picked).filter(~base_failed(F.col("signals")))
    exprs = features(F.col("signals"))
    got = x.select("doc_id", "__qr_q", *[e.alias(n) for n, e in exprs.items()]).collect()
    got = sorted(tuple(r) for r in got)
    return [r[1:] for r in got], list(exprs)


def apply_rules(docs: DataFrame, rules: list[Rule], prefix: str = "") -> DataFrame:
    """docs plus `signals`, `base_failed` and `kept` (false if the base rule or the list rejects).

    prefix goes before the three names, where docs has such columns already; other columns stay as they are. Null and empty texts have no
    words and fail the base rule; null ids, repeated rows and texts of any length are judged like any other row; an empty table stays empty.
    """
    x = with_signals(docs, out=prefix + "signals")
    s = F.col(prefix + "signals")
    failed = base_failed(s)
    return x.withColumns({prefix + "base_failed": failed, prefix + "kept": ~failed & verdict(rules, s)})


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_decision_list(*training_rows(docs, table(spark, sf_dir, "labels")))
    s = F.col("signals")
    return apply_rules(docs, rules).select("doc_id", s["n_words"].alias("n_words"), *[s[c].alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go.

    Null and empty texts have no words and go; null ids, repeated rows and very long texts are judged like any other row; an empty table
    stays empty; the columns of docs stay as they are, whatever their names.
    """
    rules = learn_decision_list(*training_rows(docs, table(spark, sf_dir, "labels")))
    return apply_rules(docs, rules, "__qr_").filter("__qr_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
