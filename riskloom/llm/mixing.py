"""Mixing sources to target weights by weighted sampling without replacement.

A source's target is its share of the mix by weight, at most CAP times its size; what is cut off goes to the others by
weight. Of each source the mix takes all documents for as many complete epochs as fit into the target. The rest is a
sample after Efraimidis and Spirakis: a document of quality weight w has the key -ln(u) / w with u from a hash of its
id, documents of a source are sorted by key, and those up to the remaining budget are taken, by prefix sums of their sizes.

Prefix sums don't gather a source in one task: documents are dealt by ranges of (source, key), sums of the ranges
before are a small table, and only a range is summed in order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import materialize, partitions, table

WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Weights of the sources in their order, over and over; the mix's size and a source's largest target, in sizes.
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
CAP = Fraction(2)
LEAST_QUALITY = 0.05


def quality(text: Column) -> Column:
    """Share of lines that repeat no other, times the share left by symbols (ten for each one); LEAST_QUALITY at least, 1 for texts without lines."""
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    value = (F.size(F.array_distinct(lines)).cast("double") / F.size(lines)) * (F.lit(1.0) - (F.lit(10.0) * symbols) / F.length(text))
    return F.when(F.size(lines) > 0, F.greatest(F.lit(LEAST_QUALITY), value)).otherwise(1.0)


def uniform(doc_id: Column) -> Column:
    """A number between 0 and 1 from a hash of the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sources: DataFrame, share: Fraction, cap: Fraction) -> DataFrame:
    """sources (…, source_size, w) plus target double: w's share of all sizes times share, no more than cap times source_size, the excess to the others.

    Each round shares what capped sources leave among the rest; those whose share is above their cap are capped, until there is none. A round
    brings one row to the driver.
    """
    unit = math.lcm(share.denominator, cap.denominator)
    n_share, n_cap = int(share * unit), int(cap * unit)
    big = lambda c: c.cast("decimal(38,0)")
    total, weights = sources.agg(F.sum("source_size"), F.sum("w")).first()
    rest, level = n_share * (total or 0), weights or 1
    while True:
        above = big(F.col("w")) * big(F.lit(str(rest))) > big(F.col("source_size")) * big(F.lit(str(n_cap * level)))
        size, w = sources.filter(above).agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
        now = n_share * (total or 0) - n_cap * size, (weights or 1) - w
        if now == (rest, level) or not now[1]:
            break
        rest, level = now
    even = (F.lit(rest) * F.col("w")).cast("double") / F.lit(float(unit * level))
    return sources.withColumn("target", F.when(above, (F.lit(n_cap) * F.col("source_size")).cast("double") / F.lit(float(unit))).otherwise(even))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, cap: Fraction = CAP, weight: Column | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken, epochs) for each row of docs; weight is the quality weight of a row, above 0.

    size counts words; sources take weights in the order of their code points, null last, over and over, and share times all sizes.
    taken is size times the epochs that the mix reads the document for: the complete ones, and one more for a sampled document. The sample ends with the
    document that brings it nearest to its budget, so a source misses its target by half a document at most.

    Null and empty texts have no size and none is taken; null sources are one source; a null doc_id draws as an empty one; repeated rows are documents of
    their own, ties of keys go by doc_id, then size, so reruns agree; texts of any length count whole; an empty table gives no rows; other
    columns are not carried, whatever their names.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    key = -F.log(uniform(F.col("doc_id"))) / (quality(text) if weight is None else weight)
    sized = docs.select("doc_id", F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("s"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key"))
    sized = materialize(sized, "sized")  # texts are read once; finding the ranges reads this
    by = ["none", "s"]
    dealt = sized.repartitionByRange(partitions(spark), *by, "key", "doc_id", "size").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "dealt")
    parts = materialize(dealt.groupBy("part", *by).agg(F.sum("size").alias("m")), "parts")
    # Sources in their order: those that begin in a range stand behind those that begin in ranges before. Ranges are few, and no source has more parts than that.
    sources = parts.groupBy(*by).agg(F.sum("m").alias("source_size"), F.min("part").alias("first"))
    begun = sources.groupBy("first").agg(F.count("*").alias("k"))
    begun = begun.select("first", (F.sum("k").over(Window.orderBy("first")) - F.col("k")).alias("earlier"))
    rank = F.row_number().over(Window.partitionBy("first").orderBy(*by)) - 1
    sources = sources.withColumn("rank", rank).join(begun, "first").withColumn("rank", F.col("rank") + F.col("earlier"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    sources = targets(materialize(sources.select(*by, "source_size", w.alias("w")), "sources"), share, cap)
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("offset", F.coalesce(F.sum("m").over(earlier), F.lit(0))).join(sources, by).select("part", *by, "offset", "source_size", "target")
    before = F.sum("size").over(Window.partitionBy("part", *by).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") + F.col("offset")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    out = dealt.join(offsets, ["part", *by]).withColumns({"before": before, "whole": whole})
    budget = F.col("target") - F.col("whole") * F.col("source_size")
    sampled = (F.col("size") > 0) & (2 * F.col("before") + F.col("size") <= 2 * budget)
    out = out.withColumn("epochs", F.when(F.col("size") > 0, F.col("whole") + sampled.cast("long")).otherwise(0).cast("long"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size")).alias("taken"), "epochs")


def op11_source_mix(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
