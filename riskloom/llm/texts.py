"""Texts brought to the rows that want them, each text shuffled once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import materialize, partitions

#: Rows that one copy of a text serves.
CELL = 256
#: Texts wanted by more rows than that whose list is broadcast at most; a longer list is joined.
BROADCAST_HOT = 100_000


def beside_texts(wanted: DataFrame, docs: DataFrame, by: list[str]) -> DataFrame:
    """wanted (want, ...) and the texts of docs (doc_id, text) in one order: (want, salt, role, ..., text).

    For every want and salt a row of role 0 with its text comes first (one for each of the rows of a doc_id), then those of role 1 that want
    it. A text that many rows want is copied once for CELL of them, dealt by a hash of the columns by, so no task reads all rows of a
    hot text, and no text is copied for every row. Texts that no row wants are read past.
    """
    payload = [c for c in wanted.columns if c != "want"]
    hot = wanted.groupBy("want").agg(F.ceil(F.count("*") / CELL).alias("cells")).filter("cells > 1")
    hot = materialize(hot, "hot")
    if hot.count() <= BROADCAST_HOT:
        hot = F.broadcast(hot)
    cells = F.coalesce("cells", F.lit(1).cast("long"))
    rows = wanted.join(hot, "want", "left").select("want", F.pmod(F.xxhash64(*by), cells).alias("salt"), F.lit(1).alias("role"), *payload, F.lit(None).cast("string").alias("text"))
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").join(hot, docs["doc_id"] == hot["want"], "left")
    nothing = [F.lit(None).cast(wanted.schema[c].dataType).alias(c) for c in payload]
    texts = texts.select(F.col("doc_id").alias("want"), F.explode(F.sequence(F.lit(0).cast("long"), cells - 1)).alias("salt"), F.lit(0).alias("role"), *nothing, "text")
    return rows.union(texts).repartition(partitions(docs.sparkSession), "want", "salt").sortWithinPartitions("want", "salt", "role")
