"""A corpus pipeline: five operators in a row, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, decontaminate, jaccard_join, quality_rules, substring_dedup
from riskloom.llm.common import materialize, table


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token count and digests of every text that is left.

    A row for each row of docs: null and empty texts have no tokens, null ids and repeated rows stay, long texts are encoded whole;
    an empty table gives no rows; further columns, whatever their names, are left out.
    """
    return bpe.digest(docs)


STAGES = [
    ("quality_rules", quality_rules.stage),
    ("jaccard_join", jaccard_join.stage),
    ("substring_dedup", substring_dedup.stage),
    ("decontaminate", decontaminate.stage),
    ("bpe", encode),
]

#: The stages learn, search and encode: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage on all that the one before it kept of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
