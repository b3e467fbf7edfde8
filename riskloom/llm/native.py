"""Native column helpers that operators share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def once(value: Column) -> Column:
    """value, marked so that the optimizer computes it in one place.

    A filter above would else be pushed below the projections with their expressions put in
    its place, even inside lambdas, where they would run once for each element.
    A partition's number is never below 0, so the value itself never changes.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def eight_hashes(words: str, name: str, df):
    """df plus column name: hashes of the windows of eight of the column words, by their first word; none of a shorter array.

    Words are hashed once, then pairs, fours and eights are hashed from two hashes each, so that a
    window costs three hashes of two numbers and not one of eight strings.
    """
    level = "__" + name
    df = df.withColumn(level, once(F.transform(words, lambda w: F.xxhash64(w))))
    for step in (1, 2, 4):
        h = F.col(level)
        joined = F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - step, F.lit(0))), F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))
        df = df.withColumn(level, once(joined))
    return df.withColumnRenamed(level, name)
