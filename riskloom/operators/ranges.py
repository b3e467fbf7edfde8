"""Orders that no task sees whole: rows dealt by ranges of keys, small tables of what stands before each range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.session import shared_folder


def dealt(df: DataFrame, order: list[str]) -> DataFrame:
    """df with __part, the number of the range of order that a row stands in; ranges ascend, and equal rows share one.

    There are as many ranges as shuffle partitions, of about as many rows each. They are written below the shared folder, since what is
    said of a range has to be of the same rows each time.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    path = shared_folder(spark, "ranges")
    x.write.parquet(path)
    return spark.read.schema(x.schema).parquet(path)


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with its rank by order, from 0, as column name: the rank in a range, plus the rows of the ranges before."""
    x = dealt(df, order)
    counts = x.groupBy("__part").agg(F.count("*").alias("__m"))
    before = counts.select("__part", (F.sum("__m").over(Window.orderBy("__part")) - F.col("__m")).alias("__before"))  # a row for each range
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return x.withColumn("__in_part", rank).join(before, "__part").withColumn(name, F.col("__in_part") + F.col("__before")).drop("__part", "__in_part", "__before")


def with_previous(df: DataFrame, key: str, order: str, values: dict[str, str]) -> DataFrame:
    """df with values of the row before by key and order, and __first where there is none; values names a new column for each old one.

    A key's rows may be of any number: they stand in as many ranges as they fill, and a range takes over the last values of the one before it.
    """
    x = dealt(df, [key, order])
    last = F.max(F.struct(F.col(order), *[F.col(c) for c in values])).alias("__last")
    ends = x.groupBy("__part", key).agg(last)
    taken = F.lag("__last").over(Window.partitionBy(key).orderBy("__part"))  # a row for each range of a key
    ends = ends.select("__part", key, taken.alias("__taken"))
    w = Window.partitionBy("__part", key).orderBy(order)
    inner = {f"__in_{c}": F.lag(c).over(w) for c in values}
    x = x.withColumns({**inner, "__n": F.row_number().over(w)}).join(ends, ["__part", key])
    head = F.col("__n") == 1
    new = {name: F.when(head, F.col(f"__taken.{c}")).otherwise(F.col(f"__in_{c}")) for c, name in values.items()}
    x = x.withColumns({**new, "__first": head & F.col("__taken").isNull()})
    return x.drop("__part", "__n", "__taken", *inner)


def first_rows(df: DataFrame, key: str, order: str, k: int, rank: str) -> DataFrame:
    """The first k rows of each key by order, with their rank from 1; a task passes k rows of a key on at most, however many it has."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(key).orderBy(order))).filter(F.col(rank) <= k)
