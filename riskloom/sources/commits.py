"""Inserts of new keys that survive replays and concurrent writers.

A table is a folder: rows lie in data/<name>, and commits/<number>.json names the folders that count, one for each insert, beside the
batch that it came from. An insert stages its rows, then claims the next number, which one writer only can. Who finds the number taken drops the
keys that the other writers have inserted since and tries the next one. Rows of inserts that never got a number are seen by nobody.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass
class State:
    """What a table held when it was read: the next number, the folders by commit, and the batches that are in."""

    next: int = 0
    folders: list[str] = field(default_factory=list)
    batches: set[str] = field(default_factory=set)


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_state(spark: SparkSession, table: str) -> State:
    """All commits: a small file for each insert, read as rows by Spark."""
    _, p, fs = _hadoop(spark, f"{table}/commits")
    if not fs.exists(p) or not fs.listStatus(p):
        return State()
    rows = spark.read.schema("number long, folder string, batch string").json(f"{table}/commits/*.json").filter("number IS NOT NULL").orderBy("number").collect()
    return State(rows[-1]["number"] + 1 if rows else 0, [r["folder"] for r in rows if r["folder"]], {r["batch"] for r in rows})


def read_table(spark: SparkSession, table: str, schema) -> DataFrame:
    """The rows of all commits."""
    return _rows(spark, table, read_state(spark, table).folders, schema)


def _rows(spark: SparkSession, table: str, folders: list[str], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{table}/{x}" for x in folders]) if folders else spark.createDataFrame([], schema)


def claim(spark: SparkSession, table: str, number: int, folder: str | None, batch: str) -> bool:
    """Whether this writer got the number: the store makes the file only if there is none.

    On one machine the file is first written whole under another name, then linked, which fails if the name is taken. Other stores have
    to make exclusive creation atomic, as HDFS does.
    """
    text = json.dumps({"number": number, "folder": folder, "batch": batch})
    path = f"{table}/commits/{number:012d}.json"
    jvm, p, fs = _hadoop(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":
        place = p.toUri().getPath()
        part = f"{os.path.dirname(place)}/.{uuid.uuid4().hex}"
        with open(part, "w") as f:
            f.write(text)
        try:
            os.link(part, place)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
    try:
        out = fs.create(p, False)
    except Exception as e:
        if "AlreadyExists" in str(e):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def insert_new(df: DataFrame, table: str, key: str, batch: str, tries: int = 100) -> bool:
    """Adds the rows of df whose key the table doesn't hold; False if that batch is in already.

    All rows of a new key go in, so what belongs to a key has to come in one insert. Null keys are never inserted. A batch without new keys is
    recorded, too, so that its replay is known for one. With streams: ``writeStream.foreachBatch(lambda df, n: insert_new(df, table, key, f"{name}-{n}"))``.
    """
    spark, schema = df.sparkSession, df.schema
    state = read_state(spark, table)
    if batch in state.batches:
        return False
    known = _rows(spark, table, state.folders, schema).select(key).distinct()
    folder = f"data/{uuid.uuid4().hex}"
    df.filter(F.col(key).isNotNull()).join(known, key, "left_anti").select(*df.columns).write.parquet(f"{table}/{folder}")
    for _ in range(tries):
        if claim(spark, table, state.next, folder, batch):
            return True
        now = read_state(spark, table)
        if batch in now.batches:
            return False
        since = _rows(spark, table, [x for x in now.folders if x not in state.folders], schema).select(key).distinct()
        again = f"data/{uuid.uuid4().hex}"
        spark.read.schema(schema).parquet(f"{table}/{folder}").join(since, key, "left_anti").select(*df.columns).write.parquet(f"{table}/{again}")
        state, folder = now, again
    raise RuntimeError(f"no commit after {tries} tries")

