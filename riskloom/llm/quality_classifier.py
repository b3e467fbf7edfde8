"""Quality scores by nearest-neighbour voting in a latent semantic space.

Texts become tf-idf vectors over frequent words and word shapes (letters, digits and marks in a row) and a
few measures of repetition and length; a truncated SVD of the labelled sample gives the latent
space. The labelled vectors are broadcast (their number is bounded), every document takes exact
cosines with all of them, block by block, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import materialize, slices, small_batches, table, tidied
from riskloom.llm.language_id import remainder

MAX_TRAIN = 6000
VOCABULARY = 3000
RANK = 48
NEIGHBOURS = 25
MEASURES = 8
THRESHOLD = 0.3
_SHAPE = bytes(0 if 97 <= c <= 122 or 65 <= c <= 90 or c >= 128 else 1 if 48 <= c <= 57 else c for c in range(256))


def _shape(word: bytes) -> bytes:
    """b'\\0' for letters, b'\\1' for digits, marks as they are; runs of one kind once, eight at most."""
    out = bytearray()
    for c in word.translate(_SHAPE):
        if not out or out[-1] != c:
            out.append(c)
    return b"\x02" + bytes(out[:8])


class _Shapes(dict):
    def __missing__(self, word: bytes) -> bytes:
        value = _shape(word)
        if len(self) < 300_000:
            self[word] = value
        return value


_shapes = _Shapes()


def _forget() -> None:
    _shapes.clear()


def token_counts(text: str | None) -> tuple[Counter, list[float]]:
    """Counts of words and shapes of a whole text, and its measures."""
    raw = (text or "").encode()
    words = raw.lower().split()
    counts = Counter(words)
    n, distinct = len(words), len(counts)
    shapes: Counter = Counter()
    for w, c in counts.items():
        shapes[_shapes[w]] += c
    lines = [x for x in raw.split(b"\n") if x.strip()]
    top = max(counts.values(), default=0)
    measures = [
        1.0 if n == 0 else 0.0,
        1.0 if n < 20 else 0.0,
        distinct / math.sqrt(n) / 20 if n else 0.0,
        1 - distinct / n if n else 0.0,
        top / n if n else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        min(1.0, len(raw) / n / 20) if n else 0.0,
        shapes.get(b"\x02\x00", 0) / n if n else 0.0,
    ]
    return counts + shapes, measures


class LatentSpace:
    def __init__(self, index: dict[bytes, int], idf: np.ndarray, basis: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.index, self.idf, self.basis, self.vectors, self.labels = index, idf, basis, vectors, labels

    def project(self, counts: Counter, measures: list[float]) -> np.ndarray:
        at, val = sparse(self.index, counts)
        return unit(weigh(self.idf, at, val, measures) @ self.basis[np.concatenate([at, np.arange(len(self.idf), len(self.idf) + MEASURES)])])


def sparse(index: dict[bytes, int], counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    known = index.keys() & counts.keys()
    return np.array([index[w] for w in known], np.int64), np.array([counts[w] for w in known], np.float64)


def weigh(idf: np.ndarray, at: np.ndarray, val: np.ndarray, measures: list[float]) -> np.ndarray:
    x = (1 + np.log(val)) * idf[at] if len(at) else np.zeros(0)
    return np.concatenate([unit(x), np.array(measures)])


def unit(x: np.ndarray) -> np.ndarray:
    n = float(np.linalg.norm(x))
    return x / n if n else x


def truncated_svd(x: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """Right singular vectors (columns), by subspace iteration from a random start."""
    rank = min(rank, *x.shape)
    q = np.random.default_rng(seed).standard_normal((x.shape[1], rank + min(10, x.shape[1] - rank)))
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T)[:, :rank]


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> LatentSpace | None:
    """The space and the labelled vectors, from at most max_train rows that aren't held out; None without any.

    The rows are those with the smallest hash of their id; null labels and null ids teach nothing; a document that stands
    twice, or has two labels, teaches twice.
    """
    lab = labels.filter(F.col("quality").isNotNull() & (remainder(F.col("doc_id"), 5) != 0)).select(F.col("doc_id").alias("__qc_id"), F.col("quality").alias("__qc_q"))
    lab = lab.orderBy(F.xxhash64("__qc_id"), "__qc_q").limit(max_train)
    picked = docs.select("doc_id", "text").join(F.broadcast(lab), F.col("doc_id") == F.col("__qc_id")).select("doc_id", "__qc_q", "text")
    picked = materialize(picked, "labelled")  # max_train rows, read three times

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in slices(batches):
            for text in b.column(2).to_pylist():
                seen.update(token_counts(text)[0].keys())
        yield pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])

    frequent = picked.mapInArrow(tidied(tokens, _forget), "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).filter("n >= 3").orderBy(F.desc("n"), "w").limit(VOCABULARY).collect()
    index = {bytes(r["w"]): k for k, r in enumerate(frequent)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at, val, mea = [], [], []
            for text in b.column(2).to_pylist():
                counts, m = token_counts(text)
                a, v = sparse(index, counts)
                at.append(a.tolist())
                val.append(v.tolist())
                mea.append(m)
            yield pa.record_batch([b.column(0), b.column(1).cast(pa.int32()), pa.array(at, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float64())), pa.array(mea, pa.list_(pa.float64()))], names=["doc_id", "q", "at", "val", "mea"])

    got = sorted(picked.mapInArrow(tidied(rows, _forget), f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, q int, at array<int>, val array<double>, mea array<double>").collect(), key=lambda r: (r["doc_id"], r["q"]))
    if not got:
        return None
    df = np.ones(len(index))
    for r in got:
        df[np.array(r["at"], np.int64)] += 1
    idf = np.log((1 + len(got)) / df) + 0.1
    x = np.zeros((len(got), len(index) + MEASURES))
    for k, r in enumerate(got):
        at = np.array(r["at"], np.int64)
        x[k, np.concatenate([at, np.arange(len(index), len(index) + MEASURES)])] = weigh(idf, at, np.array(r["val"]), r["mea"])
    basis = truncated_svd(x, RANK)
    z = x @ basis
    norms = np.linalg.norm(z, axis=1, keepdims=True)
    return LatentSpace(index, idf, basis, (z / np.where(norms == 0, 1, norms)).astype(np.float32), np.array([r["q"] for r in got], np.float32))


def classify(docs: DataFrame, space: LatentSpace | None) -> DataFrame:
    """(doc_id, score) for each row; 0.5 where nothing could be learned.

    Null texts count as empty; a null doc_id stays null; repeated rows give repeated results; texts of any length count whole; ties among
    neighbours go by their order in the sample; an empty table gives no rows; other columns are not carried.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(space)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in slices(batches, 128):
            texts = b.column(1).to_pylist()
            if m is None:
                score = np.full(len(texts), 0.5)
            else:
                z = np.stack([m.project(*token_counts(t)) for t in texts]).astype(np.float32)
                cos = z @ m.vectors.T
                k = min(NEIGHBOURS, cos.shape[1])
                near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
                weight = np.maximum(np.take_along_axis(cos, near, 1), 0) ** 2 + 1e-9
                score = (weight * m.labels[near]).sum(1) / weight.sum(1)
            yield pa.record_batch([b.column(0), pa.array(np.clip(score.astype(np.float64), 0, 1))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(tidied(run, _forget), f"doc_id {kind}, score double")


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    x = classify(docs, learn(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return x.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
