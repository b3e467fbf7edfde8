"""Language identification with hyperdimensional profiles.

Every letter has a random bipolar vector. A trigram binds its letters: the element-wise product
of the first letter's vector permuted twice, the second's permuted once, and the third's. A text
bundles (adds) its trigrams, a language bundles texts, and a text belongs to the
language whose bundle has the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import slices, small_batches, table, tidied

DIM = 1024
SEED = 20_240_601
#: Texts per language that a profile is bundled from, in expectation (all, where there are fewer).
MAX_PER_LANG = 1000
CACHE = 40_000


class Encoder:
    """Trigram vectors, made when first met and kept while there is room."""

    def __init__(self, dim: int = DIM):
        self.dim = dim
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.held = np.zeros((1024, dim), np.int8)
        self.alpha = np.array([chr(c).isalpha() for c in range(0x3000)])

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            self.letters[c] = np.random.default_rng([SEED, c]).integers(0, 2, self.dim, np.int8) * 2 - 1
        return self.letters[c]

    def row(self, code: int) -> int:
        n = len(self.rows)
        if n == len(self.held):
            self.held = np.concatenate([self.held, np.zeros_like(self.held)])
        a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
        self.held[n] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
        self.rows[code] = n
        return n

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Codes and counts of the trigrams of a text; whatever is no letter parts words, as one blank."""
        c = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype(np.int64)
        low = c < len(self.alpha)
        ok = low & self.alpha[np.where(low, c, 0)]
        if not low.all():
            ok[~low] = [chr(x).isalpha() for x in c[~low].tolist()]
        if not ok.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        c = np.concatenate([[32], np.where(ok, c, 32), [32]])
        c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
        return np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:], return_counts=True)

    def encode(self, text: str | None) -> np.ndarray | None:
        """The text's bundle, of length 1; None if it has no letter."""
        codes, counts = self.trigrams(text or "")
        if not len(codes):
            return None
        if len(self.rows) > CACHE:
            self.rows.clear()
        get = self.rows.get
        at = [r if (r := get(x)) is not None else self.row(x) for x in codes.tolist()]
        v = np.zeros(self.dim, np.float32)
        for k in range(0, len(at), 4096):
            v += counts[k : k + 4096].astype(np.float32) @ self.held[at[k : k + 4096]].astype(np.float32)
        norm = float(np.linalg.norm(v))
        return v / norm if norm else v


def remainder(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def learn_profiles(docs: DataFrame, max_per_lang: int = MAX_PER_LANG, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages and their profiles, from rows with a text, a lang and an id that isn't held out.

    Each language gives max_per_lang rows in expectation, chosen by a hash of the id. Repeated rows teach as often as they stand;
    a null id is never held out; an empty table has no languages.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), 3) != 1)).select("doc_id", "lang", "text")
    share = known.groupBy("lang").agg((F.lit(float(max_per_lang)) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    # One row per language, as many as the profiles that the driver holds below; texts are not shuffled for it.
    picked = known.join(F.broadcast(share), "lang").filter(draw < F.col("share")).select("lang", "text")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, sums = Encoder(dim), {}
        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if (v := e.encode(text)) is not None:
                    sums[lang] = sums[lang] + v if lang in sums else v
        yield pa.record_batch([pa.array(list(sums), pa.string()), pa.array([s.astype(np.float64).tobytes() for s in sums.values()], pa.binary())], names=["lang", "v"])

    def total(t: pa.Table) -> pa.Table:
        """The sum of a language's bundles, a row for each of its sampled texts at most."""
        v = np.sum([np.frombuffer(x, np.float64) for x in t.column("v").to_pylist()], axis=0)
        return pa.table({"lang": pa.array([t.column("lang")[0].as_py()], pa.string()), "v": pa.array([v.tobytes()], pa.binary())})

    parts = picked.mapInArrow(tidied(bundle), "lang string, v binary")
    rows = parts.groupBy("lang").applyInArrow(total, "lang string, v binary").collect()  # a profile for each language
    sums = {r["lang"]: np.frombuffer(r["v"], np.float64) for r in rows}
    langs = sorted(sums)
    return langs, np.array([sums[x] / np.linalg.norm(sums[x]) for x in langs]).reshape(len(langs), dim)


def identify(docs: DataFrame, langs: list[str], profiles: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) for each row; `und` with score 0 for null texts and texts without letters.

    Ties go to the first language by name; repeated rows give repeated results; a null doc_id stays null; texts of any length count whole;
    an empty table gives no rows; other columns are not carried.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast((langs, profiles.astype(np.float32)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, p = model.value
        e = Encoder(p.shape[1])
        for b in slices(batches):
            pred, score = [], []
            for text in b.column(1).to_pylist():
                v = e.encode(text) if names else None
                if v is None:
                    pred.append("und")
                    score.append(0.0)
                else:
                    cos = p @ v
                    k = int(cos.argmax())
                    pred.append(names[k])
                    score.append(float(min(1.0, max(0.0, cos[k]))))
            yield pa.record_batch([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(tidied(run), f"doc_id {kind}, lang_pred string, score double")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    x = identify(docs, *learn_profiles(docs))
    return x.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
