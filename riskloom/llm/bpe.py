"""BPE encoding and decoding over a contiguous rank array.

A pre-token ("word") is a byte string. Its parts are kept as one contiguous
list of boundaries beside one contiguous list of ranks, where ``ranks[i]`` is
the merge rank of part i with part i + 1. Each round scans the ranks for the
minimum, deletes the boundary between the two parts and refreshes the ranks
left and right of it. For short words this beats any linked structure, because
the scan runs in C over a few machine words; words beyond ``SHORT`` bytes (no
white space for pages) go through a heap over linked parts, which gives the
same merges in O(n log n).

Words repeat, so finished words are kept in a bounded cache while a task runs.
"""

from __future__ import annotations

import functools
import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import slices, small_batches, table, tidied

#: Pre-token pattern of byte-level BPE vocabularies (a fixed value).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = 1 << 60
SHORT = 96
#: Entries of either cache; a full one starts anew, and both end with the task. Words behind a space stand in one of them only.
CACHE_WORDS = 400_000


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in byte order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    shown = {chr(b): b for b in plain}
    rest = sorted(set(range(256)) - set(plain))
    return shown | {chr(256 + k): b for k, b in enumerate(rest)}


class _Loose(Exception):
    """A chunk that is empty or has white space at an end."""


class _Chunks(dict):
    """Ids of a space and the chunk after it."""

    def __init__(self, vocabulary: RankedVocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Loose
        if chunk.isascii() and chunk.isalpha():  # one pre-token
            ids = self.vocabulary.encode_word(" " + chunk)
        else:
            ids = self.vocabulary.encode_run(" " + chunk)
        keep(self, chunk, ids)
        return ids


def keep(cache: dict[str, bytes], key: str, ids: bytes) -> None:
    if len(key) <= 64:
        if len(cache) >= CACHE_WORDS:
            cache.clear()
        cache[key] = ids


class RankedVocabulary:
    """A byte-level BPE vocabulary read from a tokenizer file's content."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        to_byte = byte_symbols()
        raw = lambda s: bytes(to_byte[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        self.ids = {raw(k): v for k, v in vocab.items()}
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for n, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[raw(left), raw(right)] = n
        #: A token is made by one merge only: its rank, and the length of that merge's left part.
        self.joined = {a + b: n for (a, b), n in self.rank.items()}
        self.left = [len(a) for a, _ in self.rank]
        #: Ranks of two bytes, by their values.
        self.first = [self.joined.get(bytes(divmod(k, 256)), NEVER) for k in range(1 << 16)]
        if len(self.joined) != len(self.rank):
            raise ValueError("two merges make the same token")
        self.bytes_of = {v: k for k, v in self.ids.items()} | {v: k.encode() for k, v in self.special.items()}
        self.words = regex.compile(WORD_PATTERN).findall
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.cache: dict[str, bytes] = {}
        self.chunks = _Chunks(self)

    def merge_short(self, word: bytes) -> list[bytes]:
        n, get, left, first = len(word), self.joined.get, self.left, self.first
        bounds = list(range(n + 1))
        ranks = [first[a << 8 | b] for a, b in zip(word, word[1:])]
        while ranks and (least := min(ranks)) != NEVER:
            i = ranks.index(least)
            del bounds[i + 1], ranks[i]
            at = bounds[i]
            if i:
                was = bounds[i - 1]
                r = get(word[was : bounds[i + 1]], NEVER)
                ranks[i - 1] = r if r == NEVER or left[r] == at - was else NEVER
            if i < len(ranks):
                r = get(word[at : bounds[i + 2]], NEVER)
                ranks[i] = r if r == NEVER or left[r] == bounds[i + 1] - at else NEVER
        return [word[a:b] for a, b in zip(bounds, bounds[1:])]

    def merge_long(self, word: bytes) -> list[bytes]:
        n = len(word)
        end = list(range(1, n + 1))  # of the part that starts here, or 0 once it is swallowed
        before = list(range(-1, n - 1))
        rank = self.rank
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((word[i : i + 1], word[i + 1 : i + 2]), NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or rank.get((word[i:j], word[j : end[j]]), NEVER) != r:
                continue
            end[i], end[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
                if (q := rank.get((word[i : end[i]], word[end[i] : end[end[i]]]), NEVER)) != NEVER:
                    heapq.heappush(heap, (q, i))
            if (p := before[i]) >= 0 and (q := rank.get((word[p:i], word[i : end[i]]), NEVER)) != NEVER:
                heapq.heappush(heap, (q, p))
        return [word[i : end[i]] for i in range(n) if end[i]]

    def encode_word(self, word: str) -> bytes:
        raw = word.encode()
        parts = self.merge_short(raw) if len(raw) <= SHORT else self.merge_long(raw)
        return self.pack(len(parts))(*map(self.ids.__getitem__, parts))

    @staticmethod
    @functools.cache
    def pack(n: int):
        return struct.Struct(f"<{n}I").pack

    def encode_run(self, text: str) -> bytes:
        """A text without special tokens, by pre-tokens."""
        cache, chunks, out = self.cache, self.chunks, []
        for word in self.words(text):
            if len(word) > 1 and word[0] == " " and not word[1].isspace():
                held, key = chunks, word[1:]
            else:
                held, key = cache, word
            ids = held.get(key)
            if ids is None:
                ids = self.encode_word(word)
                keep(held, key, ids)
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A chunk between two single spaces that has no white space at its ends
        is cut into pre-tokens in the same way wherever it stands, the space
        before it included; so whole chunks are looked up. Other texts go
        through the pattern as they are.
        """
        out, chunks = [], self.chunks
        for k, run in enumerate(self.marks.split(text) if any(m in text for m in self.special) else [text]):
            if k % 2:
                out.append(self.pack(1)(self.special[run]))
                continue
            first, *rest = run.split(" ")
            if not rest or (first and first[-1].isspace()):
                out.append(self.encode_run(run))
                continue
            try:
                ids = b"".join(map(chunks.__getitem__, rest))
                out.append(self.encode_run(first))
                out.append(ids)
            except _Loose:
                out.append(self.encode_run(run))
        return b"".join(out)

    def forget(self) -> None:
        """Frees the caches: a worker lives on after the task, and what it holds adds to that of other tasks."""
        self.cache.clear()
        self.chunks.clear()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_loaded: dict[int, RankedVocabulary] = {}


def vocabulary(content: Broadcast) -> RankedVocabulary:
    """The worker's copy: parsed once per process."""
    key = hash(content.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = RankedVocabulary(content.value)
    return _loaded[key]


def load_vocabulary(spark, path: str) -> Broadcast:
    """The tokenizer file (a few MB, fixed size) as a broadcast."""
    small_batches(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def bpe_encode(df: DataFrame, vocab: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens long, ids binary): every whole text encoded, no shuffle.

    ``ids`` packs the token ids as little-endian unsigned 32-bit integers.
    A null text counts as empty and gives no tokens; a null id is kept;
    repeated rows give repeated results; texts of any length are encoded whole; an empty table
    gives no rows; other columns are not carried, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(vocab)
        try:
            for b in slices(batches):
                ids = [v.encode(t) if t else b"" for t in b.column(1).to_pylist()]
                yield pa.record_batch([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=[id_col, "n_tokens", "ids"])
        finally:
            v.forget()

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(tidied(run), f"`{id_col}` {kind}, n_tokens long, ids binary")


def bpe_decode(df: DataFrame, vocab: Broadcast, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids, decoded string) from the output of bpe_encode; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(vocab)
        for b in slices(batches):
            texts = [v.decode(x) if x else "" for x in b.column(2).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(texts, pa.string())], names=[id_col, "n_tokens", "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, "n_tokens", "ids").mapInArrow(tidied(run), f"`{id_col}` {kind}, n_tokens long, ids binary, decoded string")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token count and digests of ids and decoded text, for every document."""
    return digest(table(spark, sf_dir, "documents"), path)


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of docs.

    Null and empty texts have no tokens and the digests of nothing; null ids and repeated rows stay, one result for each
    row; long texts are encoded whole; an empty table gives no rows; columns beside doc_id and text are left out.
    """
    vocab = load_vocabulary(docs.sparkSession, path or tokenizer_path())
    return bpe_decode(bpe_encode(docs, vocab), vocab).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
