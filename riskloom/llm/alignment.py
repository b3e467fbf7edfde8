"""Alignment of two tokenizers over the same texts.

Tokens of both are nodes of a bipartite graph; two are linked where their byte ranges overlap.
Its connected components, found by union-find, are exactly the groups between neighbouring byte offsets at which tokens of both
end. The members of a component expand into links, and links are counted by id pair over the corpus.

Both tokenizers start a token at a blank that stands alone before something visible: the pattern of the one starts a word there,
and no piece of the other holds a blank behind another character. So the graph of a text falls apart into those of its
chunks, a blank and what follows it, and a chunk that was met before keeps its components. Links stand beside
their document in the shared folder; only sums by id pair are shuffled.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.bpe import WORD_PATTERN, RankedVocabulary, tokenizer_path
from riskloom.llm.common import materialize, slices, small_batches, table, tidied

#: Chunks whose components a task keeps; a full cache starts anew.
CACHE_CHUNKS = 400_000
#: Characters of a long text that are cut into chunks at a time, about.
STRETCH = 1 << 20
#: Id pairs whose counts are broadcast at most (13 bytes each); links of rarer ones are joined.
BROADCAST_PAIRS = 1_000_000
#: Links that a task sorts at a time, and distinct pairs that it holds before it passes them on.
SORTED_LINKS = 2_000_000
#: Characters of a chunk that goes through the merges of a heap, whose time doesn't grow with the square of its length.
LONG_CHUNK = 400
_BLANK = "▁"
_BYTE = re.compile("<0x([0-9A-F]{2})>")
_LOOSE = re.compile(r" \s")
_CUT = re.compile(r"(?<! ) (?=\S)")


def components(n_a: int, n_b: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The component, as its first A node, of each of n_a nodes and of each of n_b; a[k] and b[k] are the ends of link k.

    Union-find on all links at once: roots that a link joins are hooked to the smaller one, then paths are halved until every node points to its root.
    """
    parent = np.arange(n_a + n_b)
    b = b + n_a
    while True:
        x, y = parent[a], parent[b]
        differ = x != y
        if not differ.any():
            return parent[:n_a], parent[n_a:]
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            upper = parent[parent]
            if np.array_equal(upper, parent):
                break
            parent = upper


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of two rows of tokens that cover the same bytes: A token, B token, and the offset where both have been covered.

    Each stretch between neighbouring offsets, of whichever tokens, is the overlap of one pair.
    """
    cuts = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts), cuts


class Chunks(dict):
    """Numbers of chunks, in the order in which they are met; fresh holds those that are not aligned yet."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.fresh.append(chunk)
        return number


class Aligner:
    """Chunks of texts, aligned; per task."""

    def __init__(self, ranks: bytes, pieces: bytes):
        self.a = RankedVocabulary(ranks)
        special = set(self.a.special.values())
        self.a.special = {}  # their strings are plain text
        mergeable = {x: k for k, x in self.a.bytes_of.items() if k not in special}
        merged = [self.a.ids[x] for x in self.a.joined]
        if merged != sorted(merged):
            raise ValueError("ids don't follow the order of the merges")
        # Ids are in the order of the merges, so the least id that two parts make is the least merge.
        self.quick = tiktoken.Encoding("a", pat_str=WORD_PATTERN, mergeable_ranks=mergeable, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(_BLANK in name.lstrip(_BLANK) for name in names):
            raise ValueError("a piece holds a blank behind another character")
        self.a_bytes = self.a.bytes_of
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(name)) else name.replace(_BLANK, " ").encode() for name in names]
        top = max(self.a_bytes) + 1
        self.n_b = len(names)
        self.link_type = np.dtype("<u4" if top * self.n_b <= 1 << 32 else "<u8")
        self.a_len = np.array([len(self.a_bytes.get(k, b"")) for k in range(top)])
        self.b_len = np.array([len(x) for x in self.b_bytes])
        # A token as it stands in a group, by what follows it: A before A, A before B, B before B, B before the next group.
        self.shown = np.array([f"{k}{end}" for n, ends in ((top, ",|"), (self.n_b, ",;")) for end in ends for k in range(n)], object)
        self.at = np.cumsum([0, top, top, self.n_b])
        self.forget()

    def forget(self) -> None:
        self.number = Chunks()
        self.counts = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, 1 if the bytes differ
        self.groups: list[str] = []
        self.links: list[bytes] = []
        self.a.forget()

    def tokens(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all chunks in a row, how many of each a chunk has, and which chunks neither gives back whole: these have none.

        A reads chunks that stand apart by single blanks as one text, if all of them give back their bytes.
        """
        raw = " ".join(["", *chunks])
        a = self.quick.encode_to_numpy(raw, disallowed_special=()).astype(np.int64)
        ids_b = self.b.encode(chunks, num_threads=1)
        n_b = np.fromiter(map(len, ids_b), np.int64, len(chunks))
        b = np.fromiter(itertools.chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
        whole = raw.encode()
        if int(self.a_len[a].sum()) == len(whole) and b"".join(map(self.b_bytes.__getitem__, itertools.chain.from_iterable(ids_b))) == whole:  # A's bytes stand for themselves
            ends_b = np.append(0, np.cumsum(self.b_len[b]))[np.cumsum(n_b)]
            n_a = np.diff(np.searchsorted(np.cumsum(self.a_len[a]), ends_b, "right"), prepend=0)
            return a, b, n_a, n_b, np.zeros(len(chunks), bool)
        return self.tokens_apart(chunks)

    def tokens_apart(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same, chunk by chunk."""
        quick = lambda c: self.quick.encode_ordinary(c) if len(c) <= LONG_CHUNK else np.frombuffer(self.a.encode_run(c), "<u4").tolist()
        ids_a = [quick(" " + c) for c in chunks]
        ids_b = self.b.encode(chunks, num_threads=1)
        broken = np.zeros(len(chunks), bool)
        for k, c in enumerate(chunks):
            raw = b" " + c.encode()
            if b"".join(map(self.b_bytes.__getitem__, ids_b[k])) != raw or b"".join(map(self.a_bytes.__getitem__, ids_a[k])) != raw:
                broken[k], ids_a[k], ids_b[k] = True, [], []
        n_a, n_b = (np.array([len(x) for x in ids]) for ids in (ids_a, ids_b))
        a, b = (np.array([i for x in ids for i in x], np.int64) for ids in (ids_a, ids_b))
        return a, b, n_a, n_b, broken

    def align(self, fresh: list[str]) -> None:
        """Adds the components of the chunks, each without the blank before it."""
        plain = [k for k, c in enumerate(fresh) if c and len(c) <= LONG_CHUNK and " " not in c and not c[0].isspace()]
        if len(plain) == len(fresh):
            self.add(fresh, *self.tokens(fresh))
            return
        other = sorted(set(range(len(fresh))) - set(plain))
        held = len(self.groups)
        counts = np.zeros((len(fresh), 4), np.int64)
        groups, links = [""] * len(fresh), [b""] * len(fresh)
        for some, tokens in ((plain, self.tokens), (other, self.tokens_apart)):
            if some:
                chunks = [fresh[k] for k in some]
                self.add(chunks, *tokens(chunks))
                counts[some] = self.counts[held:]
                for k, g, x in zip(some, self.groups[held:], self.links[held:]):
                    groups[k], links[k] = g, x
                self.counts = self.counts[:held]
                del self.groups[held:], self.links[held:]
        self.counts = np.concatenate([self.counts, counts])
        self.groups += groups
        self.links += links

    def add(self, chunks: list[str], a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, broken: np.ndarray) -> None:
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        link_a, link_b, cuts = overlaps(ends_a, ends_b)
        root_a, root_b = components(len(a), len(b), link_a, link_b)
        # A component's members stand in a row; components are numbered by their first A token.
        first = root_a == np.arange(len(a))
        group = np.cumsum(first) - 1
        group_a, group_b = group[root_a], group[root_b]
        # A's tokens of the groups before stand before a B token, and its own group's; B's of the groups before stand before an A token.
        per_a, per_b = np.bincount(group_a, minlength=1), np.bincount(group_b, minlength=1)
        place_a = np.arange(len(a)) + (np.cumsum(per_b) - per_b)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(per_a)[group_b]
        shown = np.empty(len(a) + len(b), np.int64)
        shown[place_a] = a + np.where(np.diff(group_a, append=-1) != 0, self.at[1], self.at[0])
        shown[place_b] = b + np.where(np.diff(group_b, append=-1) != 0, self.at[3], self.at[2])
        texts = self.shown[shown].tolist()
        tokens = np.cumsum(n_a + n_b).tolist()
        codes = (a[link_a] * self.n_b + b[link_b]).astype(self.link_type).tobytes()
        last_a = np.cumsum(n_a)
        chunk_ends = np.append(0, ends_a)[last_a]
        at = (np.searchsorted(cuts, chunk_ends, "right") * self.link_type.itemsize).tolist()
        n_groups = np.diff(np.append(0, np.cumsum(first))[last_a], prepend=0)
        self.groups += ["".join(texts[x:y]) for x, y in zip([0, *tokens], tokens)]
        self.links += [codes[x:y] for x, y in zip([0, *at], at)]
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, broken], axis=1)])

    def chunks(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text, a stretch at a time: cut at each blank between something that is no blank and something visible."""
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + STRETCH) if len(text) - at > STRETCH else None
            stretch = text[at : cut.start()] if cut else text[at:]
            parts = stretch.split(" ")
            if stretch[0].isspace() or stretch[-1] == " " or _LOOSE.search(stretch):
                # Blanks in a row, or before other white space, stay inside a chunk. Before the stretch stands the blank that leads it.
                parts = _CUT.split(" " + stretch)
                parts = parts[1:] if not parts[0] else [parts[0][1:], *parts[1:]]
            yield parts
            at = cut.end() if cut else len(text)

    def describe(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, bytes]]:
        """(n_a, n_b, n_groups, digest, links) of each text, zeros and empty where the tokens don't give back its bytes."""
        if len(self.number) > CACHE_CHUNKS:
            self.forget()
        number = self.number.__getitem__
        held = [[list(map(number, parts)) for parts in self.chunks(text)] for text in texts]
        if self.number.fresh:
            self.align(self.number.fresh)
            self.number.fresh = []
        sizes = [sum(map(len, x)) for x in held]
        flat = np.fromiter(itertools.chain.from_iterable(itertools.chain.from_iterable(held)), np.int64, sum(sizes))
        ends = np.cumsum(sizes)
        totals = np.cumsum(self.counts[flat], axis=0)
        totals = np.diff(np.concatenate([np.zeros((1, 4), np.int64), totals])[ends], axis=0, prepend=np.zeros((1, 4), np.int64))
        for stretches, (n_a, n_b, n_groups, broken) in zip(held, totals.tolist()):
            if broken or not stretches:
                yield 0, 0, 0, "", b""
                continue
            digest, last = hashlib.sha256(), ""
            for x in stretches:
                shown = last + "".join(map(self.groups.__getitem__, x))
                last = shown[-1:]
                digest.update(shown[:-1].encode())
            yield n_a, n_b, n_groups, digest.hexdigest(), b"".join(map(self.links.__getitem__, itertools.chain.from_iterable(stretches)))


_loaded: dict[int, Aligner] = {}


def aligner(files: Broadcast) -> Aligner:
    """The worker's copy: read once per process."""
    key = hash(files.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Aligner(*files.value)
    return _loaded[key]


def load_files(spark, ranks: str, pieces: str) -> Broadcast:
    """Both tokenizer files (some MB, fixed size) as a broadcast."""
    with open(ranks, "rb") as f, open(pieces, "rb") as g:
        return spark.sparkContext.broadcast((f.read(), g.read()))


def aligned(docs: DataFrame, files: Broadcast) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, groups_sha256, links) of each row of docs; links packs a code for each link, in the order of the text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(files)
        try:
            for b in slices(batches, 128):
                rows = list(zip(*al.describe([t or "" for t in b.column(2).to_pylist()])))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.record_batch([b.column(0), b.column(1), *(pa.array(x, k) for x, k in zip(rows, kinds))], names=names)
        finally:
            al.forget()

    plain = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return plain.mapInArrow(tidied(run), f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, links binary")


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their counts."""
    by = np.argsort(codes, kind="stable")
    codes, counts = codes[by], counts[by]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)])
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def pair_counts(links: DataFrame, link_type: np.dtype) -> DataFrame:
    """(code, n): how many links hold each id pair, summed in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting, size = [], 0

        def settle() -> None:
            nonlocal codes, counts, waiting, size
            new, n = np.unique(np.concatenate([np.frombuffer(x, link_type) for x in waiting]), return_counts=True)
            codes, counts = summed(np.concatenate([codes, new.astype(np.int64)]), np.concatenate([counts, n]))
            waiting, size = [], 0

        def told() -> pa.RecordBatch:
            return pa.record_batch([pa.array(codes), pa.array(counts)], names=["code", "n"])

        for b in slices(batches, 64):
            waiting += b.column(0).to_pylist()
            size = sum(map(len, waiting)) // link_type.itemsize
            if size >= SORTED_LINKS:
                settle()
                if len(codes) > SORTED_LINKS:
                    yield told()
                    codes, counts = codes[:0], counts[:0]
        if waiting:
            settle()
        yield told()

    return links.select("links").mapInArrow(tidied(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def frequent(pairs: DataFrame, most: int) -> tuple[int, pa.Table]:
    """The least power of two that most pairs at most reach, and these pairs."""
    level = F.length(F.bin("n"))
    rest, least = most, 0
    for r in pairs.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # 64 rows at most
        rest -= r["count"]
        if rest < 0:
            least = 1 << r["level"]
            break
    return least, pairs.filter(F.col("n") >= least).select("code", "n", "best").toArrow()


def align_tokenizers(docs: DataFrame, ranks: str | None = None, pieces: str | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """Per row of docs (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and the pairs (a_id, b_id, n, best).

    A is a byte-level BPE file read over a blank and the text, B a sentencepiece model read over the text. n of a
    pair is the number of links of the corpus that hold it, best says whether no other pair of its B id has more. n_best counts a text's links
    of best pairs, count_sum adds up the counts of its links.

    Null and empty texts, and those whose tokens don't give back a blank and the text (the mark of a blank in the text itself, say), have zeros and an
    empty digest, and count for no pair. Repeated rows count as often as they stand; a null doc_id stays null; texts of any length are aligned whole; an
    empty table gives no rows; other columns are not carried, whatever their names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    files = load_files(spark, ranks or tokenizer_path(), pieces or tokenizer_path("piece_bpe_32k.model"))
    ours = Aligner(*files.value)
    n_b, link_type = ours.n_b, ours.link_type
    done = materialize(aligned(docs, files), "aligned")
    counts = materialize(pair_counts(done, link_type), "counts")
    b_id = F.col("code") % n_b
    # One row for each id of B's vocabulary at most.
    most = counts.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))
    pairs = counts.withColumn("b_id", b_id).join(F.broadcast(most), "b_id").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    pairs = materialize(pairs, "pairs")
    least, top = frequent(pairs, broadcast_pairs)
    code, n, best = (c.to_numpy() for c in top.combine_chunks().columns) if top.num_rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    by = np.argsort(code)
    held = spark.sparkContext.broadcast((code[by].astype(link_type), n[by], best[by]))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the links of frequent pairs; the others, by code, as lists."""
        code, n, best = held.value
        for b in slices(batches, 64):
            links = [np.frombuffer(x, link_type) for x in b.column(6).to_pylist()]
            sizes = np.array([len(x) for x in links])
            flat = np.concatenate(links)
            by = np.argsort(flat, kind="stable")
            spot = np.empty(len(flat), np.int64)
            spot[by] = np.minimum(np.searchsorted(code, flat[by]), len(code) - 1)
            known = code[spot] == flat if len(code) else np.zeros(len(flat), bool)
            row = np.repeat(np.arange(len(links)), sizes)
            n_best, total = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
            if len(code):
                np.add.at(n_best, row, known & best[spot])
                np.add.at(total, row, np.where(known, n[spot], 0))
            rare = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=len(links)))]).astype(np.int32), pa.array(flat[~known].astype(np.int64)))
            yield pa.record_batch([*(b.column(k) for k in range(5)), b.column(5), pa.array(sizes), pa.array(n_best), pa.array(total), rare], names=[*names, "n_links", "n_best", "count_sum", "rare"])

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    scored = done.mapInArrow(tidied(score), f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long, rare array<long>")
    if least:
        scored = materialize(scored, "scored")
        rare = scored.select("row", F.explode("rare").alias("code")).groupBy("row", "code").agg(F.count("*").alias("links"))
        more = rare.join(pairs.filter(F.col("n") < least), "code").groupBy("row")
        more = more.agg(F.sum(F.when(F.col("best"), F.col("links"))).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum"))
        scored = scored.join(more, "row", "left").withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    out = scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return out, pairs.select((F.col("code") / n_b).cast("long").alias("a_id"), (F.col("code") % n_b).alias("b_id"), "n", "best")


def op13_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"))[0]
