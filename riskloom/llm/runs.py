"""Periodic runs of words, by the runs theorem.

A run is a stretch of words with smallest period q and length of 2 q at least that neither neighbour
extends. Every run holds a Lyndon word of length q, its root, that is the longest Lyndon
word at its place under the order of words or under the reverse order. The longest
Lyndon word at i ends before the next smaller value of the inverse suffix array (reverse order:
the next larger value), so each place gives two candidate roots. A candidate [i, j) is extended to the right by
the longest common extension of i and j, a range minimum over the LCP array, and to the left by
the largest k for which i - k and j - k still agree for k words, which the same minima tell.

Texts are worked in groups: the suffix array, the minima and the extensions of all
texts of a group are array operations; texts never share a comparison, since each ends with an end mark of its own.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import slices, small_batches, table, tidied

WORD = re.compile(r"[^\x20\x09-\x0D]+").findall
#: A run's least length in words.
MIN_LENGTH = 12
#: Words of a group of texts, but for a longer text, which is a group of its own.
GROUP_WORDS = 200_000
BLOCK = 16
#: Symbols that all neighbours in the suffix array are compared by, and rounds of pointers of all places, as array operations.
COMPARED = 8
ROUNDS = 24
_SCHEMA = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The inverse suffix array of texts laid in a row, text by text.

    symbols are at least 1, but for the 0 at each of the places ends, where a text ends. Prefix doubling:
    a rank is the place at which the group of equal prefixes begins, and only groups of two or more are sorted on.
    """
    n = len(symbols)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
    key = text * (int(symbols.max(initial=0)) + 1) + symbols
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)

    def settle(at: np.ndarray, keys: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Ranks of the places at, sorted by keys; the places whose group has others."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(keys)))
        rank[at] = np.repeat(base[first], size)
        return at[np.repeat(size > 1, size)]

    active, h = settle(order, key[order], np.arange(n)), 1
    while len(active):
        # Members of a group stand at consecutive ranks from the group's own on.
        key = rank[active] * (n + 1) + rank[active + h]
        by = np.argsort(key, kind="stable")
        at, key = active[by], key[by]
        group = key // (n + 1)
        head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        base = group + np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
        active, h = settle(at, key, base), 2 * h
    return rank


def common_prefixes(symbols: np.ndarray, rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    """lcp[r]: symbols that the suffixes of ranks r - 1 and r share, end marks apart; lcp[0] is 0.

    All pairs are compared at once for some symbols; what still agrees is compared place by place, where the
    suffix at i shares with its forerunner at least what the one at i - 1 shares, less one.
    """
    n = len(symbols)
    before = np.full(n, -1, np.int64)  # of the place i, the place of the suffix one rank lower
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    for h in range(COMPARED):
        x = symbols[active + h]
        active = active[(x == symbols[before[active] + h]) & (x != 0)]
        shared[active] = h + 1
    text, last, h = symbols.tolist() if len(active) else [], -1, 0
    for i, j in zip(active.tolist(), before[active].tolist()):
        h = max(h - (i - last), COMPARED) if last >= 0 else COMPARED
        while text[i + h] == text[j + h] and text[i + h]:
            h += 1
        shared[i], last = h, i
    lcp = np.zeros(n, np.int64)
    lcp[rank] = shared
    return lcp


class Minima:
    """Range minima in constant time: a sparse table over blocks, running minima from both ends inside them."""

    def __init__(self, values: np.ndarray):
        rows = -(-max(len(values), 1) // BLOCK)
        cells = np.zeros(rows * BLOCK, np.int64)
        cells[: len(values)] = values
        self.flat = cells
        cells = cells.reshape(rows, BLOCK)
        self.ahead = np.minimum.accumulate(cells, axis=1).ravel()
        self.behind = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [cells.min(axis=1)]
        while 2 << len(self.levels) - 1 <= rows:
            last, step = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-step], last[step:]))
        self.log = np.zeros(rows + 1, np.int64)
        for k in range(2, rows + 1):
            self.log[k] = self.log[k >> 1] + 1
        self.table = np.concatenate(self.levels)
        self.offset = np.cumsum([0, *map(len, self.levels[:-1])])

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The minimum of values[lo..hi], both included."""
        a, b = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.behind[lo], self.ahead[hi])
        inner = np.flatnonzero(b - a > 1)
        if len(inner):
            first, width = a[inner] + 1, b[inner] - a[inner] - 1
            k = self.log[width]
            t = np.minimum(self.table[self.offset[k] + first], self.table[self.offset[k] + first + width - (1 << k)])
            out[inner] = np.minimum(out[inner], t)
        same = np.flatnonzero(a == b)
        if len(same):
            span = lo[same, None] + np.arange(BLOCK)
            out[same] = np.where(span <= hi[same, None], self.flat[np.minimum(span, hi[same, None])], np.iinfo(np.int64).max).min(axis=1)
        return out


def next_smaller(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place of a text the next one of a smaller value; the text's end, whose value is the least, gives the place after it.

    A place passes on from one that isn't smaller to where that one has come so far. Chains left after some
    rounds are followed from the right, where every pointer met is final, so each is passed once.
    """
    to = np.arange(1, len(values) + 1)
    active = np.delete(np.arange(len(values)), ends)
    for _ in range(ROUNDS):
        active = active[values[to[active]] > values[active]]
        to[active] = to[to[active]]
    text = np.searchsorted(ends, active)
    for part in np.split(active, np.flatnonzero(np.diff(text)) + 1) if len(active) else ():
        low, high = int(part[0]), int(ends[np.searchsorted(ends, part[0])])
        value, hop = values[low : high + 1].tolist(), (to[low : high + 1] - low).tolist()
        for i in reversed((part - low).tolist()):
            j, v = hop[i], value[i]
            while value[j] > v:
                j = hop[j]
            hop[i] = j
        to[low : high + 1] = np.array(hop) + low
    return to


def find_runs(symbols: np.ndarray, ends: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of min_length symbols at least, by start, then period; input as in suffix_ranks."""
    n = len(symbols)
    rank = suffix_ranks(symbols, ends)
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    minima = Minima(common_prefixes(symbols, rank, order))

    def extension(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = rank[i], rank[j]
        return minima.least(np.minimum(a, b) + 1, np.maximum(a, b))

    place = np.arange(n)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
    begins = (np.append(-1, ends)[:-1] + 1)[text]
    reverse = -rank
    reverse[ends] = -n  # an end mark ends its text under both orders
    i = np.concatenate([place, place])
    j = np.concatenate([next_smaller(rank, ends), next_smaller(reverse, ends)])
    # The leftmost root of a run is followed by a word of the run that repeats the root's first.
    ok = (j < np.append(ends, n)[text[i]]) & (symbols[i] == symbols[np.minimum(j, n - 1)])
    i, j = i[ok], j[ok]
    p, right = j - i, extension(i, j)
    # Words to the left that make the run long enough: fewer than a period, or the root before this one leads to the same run.
    need = np.maximum(np.maximum(min_length - p, p) - right, 0)
    ok = (need < p) & (i - need >= begins[i])
    i, j, p, right, need = (x[ok] for x in (i, j, p, right, need))
    ok = (need == 0) | (extension(i - need, j - need) >= need)
    i, j, p, right, need = (x[ok] for x in (i, j, p, right, need))
    low, high = need, np.minimum(p, i - begins[i])  # agreeing words to the left: at least low, at most high
    while len(open_ := np.flatnonzero(low < high)):
        mid = (low[open_] + high[open_] + 1) // 2
        agrees = extension(i[open_] - mid, j[open_] - mid) >= mid
        low[open_] = np.where(agrees, mid, low[open_])
        high[open_] = np.where(agrees, high[open_], mid - 1)
    ok = low < p
    found = np.unique(np.stack([(i - low)[ok], p[ok], (low + p + right)[ok]], axis=1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def planted(n: int, doc_id: int | None) -> np.ndarray:
    """The original number of each word of a text: for every tenth document a tail repeats its first words."""
    at = np.arange(n)
    if doc_id is None or not n:
        return at
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + np.arange(n - a) % p
    return at


def describe(texts: list[list[str]], min_length: int = MIN_LENGTH) -> list[tuple]:
    """The result columns of each list of words."""
    sizes = np.array([len(w) for w in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    numbers = pa.array(list(itertools.chain.from_iterable(texts)), pa.large_string()).dictionary_encode().indices
    symbols = np.zeros(len(numbers) + len(texts), np.int64)
    symbols[np.arange(len(numbers)) + np.repeat(np.arange(len(texts)), sizes)] = numbers.to_numpy() + 1
    start, length, period = find_runs(symbols, ends, min_length)
    of = np.searchsorted(ends, start)
    parts = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for k, words in enumerate(texts):
        a, b = parts[k], parts[k + 1]
        if a == b:
            out.append((0, None, None, None, None, sha(""), sha(" ".join(words))))
            continue
        s, n, q = start[a:b] - (ends[k] - len(words)), length[a:b], period[a:b]
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, s + q, 1)
        np.add.at(edge, s + n, -1)
        kept = [words[x] for x in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
        best = int(np.argmax(n))  # the first of the longest: by start, then period
        lines = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s.tolist(), n.tolist(), q.tolist()))
        top = int(s[best]), int(n[best]), int(q[best])
        out.append((b - a, *top, 1000 * top[1] // top[2], sha(lines), sha(" ".join(kept))))
    return out


def periodic_runs(docs: DataFrame, plant: bool = False, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) for each row of docs.

    The four numbers are those of the longest run (ties: smallest start, then period), null without a run. collapsed_sha256 is of the
    words that no run holds behind its first period. With plant, every tenth document by a hash of its id is searched after a tail of it was made periodic.

    Null and empty texts and those of white space have no words: no runs, and digests of nothing. Texts are searched whole, whatever their length (one text
    in a task, some 200 bytes a word). Repeated rows give repeated results; a null doc_id stays null and plants nothing; an empty table
    gives no rows; other columns are not carried, whatever their names.
    """
    small_batches(docs.sparkSession)
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    types = [pa.string() if x.endswith("string") else pa.int64() for x in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, room = [], [], GROUP_WORDS

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            rows = describe(texts, min_length)
            return pa.record_batch([pa.array(ids, kind), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=["doc_id", *names])

        kind = pa.int64()
        for batch in slices(batches):
            kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = WORD(text or "")
                if plant:
                    at = planted(len(words), doc_id)
                    words = [words[k] for k in at.tolist()] if len(at) and at[-1] != len(at) - 1 else words
                if texts and len(words) > room:
                    yield flush(kind)
                    ids, texts, room = [], [], GROUP_WORDS
                ids.append(doc_id)
                texts.append(words)
                room -= len(words) + 1
        if texts:
            yield flush(kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tidied(run), f"doc_id {kind}, {_SCHEMA}")


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)
