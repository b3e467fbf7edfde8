"""Exact Jaccard self-join on word shingles by T-occurrence search.

Equal sets collapse into classes first. Tokens (shingles) have one global order, rare
ones first, and each class puts the tokens of its prefix, its short lists, into inverted
lists that are spread by token. A list proposes pairs whose lengths and positions allow
the required overlap. A candidate then goes through DivideSkip against its query: the
short lists among the query's tokens are merged through a heap, the long ones are
probed by binary search, and the candidate stays if it reaches the required overlap.

A list of many classes (near copies by the thousand) isn't expanded into pairs: its most
central class is compared with all others first, components are formed, and in a second round
only members of different components still meet. No link between components can be missed,
since every pair of a list is either inside one component or compared. A list that the order's counts
say to be very long is dealt to several tasks, whose hubs are compared with each other, too.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import materialize, partitions, slices, small_batches, table, tidied
from riskloom.llm.components import connected_components
from riskloom.llm.shingles import mix, pack, set_key, shingle_sets, unpack
from riskloom.llm.texts import beside_texts

#: Link when 4 * overlap >= 3 * union.
FREQUENT = 250_000  # tokens whose order is kept by their count; all others count as rare (an order, never a filter)
SMALL_RUN = 24  # classes in a list that are paired at once
BLOCK = 2048  # members of a long list on each side of a group of the second round
CHUNK = 65_536  # classes of a list, by the order's counts, that go to one task
FLUSH = 400_000
SEEN = 200_000  # classes that a task remembers, so as to send a copy's postings once
CELL = 64  # candidates that are searched together
#: Token, class, size of its set, place of the token in its order, how central the class is, whether the list is dealt to several groups.
POSTING = np.dtype([("t", "<u8"), ("k", "<i8"), ("n", "<u4"), ("i", "<u4"), ("c", "<u2"), ("m", "u1")])


def required(x, y):
    """Least overlap of linked sets of these sizes: 7 * o >= 3 * (x + y)."""
    return -(-3 * (x + y) // 7)


def _fresh(seen: set, key: int) -> bool:
    """Whether the task meets a class for the first time, as far as it remembers."""
    if key in seen:
        return False
    if len(seen) >= SEEN:
        seen.clear()
    seen.add(key)
    return True


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: documents with their set's size and key; of kind 1: tokens seen twice or more by the task."""
    held, waiting, seen = np.zeros(0, np.uint64), [], set()
    counts = np.zeros(0, np.int64)

    def fold():
        nonlocal held, counts, waiting
        if waiting:
            t, c = np.unique(np.concatenate(waiting), return_counts=True)
            waiting, more = [], c > 1
            at = np.searchsorted(held, t)
            known = held[np.minimum(at, len(held) - 1)] == t if len(held) else np.zeros(len(t), bool)
            counts[at[known]] += c[known]
            more &= ~known
            held, counts = np.concatenate([held, t[more]]), np.concatenate([counts, c[more]])
            by = np.argsort(held)
            held, counts = held[by], counts[by]

    size = 0
    for b in slices(batches):
        ns, keys = [], []
        for s in shingle_sets(b.column(1)):
            key = set_key(s)
            ns.append(len(s))
            keys.append(key)
            if len(s) and _fresh(seen, key):
                waiting.append(s)
                size += len(s)
        if size > 2_000_000:
            fold()
            size = 0
        yield pa.record_batch([pa.array(np.zeros(len(ns), np.int32)), b.column(0), pa.array(ns, pa.int64()), pa.array(keys, pa.int64())], names=["kind", "doc_id", "n_shingles", "key"])
    fold()
    for at in range(0, len(held), 50_000):
        c = counts[at : at + 50_000]
        yield pa.record_batch([pa.array(np.ones(len(c), np.int32)), pa.nulls(len(c), b.schema.field(0).type), pa.array(c), pa.array(held[at : at + 50_000].view(np.int64))], names=["kind", "doc_id", "n_shingles", "key"])


class TokenOrder:
    """The global order: tokens not held come first, by hash; held ones follow by count."""

    BITS = 22

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        at = np.argsort(tokens)
        self.tokens, self.counts = tokens[at], counts[at]
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[self.tokens >> np.uint64(64 - self.BITS)] = True

    def count(self, s: np.ndarray) -> np.ndarray:
        out = np.zeros(len(s), np.int64)
        some = np.flatnonzero(self.maybe[s >> np.uint64(64 - self.BITS)])
        if len(some):
            x = s[some]
            at = np.minimum(np.searchsorted(self.tokens, x), len(self.tokens) - 1)
            out[some] = np.where(self.tokens[at] == x, self.counts[at], 0)
        return out

    def prefix(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The tokens of s of which it shares one with any partner, in order; their counts; and how central s is (0 to 65535)."""
        n = len(s)
        freq = self.count(s)
        p = n - -(-3 * n // 4) + 1
        held = np.count_nonzero(freq)
        if n - held >= p:
            pre, count = s[freq == 0][:p], np.zeros(p, np.int64)
        else:
            at = np.lexsort((s, freq))[:p]
            pre, count = s[at], freq[at]
        return pre, count, int(held * 65535 // n)


def _postings(order_bc, buckets: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen, waiting, size = TokenOrder(*order_bc.value), set(), [], 0

        def flush():
            p, chunks = np.concatenate([x for x, _ in waiting]), np.concatenate([c for _, c in waiting])
            p["m"] = chunks > 1
            # a list that may be long is dealt to as many groups as it has chunks, by class
            part = np.where(chunks > 1, mix(p["k"].view(np.uint64)) % chunks.astype(np.uint64), np.uint64(0))
            b = ((p["t"] + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int32)
            at = np.argsort(b, kind="stable")
            p, b = p[at], b[at]
            cuts = np.flatnonzero(np.diff(b)) + 1
            parts = np.split(p, cuts)
            return pa.record_batch([pa.array(b[np.concatenate([[0], cuts])].astype(np.int32)), pa.array([pack(x) for x in parts], pa.binary())], names=["bucket", "blob"])

        for batch in slices(batches):
            for s in shingle_sets(batch.column(0)):
                if not len(s):
                    continue
                key = set_key(s)
                if not _fresh(seen, key):
                    continue
                pre, count, central = order.prefix(s)
                p = np.zeros(len(pre), POSTING)
                p["t"], p["k"], p["n"], p["i"], p["c"] = pre, key, len(s), np.arange(len(pre)), central
                waiting.append((p, 1 + count // chunk))
                size += len(p)
            if size > FLUSH:
                yield flush()
                waiting, size = [], 0
        if waiting:
            yield flush()

    return run


def _fits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the lengths and the positions of a common token allow the required overlap."""
    nx, ny, ix, iy = (v.astype(np.int64) for v in (x["n"], y["n"], x["i"], y["i"]))
    short, at = np.minimum(nx, ny), np.where((nx < ny) | ((nx == ny) & (ix <= iy)), ix, iy)
    ok = 4 * short >= 3 * np.maximum(nx, ny)
    ok &= (at < short - -(-6 * short // 7) + 1) & (np.minimum(nx - ix, ny - iy) >= required(nx, ny))
    return ok & (x["k"] != y["k"])


def _pairs_of(p: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the short runs, run lengths one by one."""
    for m in np.unique(lengths):
        i, j = np.triu_indices(int(m), 1)
        at = starts[lengths == m]
        for k in range(0, len(at), max(1, 200_000 // len(i))):
            base = at[k : k + max(1, 200_000 // len(i))][:, None]
            yield p[(base + i).ravel()], p[(base + j).ravel()]


def _distinct(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
    return u[:, 0], u[:, 1]


#: Members of long lists as rows, and their columns' fields in a posting.
LISTS = "token long, hub boolean, k long, n long, spot long, c long"
FIELDS = {"k": "k", "n": "n", "spot": "i", "c": "c"}


def _rows(p: np.ndarray, hub: np.ndarray) -> dict[str, pa.Array]:
    return {"token": pa.array(np.ascontiguousarray(p["t"]).view(np.int64)), "hub": pa.array(hub)} | {c: pa.array(p[f].astype(np.int64)) for c, f in FIELDS.items()}


def _postings_of(t: pa.Table) -> np.ndarray:
    p = np.zeros(t.num_rows, POSTING)
    p["t"] = t.column("token").to_numpy().view(np.uint64)
    for c, f in FIELDS.items():
        p[f] = t.column(c).to_numpy()
    return p


def _star(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first, most central member beside all others that fit it."""
    hub = np.repeat(members[:1], len(members) - 1)
    ok = _fits(hub, members[1:])
    return hub["k"][ok], members["k"][1:][ok]


def _propose(small_run: int):
    def run(t: pa.Table) -> pa.Table:
        """Candidates (a, b) of one bucket of inverted lists; the members of lists of many classes leave as rows, too."""
        p = unpack(t.column("blob").to_pylist(), POSTING)
        p = p[np.lexsort((p["k"], -p["c"].astype(np.int32), p["t"]))]
        again = np.append(False, (p["t"][1:] == p["t"][:-1]) & (p["k"][1:] == p["k"][:-1]))  # the same class may come from several tasks
        p = p[~again]
        starts = np.concatenate([[0], np.flatnonzero(p["t"][1:] != p["t"][:-1]) + 1])
        lengths = np.diff(np.append(starts, len(p)))
        dealt = p["m"][starts] > 0  # a part of a list, whose other parts stand elsewhere, is never paired alone
        some = (lengths > 1) | dealt
        starts, lengths, dealt = starts[some], lengths[some], dealt[some]
        small = (lengths <= small_run) & ~dealt
        left, right, runs = [], [], []
        for x, y in _pairs_of(p, starts[small], lengths[small]):
            ok = _fits(x, y)
            left.append(np.minimum(x["k"][ok], y["k"][ok]))
            right.append(np.maximum(x["k"][ok], y["k"][ok]))
        a, b = _distinct(left, right)
        left, right = [], []
        for at, m in zip(starts[~small], lengths[~small]):
            members = p[at : at + m]
            ha, hb = _star(members)
            left.append(ha)
            right.append(hb)
            runs.append(members)
        ha, hb = _distinct(left, right)
        n, rows = len(a) + len(ha), np.concatenate(runs) if runs else p[:0]
        hub = np.append(True, rows["t"][1:] != rows["t"][:-1])[: len(rows)]
        pairs = {"a": pa.array(np.concatenate([a, ha])), "b": pa.array(np.concatenate([b, hb]))} | {f.name: pa.nulls(n, f.type) for f in _SCHEMA}
        members = {c: pa.nulls(len(rows), pa.int64()) for c in "ab"} | _rows(rows, hub)
        return pa.concat_tables([pa.table(pairs), pa.table(members)])

    return run


_SCHEMA = pa.schema([("token", pa.int64()), ("hub", pa.bool_()), *((c, pa.int64()) for c in FIELDS)])


def _between_hubs(t: pa.Table) -> pa.Table:
    """The hubs of one list's chunks beside the most central of them."""
    p = _postings_of(t)
    a, b = _star(p[np.lexsort((p["k"], -p["c"].astype(np.int32)))])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def divide_skip(query: np.ndarray, sets: list[np.ndarray]) -> list[int]:
    """Which of the sets link with the query: a T-occurrence search over their inverted lists.

    The lists of the query's tokens hold the numbers of the sets that have the token. The long
    ones, up to T - 1 of them, are left out of the heap; a set that occurs T - L times in the
    rest is probed in the L long lists by binary search.
    """
    n, m = len(query), len(sets)
    at = [np.searchsorted(query, s) for s in sets]
    hits = [(a[(a < n) & (query[np.minimum(a, n - 1)] == s)]) for a, s in zip(at, sets)]
    token = np.concatenate(hits)
    member = np.repeat(np.arange(m), [len(h) for h in hits])
    need = np.array([required(n, len(s)) for s in sets])
    by = np.lexsort((member, token))
    token, member = token[by], member[by]
    length = np.bincount(token, minlength=n)
    start = np.concatenate([[0], np.cumsum(length)])
    least = int(need.min())
    lists = np.argsort(-length, kind="stable")
    n_long = min(least - 1, n)
    long_lists, short_lists = lists[:n_long], [t for t in lists[n_long:].tolist() if length[t]]
    heap = [(int(member[start[t]]), t, int(start[t])) for t in short_lists]
    heapq.heapify(heap)
    occurs: dict[int, int] = {}
    while heap:
        who, t, k = heap[0]
        occurs[who] = occurs.get(who, 0) + 1
        if k + 1 < start[t + 1]:
            heapq.heapreplace(heap, (int(member[k + 1]), t, k + 1))
        else:
            heapq.heappop(heap)
    left = np.array([w for w in sorted(occurs) if occurs[w] >= least - n_long], np.int64)
    if not len(left):
        return []
    coded = token.astype(np.int64) * m + member  # sorted: each list is a stretch of it
    probes = (long_lists.astype(np.int64)[:, None] * m + left[None, :]).ravel()
    spot = np.minimum(np.searchsorted(coded, probes), len(coded) - 1)
    found = (coded[spot] == probes).reshape(len(long_lists), len(left)).sum(0)
    total = found + np.array([occurs[w] for w in left.tolist()])
    return [int(w) for w, o in zip(left, total) if o >= need[w]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams cells (query, then its candidates) and yields the linked pairs."""
    cell, query, keys, sets, out = None, None, [], [], []

    def close():
        nonlocal keys, sets
        if query is not None and sets:
            out.extend((cell[0], keys[w]) for w in divide_skip(query, sets))
        keys, sets = [], []

    for b in slices(batches, 64):
        texts = pa.array([zlib.decompress(x) for x in b.column(4).to_pylist()], pa.binary()).cast(pa.string())
        for a, salt, role, key, s in zip(*(c.to_pylist() for c in b.columns[:4]), shingle_sets(texts)):
            if (a, salt) != cell:
                close()
                cell, query = (a, salt), None
            if not len(s) or set_key(s) != key:
                continue  # another row under the same doc_id
            if role == 0:
                query = s
            else:
                keys.append(key)
                sets.append(s)
                if len(sets) == CELL:
                    close()
        if out:
            yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])
            out = []
    close()
    if out:
        yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row that wants a text beside it (beside each, if rows share a doc_id), packed, since a text goes to every candidate of its class."""
    cell, held = None, pa.array([], pa.string())
    for b in slices(batches):
        pool, rows, at = pa.concat_arrays([held, b.column("text").cast(pa.string())]), [], []
        mine = list(range(len(held)))
        for i, (want, salt, role) in enumerate(zip(*(b.column(c).to_pylist() for c in ("want", "salt", "role"))), len(held)):
            if (want, salt) != cell:
                cell, mine = (want, salt), []
            if role == 0:
                mine.append(i)
            else:
                rows += [i - len(held)] * len(mine)
                at += mine
        if rows:
            x = b.select(["a", "cell", "part", "key"]).take(pa.array(rows))
            packed = {k: zlib.compress(pool[k].as_py().encode(), 1) for k in set(at)}
            yield pa.record_batch([*x.columns, pa.array([packed[k] for k in at], pa.binary())], names=["a", "cell", "part", "key", "text"])
        held = pool.take(pa.array(mine, pa.int64()))


def _verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) that link; a's candidates are dealt over cells, so no query holds a task."""
    spark = docs.sparkSession
    pairs = materialize(pairs.distinct(), name + "-pairs")
    if pairs.isEmpty():
        return pairs
    wide = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(CELL)).alias("cells"))
    dealt = pairs.join(wide, "a").select("a", F.pmod(F.xxhash64("b"), F.col("cells")).cast("int").alias("cell"), "b")
    queries = dealt.select("a", "cell").distinct().select("a", "cell", F.lit(0).alias("part"), F.col("a").alias("key"))
    wanted = queries.union(dealt.select("a", "cell", F.lit(1), F.col("b")))
    wanted = wanted.join(reps, "key").select(F.col("rep").alias("want"), "a", "cell", "part", "key")
    cells = beside_texts(wanted, docs, ["a", "cell", "key"]).mapInArrow(tidied(_spread), "a long, cell int, part int, key long, text binary")
    cells = cells.repartition(partitions(spark) * 2, "a", "cell").sortWithinPartitions("a", "cell", "part")
    return materialize(cells.mapInArrow(tidied(_search), "a long, b long"), name)


def _cross(t: pa.Table) -> pa.Table:
    """Pairs of one side of a group with the other (or within its one side) whose classes are in different components so far."""
    p = _postings_of(t)
    root, side = t.column("root").to_numpy(), t.column("side").to_numpy()
    left, right = [], []
    within = t.column("j")[0].as_py() == t.column("i")[0].as_py()
    firsts, others = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if within:
        firsts = others = np.arange(len(p))
    for i in firsts:
        j = others[root[others] != root[i]]
        j = j[j > i] if within else j
        if len(j):
            j = j[_fits(np.repeat(p[i : i + 1], len(j)), p[j])]
            left.append(np.minimum(p["k"][i], p["k"][j]))
            right.append(np.maximum(p["k"][i], p["k"][j]))
    a, b = _distinct(left, right)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _meetings(rows: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """Members of long lists whose classes are in two components or more, dealt to groups (token, i, j) of two sides.

    A list of one component isn't dealt at all. Of the others, the members of the largest component stand in blocks -1, -2...
    and meet the blocks 0, 1... of the rest; these meet each other. So a component of a million and a few others cost a row
    for each of the million and not their pairs.
    """
    placed = rows.join(roots, rows["k"] == roots["node"], "left").select("token", "k", "n", "spot", "c", F.coalesce("root", "k").alias("root"))
    placed = materialize(placed, "members")
    sizes = placed.groupBy("token", "root").agg(F.count("*").alias("m"))
    per = sizes.groupBy("token").agg(F.sum("m").alias("all"), F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("roots")).filter("roots > 1")
    per = per.select("token", F.col("top")["root"].alias("top"), F.ceil(F.col("top")["m"] / block).alias("n_top"), F.ceil((F.col("all") - F.col("top")["m"]) / block).alias("n_rest"))
    x = placed.join(per, "token")
    h = F.xxhash64("k")
    x = x.withColumn("mine", F.when(F.col("root") == F.col("top"), -1 - F.pmod(h, "n_top")).otherwise(F.pmod(h, "n_rest")))
    rest = F.sequence(F.lit(0).cast("long"), F.col("n_rest") - 1)
    met = lambda i, j, side: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"), F.lit(side).alias("side"))
    of_top = F.transform(rest, lambda j: met(F.col("mine"), j, 0))
    of_rest = F.concat(
        F.transform(F.sequence(F.lit(1).cast("long"), F.col("n_top")), lambda i: met(-i, F.col("mine"), 1)),
        F.transform(rest, lambda j: F.when(j < F.col("mine"), met(j, F.col("mine"), 1)).otherwise(met(F.col("mine"), j, 0))),
    )
    return x.select("token", "k", "n", "spot", "c", "root", F.inline(F.when(F.col("mine") < 0, of_top).otherwise(of_rest)))


def near_duplicates(docs: DataFrame, small_run: int = SMALL_RUN, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    component_id is the smallest doc_id reachable over links of Jaccard 0.75 or more. Null and empty texts
    have an empty set, link with nothing, and are their own component; a null doc_id keeps a null
    or its partners' component; rows with one doc_id are rows of one document, whatever their texts; repeated rows give
    repeated results; texts of any length are read whole; an empty table gives none; other columns are not carried.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    seen = materialize(docs.mapInArrow(tidied(_describe), f"kind int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, key long"), "sets")
    sets = seen.filter("kind = 0").select("doc_id", "n_shingles", "key")
    classes = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = materialize(classes, "classes")
    reps = classes.select("key", "rep")
    common = seen.filter("kind = 1").groupBy("key").agg(F.sum("n_shingles").alias("c")).orderBy(F.desc("c"), "key").limit(FREQUENT).toArrow()
    order = spark.sparkContext.broadcast((common["key"].to_numpy().view(np.uint64), common["c"].to_numpy()))
    buckets = partitions(spark) * 4
    lists = docs.select("text").mapInArrow(tidied(_postings(order, buckets, chunk)), "bucket int, blob binary")
    found = materialize(lists.groupBy("bucket").applyInArrow(_propose(small_run), "a long, b long, " + LISTS), "proposed")
    members = found.filter("token IS NOT NULL")
    star = members.filter("hub").groupBy("token").applyInArrow(_between_hubs, "a long, b long")
    links = _verify(found.filter("token IS NULL").select("a", "b").union(star), docs, reps, "links")
    roots = connected_components(links)
    if not members.isEmpty():
        more = _meetings(members, roots, block).groupBy("token", "i", "j").applyInArrow(_cross, "a long, b long")
        further = _verify(more, docs, reps, "further")
        if not further.isEmpty():
            roots = connected_components(links.union(further))
    placed = classes.join(roots.select(F.col("node").alias("key"), "root"), "key", "left").select("key", "rep", "copies", F.coalesce("root", "key").alias("root"), F.col("root").isNotNull().alias("linked"))
    least = placed.filter("linked").groupBy("root").agg(F.min("rep").alias("least"))
    named = placed.join(least, "root", "left").filter("linked OR copies > 1").select("key", F.coalesce("least", "rep").alias("component"))
    named = materialize(named, "named")
    return sets.join(named, "key", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with its smallest id stays, once.

    Of rows with one doc_id and text any one stays. Rows without a doc_id all stay; null and empty texts are components of their own; an empty table stays empty.
    """
    keep = near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    nameless = docs.filter("doc_id IS NULL")
    return kept.unionByName(nameless).select(*[F.col(f"`{c}`") for c in docs.columns])
