"""WARC archives with revisits, and their capture index by an external k-way merge.

Archives hold one gzip member per record, so that a record can be read by its offset. Every
archive's writer leaves its captures sorted by URL key, time and page: a run. While there are more
runs than FAN_IN, groups of FAN_IN are merged into longer runs, which are written as pieces, one for each range of
keys. The last merge goes range by range, too: a task takes the stretch of every run that falls into its range
and merges them through a loser tree, so captures come out in global order while a task
opens FAN_IN runs at most and holds one batch of each. Pieces that miss the range aren't opened. Ranges are cut by
(key, time, page), so one URL with most captures is spread like any other. Names of runs and pieces stay
distributed; the driver sees KEY_SAMPLE keys at most, which cut the ranges.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm.common import materialize, partitions, scratch_path, slices, small_batches, table, tidied

REVISIT_FROM = 1000
ARCHIVE_BYTES = 32 << 20
FAN_IN = 64
RUN_ROWS = 2048
#: Keys that each run's writer offers for the cuts, and that the driver takes of all.
OFFERED = 16
KEY_SAMPLE = 20_000
#: Rows of a task that merges runs into longer ones.
PASS_ROWS = 2_000_000
EPOCH = 1_704_067_200  # page n is taken as captured n seconds after 2024-01-01, as pages have no time
RUN_SCHEMA = pa.schema([("urlkey", pa.string()), ("ts", pa.int64()), ("page_id", pa.int64()), ("digest", pa.string()), ("kind", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
RUN_DDL = "urlkey string, ts long, page_id long, digest string, kind string, refers_to long, payload_bytes long, archive string, offset long, length long"
_KEY = pa.struct([("urlkey", pa.string()), ("ts", pa.int64()), ("page_id", pa.int64())])
_KEY_DDL = "struct<urlkey:string,ts:long,page_id:long>"
#: A run is one piece or several with disjoint stretches of keys.
PIECE_SCHEMA = pa.schema([("run", pa.string()), ("path", pa.string()), ("rows", pa.int64()), ("lo", _KEY), ("hi", _KEY), ("offered", pa.list_(_KEY))])
PIECE_DDL = f"run string, path string, rows long, lo {_KEY_DDL}, hi {_KEY_DDL}, offered array<{_KEY_DDL}>"


def _key(row) -> dict:
    return dict(zip(("urlkey", "ts", "page_id"), row))


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: com,example)/a?b."""
    try:
        u = urlsplit((url or "").strip().lower())
        host = (u.hostname or "").removeprefix("www.")
    except ValueError:
        return (url or "").strip().lower()
    return ",".join(reversed(host.split("."))) + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


def stamp(ts: int) -> str:
    import datetime

    return datetime.datetime.fromtimestamp(ts, datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id: int | None, url: str | None, ts: int, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload but names the record it repeats."""
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    kind = "response" if refers_to is None else "revisit"
    uri = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    body = b"" if kind == "revisit" else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {stamp(ts)}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def read_records(chunks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, body, offset, length) of the gzip members of an archive, one at a time."""
    unzip, out, start, at = zlib.decompressobj(31), [], 0, 0
    for chunk in chunks:
        while chunk:
            out.append(unzip.decompress(chunk))
            rest = unzip.unused_data
            at += len(chunk) - len(rest)
            chunk = rest
            if not unzip.eof:
                break
            raw = b"".join(out)
            head, _, body = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            yield fields, body[: int(fields["Content-Length"])], start, at - start
            unzip, out, start = zlib.decompressobj(31), [], at


def with_payload(pages: DataFrame) -> DataFrame:
    """pages with payload digest and size, and the page that a repeated payload refers to.

    Null html is an empty payload. Of equal payloads of REVISIT_FROM bytes or more, the largest page_id is the
    response; a page without an id is always one.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumns({"payload_digest": F.sha1(F.col("html").cast("binary")), "payload_bytes": F.octet_length("html").cast("long")})
    large = p.filter((F.col("payload_bytes") >= REVISIT_FROM) & F.col("page_id").isNotNull())
    rep = large.groupBy(F.col("payload_digest").alias("d")).agg(F.max("page_id").alias("rep"), F.count("*").alias("n")).filter("n > 1").select("d", "rep")
    x = p.join(rep, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") >= REVISIT_FROM), "left").drop("d")
    return x.withColumn("refers_to", F.when(F.col("page_id") != F.col("rep"), F.col("rep"))).drop("rep")


def write_archives(pages: DataFrame, uri: str) -> DataFrame:
    """Writes archives and their sorted runs below uri; returns PIECE_DDL, a row per archive, whose run is named as it is.

    Files are named by task attempt and only those of attempts that succeed are named in the
    result, so a lost executor leaves nothing but an orphan.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(uri)
        task, part, out, rows, at, name = TaskContext.get(), 0, None, [], 0, ""
        made: list[tuple] = []

        def close():
            nonlocal out, rows
            if out is None:
                return
            out.close()
            rows.sort(key=lambda r: (r[0], r[1], r[2]))
            with pq.ParquetWriter(f"{base}/{name}.run.parquet", RUN_SCHEMA, filesystem=fs) as w:
                for k in range(0, len(rows), RUN_ROWS):
                    w.write_table(_columns(rows[k : k + RUN_ROWS]), row_group_size=RUN_ROWS)
            offered = [_key(rows[k]) for k in sorted({j * len(rows) // OFFERED for j in range(OFFERED)})]
            made.append((name, f"{name}.run.parquet", len(rows), _key(rows[0]), _key(rows[-1]), offered))
            out, rows = None, []

        fs.create_dir(base, recursive=True)
        for b in slices(batches):
            for page_id, url, html, digest, size, refers in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to"))):
                if out is None:
                    name, at = f"{task.partitionId():06d}-{task.taskAttemptId()}-{part:04d}", 0
                    out, part = fs.open_output_stream(f"{base}/{name}.warc.gz", compression=None), part + 1
                ts = EPOCH + (page_id or 0)
                zipped = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = zipped.compress(record(page_id, url, ts, html.encode(), digest, refers)) + zipped.flush()
                out.write(raw)
                rows.append((url_key(url), ts, -1 if page_id is None else page_id, digest, "response" if refers is None else "revisit", refers, size, f"{name}.warc.gz", at, len(raw)))
                at += len(raw)
                if at >= ARCHIVE_BYTES:
                    close()
        close()
        if made:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*made), PIECE_SCHEMA.types)], schema=PIECE_SCHEMA)

    return pages.mapInArrow(tidied(run), PIECE_DDL)


def _columns(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), RUN_SCHEMA.types)], schema=RUN_SCHEMA)


class LoserTree:
    """Merges sorted iterators: inner nodes hold the loser of their match, the winner goes up."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def _play(self, i: int) -> None:
        node, winner = (i + self.k) // 2, i
        while node > 0:
            if self.tree[node] == -1:
                self.tree[node] = winner
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[w := self.tree[0]] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            self._play(w)


def _stretch(fs: pafs.FileSystem, path: str, low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """The rows of a run from low up to, not including, high; row groups outside aren't read."""
    f = pq.ParquetFile(path, filesystem=fs)
    for g in range(f.num_row_groups):
        s = f.metadata.row_group(g).column(0).statistics
        if s is not None and s.has_min_max and ((low and s.max < low[0]) or (high and s.min > high[0])):
            continue
        rows = list(zip(*(c.to_pylist() for c in f.read_row_group(g).columns)))
        keys = [r[:3] for r in rows]
        yield from rows[bisect.bisect_left(keys, low) if low else 0 : bisect.bisect_left(keys, high) if high else len(rows)]


def _overlapping(cuts: list[tuple]):
    """Pieces with the number of each range that they reach into: range k ends before cuts[k]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, part = [], []
            for k, (lo, hi) in enumerate(zip(b.column("lo").to_pylist(), b.column("hi").to_pylist())):
                for r in range(bisect.bisect_right(cuts, tuple(lo.values())), bisect.bisect_right(cuts, tuple(hi.values())) + 1):
                    at.append(k)
                    part.append(r)
            x = b.select(["grp", "run", "path", "lo"]).take(pa.array(at, pa.int64()))
            yield pa.record_batch([x.column(0), pa.array(part, pa.int32()), *x.columns[1:]], names=["grp", "part", "run", "path", "lo"])

    return run


def _merged(batches: Iterator[pa.RecordBatch], uri: str, bounds: list[tuple]) -> Iterator[tuple[int, int, Iterator[tuple]]]:
    """(group, range, its rows in order) of rows (grp, part, run, path) that are sorted by group, range, run and first key."""
    fs, base = filesystem(uri)
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("grp", "part", "run", "path"))))
    for (grp, part), mine in itertools.groupby(rows, key=lambda r: r[:2]):
        low, high = bounds[part]
        runs = [[r[3] for r in pieces] for _, pieces in itertools.groupby(mine, key=lambda r: r[2])]
        stretch = lambda paths: itertools.chain.from_iterable(_stretch(fs, f"{base}/{p}", low, high) for p in paths)
        yield grp, part, iter(LoserTree([stretch(paths) for paths in runs]))


def _longer_runs(uri: str, bounds: list[tuple], level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Writes each merged range of a group as a piece of the group's run."""
        fs, base = filesystem(uri)
        attempt = TaskContext.get().taskAttemptId()
        for grp, part, rows in _merged(batches, uri, bounds):
            path, n, lo, hi = f"merged-{level}-{grp}-{part:06d}-{attempt}.run.parquet", 0, None, None
            with pq.ParquetWriter(f"{base}/{path}", RUN_SCHEMA, filesystem=fs) as w:
                while some := list(itertools.islice(rows, RUN_ROWS)):
                    w.write_table(_columns(some), row_group_size=RUN_ROWS)
                    lo, hi, n = lo or some[0], some[-1], n + len(some)
            if n:
                yield pa.record_batch([pa.array([v], t) for v, t in zip((f"{level}-{grp}", path, n, _key(lo), _key(hi), []), PIECE_SCHEMA.types)], schema=PIECE_SCHEMA)

    return run


def merge_runs(pieces: DataFrame, uri: str, ranges: int, fan_in: int = FAN_IN) -> DataFrame:
    """The captures of all runs in global order: the run columns, `part` (the range) and `n` (the order within it).

    More than fan_in runs go through further passes, each of which merges fan_in runs into one; no task opens more.
    """
    spark = pieces.sparkSession
    offered = pieces.select(F.explode("offered").alias("k")).select("k.*")
    sample = sorted(tuple(r) for r in offered.orderBy(F.xxhash64("urlkey", "ts", "page_id")).limit(KEY_SAMPLE).collect())
    total, n_runs = pieces.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()
    cuts_of = lambda n: sorted({sample[k * len(sample) // n] for k in range(1, n)}) if sample else []
    bounds_of = lambda cuts: list(zip([None, *cuts], [*cuts, None]))
    level = 0
    tasks = "grp long, part int, run string, path string, lo " + _KEY_DDL
    while n_runs > fan_in:
        groups = pieces.select("run").distinct().coalesce(max(1, n_runs // (16 * fan_in)))
        groups = materialize(groups.select("run", F.floor(F.monotonically_increasing_id() / fan_in).alias("grp")), "groups")
        n_runs = groups.select("grp").distinct().count()
        cuts, level = cuts_of(min(ranges, max(1, total // (n_runs * PASS_ROWS)))), level + 1
        dealt = pieces.join(groups, "run").mapInArrow(tidied(_overlapping(cuts)), tasks)
        dealt = dealt.repartition(min(n_runs * (len(cuts) + 1), 4 * partitions(spark)), "grp", "part").sortWithinPartitions("grp", "part", "run", "lo")
        pieces = materialize(dealt.mapInArrow(tidied(_longer_runs(uri, bounds_of(cuts), level)), PIECE_DDL), "pieces")
    cuts = cuts_of(ranges)
    bounds = bounds_of(cuts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("n", pa.int64()), *RUN_SCHEMA])
        for _, part, rows in _merged(batches, uri, bounds):
            n = 0
            while some := list(itertools.islice(rows, RUN_ROWS)):
                yield pa.record_batch([pa.array([part] * len(some), pa.int32()), pa.array(range(n, n + len(some)), pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*some), RUN_SCHEMA.types))], schema=schema)
                n += len(some)

    dealt = pieces.withColumn("grp", F.lit(0).cast("long")).mapInArrow(tidied(_overlapping(cuts)), tasks)
    dealt = dealt.repartition(len(bounds), "part").sortWithinPartitions("grp", "part", "run", "lo")
    return dealt.mapInArrow(tidied(merge), "part int, n long, " + RUN_DDL)


def read_archives(runs: DataFrame, uri: str) -> DataFrame:
    """Every record of the archives of runs, read from the files: page_id, record_type, digest and size of the payload, refers_to, offset, length."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(uri)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length"]

        def records(name: str) -> Iterator[tuple]:
            with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                for h, body, at, size in read_records(iter(lambda: f.read(1 << 20), b"")):
                    sha = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if h["WARC-Type"] == "response" and hashlib.sha1(body).hexdigest() != sha:
                        raise ValueError(f"{name} at {at}: the payload doesn't have its digest")
                    page, ref = h["X-Page-Id"], h.get("X-Refers-To-Page-Id")
                    yield (int(page) if page else None, int(h["X-Payload-Length"]), sha, h["WARC-Type"], int(ref) if ref else None, name, at, size)

        for b in batches:
            for name in b.column(0).to_pylist():
                rows = records(f"{name}.warc.gz")
                while some := list(itertools.islice(rows, RUN_ROWS)):
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*some), kinds)], names=names)

    n = max(1, min(runs.count(), 4 * partitions(runs.sparkSession)))
    # Dealt in turns, which adaptive execution leaves as it is: names are small, the archives behind them aren't.
    return runs.select("run").repartition(n).mapInArrow(tidied(read), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long")


def archive(pages: DataFrame, uri: str) -> DataFrame:
    """Writes the archives of pages below uri; their runs."""
    small_batches(pages.sparkSession)
    return materialize(write_archives(with_payload(pages), uri), "runs")


def capture_index(runs: DataFrame, uri: str, fan_in: int = FAN_IN) -> DataFrame:
    """The merged index of the runs, with `capture`, the place in the URL's history.

    Nulls: html is empty, url has an empty key, page_id sorts first. Repeated rows are records of their own: captures with
    equal key, time and page stand side by side, by run. Html of any length is one record; other columns of pages are not read;
    an empty table gives an empty index.
    """
    merged = materialize(merge_runs(runs, uri, partitions(runs.sparkSession), fan_in), "index")
    spans = merged.groupBy("urlkey", "part").agg(F.count("*").alias("rows"), F.min("n").alias("first"))
    before = Window.partitionBy("urlkey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    return merged.join(spans, ["urlkey", "part"]).withColumn("capture", F.col("before") + F.col("n") - F.col("first")).drop("before", "first")


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """What the archives say of every page, with its place in the merged index."""
    uri = scratch_path(spark, "warc")
    runs = archive(table(spark, sf_dir, "pages"), uri)
    index = capture_index(runs, uri)
    back = read_archives(runs, uri)
    place = index.select("archive", "offset", "urlkey", "capture")
    # Spark takes what a Python operator makes for as small as what it read, and would broadcast all records.
    return back.hint("merge").join(place, ["archive", "offset"]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "capture")
