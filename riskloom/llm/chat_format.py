"""Chat formatting in budgeted, turn-aligned windows.

Prefix sums of turn tokens choose the spans: a window takes the next turns as long as its system turn, its history and
they stay within the budget. The first system turn of a conversation opens each of its windows, then the last turns of the
window before are repeated, up to HISTORY tokens, then the window's own turns follow. The loss mask covers the texts of
the window's own assistant turns only, so each assistant text is a target exactly once. Tokens are ASCII words and
single other characters, and four for the markup of a turn; no tokenizer is asked.

A conversation of BLOCK turns at most is one block, whatever its turns are numbered. A longer one is cut into blocks of BLOCK turn
numbers, and each block starts a window without history, so a conversation with a third of all turns is spread over many tasks. Texts
are shuffled once. A task streams its blocks and holds one window.

Template: an assistant turn is ``<s>role\\ntext</s>``, any other ``[INST]role\\ntext[/INST]``.
Inside roles and texts a backslash goes before ``\\``, ``<`` and ``[``, so no control string can
stand there; a newline in a role is ``\\n`` spelled out. Dropping the backslashes reverses it.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import materialize, partitions, slices, small_batches, table, tidied

BUDGET = 512
HISTORY = 96
BLOCK = 1 << 16
#: Conversations of more turns whose list is broadcast at most; a longer list is joined.
BROADCAST_LONG = 100_000
#: Markup of a turn, in tokens.
MARKUP = 4
#: A token: an ASCII word, or any other character that isn't ASCII white space.
TOKEN = r"[0-9A-Za-z_]+|[^0-9A-Za-z_\x09-\x0D\x20]"
_TOKEN = re.compile(TOKEN)
_ESC = re.compile(r"[\\<\[]")
_UNESC = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"(<s>|\[INST\])((?:[^\\<\[]|\\.)*)(</s>|\[/INST\])", re.S)


def escape(s: str) -> str:
    return _ESC.sub(r"\\\g<0>", s)


def unescape(s: str) -> str:
    return _UNESC.sub(lambda m: "\n" if m[1] == "n" else m[1], s)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's markup, and where the text starts and ends in it."""
    a, z = ("<s>", "</s>") if role == "assistant" else ("[INST]", "[/INST]")
    head = a + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + z, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a window."""
    out = []
    for m in _TURN.finditer(formatted):
        role, _, text = m[2].partition("\n")
        out.append((unescape(role), unescape(text)))
    return out


def n_tokens(text: str) -> int:
    return sum(1 for _ in _TOKEN.finditer(text)) + MARKUP


class Windows:
    """Cuts a stream of a block's turns into windows: (formatted, repeated turns, loss spans, tokens)."""

    def __init__(self, budget: int, history: int, system: str | None, opens_with_system: bool):
        self.budget, self.history = budget, history
        #: The system turn to repeat; the block of the conversation's start has it as its first own turn.
        self.system = None if system is None else (render_turn("system", system), n_tokens(system))
        self.own_system = opens_with_system
        self.total = self.start = 0  # prefix sums: of all turns so far, and before the window's own ones
        self.own: list[tuple] = []
        self.tail: deque[tuple] = deque()  # (prefix sum before the turn, rendered) of the last turns that history may take
        self.before: list[tuple] = []

    def _opening(self) -> int:
        return self.system[1] if self.system and not self.own_system else 0

    def add(self, role: str, text: str) -> Iterator[tuple]:
        n = n_tokens(text)
        room = self.budget - self._opening() - (self.start - self.before[0][0] if self.before else 0)
        if self.own and self.total + n - self.start > room:
            yield self.close()
            fits = self.budget - self._opening() - n
            self.before = [x for x in self.tail if self.total - x[0] <= min(self.history, fits)]
        shown = render_turn(role, text)
        self.own.append((shown, role == "assistant"))
        if not (self.own_system and self.total == 0 and len(self.own) == 1):
            self.tail.append((self.total, shown))
        self.total += n
        while self.tail and self.total - self.tail[0][0] > self.history:
            self.tail.popleft()

    def close(self) -> tuple:
        parts, spans, at = [], [], 0
        repeated = [x[1] for x in self.before]
        if self.system and not self.own_system:
            repeated.insert(0, self.system[0])
        tokens = self._opening() + self.total - (self.before[0][0] if self.before else self.start)
        for (shown, lo, hi), target in [*((x, False) for x in repeated), *self.own]:
            if target:
                spans.append({"start": at + lo, "end": at + hi})
            parts.append(shown)
            at += len(shown)
        self.own, self.start, self.own_system = [], self.total, False
        return "".join(parts), len(repeated), spans, tokens


SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
WINDOW_SCHEMA = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("w", pa.int64()), ("formatted", pa.string()), ("n_repeated", pa.int32()), ("loss_spans", SPAN), ("n_tokens", pa.int64()), ("blocks", pa.int64())])
WINDOW_DDL = "conv_id long, block long, w long, formatted string, n_repeated int, loss_spans array<struct<start:long,end:long>>, n_tokens long, blocks long"


def _assemble(budget: int, history: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams blocks: a head (the system turn, and how many blocks there are), then the turns in order."""
        key, windows, w, blocks, rows = None, None, 0, 0, []

        def flush():
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), WINDOW_SCHEMA.types)], schema=WINDOW_SCHEMA)

        def put(window: tuple) -> None:
            nonlocal w
            formatted, repeated, spans, tokens = window
            rows.append((key[1], key[2], w, formatted, repeated, spans, tokens, blocks))
            w += 1

        for b in slices(batches):
            for no_conv, conv, block, head, role, text, count, opens in zip(*(b.column(c).to_pylist() for c in ("no_conv", "conv", "block", "head", "role", "text", "blocks", "opens"))):
                if head:
                    if windows and windows.own:
                        put(windows.close())
                    key, w, blocks = (no_conv, None if no_conv else conv, block), 0, count
                    windows = Windows(budget, history, text, opens)
                    continue
                for window in windows.add(role, text):
                    put(window)
            if rows:
                yield flush()
                rows = []
        if windows and windows.own:
            put(windows.close())
            yield flush()

    return run


def format_chats(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, block: int = BLOCK) -> DataFrame:
    """WINDOW_DDL: a row per window, ordered by (conv_id, block, w); the rows of a block come out of one task in this order.

    The first n_repeated turns are system and history; loss_spans are code point offsets into formatted; n_tokens is over the
    budget only where a window has a single own turn, since turns are never cut. blocks counts those of the conversation.
    Nulls: text and role count as empty, a null turn sorts first (in a conversation of several blocks it is one of its own), a null conv_id is a conversation of its own.
    Equal turn numbers go by role and text; repeated rows are turns of their own; all turns with one number stand in one block; other columns are
    not carried; an empty table gives no window.
    """
    small_batches(conversations.sparkSession)
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 40)))
    c = conversations.select(F.col("conv_id").isNull().alias("no_conv"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), turn.alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    long = materialize(c.groupBy("no_conv", "conv").agg(F.count("*").alias("n")).filter(F.col("n") > block).select("no_conv", "conv", F.lit(True).alias("long")), "long")
    if long.count() <= BROADCAST_LONG:
        long = F.broadcast(long)
    c = c.join(long, ["no_conv", "conv"], "left").withColumn("block", F.when(F.col("long"), F.floor(F.col("turn") / block)).otherwise(0)).drop("long")
    # The conversation's first turn by number and role is the smallest of these; only whether it is a system turn counts.
    rank = F.col("turn") * 3 + F.when(F.col("role") < "system", 0).when(F.col("role") == "system", 1).otherwise(2)
    heads = c.groupBy("no_conv", "conv", "block").agg(F.min(rank).alias("least"))
    firsts = heads.groupBy("no_conv", "conv").agg(F.min("least").alias("first"), F.min("block").alias("first_block"), F.count("*").alias("blocks"))
    system = c.filter("role = 'system'").withColumn("rank", rank).join(firsts.filter("first % 3 = 1 OR first % 3 = -2"), ["no_conv", "conv"]).filter("rank = first")
    system = system.groupBy("no_conv", "conv").agg(F.min("text").alias("system"))
    heads = heads.select("no_conv", "conv", "block").join(firsts, ["no_conv", "conv"]).join(system, ["no_conv", "conv"], "left")
    heads = heads.select("no_conv", "conv", "block", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("system").alias("text"), "blocks", (F.col("system").isNotNull() & (F.col("block") == F.col("first_block"))).alias("opens"))
    turns = c.select("no_conv", "conv", "block", F.lit(False).alias("head"), "turn", "role", "text", F.lit(None).cast("long").alias("blocks"), F.lit(None).cast("boolean").alias("opens"))
    rows = heads.union(turns).repartition(partitions(conversations.sparkSession), "no_conv", "conv", "block")
    rows = rows.sortWithinPartitions("no_conv", "conv", "block", F.desc("head"), "turn", "role", "text")
    return rows.mapInArrow(tidied(_assemble(budget, history)), WINDOW_DDL)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_PART_DDL = "block long, w long, own string, n long, loss string, chars long"


def read_window(formatted: str, repeated: int, spans: list[dict]) -> tuple[str, int, str, int]:
    """A window's own turns as the text to digest, their number, its text under the loss mask, unescaped, and its length."""
    turns = parse(formatted)[repeated:]
    return "".join(f"{r}\n{t}\n" for r, t in turns), len(turns), "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans), len(formatted)


class _Digests:
    """Streams the windows of conversations, in order, through their digests, in constant memory."""

    def __init__(self):
        self.key, self.state, self.rows = (), None, []

    def add(self, conv: int | None, own: str, n: int, loss: str, chars: int) -> None:
        if (conv,) != self.key:
            self.close()
            self.key, self.state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
        s = self.state
        s[0] += n
        s[1].update(own.encode())
        s[2] += len(loss)
        s[3].update(loss.encode())
        s[4] += chars

    def close(self) -> None:
        if self.state:
            n, own, chars, loss, formatted = self.state
            self.rows.append((self.key[0], n, own.hexdigest(), chars, loss.hexdigest(), formatted))
        self.key, self.state = (), None

    def take(self) -> list[tuple]:
        out, self.rows = self.rows, []
        return out


def _digest_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations of one block; the windows of others leave as text."""
    found = _Digests()
    part = pa.schema([("block", pa.int64()), ("w", pa.int64()), ("own", pa.string()), ("n", pa.int64()), ("loss", pa.string()), ("chars", pa.int64())])
    schema = pa.schema([*_DIGEST, *part])

    def flush(texts: list[tuple]) -> pa.RecordBatch:
        rows = [(*r, *[None] * len(part)) for r in found.take()] + [(t[0], *[None] * (len(_DIGEST) - 1), *t[1:]) for t in texts]
        return pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(schema), schema.types)], schema=schema)

    for b in slices(batches, 64):
        texts = []
        for conv, block, w, formatted, repeated, spans, blocks in zip(*(b.column(c).to_pylist() for c in ("conv_id", "block", "w", "formatted", "n_repeated", "loss_spans", "blocks"))):
            own, n, loss, chars = read_window(formatted, repeated, spans)
            if blocks == 1:
                found.add(conv, own, n, loss, chars)
            else:
                texts.append((conv, block, w, own, n, loss, chars))
        yield flush(texts)
    found.close()
    yield flush([])


def _digest_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = _Digests()

    def flush() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*found.take())) or [()] * len(_DIGEST), _DIGEST.types)], schema=_DIGEST)

    for b in slices(batches, 64):
        for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "own", "n", "loss", "chars"))):
            found.add(*row)
        yield flush()
    found.close()
    yield flush()


def digests(windows: DataFrame) -> DataFrame:
    """The contract's row per conversation, read back from the windows as format_chats made them.

    A digest reads a conversation's text in order, so the windows of a conversation of several blocks pass through one task once more,
    in constant memory. An empty table gives no row.
    """
    read = materialize(windows.mapInArrow(tidied(_digest_windows), f"{_DIGEST_DDL}, {_PART_DDL}"), "digests")
    whole = read.filter("own IS NULL").select(*_DIGEST.names)
    parts = read.filter("own IS NOT NULL").select("conv_id", "block", "w", "own", "n", "loss", "chars")
    parts = parts.repartition(partitions(windows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "block", "w")
    return whole.union(parts.mapInArrow(tidied(_digest_parts), _DIGEST_DDL))


def op2_chat_format(spark, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    return digests(format_chats(c.unionByName(extra)))
