"""Benchmark decontamination by template canonicalisation, in native expressions.

Words become template tokens: numbers, names (capitalised inside a sentence) and units
turn into typed placeholders, everything else is lower-cased. Windows of eight template tokens
of documents and benchmark items meet in a hash join, so that a question whose numbers or
names were exchanged still meets its original. Windows of one alignment (same offset
between document and item) and of those at most NEAR words beside it, where words were inserted or left out, form an
occurrence; an occurrence counts only if its slots are consistent: each value in the item stands for one value in
the document throughout. Of one that isn't, the alignment with most windows counts, if it is consistent by itself.
Windows with few literal words, and items of fewer than eight words as a whole, are matched word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import table
from riskloom.llm.native import eight_hashes, once

WINDOW = 8
#: Template tokens of a window that must be literal words.
LITERALS = 4
#: Share of an item's windows that consistent occurrences must cover.
COVERAGE = 0.5
#: Words by which alignments of one occurrence differ at most.
NEAR = 8
#: Item windows that are broadcast at most; more go through a shuffled join.
BROADCAST_WINDOWS = 200_000
#: Words taken for units (a fixed list).
UNITS = ["km", "kilometers", "kilometres", "m", "meters", "metres", "cm", "mm", "miles", "mile", "feet", "foot", "inches", "inch", "kg", "kilograms", "g", "grams", "mg", "pounds", "pound", "ounces", "liters", "litres", "ml", "gallons", "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years", "year", "dollars", "dollar", "cents", "euros", "euro", "percent", "degrees", "mph", "kmh"]
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"


def _tokens(text: Column) -> Column:
    """Words of a text; '_' marks one that opens a sentence, where a capital means nothing, and stands for a point or comma inside of a number."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), "((?:^|[.!?:\\n])[\"'\\s]*)(?=\\p{Lu})|[.,](?<=\\p{N}.)(?=\\p{N})", "$1_")
    words = F.split(marked, "[^\\p{L}\\p{N}_]+")
    return F.filter(words, lambda w: F.translate(w, "_", "") != "")


def _template(w: Column) -> Column:
    low = F.lower(w)
    literal = F.translate(low, "_", "")
    return (
        F.when((w >= "0") & (w < ":"), NUM)
        .when(low == w, F.when(w.isin(UNITS), UNIT).otherwise(literal))
        .when((F.substring(w, 1, 1) != "_") & (F.length(w) > 1) & (F.substring(w, 2, 1 << 20) == F.substring(low, 2, 1 << 20)), NAME)
        .when(literal.isin(UNITS), UNIT)
        .otherwise(literal)
    )


def with_windows(df: DataFrame, id_col: str, text_col: str, prefix: str) -> DataFrame:
    """(id, raw words, template tokens, hashes of the template windows) of each row."""
    return _windows_of(df.select(F.col(id_col).alias(prefix + "id"), once(_tokens(F.col(text_col))).alias(prefix + "raw")), prefix)


def _windows_of(x: DataFrame, prefix: str) -> DataFrame:
    x = x.withColumn(prefix + "canon", once(F.transform(prefix + "raw", _template)))
    return eight_hashes(prefix + "canon", prefix + "h", x)


def _verbatim(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(F.lower(w), "_", ""))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """A row per window of each distinct item; an item of fewer words than WINDOW is one window.

    b_len is 0 for a window of LITERALS literal tokens at least, which is met as a template; others are met word for word and
    have their length there. b_open counts the item's templates. An item opens a sentence, but a document may hold it inside of one, where its
    first word is a name if it has a capital: the first template of such an item is there in both forms.
    """
    items = with_windows(benchmark.select(F.col("item_id"), F.col("text")).distinct(), "item_id", "text", "b_").filter(F.size("b_raw") > 0)
    inside = F.concat(F.array(F.regexp_replace(F.get("b_raw", F.lit(0)), "^_", "")), F.slice("b_raw", 2, F.size("b_raw")))
    named = _windows_of(items.filter(F.startswith(F.get("b_raw", F.lit(0)), F.lit("_"))).select("b_id", F.col("b_raw").alias("b_own"), once(inside).alias("b_raw")), "b_")

    def windows(x: DataFrame, own: str) -> DataFrame:
        x = eight_hashes("b_low", "b_low_h", x.withColumn("b_low", once(_verbatim(F.col("b_raw")))))
        some = F.when(F.size("b_h") > 0, F.arrays_zip("b_h", "b_low_h")).otherwise(F.array(F.struct(F.lit(0).cast("bigint").alias("b_h"), F.xxhash64("b_low", F.size("b_low")).alias("b_low_h"))))
        x = x.select("b_id", F.greatest(F.size("b_h"), F.lit(1)).alias("b_n"), F.col(own).alias("b_own"), "b_raw", "b_canon", F.posexplode(some).alias("b_pos", "b_both"))
        x = x.select("b_id", "b_n", "b_own", "b_pos", "b_both", F.slice("b_raw", F.col("b_pos") + 1, WINDOW).alias("b_win"), F.slice("b_canon", F.col("b_pos") + 1, WINDOW).alias("b_kinds"))
        is_open = (F.size("b_kinds") == WINDOW) & (F.size(F.filter("b_kinds", lambda k: ~k.isin(NUM, NAME, UNIT))) >= LITERALS)
        return x.withColumn("b_len", F.when(is_open, 0).otherwise(F.size("b_win")))

    x = windows(items, "b_raw")
    opened = x.groupBy("b_id", "b_n", "b_own").agg(F.count_if(F.col("b_len") == 0).alias("b_open"), F.bool_or((F.col("b_len") == 0) & (F.col("b_pos") == 0)).alias("b_first"))
    # The same words stand behind both forms of the first window, so the second one may have a literal less.
    x = x.join(opened, ["b_id", "b_n", "b_own"]).unionByName(windows(named, "b_own").filter("b_pos = 0").withColumn("b_len", F.lit(0)).join(opened.filter("b_first"), ["b_id", "b_n", "b_own"]))
    x = x.withColumn("b_item", F.xxhash64("b_own")).drop("b_own", "b_first")
    return x.withColumn("b_hash", F.when(F.col("b_len") == 0, F.col("b_both.b_h")).otherwise(F.col("b_both.b_low_h"))).drop("b_both").distinct()


def _with_verbatim(d: DataFrame, verbatim: list[int]) -> DataFrame:
    """d plus the lower-cased words and, where items ask for them, the hashes of their runs of WINDOW."""
    if not verbatim:
        return d
    d = d.withColumn("d_low", once(_verbatim(F.col("d_raw"))))
    return eight_hashes("d_low", "d_low_h", d) if WINDOW in verbatim else d


def _grams(d: DataFrame, verbatim: list[int], *keep: str) -> DataFrame:
    """A row (keep, d_len, d_pos, d_hash) per window of a document: templates (d_len 0), and runs of the lengths that are met word for word."""
    if not verbatim:
        return d.select(*keep, F.lit(0).alias("d_len"), F.posexplode("d_h").alias("d_pos", "d_hash"))
    spot = lambda n, i, h: F.struct(F.lit(n).alias("d_len"), i.alias("d_pos"), h.alias("d_hash"))
    met = [F.transform("d_h", lambda h, i: spot(0, i, h))]

    def runs(n: int) -> Column:
        if n == WINDOW:
            return F.transform("d_low_h", lambda h, i: spot(n, i, h))
        spots = F.when(F.size("d_low") >= n, F.sequence(F.lit(0), F.size("d_low") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(spots, lambda i: spot(n, i, F.xxhash64(F.slice(F.col("d_low"), i + 1, n), F.lit(n))))

    met += map(runs, verbatim)  # WINDOW lengths at most
    return d.select(*keep, F.inline(F.concat(*met)))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, coverage, exact) for each contaminated pair.

    n_windows counts the item's windows that consistent occurrences hold; coverage is their share, or that among
    the templates where it is larger; ``exact`` tells whether no slot was exchanged. Null texts and items without words give no
    rows, nor do null ids; equal items are one, and an item_id with several texts is an item for each; documents of one id count together; a
    document of any length is read to its end; an empty table on either side gives no rows; other columns are not carried.
    """
    items = item_windows(benchmark)
    lengths = {r["b_len"]: r["count"] for r in items.groupBy("b_len").count().collect()}
    verbatim = sorted(set(lengths) - {0})
    d = with_windows(docs.filter("doc_id IS NOT NULL"), "doc_id", "text", "d_")
    d = _with_verbatim(d, verbatim)
    same = (F.col("d_hash") == F.col("b_hash")) & (F.col("d_len") == F.col("b_len"))
    if sum(lengths.values()) <= broadcast_windows:
        met = _grams(d, verbatim, "d_id", "d_raw").join(F.broadcast(items), same)
    else:  # only hashes are shuffled; the few documents that are hit are read again
        hits = _grams(d, verbatim, "d_id").join(items, same)
        again = F.get("d_h", F.col("d_pos"))
        if verbatim:
            of_run = F.xxhash64(F.slice("d_low", F.col("d_pos") + 1, F.greatest("d_len", F.lit(1))), "d_len")
            if WINDOW in verbatim:
                of_run = F.when(F.col("d_len") == WINDOW, F.get("d_low_h", F.col("d_pos"))).otherwise(of_run)
            again = F.when(F.col("d_len") == 0, again).otherwise(of_run)
        met = hits.join(d, "d_id").filter(again == F.col("d_hash"))
    item = ["d_id", "b_id", "b_item", "b_n", "b_open"]
    met = met.select(*item, "b_len", "b_pos", (F.col("d_pos") - F.col("b_pos")).alias("shift"), "b_win", "b_kinds", F.slice("d_raw", F.col("d_pos") + 1, F.size("b_win")).alias("d_win"))
    slots = F.filter(
        F.transform("b_kinds", lambda k, i: F.struct(k.alias("kind"), F.translate(F.lower(F.get("b_win", i)), "_", "").alias("was"), F.translate(F.lower(F.get("d_win", i)), "_", "").alias("now"))),
        lambda s: s["kind"].isin(NUM, NAME, UNIT),
    )
    one_value = lambda c: F.size(c) == F.size(F.array_distinct(F.transform(c, lambda s: F.struct(s["kind"], s["was"]))))
    spots = met.select(*item, "shift", F.struct("b_pos", (F.col("b_len") == 0).alias("open")).alias("spot"), slots.alias("slots"))
    found = spots.groupBy(*item, "shift").agg(F.collect_set("spot").alias("at"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    own = Window.partitionBy(*item).orderBy("shift")
    found = found.withColumn("leaves", (F.col("shift") - F.lag("shift").over(own) > NEAR).cast("int"))
    found = found.withColumn("occurrence", F.coalesce(F.sum("leaves").over(own), F.lit(0)))
    best = F.max(F.when(one_value("slots"), F.struct(F.size("at").alias("n"), -F.col("shift"), "at", "slots")))
    merged = found.groupBy(*item, "occurrence").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"), best.alias("best"))
    whole = one_value("slots")
    used = merged.select(*item, F.when(whole, F.col("at")).otherwise(F.col("best.at")).alias("at"), F.when(whole, F.col("slots")).otherwise(F.col("best.slots")).alias("slots")).filter("at IS NOT NULL")
    exchanged = F.exists("slots", lambda s: s["was"] != s["now"])
    pairs = used.groupBy(*item).agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), (~F.max(exchanged)).alias("exact"))
    pairs = pairs.withColumn("n_windows", F.size("at").cast("long"))
    share = F.greatest(F.col("n_windows") / F.col("b_n"), F.when(F.col("b_open") > 0, F.size(F.filter("at", lambda x: x["open"])) / F.greatest("b_open", F.lit(1))))
    return pairs.filter(share >= coverage).select(F.col("d_id").alias("doc_id"), F.col("b_id").alias("item_id"), "n_windows", F.col("b_n").cast("long").alias("item_windows"), share.alias("coverage"), "exact")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go; a null id is never contaminated.

    Repeated rows go or stay together; null, empty and very long texts are judged as contaminated does; an empty table stays empty;
    the columns of docs stay as they are, whatever their names.
    """
    hit = contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
