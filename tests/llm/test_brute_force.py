"""Learned operators on the table against plain versions, and columns that clash with the operators' own."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat_format, language_id, license_scan, quality_rules, warc

SF = "/root/testdata/sf0.001"


def test_language_predictions(spark):
    """Profiles and cosines by loops over letters; the same languages and scores."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    letters = language_id.Encoder().letter

    def plain(text):
        v = np.zeros(language_id.DIM)
        kept = [c if c.isalpha() else " " for c in (text or "").lower()]
        t = " " + " ".join("".join(kept).split()) + " "
        if len(t) < 3:
            return None
        for (a, b, c), n in collections.Counter(zip(t, t[1:], t[2:])).items():
            v += n * (np.roll(letters(ord(a)), 2).astype(int) * np.roll(letters(ord(b)), 1) * letters(ord(c)))
        return v / np.linalg.norm(v)

    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    vectors = {r["doc_id"]: plain(r["text"]) for r in docs}
    sums = collections.defaultdict(float)
    for r in docs:
        if r["lang"] and r["text"] is not None and not held(r["doc_id"]) and vectors[r["doc_id"]] is not None:
            sums[r["lang"]] = sums[r["lang"]] + vectors[r["doc_id"]]
    names = sorted(sums)
    profiles = np.array([sums[n] / np.linalg.norm(sums[n]) for n in names])
    for r in language_id.op5_language_id(spark, SF).collect():
        v = vectors[r["doc_id"]]
        want = ("und", 0.0) if v is None else (names[int((profiles @ v).argmax())], float(np.clip((profiles @ v).max(), 0, 1)))
        assert (r["lang_pred"], r["held_out"]) == (want[0], held(r["doc_id"])) and r["score"] == pytest.approx(want[1], abs=1e-4)


def test_a_language_without_letters(spark):
    docs = spark.createDataFrame([(1, "123 456", "digits"), (2, "!!", "digits"), (3, "ein Haus und ein Baum", "de"), (5, "a house and a tree", "en"), (6, "77", None)], "doc_id long, text string, lang string")
    names, profiles = language_id.learn_profiles(docs)
    assert "digits" not in names and profiles.shape == (len(names), language_id.DIM)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, names, profiles).collect()}
    assert got[1] == got[2] == got[6] == "und"


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signals(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    repeated = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    count = lambda chars: sum((text or "").count(c) for c in chars)
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": count("#*$%&|<>"), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "n_upper": count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "n_marks": count("!?;:=+_@{}[]/\\~^"), "n_distinct": len(set(w)),
    }


def test_the_learned_list_on_the_table(spark):
    """The list learned from plain statistics of all labelled rows gives the query's verdicts, on documents without a label, too."""
    docs = {r["doc_id"]: signals(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    failed = {i: s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"] for i, s in docs.items()}
    columns = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_upper long, n_marks long, n_distinct long"
    table = spark.createDataFrame([(i, tuple(s.values())) for i, s in docs.items()], f"doc_id long, signals struct<{columns.replace(' long', ':long')}>")
    ratios = quality_rules.features(F.col("signals"))
    values = {r["doc_id"]: tuple(r)[1:] for r in table.select("doc_id", *[c.alias(n) for n, c in ratios.items()]).collect()}
    labels = sorted((r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["quality"] is not None and r["doc_id"] in docs)
    rules = quality_rules.learn_decision_list([(q, *values[i]) for i, q in labels if not failed[i]], list(ratios))
    ids = sorted(docs)
    cols = {n: np.array([values[i][k] for i in ids]) for k, n in enumerate(ratios)}
    rejected = np.zeros(len(ids), bool)
    for r in rules:
        rejected |= r.mask(cols, len(ids))
    want = {i: (docs[i]["n_words"], failed[i], not failed[i] and not out) for i, out in zip(ids, rejected.tolist())}
    assert {r["doc_id"]: (r["n_words"], r["base_failed"], r["kept"]) for r in quality_rules.op10_quality_rules(spark, SF).collect()} == want


def test_columns_that_chats_name_themselves(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (2, 5, "assistant", "a")]
    plain = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = plain.withColumns({c: F.lit("x") for c in ("no_conv", "conv", "block", "head", "blocks", "opens", "w", "formatted", "long", "n", "rank", "least")})
    of = lambda df: sorted(map(str, chat_format.digests(chat_format.format_chats(df)).collect()))
    assert of(more) == of(plain)


def test_columns_that_the_license_scan_names_itself(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0"), (2, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    more = plain.withColumns({c: F.lit(7) for c in ("places", "matches", "n_words", "share", "first", "last", "label")})
    of = lambda df: sorted(map(str, license_scan.scan(df, license_scan.token_frequencies(df)).collect()))
    assert of(more) == of(plain)


def test_archives_of_repeated_pages(spark):
    """Rows of one page with one payload are all responses, others revisit the page; columns with the operator's names change nothing."""
    body = "<p>" + "y" * 1500
    rows = [(7, "http://a.com/1", body), (7, "http://a.com/1", body), (3, "http://a.com/2", body), (9, None, "small"), (8, "http://b.com", "small")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("urlkey", "part", "n", "run", "record_type", "rep", "d", "payload_digest")})
    uri = warc.scratch_path(spark, "warc")
    runs = warc.archive(pages, uri)
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.read_archives(runs, uri).collect())
    assert got == [(3, "revisit", 7), (7, "response", None), (7, "response", None), (8, "response", None), (9, "response", None)]
    index = warc.capture_index(runs, uri)
    assert sorted((r["urlkey"], r["capture"]) for r in index.collect() if r["page_id"] == 7) == [("com,a)/1", 0), ("com,a)/1", 1)]
