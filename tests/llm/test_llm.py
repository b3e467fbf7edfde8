"""Operators against brute force, round trips and edge cases on small tables."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import bpe, chat_format, components, decontaminate, jaccard_join, language_id, license_scan, quality_classifier, quality_rules, substring_dedup, warc
from riskloom.llm.shingles import shingle_set

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{k * 7919 % 3001}" for k in range(20_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, signals string, key string, kept string, h long"


def edge_docs(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows, and columns that operators use inside."""
    t = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None), (2, ""), (3, " \n "), (4, LONG), (5, t), (5, t), (6, t), (None, t), (7, "short"), (8, "short")]
    return spark.createDataFrame([(i, x, None if i == 7 else "en", None, 3, "s", None, "k", 1) for i, x in rows], SCHEMA)


@pytest.fixture(scope="module")
def vocab(spark):
    return bpe.load_vocabulary(spark, bpe.tokenizer_path())


def test_bpe_equals_the_library(spark, vocab):
    from tokenizers import Tokenizer

    lib, own, draw = Tokenizer.from_file(bpe.tokenizer_path()), bpe.vocabulary(vocab), random.Random(3)
    alphabet = [chr(c) for c in range(0x180)] + ["<|endoftext|>", "  ", " a", "'ll", " ", "　", "漢", "😀", "é"]
    texts = ["", " ", "a" * 500, "the cat's  hat\n\n x"] + ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 40))) for _ in range(1500)]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        mine = own.encode(t)
        assert np.frombuffer(mine, "<u4").tolist() == ids, repr(t)
        assert own.decode(mine) == lib.decode(ids, skip_special_tokens=False)
    for n in (5, 96, 97, 300):
        w = "".join(draw.choice("etaoinshrdlu") for _ in range(n)).encode()
        assert own.merge_short(w) == own.merge_long(w)


def test_bpe_edges(spark):
    got = {r["doc_id"]: r for r in bpe.digest(edge_docs(spark)).collect()}
    assert got[1]["n_tokens"] == got[2]["n_tokens"] == 0
    assert got[4]["decoded_sha256"] == hashlib.sha256(LONG.encode()).hexdigest()


def test_quality_signals(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, "a b c d e f g h " * 3 + "\nx\nx\n \n#|"), (-2, None), (-3, "")], "doc_id long, text string")
    for r in quality_rules.with_signals(docs.union(extra)).collect():
        text, s = r["text"] or "", r["signals"]
        w = WORD.findall(text)
        grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == want


def test_decision_list():
    draw = random.Random(1)
    rows = [(0 if a > 0.7 and b < 0.3 else 1, a, b) for a, b in ((draw.random(), draw.random()) for _ in range(1500))]
    rules = quality_rules.learn_decision_list(rows, ["a", "b"])
    cols = {"a": np.array([r[1] for r in rows]), "b": np.array([r[2] for r in rows])}
    hit = np.zeros(len(rows), bool)
    for r in rules:
        hit |= r.mask(cols, len(rows))
    bad = np.array([r[0] == 0 for r in rows])
    assert (hit == bad).mean() > 0.97
    assert quality_rules.learn_decision_list([], ["a"]) == [] and quality_rules.learn_decision_list([(1, 0.5)] * 9, ["a"]) == []


def test_quality_rules_edges(spark):
    docs = edge_docs(spark)
    out = quality_rules.stage(spark, docs, SF)
    assert out.columns == docs.columns and quality_rules.stage(spark, docs.limit(0), SF).count() == 0
    kept = quality_rules.apply_rules(docs.select("doc_id", "text"), []).collect()
    assert len(kept) == 10 and all(r["kept"] == (not r["base_failed"]) for r in kept)


def brute_components(texts):
    sets = {k: frozenset(shingle_set(t).tolist()) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in ids}


@pytest.mark.parametrize("small_run, chunk", [(24, 1 << 16), (2, 1 << 16), (24, 3), (2, 11)])
def test_jaccard_join(spark, small_run, chunk):
    """Chains of near copies around their hub, some linked to each other only through it; lists whole, and dealt in chunks of any size."""
    draw, texts = random.Random(7), {}
    for g in range(4):
        base = [f"g{g}x{k}" for k in range(60)]
        for c in range(30):
            w = list(base)
            for _ in range(draw.randint(0, 3)):
                w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
            texts[len(texts)] = " ".join(w)
    texts |= {900: None, 901: "", 902: "A b", 903: "a B", 904: "a b c", 905: LONG, 906: LONG + " tail"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs, small_run, 7, chunk).collect()}
    assert got == brute_components(texts)


def test_divide_skip():
    draw = random.Random(5)
    for _ in range(60):
        q = np.unique(np.array([draw.randrange(60) for _ in range(40)], np.uint64))
        sets = [np.unique(np.array([draw.choice(q) if draw.random() < 0.9 else draw.randrange(60, 99) for _ in range(draw.randint(5, 60))], np.uint64)) for _ in range(draw.randint(1, 12))]
        want = [k for k, s in enumerate(sets) if 7 * len(np.intersect1d(q, s)) >= 3 * (len(q) + len(s))]
        assert sorted(jaccard_join.divide_skip(q, sets)) == want


def test_jaccard_edges(spark):
    docs = edge_docs(spark)
    got = collections.defaultdict(set)
    for r in jaccard_join.near_duplicates(docs).collect():
        got[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert got[1] == {(0, 1)} and got[6] == {(8, 5)} and got[8] == {(1, 7)} and got[None] == {(8, 5)}
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0
    kept = jaccard_join.stage(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 7]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[k] for k in range(41)}) == 1 and len({got[k] for k in (100, 101, 102)}) == 1 and got[0] != got[100]


def test_substring_dedup(spark):
    draw = random.Random(2)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    p, short = noise(80), noise(40)
    fuzzy = list(p)
    fuzzy[30], fuzzy[55:55] = "changed", ["put", "in"]
    texts = {1: noise(30) + p + noise(30), 2: noise(90) + p + noise(5), 3: fuzzy + noise(60), 4: noise(200), 5: short + noise(100), 6: noise(10) + short, 7: [], 8: p[:79]}
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()] + [(9, None), (None, " ".join(p))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in substring_dedup.repeated_passages(docs).collect()}
    assert set(got) == {2, 3, 8}
    assert (got[2]["start_word"], got[2]["end_word"], got[2]["src_doc_id"], got[2]["src_start"], got[2]["edits"]) == (90, 170, 1, 30, 0)
    assert (got[3]["start_word"], got[3]["end_word"], got[3]["edits"]) == (0, 82, 3)
    left = {r["doc_id"]: r["text"] for r in substring_dedup.stage(spark, docs.withColumn("n_chars", F.lit(1)), SF).collect()}
    assert left[2].split() == texts[2][:90] + texts[2][170:] and left[1].split() == texts[1] and 8 not in left


def test_substring_edges(spark):
    docs = edge_docs(spark)
    assert substring_dedup.repeated_passages(docs.limit(0)).count() == 0
    out = substring_dedup.stage(spark, docs, SF)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_chain():
    a = np.array([(0, 0, 10), (12, 12, 10), (30, 5, 10), (40, 41, 10), (300, 80, 10)], substring_dedup.ANCHOR)
    best = substring_dedup.chain(a)
    assert best[0]["p"].tolist() == [0, 12, 40] and sum(map(len, best)) >= 4
    assert substring_dedup.edits(np.array([1, 2, 3, 4]), np.array([1, 9, 3, 4, 5])) == 2


def test_decontamination(spark):
    item = "On Monday the farmer Alice has 12 apples and gives 5 apples to Bob before the 12 friends arrive home."
    same = "x. On Tuesday the farmer Carol has 31 apples and gives 7 apples to Dave before the 31 friends arrive home."
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short")], "item_id long, text string")
    docs = spark.createDataFrame([(1, same), (2, same.replace("the 31", "the 99")), (3, None), (4, ""), (5, "y " + item), (6, LONG)], "doc_id long, text string")
    got = {r["doc_id"]: r["exact"] for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {1: False, 5: True}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 and decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.stage(spark, edge_docs(spark), SF).count() == 10


def test_leaks_of_the_tables(spark):
    norm = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = {r["item_id"]: norm(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, b in items.items() if b in norm(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.op4_decontaminate(spark, SF).collect()}
    assert want <= got and len(got - want) <= 2


def test_language_id(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = language_id.op5_language_id(spark, SF).collect()
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.9
    docs = edge_docs(spark)
    preds = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, *language_id.learn_profiles(docs)).collect()}
    assert preds[1] == preds[2] == preds[3] == "und"
    assert {r["lang_pred"] for r in language_id.identify(docs, *language_id.learn_profiles(docs.limit(0))).collect()} == {"und"}


def test_quality_classifier(spark):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [r for r in quality_classifier.op7_quality_classifier(spark, SF).collect() if r["held_out"] and r["doc_id"] in label]
    good, bad = ([r["score"] for r in got if label[r["doc_id"]] == q] for q in (1, 0))
    assert good and all(0 <= s <= 1 for s in good + bad)
    assert not bad or np.mean(good) > np.mean(bad)
    docs = edge_docs(spark)
    assert quality_classifier.classify(docs, None).count() == 10


def test_licenses(spark):
    texts = {1: "Licensed under the APACHE License, version 2.0\nx", 2: None, 3: "mit license mit license", 4: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", 5: "apache\nlicense"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs, license_scan.token_frequencies(docs)).collect()}
    assert [m["template"] for m in got[1]["matches"]] == ["Apache-2.0"] and got[2]["n_words"] == 0
    assert [(p["first"], p["label"]) for p in got[3]["places"]] == [(0, "mit"), (2, "mit")]
    assert [m["template"] for m in got[4]["matches"]] == ["MIT-text"] and [p["label"] for p in got[5]["places"]] == ["apache"]


def test_template_search_is_exact():
    index, draw = license_scan.TemplateIndex({}), random.Random(4)
    vocab = sorted(index.vocab)
    for _ in range(400):
        name, tokens, _, need = draw.choice(index.templates)
        block = [w for w in tokens if draw.random() < 0.93] + draw.sample(vocab, draw.randint(0, 6))
        want = {n for n, t, _, k in index.templates if len(t & set(block)) >= k}
        assert {n for n, _ in index.search(block)} == want


def test_chats(spark):
    draw = random.Random(9)
    rows = [(c, k, ["system", "user", "assistant"][0 if k == 0 and c % 2 else 1 + k % 2], draw.choice(["<s>[INST] \\n ok", "a\nb [/INST]</s>", "word " * draw.randint(0, 300), None])) for c in range(6) for k in range(draw.choice([1, 2, 700]))]
    rows += [(None, 1, "user", "x"), (3, None, None, "first"), (4, 0, "user", "tie"), (4, 0, "user", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by = collections.defaultdict(list)
    for c, k, r, t in rows:
        by[c].append((-1e18 if k is None else k, r or "", t or ""))
    for block in (1 << 16, 64):
        made = chat_format.format_chats(df, block=block).cache()
        windows = made.orderBy("conv_id", "block", "w").collect()
        back, loss = collections.defaultdict(list), collections.defaultdict(str)
        for w in windows:
            turns = chat_format.parse(w["formatted"])
            own = turns[w["n_repeated"] :]
            back[w["conv_id"]] += own
            loss[w["conv_id"]] += "".join(chat_format.unescape(w["formatted"][s["start"] : s["end"]]) for s in w["loss_spans"])
            assert w["n_tokens"] == sum(chat_format.n_tokens(t) for _, t in turns)
            assert w["n_tokens"] <= chat_format.BUDGET or len(own) == 1
            first = sorted(by[w["conv_id"]])[0]
            if first[1] == "system" and (w["w"], own[0]) != (0, first[1:]):
                assert turns[0] == first[1:]
        digests = {r["conv_id"]: r for r in chat_format.digests(made).collect()}
        assert len(digests) == len(by) and any(w["n_repeated"] for w in windows)
        for c, turns in by.items():
            want = [(r, t) for _, r, t in sorted(turns)]
            targets = "".join(t for r, t in want if r == "assistant")
            assert back[c] == want and loss[c] == targets
            assert digests[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
            assert (digests[c]["n_turns"], digests[c]["loss_chars"], digests[c]["loss_sha256"]) == (len(want), len(targets), hashlib.sha256(targets.encode()).hexdigest())
        assert sum(w["n_tokens"] for w in windows) / len(windows) > 0.6 * chat_format.BUDGET
        made.unpersist()
    assert chat_format.digests(chat_format.format_chats(df.limit(0))).count() == 0


def test_chat_query(spark):
    """The query's rows against brute force over the table, conversation -1 included."""
    by = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        by[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    probe = "</s>[INST] ok [/INST]"
    by[-1] = [(0, "user", probe), (1, "assistant", probe)]
    got = {r["conv_id"]: r for r in chat_format.op2_chat_format(spark, SF).collect()}
    assert got.keys() == by.keys()
    for c, turns in by.items():
        want = [(r, t) for _, r, t in sorted(turns)]
        targets = "".join(t for r, t in want if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(want), len(targets), hashlib.sha256(targets.encode()).hexdigest())
        assert got[c]["formatted_chars"] >= sum(len(t) for _, t in want)


@pytest.mark.parametrize("number", [lambda k: k, lambda k: 70_000 * k, lambda k: 999_983 * k - 10**8], ids=["dense", "sparse", "negative"])
def test_chat_sql(spark, tmp_path, number):
    """The SQL of the query on conversations of many windows, with and without a system turn, and turns over the budget; however turns are numbered."""
    import duckdb

    from riskloom.llm import registry

    draw = random.Random(31)
    rows = [(c, number(k), "system" if k == 0 and c % 2 else draw.choice(["user", "assistant", "a\nb"]), draw.choice(["", "é <s> [x] \\\\ ", "long "]) * draw.randint(0, draw.choice([5, 60, 600]))) for c in range(12) for k in range(draw.choice([1, 3, 120]))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = duck.execute(registry.oracle_sql()["op2_chat_format"])
    columns = [c[0] for c in want.description]
    got = chat_format.op2_chat_format(spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_chat_edges(spark):
    """A very long turn, extra columns with the operator's own names, and equal turn numbers."""
    rows = [(1, 0, "system", "be brief", 1, "h"), (1, 1, "assistant", LONG, 2, "h"), (1, 1, "assistant", "b", 2, "h"), (1, 2, "user", "", 3, "h")]
    made = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block long, head string"))
    turns = [t for w in made.orderBy("block", "w").collect() for t in chat_format.parse(w["formatted"])[w["n_repeated"] :]]
    assert turns == [("system", "be brief"), ("assistant", "b"), ("assistant", LONG), ("user", "")]


def test_archives(spark):
    body = "<p>" + "x" * 1200
    rows = [(k, f"http://www.site{k % 3}.com/{k % 5}", body if k % 4 == 0 else None if k == 1 else f"page {k} é") for k in range(40)] + [(40, None, body), (None, "http://a.com", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    uri = warc.scratch_path(spark, "warc")
    runs = warc.archive(pages, uri)
    index = warc.materialize(warc.capture_index(runs, uri), "index")
    records = warc.read_archives(runs, uri)
    back = {r["page_id"]: r for r in records.collect()}
    for page, _, html in rows:
        raw = (html or "").encode()
        assert back[page]["payload_bytes"] == len(raw) and back[page]["payload_digest"] == hashlib.sha1(raw).hexdigest()
        assert (back[page]["record_type"], back[page]["refers_to"]) == (("revisit", 40) if html == body and page != 40 else ("response", None))
    order = [(r["urlkey"], r["ts"], r["page_id"]) for r in index.orderBy("part", "n").collect()]
    assert order == sorted(order) and len(order) == 42
    history = collections.defaultdict(list)
    for r in index.collect():
        history[r["urlkey"]].append(r["capture"])
    assert all(sorted(v) == list(range(len(v))) for v in history.values())
    none = warc.scratch_path(spark, "none")
    assert warc.capture_index(warc.archive(pages.limit(0), none), none).count() == 0


def test_archives_in_passes(spark, monkeypatch):
    """More runs than a task may open, repeated rows, a very long page and columns that the operator names itself."""
    monkeypatch.setattr(warc, "PASS_ROWS", 20)
    draw = random.Random(2)
    rows = [(k, f"http://s{draw.randrange(4)}.com/{draw.randrange(3)}", "z" * 3_000_000 if k == 7 else f"p{k}", "x", 1) for k in range(300)] + [(5, "http://s1.com/1", "p5", "x", 1)] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, archive string, rep long")
    uri = warc.scratch_path(spark, "warc")
    runs = warc.materialize(warc.write_archives(warc.materialize(warc.with_payload(pages), "payload").repartition(23), uri), "runs")
    assert warc.read_archives(runs, uri).rdd.getNumPartitions() == min(23, 4 * warc.partitions(spark))
    index = warc.capture_index(runs, uri, fan_in=4).orderBy("part", "n").collect()
    order = [(r["urlkey"], r["ts"], r["page_id"]) for r in index]
    assert runs.count() == 23 and len(order) == 303 and order == sorted(order)
    assert collections.Counter(r["page_id"] for r in index) == collections.Counter(r[0] for r in rows)
    history = collections.defaultdict(list)
    for r in index:
        history[r["urlkey"]].append(r["capture"])
    assert all(v == list(range(len(v))) for v in history.values())


def test_loser_tree():
    draw = random.Random(6)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((draw.randrange(40),) for _ in range(draw.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_substring_partners(spark):
    """Exact passages whose parts stand in smaller documents, against brute force over all 50-word runs."""
    draw = random.Random(11)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    texts, wanted = {}, {}
    for g in range(12):
        p, at = noise(60), 100 * g
        for k in range(draw.randint(2, 5)):
            lo = draw.choice([0, 60 - (n := draw.randint(30, 49)), draw.randint(0, 20)])
            texts[at + k] = noise(70) + p[lo : lo + n] + noise(70)
        texts |= {at + 50: noise(20) + p + noise(20), at + 60: noise(9) + p[:45] + noise(9), at + 61: noise(9) + p[15:] + noise(9), at + 90: noise(33) + p + noise(3)}
    seen = set()
    for d in sorted(texts):
        runs = [tuple(texts[d][k : k + 50]) for k in range(len(texts[d]) - 49)]
        wanted[d] = {j for k, r in enumerate(runs) if r in seen for j in range(k, k + 50)}
        seen |= set(runs)
    got = collections.defaultdict(set)
    for r in substring_dedup.repeated_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string")).collect():
        got[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    assert sum(map(len, wanted.values())) == 12 * 60
    assert all(got[d] == wanted[d] for d in texts)


def test_substring_edits(spark):
    """Passages with 10 to 20 % of their words exchanged; brute force: without an 8-mer in common they can't be found."""
    draw = random.Random(12)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    texts, cases = {}, collections.defaultdict(list)
    for n, share, least in ((60, 0.1, 1), (60, 0.15, 0.98), (60, 0.18, 0.95), (100, 0.1, 1), (100, 0.15, 1), (100, 0.2, 0.98)):
        for _ in range(60):
            p, d = noise(n), len(texts)
            q = list(p)
            for k in draw.sample(range(n), round(n * share)):
                q[k] = noise(1)[0]
            texts[d], texts[d + 1] = noise(70) + p + noise(70), noise(55) + q + noise(85)
            if any(p[k : k + 8] == q[k : k + 8] for k in range(n - 7)):
                cases[n, share, least].append(d + 1)
    got = {r["doc_id"]: r for r in substring_dedup.repeated_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string")).collect()}
    for (n, _, least), ids in cases.items():
        assert len(ids) >= 57 and sum(d in got for d in ids) >= least * len(ids)
        assert all(55 <= got[d]["start_word"] and got[d]["end_word"] <= 55 + n and got[d]["src_doc_id"] == d - 1 for d in ids if d in got)


@pytest.mark.parametrize("bend", [0, 10])
def test_substring_all_partners(spark, bend):
    """A passage with an edit behind every eight words, of which the smallest document and the one before hold one stretch each; also with words put in."""
    draw = random.Random(14)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    p = noise(72)
    q = [noise(1)[0] if k % 9 == 8 else x for k, x in enumerate(p)]
    q[36:36] = noise(bend // 2)
    texts = {500: noise(70) + p + noise(70), 600: noise(55) + q + noise(85)}
    for k in range(8):
        texts[k], texts[550 + k] = (noise(20) + p[9 * k : 9 * k + 8] + noise(20) for _ in range(2))
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string").coalesce(1)
    rows = substring_dedup.repeated_passages(frame).collect()
    assert {r["doc_id"] for r in rows} == {600} and {r["src_doc_id"] for r in rows} == {500}
    assert set().union(*(range(r["start_word"], r["end_word"]) for r in rows)) == set(range(55, 55 + len(q) - 1))


def test_substring_meetings_of_a_hot_line():
    """Of 300 documents with one line only the two that share the words around it, with edits, meet; each sends one window."""
    draw = random.Random(15)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    line, around = noise(14), noise(42)
    bent = [x if k % 6 else noise(1)[0] for k, x in enumerate(around, 1)]
    texts = {k: noise(60) + line + noise(60) for k in range(300)} | {7: noise(60) + line + around + noise(9), 250: noise(30) + line + bent + noise(50)}
    batch = pa.record_batch([pa.array(list(texts)), pa.array([" ".join(w) for w in texts.values()]), pa.array([None] * 300, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))], names=["doc_id", "text", "spans"])
    h = substring_dedup._grams(substring_dedup.text_words(pa.array([" ".join(line)]))[0])[0][:1]
    bits = np.zeros(1 << 16, bool)
    bits[np.concatenate([substring_dedup._bit(h, k, 16) for k in range(4)])] = True

    class Held:
        value = (16, np.packbits(bits))

    t = pa.Table.from_batches(list(substring_dedup._windows(Held)([batch])))
    t = t.filter(pa.array(t.column("h").to_numpy() == h.view(np.int64)[0]))
    assert t.num_rows == 300
    for c in ("i", "j", "side"):
        t = t.append_column(c, pa.array(np.zeros(300, np.int64)))
    m = substring_dedup.unpack(substring_dedup._meetings(1)(t).column("blob").to_pylist(), substring_dedup.MATCH)
    assert m[["d", "s", "p", "q"]].tolist() == [(250, 7, 30, 60)]


def test_substring_index_is_bounded():
    """Two-word runs that many windows have fill a table of MOST_CELLS cells at most; the windows found are those of brute force."""
    draw = np.random.default_rng(16)
    rows, runs = 8000, 2000
    held = draw.random((rows, runs)) < 0.1
    code, who = np.nonzero(held.T)
    index = substring_dedup._Index(np.arange(rows), who, code.astype(np.uint32))
    assert index.table.size <= 1 << 22
    wanted = np.sort(draw.choice(runs, 300, replace=False))
    places, number = index.find(wanted.astype(np.uint32))
    assert index.least(places, number, 40).tolist() == np.flatnonzero(held[:, wanted].sum(1) >= 40).tolist()


def test_substring_second_pass_adds_words():
    """Of chains that can fill the same words the longest one is aligned; one with words of its own is, too, and one whose words are taken isn't chained."""
    w = np.arange(1, 201, dtype="<u4")
    rows = []
    for src, p0, p1 in ((3, 20, 120), (1, 30, 90), (2, 100, 180)):
        free = np.array([(max(0, p0 - 64), p1 + 64)], "<i4").tobytes() if src == 2 else np.array([(40, 80)], "<i4").tobytes()
        anchors = np.array([(p0, p0, p1 - p0)], substring_dedup.ANCHOR).tobytes()
        other = np.where((w > p0) & (w <= p1), w, w + 1000 * src).astype("<u4").tobytes()
        rows += [(9, src, 0, 0, 0, w.tobytes(), anchors, p0 - p1, free), (9, src, 0, 1, 0, other, None, p0 - p1, None)]
    names = ["doc", "src", "c", "side", "at", "words", "anchors", "rank", "free"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
    batch = pa.record_batch([pa.array(x, k) for x, k in zip(zip(*sorted(rows, key=lambda r: (r[7], r[1], r[3]))), kinds)], names=names)
    got = [(r["src_doc_id"], r["start_word"], r["end_word"]) for b in substring_dedup._align_all(iter([batch])) for r in b.to_pylist()]
    assert got == [(3, 20, 120), (2, 100, 180)]

    m = np.zeros(2, substring_dedup.MATCH)
    m["d"], m["s"], m["p"], m["q"], m["n"] = 9, 1, [100, 400], [0, 500], 8
    span = np.array([(9, 0, 150), (9, 140, 300)], substring_dedup.SPAN)
    t = pa.table({"kind": [substring_dedup.REST, substring_dedup.SPANS], "blob": pa.array([substring_dedup.pack(m), substring_dedup.pack(span)], pa.binary())})
    assert [(r["p0"], np.frombuffer(r["free"], "<i4").tolist()) for r in substring_dedup._chains(t).to_pylist()] == [(400, [336, 472])]


def test_substring_meetings_in_parts(monkeypatch):
    """Many matches of one 8-mer are dealt in parts, none of them whole in memory."""
    monkeypatch.setattr(substring_dedup, "FLUSH", 100)
    draw = random.Random(17)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    texts = {k: noise(3) + ["the"] * (30 + k) + noise(1) + ["the"] * 40 + noise(3) for k in range(20)}
    batch = pa.record_batch([pa.array(list(texts)), pa.array([" ".join(w) for w in texts.values()]), pa.array([None] * 20, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))], names=["doc_id", "text", "spans"])

    class Held:
        value = (16, np.full(1 << 13, 255, np.uint8))

    t = pa.Table.from_batches(list(substring_dedup._windows(Held)([batch])))
    for c in ("i", "j", "side"):
        t = t.append_column(c, pa.array(np.zeros(t.num_rows, np.int64)))
    got = substring_dedup._meetings(1)(t)
    m = [substring_dedup.unpack([b], substring_dedup.MATCH) for b in got.column("blob").to_pylist()]
    assert len(m) > 20 and max(map(len, m)) < 2000
    m = np.concatenate(m)
    assert {(d, s) for d, s in m[["d", "s"]].tolist()} == {(d, s) for d in range(20) for s in range(d)} and len(np.unique(m)) == len(m)


def test_substring_order(spark):
    """Passages that change places: each of them is a passage of the later document."""
    draw = random.Random(13)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    p1, p2, p3 = noise(60), noise(80), noise(60)
    docs = spark.createDataFrame([(1, " ".join(p1 + p2 + p3)), (2, " ".join(p1 + p3 + p2))], "doc_id long, text string")
    got = [(r["start_word"], r["end_word"], r["src_start"], r["edits"]) for r in substring_dedup.repeated_passages(docs).collect()]
    assert sorted(got) == [(0, 60, 0, 0), (60, 120, 140, 0), (120, 200, 60, 0)]


def test_decontamination_of_dense_and_short_items(spark):
    """Word-for-word copies of items with few literal words, or of fewer than eight words."""
    dense, names, short = "Convert 3 hours 20 minutes 15 seconds to seconds.", "Ann, Bob, Carl, Dora, Emil, Fred and Gus have 12 apples in the house.", "What is the capital of France?"
    bench = spark.createDataFrame([(1, dense), (2, names), (3, short), (4, "..."), (5, "")], "item_id long, text string")
    docs = [(1, "so " + dense), (2, "x y " + names + " z"), (3, "he asked: what is the capital of france"), (4, "What is the capital of Spain?"), (5, dense.replace("20", "21")), (6, "the capital"), (7, "")]
    got = {(r["doc_id"], r["item_id"]): r["exact"] for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1): True, (2, 2): True, (3, 3): True}


def test_decontamination_of_written_numbers(spark):
    """A number is one slot, however it is written."""
    item = "Alice buys 3 pens and then Bob buys 4 pens for the class, so how many pens do both of them have?"
    docs = [(1, item.replace("Alice", "Carol").replace("3", "3.5").replace("4", "1,200,000")), (2, item.replace("3", "1.5").replace("4", "2")), (3, item), (4, item.replace("3", "3. 5"))]
    bench = spark.createDataFrame([(1, item), (2, item.replace("3", "2.75"))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["exact"], r["coverage"]) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert all(got[d, i][1] == (1.0 if d > 1 else 14 / 15) for d in (1, 2, 3) for i in (1, 2))  # a name that opens the text is a word of it
    assert [k for k, v in sorted(got.items()) if v[0]] == [(3, 1)] and got[4, 1][1] < 14 / 15


def test_wrapped_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\nfiles to deal in the software without restriction"
    texts = {1: "# " + mit.replace("\n", "\n# ") + "\n\nother", 2: mit.replace("\n", "\n\n"), 3: "a\n\nLicensed under CC BY 4.0\nx"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: [(m["block"], m["template"]) for m in r["matches"]] for r in license_scan.scan(docs, {}).collect()}
    assert got == {1: [(0, "MIT-text")], 2: [], 3: [(2, "CC-BY-4.0")]}


def naive_template(word, opens):
    low = word.lower()
    if "0" <= word[0] <= "9":
        return "<num>"
    if low in decontaminate.UNITS:
        return "<unit>" if low == word or opens or len(word) > 1 else low
    if not opens and low != word and len(word) > 1 and word[1:] == low[1:]:
        return "<name>"
    return low


def test_decontamination_of_templates(spark):
    """Items whose numbers, names or units were exchanged, with inserted words, and with slots that contradict each other."""
    item = "the train left Berlin with 120 people and after 40 minutes the train reached Hamburg where 15 people left before it went on to Berlin again"
    exchanged = item.replace("Berlin", "Vienna").replace("120", "77").replace("Hamburg", "Prague")
    inserted = exchanged.replace("and after", "and then just after")
    contradicts = item.replace("Berlin with", "Vienna with")  # the first Berlin is exchanged, the second isn't
    twice = inserted.replace("to Vienna again", "to Warsaw again")  # consistent in each half, not as a whole
    docs = [(1, "x y z " + exchanged), (2, inserted + " q"), (3, contradicts), (4, twice), (5, item), (6, item.replace("train", "plane").replace("people", "cows").replace("left", "took"))]
    docs += [(None, item), (7, None), (8, ""), (5, item), (9, ("pad " * 30_000) + exchanged)]
    frame = spark.createDataFrame([(k, t, "s", 1) for k, t in docs], "doc_id long, text string, d_raw string, shift int")
    bench = spark.createDataFrame([(1, item, 5), (1, item, 6), (None, "another item of many words that nobody has ever written down here", 1)], "item_id long, text string, b_n int")
    for limit in (decontaminate.BROADCAST_WINDOWS, 0):
        got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(frame, bench, broadcast_windows=limit).collect()}
        assert {k for k, _ in got} == {1, 2, 4, 5, 9}, limit
        assert got[5, 1]["exact"] and not got[1, 1]["exact"] and got[1, 1]["coverage"] == 1.0 and got[9, 1]["coverage"] == 1.0
        assert got[4, 1]["coverage"] < got[2, 1]["coverage"] < 1  # a part of the contradicting one, all but the cut windows of the inserted one
    assert decontaminate.contaminated(frame.limit(0), bench).count() == decontaminate.contaminated(frame, bench.limit(0)).count() == 0
    kept = frame.join(decontaminate.contaminated(frame, bench).select("doc_id").distinct(), "doc_id", "left_anti")
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [3, 6, 7, 8]


def test_decontamination_is_exact(spark):
    """Random texts of few words, so that windows meet by chance, against a naive count of the windows that match as templates."""
    draw = random.Random(21)
    vocab = ["Rome", "Paris", "km", "hours", "7", "12"] + [f"w{k}" for k in range(5)]
    phrase = lambda n: " ".join(draw.choice(vocab) for _ in range(n))
    items = {k: phrase(draw.randint(3, 16)) for k in range(12)}
    docs = {}
    for k in range(80):
        words = draw.choice(list(items.values())).split()
        for _ in range(draw.randint(0, 2)):
            words[draw.randrange(len(words))] = draw.choice(vocab)
        docs[k] = phrase(draw.randint(0, 8)) + " " + " ".join(words) + " " + phrase(draw.randint(0, 8))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(frame, bench).collect()}
    low = lambda t: t.lower().split()
    for i, item in items.items():
        w = low(item)
        for d, text in docs.items():
            held = [k for k in range(len(low(text)) - len(w) + 1) if low(text)[k : k + len(w)] == w]
            if held:  # a verbatim copy is found, whatever it is made of
                assert got[d, i]["coverage"] == 1.0 or got[d, i]["n_windows"] == got[d, i]["item_windows"], (d, i)
    for (d, i), r in got.items():  # and what is found has the windows that it claims, as templates at least
        t, w = [naive_template(x, k == 0) for k, x in enumerate(docs[d].split())], [naive_template(x, k == 0) for k, x in enumerate(items[i].split())]
        n = min(8, len(w))
        have = {tuple(t[k : k + n]) for k in range(len(t) - n + 1)}
        assert sum(tuple(w[k : k + n]) in have for k in range(len(w) - n + 1)) >= r["n_windows"] - 1


def test_specific_licenses(spark, tmp_path):
    """One label for a notice, whichever others hold its words; none for words that are scattered; SQL says the same."""
    import duckdb

    from riskloom.llm import registry

    gnu = "Released under the GNU Lesser General Public License version 3"
    cases = {
        "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0,cc-by",
        "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0,cc-by",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0,cc-by",
        "Licensed under CC BY 4.0": "CC-BY-4.0,cc-by",
        "a\nLicensed under CC\nBY-ND 4.0\nb": "CC-BY-ND-4.0,cc-by",
        "Licensed under CC BY 4.0\nLicensed under CC BY-NC 4.0": "CC-BY-4.0,CC-BY-NC-4.0,cc-by",
        gnu: "LGPL-3.0",
        gnu.replace("Lesser ", ""): "GPL-3.0,gpl",
        gnu.replace(" version 3", ""): "LGPL",
        "The band was released under a deal; the mit campus has a license office.": "",
        "Released, as all of it, under the MIT License": "mit",
        "Released under the well known MIT License": "MIT,mit",
        license_scan.TEMPLATES["MIT-grant"]: "MIT-grant",
    }
    spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    rows = license_scan.op9_license_scan(spark, str(tmp_path)).collect()
    assert [r["labels"] for r in sorted(rows, key=lambda r: r["doc_id"])] == list(cases.values())
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(registry.oracle_sql()["op9_license_scan"])
    columns = [c[0] for c in want.description]
    assert sorted(str(tuple(r[c] for c in columns)) for r in rows) == sorted(map(str, want.fetchall()))


def test_whole_licenses(spark):
    """Licence texts with line breaks anywhere, upper case and comment marks."""
    draw = random.Random(8)

    def wrapped(name):
        words = license_scan.TEMPLATES[name].split(" ")
        return "".join(w + draw.choice([" ", " ", "\n", "\n * "]) for w in words)

    names = ["MIT-grant", "MIT-warranty", "BSD-source", "BSD-binary", "BSD-warranty", "Apache-2.0-header", "Apache-2.0-warranty", "GPL-3.0-header", "ISC", "MPL-2.0", "Unlicense"]
    texts = [(k, "some code\n\n" + wrapped(n).upper() + "\n\nmore code") for k, n in enumerate(names)] + [(100, "the software is provided with a warranty"), (None, wrapped("ISC"))]
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts], "doc_id long, text string, matches string")
    found = license_scan.scan(docs, license_scan.token_frequencies(docs))
    got = {r["doc_id"]: {m["template"] for m in r["matches"]} for r in found.collect()}
    assert all(n in got[k] for k, n in enumerate(names)) and got[100] == set() and "ISC" in got[None]
    assert license_scan.scan(docs.limit(0), license_scan.token_frequencies(docs.limit(0))).count() == 0


@pytest.mark.parametrize("name", ["op2_chat_format", "op6_warc", "op8_jaccard_join", "op9_license_scan"])
def test_queries_match_sql(spark, name):
    import os

    import duckdb

    from riskloom.llm import registry

    duck = duckdb.connect()
    for f in os.listdir(SF):
        duck.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    want = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    show = lambda rows: sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert show(tuple(r) for r in got.select(*columns).collect()) == show(want.fetchall())


def test_license_blocks_match_sql(spark, tmp_path):
    """The SQL of the license scan on texts whose notices run over lines, with blank lines of all kinds."""
    import duckdb

    from riskloom.llm import registry

    notice = "Redistribution and use in source and binary forms,\nwith or without modification, are permitted provided\nthat the following conditions are met"
    texts = [notice, notice.replace("\n", "\n \t\n"), "a\n\n" + notice + "\n\n\nLicensed under CC BY 4.0", "  \n" + notice, "", None, "mit license\r\n\r\n" + notice]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(registry.oracle_sql()["op9_license_scan"])
    columns = [c[0] for c in want.description]
    got = license_scan.op9_license_scan(spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_substring_recall_on_the_tables(spark):
    """Every run of 50 words that a smaller document has, over the whole table by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in docs.collect()}
    seen, wanted = set(), {}
    for d in sorted(texts):
        w = texts[d]
        runs = [b" ".join(w[k : k + 50]) for k in range(len(w) - 49)]
        wanted[d] = {j for k, r in enumerate(runs) if r in seen for j in range(k, k + 50)}
        seen |= set(runs)
    for parts in (1, 7):  # whichever rows meet in a task
        got = collections.defaultdict(set)
        for r in substring_dedup.repeated_passages(docs.repartition(parts)).collect():
            assert r["src_doc_id"] < r["doc_id"] and r["edits"] <= 0.2 * r["n_words"]
            got[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
        missed = sum(len(wanted[d] - got[d]) for d in texts)
        assert sum(map(len, wanted.values())) > 1000 and missed == 0


def test_substring_twice_in_a_document(spark):
    """Both places of a passage that a later document has twice, whether the documents meet in a task or not."""
    draw = random.Random(5)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    p = noise(60)
    docs = spark.createDataFrame([(1, " ".join(noise(10) + p)), (2, " ".join(p + noise(40) + p)), (3, " ".join(noise(5) + p))], "doc_id long, text string")
    for frame in (docs.coalesce(1), docs.repartition(3, "doc_id")):
        got = {(r["doc_id"], r["start_word"], r["end_word"]) for r in substring_dedup.repeated_passages(frame).collect()}
        assert got == {(2, 0, 60), (2, 100, 160), (3, 5, 65)}


def test_substring_of_a_hot_line(spark):
    """One passage in every document, and a document without words of its own: matches stay in proportion."""
    draw = random.Random(3)
    noise = lambda n: [f"n{draw.randrange(10**9)}" for _ in range(n)]
    line = noise(55)
    docs = [(k, " ".join(noise(30) + line + noise(30))) for k in range(400)]
    frame = spark.createDataFrame([(k, t, "s") for k, t in docs], "doc_id long, text string, anchors string").repartition(9)
    rows = substring_dedup.repeated_passages(frame).collect()
    assert {r["doc_id"] for r in rows} == set(range(1, 400)) and len(rows) <= 3 * 400
    assert all((r["start_word"], r["end_word"]) == (30, 85) for r in rows)


def test_long_lists_of_the_join(spark):
    """20,000 classes in one list: near copies of two texts. Members are dealt a bounded number of times, and components are those of brute force."""
    base = [f"b{k}" for k in range(60)]
    other = base[:44] + [f"c{k}" for k in range(30)]
    docs = [(k, " ".join(base + [f"x{k}"])) for k in range(19_000)] + [(20_000 + k, " ".join(other + [f"y{k}"])) for k in range(1000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(frame, chunk=5000).collect()}
    assert set(got.values()) == {0, 20_000} and all(c == (0 if d < 20_000 else 20_000) for d, c in got.items())
    m = spark.range(20_000).selectExpr("cast(7 as long) as token", "id as k", "50L as n", "0L as spot", "0L as c")
    roots = spark.range(20_000).selectExpr("id as node", "if(id < 19990, 0, id) as root")
    dealt = jaccard_join._meetings(m, roots, 2048)
    assert dealt.count() <= 2 * 20_000 and dealt.groupBy("i", "j").count().agg({"count": "max"}).first()[0] <= 2 * 2048 * 1.2
    met = {(r["a"], r["b"]) for r in dealt.filter("k = 5 or root = k").crossJoin(spark.range(1)).alias("x").join(dealt.alias("y"), "token").filter("x.i = y.i and x.j = y.j and x.k < y.k and x.root <> y.root and x.k = 5").selectExpr("x.k as a", "y.k as b").collect()}
    assert met == {(5, b) for b in range(19_990, 20_000)}
    assert jaccard_join._meetings(m, roots.withColumn("root", F.lit(0).cast("long")), 2048).count() == 0


def test_path_components(spark):
    """A path in order of its names, and rings: few rounds, one root for each."""
    path = [(k, k + 1) for k in range(400)] + [(1000 + k, 1000 + (k + 1) % 50) for k in range(50)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert len({got[k] for k in range(401)}) == 1 and len({got[1000 + k] for k in range(50)}) == 1 and got[0] != got[1000]


def test_bpe_digests(spark):
    """The query's digests of every document of the table, against the library; null ids, repeated rows and an empty table."""
    import struct

    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.tokenizer_path())
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in bpe.op3_bpe(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        assert got[d]["n_tokens"] == len(ids) and got[d]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    docs = edge_docs(spark)
    rows = bpe.digest(docs).collect()
    assert len(rows) == 10 and len({(r["n_tokens"], r["ids_sha256"]) for r in rows if r["doc_id"] in (None, 5, 6)}) == 1
    assert bpe.digest(docs.limit(0)).count() == 0


def test_language_brute_force(spark):
    """Bundles by plain sums over letters, for a few texts; null ids, repeated rows and tables without rows."""
    draw = np.random.default_rng(4)
    texts = ["hello world", "hallo welt hallo", "xyz"]
    e = language_id.Encoder(256)
    for t in texts:
        want = np.zeros(256)
        padded = " " + t + " "
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            want += np.roll(e.letter(ord(a)), 2).astype(int) * np.roll(e.letter(ord(b)), 1) * e.letter(ord(c))
        assert np.allclose(e.encode(t), want / np.linalg.norm(want), atol=1e-5)
    docs = edge_docs(spark)
    langs, profiles = language_id.learn_profiles(docs)
    rows = language_id.identify(docs, langs, profiles).collect()
    assert len(rows) == 10 and len({(r["lang_pred"], round(r["score"], 6)) for r in rows if r["doc_id"] in (None, 5, 6)}) == 1
    empty = docs.limit(0)
    assert language_id.identify(empty, *language_id.learn_profiles(empty)).count() == 0
    some = spark.createDataFrame([(k, f"{'aeiou'[k % 2] * 3} {draw.integers(9)} bc", "l" + str(k % 2)) for k in range(60)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language_id.identify(some.filter("doc_id % 2 = 0"), *language_id.learn_profiles(some)).collect()} == {"l0"}


def test_quality_votes(spark):
    """Votes against a plain nearest-neighbour search in the same space, held-out order, and tables without rows or labels."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    space = quality_classifier.learn(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.classify(docs, space).collect()}
    for r in docs.orderBy("doc_id").limit(40).collect():
        z = space.project(*quality_classifier.token_counts(r["text"])).astype(np.float32)
        cos = space.vectors @ z
        near = np.argsort(-cos, kind="stable")[: quality_classifier.NEIGHBOURS]
        w = np.maximum(cos[near], 0) ** 2 + 1e-9
        assert abs(got[r["doc_id"]] - float((w * space.labels[near]).sum() / w.sum())) < 0.02
    bad = [(2000 + k, "@@ ## !! " * (5 + k % 7)) for k in range(60)]
    good = [(1000 + k, f"a calm sentence number {k} about the sea and the hills and whatever grows there in spring time") for k in range(60)]
    frame = spark.createDataFrame(good + bad, "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(k < 2000)) for k, _ in good + bad] + [(None, 1), (7, None)], "doc_id long, quality int")
    op = {r["doc_id"]: r["score"] for r in quality_classifier.classify(frame, quality_classifier.learn(frame, marks)).collect()}
    assert min(op[k] for k, _ in good) > 0.9 and max(op[k] for k, _ in bad) < 0.1
    empty = frame.limit(0)
    assert quality_classifier.learn(empty, marks) is None and quality_classifier.learn(frame, marks.limit(0)) is None
    assert quality_classifier.classify(empty, None).count() == 0


def test_quality_verdicts(spark):
    """The list as a CASE against the same list over numpy columns, on the table; rows that pass neither rule nor list."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rules = [quality_rules.Rule([("symbols_per_word", ">=", 0.05), ("n_words", "<=", 400.0)]), quality_rules.Rule([("distinct_share", "<=", 0.4)])]
    rows = quality_rules.apply_rules(docs, rules).collect()
    x = quality_rules.with_signals(docs)
    exprs = quality_rules.features(F.col("signals"))
    values = {r["doc_id"]: r for r in x.select("doc_id", *[c.alias(n) for n, c in exprs.items()]).collect()}
    for r in rows:
        v, s = values[r["doc_id"]], r["signals"]
        hit = (v["symbols_per_word"] >= 0.05 and v["n_words"] <= 400) or v["distinct_share"] <= 0.4
        failed = s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"]
        assert (r["base_failed"], r["kept"]) == (failed, not failed and not hit)
    assert any(not r["kept"] and not r["base_failed"] for r in rows)


def test_stage_edges(spark):
    """Each stage on nulls, empty, blank and long texts, repeated rows, clashing names and no rows at all."""
    import corpus_pipeline

    docs = edge_docs(spark)
    x = docs
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs, SF)
        rows = out.collect()
        if name != "bpe":
            assert out.columns == docs.columns and {r["kept"] for r in rows} <= {"k"}, name
        assert f(spark, docs.limit(0), SF).count() == 0, name
    assert x is docs
