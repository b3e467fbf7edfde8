"""Aligned tokens against the two libraries and all pairs of tokens."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece
import tokenizers

from riskloom.llm import alignment
from riskloom.llm.bpe import tokenizer_path

SF = "/root/testdata/sf0.001"
RANKS, PIECES = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(RANKS)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def aligner():
    with open(RANKS, "rb") as f, open(PIECES, "rb") as g:
        return alignment.Aligner(f.read(), g.read())


def plain(text, libraries, aligner):
    """n_a, n_b, n_groups, digest and links by comparing every token with every other."""
    lib, sp = libraries
    a, b = lib.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    raw_a = [aligner.a.bytes_of[x] for x in a]
    names = [sp.id_to_piece(x) for x in b]
    raw_b = [bytes([int(m[1], 16)]) if (m := re.fullmatch("<0x(..)>", n)) else n.replace("▁", " ").encode() for n in names]
    raw = (" " + text).encode()
    if not text or b"".join(raw_a) != raw or b"".join(raw_b) != raw:
        return 0, 0, 0, "", []
    at_a, at_b = (np.cumsum([0, *map(len, x)]).tolist() for x in (raw_a, raw_b))
    links, j = [], 0
    for i in range(len(a)):
        while at_b[j + 1] <= at_a[i]:
            j += 1
        k = j
        while k < len(b) and at_b[k] < at_a[i + 1]:
            links.append(a[i] * aligner.n_b + b[k])
            k += 1
    groups, i, j = [], 0, 0
    for cut in sorted(set(at_a[1:]) & set(at_b[1:])):
        x, y = at_a.index(cut), at_b.index(cut)
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), sorted(links)


@pytest.mark.parametrize("stretch", [12, alignment.STRETCH])
def test_chunks_equal_whole_texts(libraries, aligner, monkeypatch, stretch):
    monkeypatch.setattr(alignment, "STRETCH", stretch)
    draw = random.Random(stretch)
    parts = ["a", "the", " ", "  ", "\n", "\t", " word", "é", "漢字", "😀", "▁", "<s>", "<|endoftext|>", "'s", "\xa0", "　", "12", "...", "ﬁ", "<0x41>", "\x1c", "\0", "ing", "tion", "\x85"]
    texts = ["", " ", "  ", " a", "a ", "\n a", "a \tb", "x" * 3000, " " * 900, "ab" * 700 + " c"]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 30))) for _ in range(1500)]
    for k in range(0, len(texts), 50):
        for text, got in zip(texts[k : k + 50], aligner.describe(texts[k : k + 50])):
            assert (*got[:4], sorted(np.frombuffer(got[4], aligner.link_type).tolist())) == plain(text, libraries, aligner), repr(text)


def test_components():
    """Groups of a random bipartite graph, against a search."""
    draw = random.Random(1)
    for _ in range(200):
        n_a, n_b = draw.randint(1, 12), draw.randint(1, 12)
        links = [(draw.randrange(n_a), draw.randrange(n_b)) for _ in range(draw.randint(0, 14))]
        a, b = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
        root = np.concatenate(alignment.components(n_a, n_b, a, b))
        want = list(range(n_a + n_b))
        for _ in range(30):
            for x, y in links:
                want[x] = want[n_a + y] = min(want[x], want[n_a + y])
        assert root.tolist() == want


@pytest.mark.parametrize("most", [10**6, 300, 0])
def test_query_equals_brute_force(spark, libraries, aligner, most):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by = {r["doc_id"]: plain(r["text"] or "", libraries, aligner) for r in docs.collect()}
    count = collections.Counter(c for x in by.values() for c in x[4])
    top = collections.defaultdict(int)
    for c, n in count.items():
        top[c % aligner.n_b] = max(top[c % aligner.n_b], n)
    want = {i: (*x[:3], len(x[4]), sum(count[c] == top[c % aligner.n_b] for c in x[4]), sum(count[c] for c in x[4]), x[3]) for i, x in by.items()}
    out, pairs = alignment.align_tokenizers(docs.repartition(3), broadcast_pairs=most)
    assert {r["doc_id"]: tuple(r)[1:] for r in out.collect()} == want
    n_b = aligner.n_b
    assert {(r["a_id"], r["b_id"]): (r["n"], r["best"]) for r in pairs.collect()} == {divmod(c, n_b): (n, n == top[c % n_b]) for c, n in count.items()}


def test_edges(spark):
    long = " ".join(f"w{k * 7919 % 3001}" for k in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n "), (4, long), (5, "one two"), (5, "one two"), (None, "one two"), (6, "a▁b")]
    docs = spark.createDataFrame([(a, b, 1, "k", 2) for a, b in rows], "doc_id long, text string, row long, links string, n long")
    got = alignment.align_tokenizers(docs)[0].collect()
    by = {r["doc_id"]: tuple(r)[1:] for r in got}
    assert len(got) == len(rows) and by[5] == by[None]
    assert by[1] == by[2] == by[6] == (0, 0, 0, 0, 0, 0, "")
    assert by[5][:6] == (2, 2, 2, 2, 2, 6) and by[3][0] and by[4][0] > 20_000
    assert alignment.align_tokenizers(docs.limit(0))[0].collect() == []
