"""The pipeline against brute force over its own input."""

import re

import corpus_pipeline
from riskloom.llm.shingles import shingle_set

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    stages, x = [], docs
    for name, f in corpus_pipeline.STAGES:
        x = corpus_pipeline.materialize(f(spark, x, SF), name)
        stages.append(x)
        if name != "bpe":
            assert x.columns == docs.columns
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in stages]
    assert ids[0] > ids[1] >= ids[2] >= ids[3] == ids[4]
    kept = {k: frozenset(shingle_set(texts[k]).tolist()) for k in ids[1]}
    some = sorted(kept)
    for i, a in enumerate(some):
        for b in some[i + 1 :]:
            o = len(kept[a] & kept[b])
            assert not o or 100 * o < 75 * (len(kept[a]) + len(kept[b]) - o)
    items = [" ".join(re.findall(r"\w+", r["text"].lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    final = {r["doc_id"]: " ".join(re.findall(r"\w+", r["text"].lower())) for r in stages[3].collect()}
    assert not [k for k, t in final.items() if any(i in t for i in items)]
    gone = ids[2] - ids[3]
    assert all(any(i in " ".join(re.findall(r"\w+", texts[k].lower())) for i in items) for k in gone)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [k for k, q in labels.items() if q == 1 and len(texts[k].split()) >= 20]
    assert sum(k in ids[0] for k in good) / len(good) > 0.95
