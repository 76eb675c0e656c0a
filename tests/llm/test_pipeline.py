from __future__ import annotations

from collections import Counter, defaultdict

from helpers import clashing, odd_docs, rows
from test_dedup import brute_lines
from test_mixing import draw
from test_near_copies import brute_kept
from test_packing import check

import corpus_pipeline
from gridloom.llm import quality
from gridloom.llm.common import table


def test_stages_against_brute_force(spark, sf):
    """Each stage on the rows of the one before, against the plainest way to do the same."""
    docs = table(spark, sf, "documents")
    columns = docs.columns
    at = docs
    texts = {r["doc_id"]: r["text"] for r in rows(docs)}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, sf)
        if name != "packing":
            assert out.columns == columns
            out = spark.createDataFrame(out.collect(), docs.schema)
        got = rows(out)
        if name == "quality":
            score = quality.Scorer(quality.train(docs, table(spark, sf, "labels"), ~quality.held_out_fold()))
            assert {r["doc_id"] for r in got} == {i for i, t in texts.items() if score(t) >= 0.3}
            assert len(got) > 0.7 * len(texts)
        elif name == "line_dedup":
            want = brute_lines(list(texts.items()))
            assert {r["doc_id"]: r["text"] for r in got} == {i: w[2] for i, w in want.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in got)
        elif name == "near_dedup":
            kept = brute_kept(texts)
            assert {r["doc_id"]: r["text"] for r in got} == {i: texts[i] for i in kept}
        elif name == "mixing":
            sizes = defaultdict(int)
            for r in rows(at):
                sizes[r["source"]] += len(r["text"].encode())
            total, weight = sum(sizes.values()), sum(s**0.5 for s in sizes.values())
            want = Counter({r["doc_id"]: draw(sizes[r["source"]] ** 0.5 / weight * total / sizes[r["source"]], 7, r["doc_id"]) for r in rows(at) if sizes[r["source"]]})
            assert Counter(r["doc_id"] for r in got) == +want
        else:
            check(got, [(r["doc_id"], r["text"]) for r in rows(at)])
        texts = {r["doc_id"]: r["text"] for r in got} if name != "packing" else texts
        at = out


def test_run_equals_stages(spark, sf):
    at = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES:
        at = spark.createDataFrame(stage(spark, at, sf).collect() or [], at.schema) if stage is not corpus_pipeline.STAGES[-1][1] else stage(spark, at, sf)
    digest = lambda df: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows(df))
    assert digest(corpus_pipeline.run(spark, sf)) == digest(at)


def test_stages_on_odd_and_empty_rows(spark, sf):
    for docs in (odd_docs(spark), clashing(odd_docs(spark)), odd_docs(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert name == "packing" or out.columns == docs.columns
            out.count()
