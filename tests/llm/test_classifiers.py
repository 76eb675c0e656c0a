from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from helpers import DOCS, clashing, odd_docs, rows
from pyspark.sql import functions as F

from gridloom.llm import quality, toxicity
from gridloom.llm.common import crc32_mod

LABELS = "doc_id long, quality int, toxic int"


def auc(scores, labels) -> float:
    s, y = np.asarray(scores), np.asarray(labels)
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (rank[y == 1].mean() - (n1 - 1) / 2) / n0


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(11)
    good = ["river", "meadow", "carefully", "between", "history", "painting", "evening", "orchard", "because", "although", "letters", "winter"]
    insults = ["gruzzle", "snarfle", "blorpish"]
    docs, labels = [], []
    for i in range(1500):
        n = r.choice([6, 30, 120, 2000 if i % 97 == 0 else 60])
        words = [r.choice(good) + r.choice(["", "s", "ing", "ed"]) for _ in range(n)]
        bad, toxic = r.random() < 0.3, r.random() < 0.2
        if bad:
            words = [w.upper() + "!!" if i % 2 else f"{w}%%% |" for w in words]
        if toxic:
            for _ in range(2):
                words.insert(r.randrange(len(words)), r.choice(insults) + r.choice(["", "s", "er"]))
        docs.append((i, " ".join(words), "en", "a", 1))
        if r.random() < 0.6:
            labels.append((i, int(not bad), int(toxic)))
    truth = {i: (q, t) for i, q, t in labels}
    return spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS), truth


@pytest.mark.parametrize("module, fold, out, column", [(quality, 5, 0, 0), (toxicity, 3, 1, 1)])
def test_held_out_accuracy(corpus, module, fold, out, column):
    docs, labels, truth = corpus
    held = crc32_mod(F.col("doc_id"), fold) == out
    model = module.train(docs, labels, ~held)
    scored = rows(module.score(docs, model).withColumn("held", held))
    assert all(0 <= r["score"] <= 1 for r in scored) and len(scored) == docs.count()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % fold == out) for r in scored)
    test = [(r["score"], truth[r["doc_id"]][column]) for r in scored if r["held"] and r["doc_id"] in truth]
    assert len(test) > 50 and auc(*zip(*test, strict=True)) > 0.97
    again = rows(module.score(docs, module.train(docs.repartition(5), labels.repartition(2), ~held)))
    assert {r["doc_id"]: round(r["score"], 6) for r in again} == {r["doc_id"]: round(r["score"], 6) for r in scored}


@pytest.mark.parametrize("query, fold, out, column, threshold", [(quality.op7_quality, 5, 0, "quality", 0.3), (toxicity.op6_toxicity, 3, 1, "toxic", 0.7)])
def test_queries_on_held_out_rows(spark, query, fold, out, column, threshold):
    """The registered queries on a whole table, against labels they have not seen."""
    folder = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in rows(query(spark, folder))}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % fold == out) and r["predicted"] == (r["score"] >= threshold) for i, r in got.items())
    labels = {r["doc_id"]: r[column] for r in rows(spark.read.parquet(f"{folder}/labels.parquet")) if r[column] is not None}
    test = [(got[i]["score"], y) for i, y in labels.items() if i in got and got[i]["held_out"]]
    assert {y for _, y in test} == {0, 1} and auc(*zip(*test, strict=True)) > 0.97


def test_scores_equal_a_plain_computation(spark, corpus):
    """Scores from the models' numbers by the plain definitions."""
    import math

    import zstandard

    docs, labels, _ = corpus
    some = {r["doc_id"]: r["text"] for r in docs.where("doc_id % 40 = 0").collect()}
    model = toxicity.train(docs, labels, F.lit(True))
    for r in rows(toxicity.score(docs, model).where("doc_id % 40 = 0")):
        words = set(re.findall(r"\w+", some[r["doc_id"]].lower()))
        features = words | {f"{w[:k]}*" for w in words for k in (5, 6, 7, 8) if len(w) > k}
        z = model.bias + model.length * (math.log1p(len(words)) / 5 - 1) + sum(w for f, w in model.weights.items() if f in features)
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-9
    model = quality.train(docs, labels, F.lit(True))
    sizes = lambda data, raw: sum(len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_checksum=False, write_dict_id=False).compress(data[at : at + 256])) for at in range(0, len(data), 256))
    for r in rows(quality.score(docs, model).where("doc_id % 200 = 0")):
        data = some[r["doc_id"]].encode()
        good, bad = sizes(data, model.good), sizes(data, model.bad)
        z = model.weights[0] + model.weights[1] * (bad - good) / (bad + good) + model.weights[2] * min(1.0, min(good, bad) / len(data))
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 0.02


def test_features_are_counted_over_all_texts(spark):
    """A word that a rare clean source has too is no sign, even if no sampled text shows it."""
    docs = spark.createDataFrame([(i, f"word{i % 7} common plain text " + ("gruzzle blorpish" if i % 10 == 0 else "blorpish" if i % 10 == 1 else ""), "en", "a", 1) for i in range(600)], DOCS)
    everywhere = toxicity._counts_everywhere(docs, ["gruzzle", "blorpish", "word3", "absent"])
    assert everywhere.tolist() == [60, 120, len([i for i in range(600) if i % 7 == 3]), 0]


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_labels_are_not_learnt(corpus, module, column):
    """Scores are the same when the labels of the held-out fold are turned around."""
    docs, labels, _ = corpus
    held = crc32_mod(F.col("doc_id"), 4) == 0
    turned = labels.withColumn(column, F.when(held, 1 - F.col(column)).otherwise(F.col(column)))
    a, b = (rows(module.score(docs, module.train(docs, x, ~held))) for x in (labels, turned))
    assert {r["doc_id"]: r["score"] for r in a} == {r["doc_id"]: r["score"] for r in b}


def test_quality_filter(corpus):
    docs, labels, truth = corpus
    model = quality.train(docs, labels, F.lit(True))
    kept = quality.keep_good(clashing(docs), model)
    assert kept.columns == clashing(docs).columns
    scores = {r["doc_id"]: r["score"] for r in rows(quality.score(docs, model))}
    assert {r["doc_id"] for r in rows(kept)} == {i for i, s in scores.items() if s >= 0.3}


def test_shared_lines_leave_dictionaries():
    a, b = quality.without_shared_lines([["boilerplate line of some length\nown", "x"], ["boilerplate line of some length\nother"]])
    assert (a, b) == (["own", "x"], ["other"])


def test_nnpu_reverses_negative_risk():
    """More than the prior of the unlabelled part looks positive: the corrected risk must not run below zero for long."""
    r = np.random.default_rng(0)
    rows_p, rows_u = np.arange(40), np.arange(200)
    p = (rows_p, r.integers(0, 4, 40), np.zeros(40))
    u = (rows_u, r.integers(0, 8, 200), np.zeros(200))
    w = toxicity.fit_nnpu(p, u, 8, 0.5, steps=600)
    assert np.isfinite(w).all() and w[:4].min() > w[4:8].max()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_and_missing_labels(spark, corpus, module):
    docs, labels, _ = corpus
    model = module.train(docs, labels, F.lit(True))
    odd = clashing(odd_docs(spark))
    got = rows(module.score(odd, model))
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert module.score(odd_docs(spark).limit(0), model).count() == 0
    for some in (labels.limit(0), spark.createDataFrame([(1, None, None)], LABELS), spark.createDataFrame([(99_999, 1, 1), (99_998, 0, 0)], LABELS)):
        poor = module.train(odd_docs(spark), some, F.lit(True))
        assert module.score(odd, poor).count() == odd.count()
    one = module.train(odd_docs(spark), spark.createDataFrame([(4, 1, 1), (4, 1, 1), (5, 0, 0), (6, 0, None)], LABELS), F.lit(True))
    assert module.score(odd, one).count() == odd.count()
