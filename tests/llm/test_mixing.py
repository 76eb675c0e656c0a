from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from helpers import DOCS, clashing, odd_docs, rows

from gridloom.llm.mixing import PART, mix_sources, poisson_cdf, source_rates


def unit(seed, doc, i):
    return (int(hashlib.md5(f"{seed}:{doc}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def draw(rate, seed, doc):
    """Poisson numbers by inversion, in the plainest way."""
    parts = max(1, math.ceil(rate / PART))
    total = 0
    for i in range(1, parts + 1):
        u, k, p = unit(seed, doc, i), 0, math.exp(-rate / parts)
        cdf = p
        while cdf < u and k < 200:
            k += 1
            p *= rate / parts / k
            cdf += p
        total += k
    return total


def corpus(spark):
    out = [(i, "x" * (20 + i % 50), "en", "big" if i % 3 else ("mid" if i % 2 else "small"), 1) for i in range(3000)] + [(5000, "y" * 30, "en", "rare", 1)]
    return spark.createDataFrame(out, DOCS).repartition(3)


@pytest.mark.parametrize("options", [{}, {"temperature": 1.0}, {"weights": {"big": 0.2, "mid": 0.3, "rare": 0.5}, "volume": 2.0}])
def test_counts_equal_inversion(spark, options):
    docs = corpus(spark)
    rates = {r["source"]: r["rate"] for r in rows(source_rates(docs, **options))}
    got = rows(mix_sources(docs, seed=7, **options))
    want = {r["doc_id"]: draw(rates[r["source"]], 7, r["doc_id"]) if rates[r["source"]] else 0 for r in rows(docs)}
    have = Counter(r["doc_id"] for r in got)
    assert have == Counter({k: v for k, v in want.items() if v})
    assert all(r["n_copies"] == have[r["doc_id"]] for r in got)
    assert {(r["doc_id"], r["copy"]) for r in got} == {(d, c) for d, n in have.items() for c in range(1, n + 1)}
    assert len({r["mix_key"] for r in got}) == len(got)


def test_weights_are_met(spark):
    docs = corpus(spark)
    weights = {"big": 0.25, "mid": 0.5, "small": 0.25}
    volume = Counter()
    for r in rows(mix_sources(docs, weights=weights, volume=3.0)):
        volume[r["source"]] += len(r["text"])
    total = sum(volume.values())
    assert all(abs(volume[s] / total - w) < 0.04 for s, w in weights.items())
    assert volume["rare"] == 0


def test_large_means(spark):
    """One document that stands for half of the mix repeats thousands of times, within Poisson's spread."""
    docs = corpus(spark)
    rate = {r["source"]: r["rate"] for r in rows(source_rates(docs, weights={"rare": 1.0}))}["rare"]
    n = mix_sources(docs, weights={"rare": 1.0}).count()
    assert rate > 1000 and abs(n - rate) < 6 * math.sqrt(rate)


def test_table_of_probabilities(spark):
    from pyspark.sql import functions as F

    for mean in (0.01, 1.0, 7.5, 16.0):
        table = spark.range(1).select(poisson_cdf(F.lit(mean)).alias("c")).first()["c"]
        p = [math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(97)]
        assert all(abs(c - sum(p[: k + 1])) < 1e-12 for k, c in enumerate(table))


def test_order_is_mixed(spark):
    seen = [r["source"] for r in rows(mix_sources(corpus(spark)))]
    runs = 1 + sum(a != b for a, b in zip(seen, seen[1:], strict=False))
    assert runs > len(seen) / 4


def test_odd_rows_and_empty(spark):
    docs = clashing(odd_docs(spark))
    got = mix_sources(docs, volume=20.0)
    assert got.columns == [*docs.columns, "n_copies_", "copy_", "mix_key_"]
    assert {r["source"] for r in rows(got)} <= {"a", "b", "c", None}
    assert mix_sources(odd_docs(spark).limit(0)).count() == 0
    assert mix_sources(odd_docs(spark), weights={}).count() == 0
    twice = rows(mix_sources(odd_docs(spark), volume=20.0))
    assert sorted(map(str, twice)) == sorted(map(str, rows(mix_sources(odd_docs(spark), volume=20.0))))
