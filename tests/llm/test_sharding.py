from __future__ import annotations

import zlib

import pytest
from helpers import DOCS, clashing, docs_of, odd_docs, rows, texts

from gridloom.llm import sharding
from gridloom.llm.sharding import shard_by_bytes, write_shards


def check(got, docs, shards):
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(i), len((t or "").encode()) + 1) for i, t in docs)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(shards):
        own = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= largest
    assert {r["shard"] for r in got} <= set(range(shards))


@pytest.mark.parametrize("case", ["mixed", "hot", "few", "one"])
def test_equal_bytes_and_gapless_slots(spark, case):
    some = {"mixed": texts(300, 9), "hot": texts(100, 9) + ["the same text " * 5] * 200, "few": ["a", "bb", "ccc"], "one": ["x" * 1000]}[case]
    got = rows(shard_by_bytes(docs_of(spark, some)))
    check(got, list(enumerate(some)), 8)


def test_more_ranges_than_one_search_step(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_BYTES", 64)
    some = texts(400, 10)
    got = rows(shard_by_bytes(docs_of(spark, some), 5))
    check(got, list(enumerate(some)), 5)


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    """A sample that misses most of the keys gives uneven ranges; they are sampled again."""
    slim = spark.createDataFrame([(i * i, i, 10) for i in range(2000)], "key long, doc long, size long")
    first = sharding._quantiles
    calls = []

    def skewed(sample, n):
        calls.append(n)
        return first(sample[:50] if len(calls) == 1 else sample, n)

    monkeypatch.setattr(sharding, "_quantiles", skewed)
    bounds, sizes = sharding.splitters(slim, 20_000, 40)
    assert len(calls) > 1 and max(b for b, _ in sizes.values()) < 2_500
    assert sum(n for _, n in sizes.values()) == 2000 and bounds == sorted(bounds)


def test_odd_rows_and_empty(spark, tmp_path):
    docs = clashing(odd_docs(spark))
    got = shard_by_bytes(docs)
    assert got.count() == docs.count() and got.columns[-3:] == ["size_", "shard_", "slot_"]
    check([{**r, "size": r["size_"], "shard": r["shard_"], "slot": r["slot_"]} for r in rows(got)], [(r["doc_id"], r["text"]) for r in rows(odd_docs(spark))], 8)
    assert shard_by_bytes(odd_docs(spark).limit(0)).count() == 0
    write_shards(shard_by_bytes(docs_of(spark, texts(20, 1)), 2), f"file://{tmp_path}/s")
    assert spark.read.parquet(f"file://{tmp_path}/s").count() == 20
    nothing = spark.createDataFrame([(1, None, None, None, None)] * 3, DOCS)
    assert {(r["size"], r["slot"]) for r in rows(shard_by_bytes(nothing, 1))} == {(1, 0), (1, 1), (1, 2)}


def test_query(spark, sf):
    from gridloom.llm.sharding import op5_shard

    got = rows(op5_shard(spark, sf))
    text = {r["doc_id"]: r["text"] for r in rows(spark.read.parquet(f"{sf}/documents.parquet"))}
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    check(got, list(text.items()), 8)


@pytest.mark.parametrize("case", ["mixed", "hot"])
def test_equals_a_plain_cut(spark, case):
    """Rows in the order of (hash of the text, identifier), each in the shard that holds the middle of its bytes."""
    from pyspark.sql import functions as F

    some = {"mixed": texts(200, 12), "hot": ["the same text " * 9] * 150 + texts(60, 3)}[case]
    docs = docs_of(spark, some)
    key = {r["doc_id"]: r["k"] for r in docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()}
    size = [len(t.encode()) + 1 for t in some]
    total, at, want, filled = sum(size), 0, {}, [0] * 8
    for i in sorted(range(len(some)), key=lambda i: (key[i], i)):
        shard = min(7, (2 * at + size[i]) * 8 // (2 * total))
        want[i] = (shard, filled[shard])
        filled[shard] += 1
        at += size[i]
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in rows(shard_by_bytes(docs))} == want
