from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import anchors
from gridloom.operators.intervals import interval_join
from gridloom.sources.tables import cells_in_merged_ranges


def plain_hits(texts, patterns):
    out = []
    for key, text in texts:
        for pid, p in patterns:
            if p and text:
                out += [(key, pid, p, m.start() + 1, len(p)) for m in re.finditer(f"(?={re.escape(p)})", text)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("most", "window", "handed_on"), [(200_000, 1 << 18, 1 << 22), (2, 7, 20), (200_000, 5, 1)])
def test_every_place_of_every_pattern(spark, monkeypatch, most, window, handed_on):
    monkeypatch.setattr(anchors, "MOST_ANCHORS", most)
    monkeypatch.setattr(anchors, "WINDOW", window)
    monkeypatch.setattr(anchors, "HANDED_ON", handed_on)
    r = random.Random(1)
    texts = [(i, "".join(r.choice("abcé漢😀 ") for _ in range(r.randrange(60)))) for i in range(40)] + [(100, None), (101, ""), (102, "a"), (103, "aaaa")]
    patterns = [(i, "".join(r.choice("abcé漢😀 ") for _ in range(r.randrange(1, 5)))) for i in range(60)] + [(90, None), (91, ""), (92, "a"), (93, "aa"), (94, "aa"), (95, "😀")]
    df, known = spark.createDataFrame(texts, "k long, text string"), spark.createDataFrame(patterns, "pattern_id int, pattern string")
    assert got(anchors.find_patterns(df, known, key="k")) == plain_hits(texts, patterns)
    assert anchors.find_patterns(df, known.limit(0), key="k").count() == 0
    assert anchors.find_patterns(df.limit(0), known, key="k").count() == 0


def test_a_thousand_patterns_in_a_long_text_cost_what_hits(spark):
    r = random.Random(2)
    text = "".join(r.choice("abcdefghij") for _ in range(1_000_000))
    patterns = [(i, "xyz" + "".join(r.choice("abc") for _ in range(5))) for i in range(1000)]
    text = text[:500] + patterns[7][1] + text[500:]
    places = list(anchors._Anchors(["xy"]).places(text))
    assert [(size, p.tolist()) for size, p in places] == [(2, [500])]  # all that leaves the task
    df = spark.createDataFrame([(1, text)], "k int, text string")
    want = [(1, i, p, 501, 8) for i, p in patterns if p == patterns[7][1]]
    assert got(anchors.find_patterns(df, spark.createDataFrame(patterns, "pattern_id int, pattern string"), key="k")) == want


def test_leftmost_longest(spark):
    texts = spark.createDataFrame([(1, "abcabcd ab"), (2, "bcbc"), (3, "zzz")], "k int, text string")
    known = spark.createDataFrame([(1, "ab"), (2, "abcd"), (3, "bc"), (4, "cab")], "pattern_id int, pattern string")
    kept = anchors.leftmost_longest(anchors.find_patterns(texts, known, key="k"), "k")
    assert got(kept.select("k", "start", "pattern")) == [(1, 1, "ab"), (1, 3, "cab"), (1, 9, "ab"), (2, 1, "bc"), (2, 3, "bc")]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abé😀", max_size=30), st.lists(st.text(alphabet="abé😀", min_size=1, max_size=2), min_size=1, max_size=5))
def test_places_of_anchors(text, some):
    found = {(size, int(p)) for size, places in anchors._Anchors(some).places(text) for p in places}
    assert found == {(len(a), i) for a in some for i in range(len(text)) if text.startswith(a, i)}


def plain_pairs(points, intervals):
    return sorted((k, x, lo, hi) for k, x in points for k2, lo, hi in intervals if None not in (x, lo, hi, k) and k == k2 and lo <= x <= hi)


def test_points_meet_intervals_of_any_length(spark):
    r = random.Random(3)
    points = [(r.randrange(3), r.randrange(-5000, 5000)) for _ in range(300)] + [(1, None), (None, 3), (1, 2**61), (1, -(2**61))]
    intervals = [(r.randrange(4), lo, lo + int(4 ** (r.random() * 7)) - 1) for lo in (r.randrange(-6000, 5000) for _ in range(200))]
    intervals += [(1, 5, 4), (1, None, 4), (1, -(2**61), 2**61), (2, 0, 10**9), (1, 7, 7)]
    df = interval_join(spark.createDataFrame(points, "k int, x long"), spark.createDataFrame(intervals, "k int, lo long, hi long"), ["k"], "x", "lo", "hi")
    assert df.columns == ["k", "x", "lo", "hi"] and got(df) == plain_pairs(points, intervals)
    none = spark.createDataFrame([], "k int, lo long, hi long")
    assert interval_join(spark.createDataFrame(points, "k int, x long"), none, ["k"], "x", "lo", "hi").count() == 0


def test_a_band_join_does_not_multiply_points_and_cuts_a_hot_key(spark):
    points = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("x"), F.lit("p").alias("_level"))
    bands = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("b"), (F.col("id") - 1).alias("lo"), (F.col("id") + 1).alias("hi"))
    df = interval_join(points, bands, ["k"], "x", "lo", "hi")
    assert df.columns == ["k", "x", "_level", "b", "lo", "hi"] and df.count() == 3 * 3000 - 2
    keys = [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in line]
    assert len(keys) == 1 and "_bin" in keys[0]  # the key and the bin, not the key alone


def test_a_range_of_a_billion_cells(spark):
    cells = spark.createDataFrame([("s", 5, 7, "a"), ("s", 50_000, 1, "b"), ("t", 5, 7, "c"), ("s", 2, 2, "d"), ("s", 2, 2, "e")], "sheet string, row int, col int, v string")
    ranges = spark.createDataFrame([("s", 5, 7, 100_004, 10_006, "big"), ("s", 2, 2, 2, 3, "small")], "sheet string, row0 int, col0 int, row1 int, col1 int, name string")
    found = {r["v"]: (r["merged_range"], r["is_anchor"], r["is_merged"]) for r in cells_in_merged_ranges(cells, ranges).collect()}
    assert found == {"a": ("big", True, True), "b": (None, False, False), "c": (None, False, False), "d": ("small", True, True), "e": ("small", True, True)}


def rows_by_task(df):
    return [r["count"] for r in df.withColumn("_task", F.spark_partition_id()).groupBy("_task").count().collect()]


def test_days_apart_deals_by_rows(spark, sf, monkeypatch):
    from gridloom.operators import columns
    from gridloom.plans.operator_queries import QUERIES

    monkeypatch.setattr(columns, "ROWS_PER_TASK", 300, raising=False)
    dealt = rows_by_task(QUERIES["f13_days_apart"](spark, sf))
    assert sum(dealt) == spark.read.parquet(f"{sf}/lineitem.parquet").count() and max(dealt) < 900


def test_terms_and_collections_of_the_star_are_dealt_by_rows(spark, sf, monkeypatch):
    from gridloom.operators import columns
    from gridloom.plans.library import Library

    monkeypatch.setattr(columns, "ROWS_PER_TASK", 300, raising=False)
    lib = Library.from_star(spark, sf)
    assert max(rows_by_task(lib.collections)) < 900 and max(rows_by_task(lib.terms)) < 1800
