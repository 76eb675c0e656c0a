from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions.fuzzy import indel_ratio
from gridloom.operators.similar import similar_pairs


def plain(left, right, least):
    return sorted((i, j, round(indel_ratio(a, b) / 100, 9)) for i, a in left for j, b in right if a and b and indel_ratio(a, b) / 100 >= least - 1e-12)


def noisy(r, text, alphabet):
    out = list(text)
    for _ in range(r.randrange(4)):
        at = r.randrange(len(out) + 1)
        if r.random() < 0.5 and out:
            out.pop(min(at, len(out) - 1))
        else:
            out.insert(at, r.choice(alphabet))
    return "".join(out)


@pytest.mark.parametrize("least", [0.76, 0.8, 0.9, 0.95, 1.0])
def test_no_pair_is_lost(spark, least):
    r = random.Random(int(least * 100))
    alphabet = "abcé漢😀 "
    base = ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 40))) for _ in range(60)]
    left = [(i, t) for i, t in enumerate(base)] + [(900, None), (901, ""), (902, "a"), (903, "aaaa")]
    right = [(i, noisy(r, r.choice(base), alphabet)) for i in range(150)] + [(900, None), (901, ""), (902, "aaaaa"), (903, "a")]
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} long, text string")
    got = similar_pairs(frame(left, "l"), frame(right, "r"), least, left_key="l", right_key="r")
    want = plain(left, right, least)
    assert sorted((x["l"], x["r"], round(x["ratio"], 9)) for x in got.collect()) == want and len(want) > 20


def test_all_pairs_of_a_table(spark, sf):
    names = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", F.substring(F.substring_index("text", "\n", 1), 1, 60).alias("text"))
    rows = [tuple(x) for x in names.collect()]
    got = similar_pairs(names.withColumnRenamed("item_id", "l"), names.withColumnRenamed("item_id", "r"), 0.8, left_key="l", right_key="r")
    assert sorted((x["l"], x["r"], round(x["ratio"], 9)) for x in got.collect()) == plain(rows, rows, 0.8)


def test_most_pairs_never_meet(spark):
    """The higher the bound, the fewer pairs meet that are not similar."""
    from gridloom.operators import similar

    r = random.Random(9)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(400)]
    texts = [(side, i, " ".join(r.choice(words) for _ in range(6))) for side in (0, 1) for i in range(150)]
    df = spark.createDataFrame(texts, "side int, key long, text string").withColumn("n", F.char_length("text"))
    met = [similar._meetings(df, similar._size(least), least).count() for least in (0.85, 0.9, 0.95)]
    assert met == sorted(met, reverse=True) and met[2] < 0.1 * 150 * 150, met


def test_bounds_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "x")], "k long, text string")
    with pytest.raises(ValueError):
        similar_pairs(df, df, 0.75, left_key="k", right_key="k")
    other = df.withColumnRenamed("k", "j")
    assert similar_pairs(df.limit(0), other, 0.9, left_key="k", right_key="j").count() == 0
    assert [tuple(x) for x in similar_pairs(df, other, 0.9, left_key="k", right_key="j").collect()] == [(1, 1, 1.0)]


@pytest.mark.parametrize("least", [0.9, 0.95, 1.0])
def test_classes_hold_every_link_once(spark, least):
    """Links between different texts, and copies with the name of their class, say the same as all pairs do."""
    from gridloom.operators.similar import similar_classes

    r = random.Random(int(least * 1000))
    words = ["".join(r.choice("abcdefé漢😀") for _ in range(r.randrange(1, 9))) for _ in range(60)]
    base = [" ".join(r.choice(words) for _ in range(r.randrange(1, 60))) for _ in range(30)]
    texts = [(i, noisy(r, r.choice(base), "abc ")) for i in range(120)] + [(500 + i, t) for i, t in enumerate(base * 3)] + [(900, None), (901, ""), (902, "a"), (903, "a"), (904, "ab")]
    found = [tuple(x) for x in similar_classes(spark.createDataFrame(texts, "k long, text string"), least, key="k").select("link", "left", "right", "ratio").collect()]
    of = {right: left for link, left, right, _ in found if link == "copy"}
    named = {}
    for k, t in texts:
        named.setdefault(t, min(k for k, other in texts if other == t))
    assert of == {k: named[t] for k, t in texts if t and named[t] != k}
    links = sorted((left, right, round(ratio, 9)) for link, left, right, ratio in found if link == "similar")
    kept = sorted((k, t) for t, k in named.items() if t)
    assert links == [(i, j, ratio) for i, j, ratio in plain(kept, kept, least) if i < j]
    assert len(of) > 50 and (least == 1.0 or len(links) > 50)


def test_copies_are_not_paired_with_each_other(spark):
    from gridloom.operators.similar import similar_classes

    df = spark.range(3000).select(F.col("id").alias("k"), F.concat(F.lit("a line that very many documents begin with, "), F.col("id") % 2).alias("text"))
    found = similar_classes(df, 0.95, key="k")
    assert found.count() == 2999 and [tuple(x)[1:3] for x in found.where("link = 'similar'").collect()] == [(0, 1)]


@pytest.mark.parametrize("at_once", [1, 5, 256])
def test_common_subsequence_from_a_bound(monkeypatch, at_once):
    """The same length as by the whole programme where the bound is reached, and less than the bound elsewhere."""
    from gridloom.functions import fuzzy

    monkeypatch.setattr(fuzzy, "_AT_ONCE", at_once)
    r = random.Random(at_once)
    for i in range(6000):
        a = "".join(r.choice("abc") for _ in range(r.randrange(30)))
        b = noisy(r, noisy(r, a, "abc"), "abc") if i % 4 else "".join(r.choice("abc") for _ in range(r.randrange(30)))
        needed, common = r.randrange(max(len(a), len(b)) + 2), fuzzy.lcs_length(a, b)
        got = fuzzy.lcs_length_from(a, b, needed)
        assert got == common if common >= needed else got < needed, (a, b, needed)
        ratio, found = fuzzy.indel_ratio(a, b), fuzzy.indel_ratio_from(a, b, 90)
        assert found == ratio if ratio >= 90 else found is None, (a, b)


def test_texts_that_share_pieces_by_chance_are_not_compared(spark):
    """Texts of few syllables share pieces everywhere. Few of them meet, fewer are compared, and no similar pair is lost."""
    from gridloom.operators import similar

    r = random.Random(5)
    syllables = [" the", "tion", "ing", "er", "on", "an", " of", " in", "re"]
    texts = ["".join(r.choice(syllables) for _ in range(r.randrange(90, 110))) for _ in range(250)]
    texts += [noisy(r, noisy(r, t, "the on"), "the on") for t in texts[:40]]
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "side int, key long, text string")
    met = similar._met_by_pieces(df, 0.95, alone=True)
    near = similar._near(met, df, df, 0.95)
    links = [tuple(x) for x in similar._scored(met, df, df, 0.95).select("left", "right").collect()]
    assert set(links) >= {(i, 250 + i) for i in range(40)} and len(links) == len(set(links))
    rows = list(enumerate(texts))
    assert sorted(links) == [(i, j) for i, j, _ in plain(rows, rows, 0.95) if i < j]
    # Of 41,905 pairs; 4,946 met where every place was looked at that the steps reach.
    assert met.count() < 2000 and near.count() < 200


def test_texts_that_are_all_alike_move_once_for_a_tile(spark, monkeypatch):
    """Not once for each of their pairs; and a tile holds some ``PAIRS`` pairs."""
    from gridloom.operators import similar

    monkeypatch.setattr(similar, "PAIRS", 200)
    line = "a line of some length that many documents begin with, each with a number of its own, "
    df = spark.range(150).select(F.col("id").alias("key"), F.concat(F.lit(line), F.lpad("id", 3, "0")).alias("text"))
    near = df.select(F.col("key").alias("left")).join(df.select(F.col("key").alias("right")), F.expr("left < right"))
    pairs, texts = similar._tiled(near, df, df, 4)
    assert pairs.count() == 150 * 149 / 2 and 50 < pairs.select("tile").distinct().count() <= 64
    assert texts.count() <= 2 * 150 * 8 < 150 * 149 / 4
    assert similar.similar_classes(df, 0.95, key="key").count() == 150 * 149 / 2
