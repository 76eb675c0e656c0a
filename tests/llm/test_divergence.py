from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOCS, clashing, odd_docs, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import divergence as d


def brute(some: list[tuple], least: int, top: int) -> list[tuple]:
    """``some``: (text, lang, source)."""
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in some:
        lowered = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        v = len(kept)
        groups = {s: {t: n[t] for t in kept} for (la, s), n in counts.items() if la == lang}
        shares = lambda n: {t: 1 + 10**9 * (n[t] + 5) // (sum(n.values()) + 5 * v) for t in kept}  # noqa: B023, E731
        p = {s: shares(n) for s, n in groups.items()}
        q = shares({t: sum(n[t] for n in groups.values()) for t in kept})
        for s in groups:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            out += [(lang, s, "pair", o.decode(), -value, i) for i, (value, o) in enumerate(pairs, 1)]
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -value, i) for i, (value, t) in enumerate(terms[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[x] for x in ("lang", "source", "part", "item", "value", "rank")) for r in rows(df))


def frame(spark, some, parts=3):
    return spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(some)], DOCS).repartition(parts)


def prose(n: int, sources: int, seed: int = 0) -> list[tuple]:
    r = random.Random(seed)
    common = ["The", "of", "É", "é", "naïve", "漢字", "and"]
    rare = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    out = []
    for _ in range(n):
        s = int(sources * r.random() ** 2)
        words = [r.choice(common) if r.random() < 0.6 else rare[(s * 7 + r.randrange(12)) % 80] for _ in range(r.randrange(40))]
        out.append((r.choice([" ", "-1 ", "_"]).join(words), r.choice(["en", "en", None]), None if s == 1 else f"s{s}"))
    return [*out, (None, "en", "empty"), ("12 34", "xx", "a"), ("", "xx", None)]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_tiles_equal_plain_sums(data):
    groups, terms = data.draw(st.integers(1, 9)), data.draw(st.integers(1, 12))
    base = np.array(data.draw(st.lists(st.integers(1, 50), min_size=groups, max_size=groups)), np.int64)
    cells = {(t, g): int(base[g]) + data.draw(st.integers(0, 100)) for t in range(terms) for g in range(groups) if data.draw(st.booleans())}
    heavy, cut = data.draw(st.sampled_from([0.0, 0.3, 2.0])), data.draw(st.integers(0, groups))
    whole = np.tile(base, (terms, 1))
    for (t, g), p in cells.items():
        whole[t, g] = p
    apart = np.abs(base[:, None] - base[None, :])
    for (a, a_end), (b, b_end) in [((0, groups), (0, groups))] + ([((0, cut), (cut, groups))] if 0 < cut < groups else []):
        mine = [(t + 1000, g, p) for (t, g), p in cells.items() if a <= g < a_end or b <= g < b_end]
        if not mine:
            continue
        dense, light = d.tile_sums(*np.array(mine, np.int64).T, (a, b), (base[a:a_end], base[b:b_end]), heavy)
        want = np.abs(whole[:, :, None] - whole[:, None, :]).sum(0) - terms * apart
        for i in range(a, a_end):
            for j in range(b, b_end):
                if i < j:
                    assert dense[i - a, j - b] + light[i - a, j - b] == want[i, j]
        assert heavy < 2 or not dense.any()
        assert heavy > 0 or not light.any()


@pytest.mark.parametrize(("width", "tile", "heavy"), [(256, 1024, 0.25), (4, 8, 0.25), (3, 1000, 2.0), (5, 16, 0.0)])
def test_equals_brute_force(spark, width, tile, heavy, monkeypatch):
    whole = d.group_distances
    monkeypatch.setattr(d, "group_distances", lambda groups, postings: whole(groups, postings, width=width, tile=tile, heavy_share=heavy))
    some = prose(150, 14)
    assert got(d.source_divergence(frame(spark, some), least=6, top=5)) == brute(some, 6, 5)


def test_counts_that_are_handed_on_early(spark, monkeypatch):
    monkeypatch.setattr(d, "HELD_COUNTS", 40)
    monkeypatch.setattr(d, "CHUNK_BYTES", 16)
    some = prose(120, 6, 2)
    tallies = [r for batch in [d._Tally()] for r in [batch.add(["a b a", ""], ["x", "y"])] if r]
    assert not tallies
    assert got(d.source_divergence(frame(spark, some), least=5)) == brute(some, 5, 50)


def test_one_source_and_one_term_in_most_rows(spark, monkeypatch):
    from gridloom.llm import common

    monkeypatch.setattr(common, "HEAVY_ROWS", 3)
    monkeypatch.setattr(common, "HEAVY_KEYS", 20)
    some = prose(60, 5, 3) + [("the the hot words", "en", "s0")] * 60
    assert got(d.source_divergence(frame(spark, some, 12), least=5)) == brute(some, 5, 50)


def test_no_kept_terms_odd_rows_and_empty(spark):
    odd = [(r["text"], r["lang"], r["source"]) for r in rows(odd_docs(spark))]
    assert got(d.source_divergence(clashing(odd_docs(spark)))) == brute(odd, 30, 50)  # nothing is kept: all values 0
    assert got(d.source_divergence(clashing(odd_docs(spark)), least=1)) == brute(odd, 1, 50)
    assert d.source_divergence(odd_docs(spark).limit(0)).count() == 0


def test_shares_pass_64_bits(spark):
    from pyspark.sql import functions as F

    n, total, v = 10**15 + 7, 3 * 10**15 + 1, 10**6
    row = spark.range(1).select(*[F.lit(x).cast("long").alias(c) for c, x in (("n", n), ("total", total), ("v", v))])
    assert row.select(d.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).first()["p"] == 1 + 10**9 * (n + 5) // (total + 5 * v)
