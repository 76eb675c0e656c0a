from __future__ import annotations

import random
import re

import numpy as np
from helpers import clashing, docs_of, odd_docs, rows, texts
from test_dedup import LOWER, brute_components, brute_fingerprint

import corpus_pipeline
from gridloom.llm import near_copies
from gridloom.llm.simhash import drop_near_duplicates


def drop(docs):
    return drop_near_duplicates(docs, width=5, similarity=0.8)


def brute_kept(some: dict, width=5):
    """Identifiers that stay, from all pairs of sets of shingles."""
    sets = {}
    for i, t in some.items():
        words = re.findall(r"[^ \t\n\x0b\x0c\r]+", (t or "").translate(LOWER))
        sets[i] = {tuple(words[j : j + width]) for j in range(max(1, len(words) - width + 1))} if words else set()
    root = {i: i for i in some}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in some:
        for j in some:
            same = len(sets[i] & sets[j])
            if i < j and (sets[i] == sets[j] or 5 * same >= 4 * len(sets[i] | sets[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i for i in some if find(i) == i}


def edited() -> list[str]:
    """Texts with copies in which a few words differ, far beyond 4 bits of a fingerprint; one large cluster around 0.8."""
    r = random.Random(5)
    word = lambda: "w%d" % r.randrange(50_000)
    out = []
    for i in range(40):
        base = [word() for _ in range(r.randrange(60, 300))]
        out.append(" ".join(base))
        for _ in range(r.randrange(3) if i else 200):
            copy = list(base)
            for _ in range(max(1, len(base) * r.randrange(4) // 100)):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    passage = " ".join(word() for _ in range(30))
    out += [f"{passage} {' '.join(word() for _ in range(r.randrange(5, 60)))}" for _ in range(100)]
    return out + texts(60, 8)


def test_stage_finds_all_pairs_at_08(spark, sf):
    some = edited()
    kept = {r["doc_id"] for r in rows(corpus_pipeline.near_dedup_stage(spark, docs_of(spark, some), sf))}
    want = brute_kept(dict(enumerate(some)))
    assert kept == want
    assert len(want) < len(set(brute_components({i: brute_fingerprint(t) for i, t in enumerate(some)}).values()))


def test_order_does_not_matter(spark, monkeypatch):
    some = edited()
    monkeypatch.setattr(near_copies, "SAMPLE", 1)
    monkeypatch.setattr(near_copies, "PAIRS", 64)
    monkeypatch.setattr(near_copies, "TILE", 16)
    assert {r["doc_id"] for r in rows(drop(docs_of(spark, some)))} == brute_kept(dict(enumerate(some)))


def test_odd_and_empty_rows(spark):
    for docs in (odd_docs(spark), clashing(odd_docs(spark))):
        got = rows(drop(docs))
        assert sorted(r["doc_id"] for r in got if r["doc_id"]) == [1, 4, 5, 8, 10, 11, 12]
    assert drop(odd_docs(spark).limit(0)).count() == 0


def test_parity_maps_bound_the_difference():
    r = np.random.default_rng(2)
    for n, edits in ((50, 3), (2000, 100), (9000, 900), (30_000, 20_000)):
        a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[edits // 2 :], r.integers(0, 1 << 63, edits // 3, dtype=np.uint64)]))
        differing = len(np.setxor1d(a, b))
        p, q = near_copies.parities(a), near_copies.parities(b)
        w = min(len(p), len(q))
        bound = np.bitwise_count(near_copies.folded(p, w) ^ near_copies.folded(q, w)).sum()
        assert 0.2 * differing < bound <= differing
        assert (near_copies.folded(p, 16) == near_copies.folded(near_copies.folded(p, w), 16)).all()
    long = r.integers(0, 1 << 63, (2, 3000), dtype=np.uint64)
    keys, similar = np.array([1, 2]), near_copies.Similar(0.8)
    maps = np.empty(2, dtype=object)
    maps[:] = [near_copies.parities(np.unique(x)) for x in long]
    assert near_copies.group_pairs(keys, np.array([3000, 3000]), maps, keys, keys * 0, nearest=False, similar=similar).shape == (2, 0)


def test_the_walk_gives_pairs_that_make_its_links():
    """With ``met``, every pair is within the budget, and the pairs have the components of the links."""
    from gridloom.llm.simhash import trie_links

    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in r.choice(64, 3, replace=False)) for _ in range(600)], dtype=np.uint64)
    fps = np.unique(np.concatenate([base, np.repeat(base, 10) ^ flips]))
    met: list[np.ndarray] = []
    to = trie_links(np.zeros(len(fps), dtype=np.int64), fps, 4, met)
    a, b = np.concatenate(met, axis=1)
    assert (np.bitwise_count(fps[a] ^ fps[b]) <= 4).all() and len(a) == (to != np.arange(len(fps))).sum() > 100
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        i, j = sorted((top(i), top(j)))
        root[j] = i
    assert [top(i) for i in range(len(fps))] == to.tolist()


def test_the_stage_walks_the_trie(spark, monkeypatch):
    """Near copies within the walk's reach are linked by it, and what it links is checked on whole sets."""
    walked, plain = [], near_copies._walked
    monkeypatch.setattr(near_copies, "_walked", lambda *x: walked.append(plain(*x).cache()) or walked[-1])
    text = " ".join(f"word{i}" for i in range(400))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "something else altogether"), (4, None)], "doc_id long, text string")
    assert sorted(x["doc_id"] for x in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()) == [1, 3, 4]
    assert walked[0].count() >= 1
