from __future__ import annotations

import hashlib
import random
import time
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from helpers import DOCS, clashing, docs_of, odd_docs, rows, texts
from pyspark.sql import functions as F

from gridloom.llm.components import connected_components
from gridloom.llm.exact_dedup import drop_exact_duplicates, exact_groups
from gridloom.llm.line_dedup import LineRuns, _added_up, dedup_lines, line_hashes
from gridloom.llm.simhash import GROUP, Forest, drop_near_duplicates, fingerprint, groups, near_duplicates, near_links, trie_links

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- exact ----


def brute_exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[(t or "").translate(LOWER)].append(i)
    return {i: (max(g), len(g), i == max(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for i in g}


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_groups(spark, partitions):
    some = texts(120, 4) + ["hot text"] * 150 + ["HOT text"] * 30
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows(exact_groups(docs_of(spark, some, 5)))}
        assert got == brute_exact(list(enumerate(some)))
        kept = {r["doc_id"] for r in rows(drop_exact_duplicates(docs_of(spark, some)))}
        assert kept == {i for i, r in got.items() if r[2]}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_exact_odd_rows(spark):
    got = rows(exact_groups(clashing(odd_docs(spark))))
    assert len(got) == odd_docs(spark).count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["keep_id"] == 2 and by[1]["group_size"] == 2  # null is empty
    assert by[5]["keep_id"] == 7 and by[5]["group_size"] == 4
    assert sum(r["kept"] for r in got if r["doc_id"] == 7) == 1  # one of the repeated rows
    assert by[8]["keep_id"] == 8  # accents are not folded
    assert exact_groups(odd_docs(spark).limit(0)).count() == 0


def test_drop_exact_duplicates_keeps_one_row(spark):
    docs = [(1, "Same Text"), (3, "same text"), (3, "SAME text"), (3, "same text"), (3, "another"), (None, "same text"), (None, "alone"), (None, "ALONE"), (None, "alone"), (9, None), (8, "")]
    got = sorted((r["doc_id"] or 0, (r["text"] or "").lower()) for r in rows(drop_exact_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))))
    assert got == [(0, "alone"), (3, "another"), (3, "same text"), (9, "")]


# ---- lines ----


def brute_lines(docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= 3 and i != max(holders[key(x)]))]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_line_dedup(spark, batches):
    hot = "this very common line is in many documents"
    some = texts(60, 5) + [f"{hot}\nrow {i}\n{hot.upper()}" for i in range(30)] + ["\n".join([hot, "x" * 25] * 150)]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in rows(dedup_lines(docs_of(spark, some), batches=batches))}
    assert got == brute_lines(list(enumerate(some)))


def test_line_runs_level_up(spark):
    hashes = line_hashes(docs_of(spark, texts(40, 6)))
    runs = LineRuns(spark, fanout=2)
    earlier: set = set()
    for i in range(5):
        own = {tuple(r) for r in hashes.where(f"doc % 5 = {i}").select("h1", "h2").collect()}
        runs.add(hashes.where(f"doc % 5 = {i}"))
        if i in (0, 2, 4):  # not compacted at once: the run says what the anti-join found
            seen = {(r["h1"], r["h2"]): r["seen"] for r in runs.levels[0][-1].collect()}
            assert seen == {k: k in earlier for k in own}
        earlier |= own
    assert [len(level) for level in runs.levels] == [1, 0, 1] and runs.compactions == 3
    new = [(r["h1"], r["h2"]) for run in runs.runs() for r in run.where("not seen").collect()]
    assert len(new) == len(set(new)) and set(new) == earlier
    want = {(r["h1"], r["h2"]): (r["n"], r["k"]) for r in hashes.groupBy("h1", "h2").agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("k")).collect()}
    for least in (1, 3):
        got = {(r["h1"], r["h2"]): (r["n_docs"], r["keeper"]) for r in runs.repeated(least).collect()}
        assert got == {k: v for k, v in want.items() if v[0] >= least}
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_runs_are_not_shuffled(spark):
    """A batch meets the runs in their buckets, and compaction stays in them."""
    hashes = line_hashes(docs_of(spark, texts(40, 6)))
    runs = LineRuns(spark, fanout=9)
    for i in range(3):
        runs.add(hashes.where(f"doc % 3 = {i}"))
    plans = [_added_up(runs.runs()), runs.runs()[0].join(runs.runs()[1].hint("merge"), ["h1", "h2"], "left_anti")]
    for df in plans:
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    runs.close()


def test_long_texts_of_repeated_lines(spark):
    """Three documents that share 200,000 lines: the time is linear in the lines."""
    body = "\n".join(f"line number {i} is long enough" for i in range(200_000))
    began = time.perf_counter()
    got = {r["doc_id"]: (r["n_dropped"], len(r["text"])) for r in rows(dedup_lines(docs_of(spark, [body] * 3)))}
    assert got == {0: (200_000, 0), 1: (200_000, 0), 2: (0, len(body))}
    assert time.perf_counter() - began < 120


def test_line_odd_rows(spark):
    docs = clashing(odd_docs(spark)).withColumnRenamed("score", "N_LINES2")
    got = rows(dedup_lines(docs))
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["text"] == "" and by[1]["n_lines_"] == 1 and by[1]["n_lines"] == "x"
    assert by[5]["text"] == "" and by[7]["text"].startswith("SAME")  # three documents hold it, the largest id keeps it
    assert dedup_lines(odd_docs(spark).limit(0)).count() == 0


# ---- near ----


def brute_fingerprint(text, width=4):
    import re

    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", (text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps: dict, budget=4):
    ids = list(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= budget:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def one_group(fps):
    fps = np.array(fps, dtype=np.uint64)
    return trie_links(np.zeros(len(fps), dtype=np.int64), fps, 4)


def test_fingerprints():
    for t in texts(40, 7) + ["", None, "a", "a b c", "A b C d e"]:
        assert fingerprint(t or "") == brute_fingerprint(t)


def test_near_duplicates(spark):
    some = texts(150, 8) + ["alpha beta gamma delta epsilon"] * 20
    fps = {i: brute_fingerprint(t) for i, t in enumerate(some)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(near_duplicates(docs_of(spark, some)))}
    want = brute_components(fps)
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert {r["doc_id"] for r in rows(drop_near_duplicates(docs_of(spark, some)))} == set(want.values())


@pytest.mark.parametrize("seed", range(3))
def test_trie_join_keeps_every_component(spark, seed):
    r = random.Random(seed)
    fps: set[int] = set()
    for _ in range(25):  # clusters and chains of near fingerprints, and some far ones
        f = r.getrandbits(64)
        for _ in range(r.randrange(1, 30)):
            fps.add(f)
            for _ in range(r.randrange(0, 5)):
                f ^= 1 << r.randrange(64)
    fps |= {r.getrandbits(64) for _ in range(300)}
    ordered = sorted(fps)
    want = brute_components(dict(enumerate(ordered)))
    to = one_group(ordered)
    assert to.tolist() == [want[i] for i in range(len(ordered))]

    signed = [f - (1 << 64) if f >> 63 else f for f in ordered]
    limit = (GROUP, 60, 20)[seed]  # groups of over 60 or 20 fingerprints are cut further
    links = near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), limit=limit)
    roots = {r["node"]: r["root"] for r in rows(connected_components(links))}
    groups, mine = defaultdict(set), defaultdict(set)
    for i, f in enumerate(signed):
        groups[want[i]].add(f)
        mine[roots.get(f, f)].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_groups_are_cut_to_the_limit(spark):
    r = random.Random(5)
    fps = {r.getrandbits(63) & ~0xFFFF | r.getrandbits(4) for _ in range(400)} | set(range(300))
    cut = groups(spark.createDataFrame([(f,) for f in fps], "fp long"), limit=64)
    sizes = cut.groupBy("turn", "mask", "value").count().agg({"count": "max"}).first()[0]
    assert sizes <= 64
    assert cut.select("fp").distinct().count() == len(fps)


def test_trie_walk_of_many_fingerprints():
    """Enough leaves for the walk by node pairs, random ones and near ones, against all pairs."""
    r = np.random.default_rng(3)
    fps = r.integers(0, 1 << 63, 1500, dtype=np.uint64)
    flipped = fps[:400] ^ (np.uint64(1) << r.integers(0, 64, 400, dtype=np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 400, dtype=np.uint64))
    fps = np.unique(np.concatenate([fps, flipped]))
    want = brute_components({i: int(f) for i, f in enumerate(fps)})
    assert one_group(fps).tolist() == [want[i] for i in range(len(fps))]


@pytest.mark.parametrize("size", [3, 500, 20_000])
def test_every_group_is_walked(monkeypatch, size):
    """Whatever a group's size, its pairs come out of the walk; groups beside it stay apart."""
    walked = []

    def counted(self, depth, a, b, bits, budget, own=Forest.descend):
        walked.append(len(a))
        return own(self, depth, a, b, bits, budget)

    monkeypatch.setattr(Forest, "descend", counted)
    r = np.random.default_rng(size)
    base = r.integers(0, 1 << 63, size, dtype=np.uint64)
    near = base[: -(-size // 3)] ^ (np.uint64(1) << r.integers(0, 64, -(-size // 3), dtype=np.uint64))
    fps = np.concatenate([base, near])
    groups_ = np.concatenate([np.repeat([4, 9], [len(fps), len(near)])])
    to = trie_links(groups_, np.concatenate([fps, near]), 4)
    assert walked and sum(walked) >= size
    assert (to[size : len(fps)] == to[: len(near)]).all()  # each near one with its origin
    assert (to[len(fps) :] >= len(fps)).all()  # the same fingerprints in another group don't meet these
    if size <= 500:
        want = brute_components({i: int(f) for i, f in enumerate(fps)})
        assert len(set(want.values())) == len(set(to[: len(fps)].tolist()))
    else:  # a plain search of all pairs, in blocks
        linked = {tuple(x) for at in range(0, len(fps), 500) for x in (np.argwhere(np.bitwise_count(fps[at : at + 500, None] ^ fps[None]) <= 4) + [at, 0]).tolist()}
        assert all(to[a] == to[b] for a, b in linked)


def test_one_row_of_each_component_stays(spark):
    near = "alpha beta gamma delta epsilon zeta eta"
    docs = [(5, near, "en", "a", 1), (5, near, "en", "a", 1), (5, near, "fr", "b", 1), (5, "another text, which nothing resembles at all", "en", "a", 1), (9, near, "en", "a", 1), (None, near, "en", "a", 1), (None, "only here, without an identifier", "en", "a", 1), (None, "only here, without an identifier", "en", "a", 1), (7, None, "en", "a", 1), (6, "", "en", "a", 1)]
    for similarity in (None, 0.8):
        got = sorted((r["doc_id"] or 0, r["text"]) for r in rows(drop_near_duplicates(clashing(spark.createDataFrame(docs, DOCS)), similarity=similarity)))
        assert got == [(0, "only here, without an identifier"), (5, near), (5, "another text, which nothing resembles at all"), (6, "")]


def test_trie_join_of_a_dense_cluster():
    base = 0x0123456789ABCDEF
    cluster = sorted({base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)})
    assert len(cluster) > 2000
    assert set(one_group(cluster).tolist()) == {0}


def test_near_odd_rows(spark):
    got = rows(near_duplicates(clashing(odd_docs(spark))))
    assert len(got) == odd_docs(spark).count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == "0" * 16 and by[3]["component_id"] == by[2]["component_id"] == 1
    assert by[6]["component_id"] == 5
    assert near_duplicates(odd_docs(spark).limit(0)).count() == 0


def test_components_of_long_chains(spark):
    n = 60
    edges = [(i, i + 1) for i in range(n)] + [(100, 100), (205, 201), (201, 205)]
    got = {r["node"]: r["root"] for r in rows(connected_components(spark.createDataFrame(edges, "u long, v long")))}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 205: 201}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert DOCS
