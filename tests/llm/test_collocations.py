from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import DOCS, clashing, odd_docs, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import collocations as c


def brute(some: list[tuple[str | None, str | None]], least: int, top: int) -> list[tuple]:
    counts: dict[str, Counter] = {}
    n: Counter = Counter()
    for text, lang in some:
        of = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        lowered = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            of.update(tuple(words[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        gone = {p[i : i + k] for p in candidates for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * f[p] >= 80 * f[p[i : i + k]]}
        scored = []
        for p in candidates:
            score, _, left, right = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -f[p], " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def got(df):
    return sorted(tuple(r[x] for x in NAMES) for r in rows(df))


def prose(n: int, seed: int = 0) -> list[tuple[str | None, str | None]]:
    r = random.Random(seed)
    words = ["The", "of", "new", "york", "City", "É", "é", "x\x00y", "big", "apple", "\x1f", "漢字"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "?!", " ; "]
    out = []
    for _ in range(n):
        text = "".join(r.choice(["new york city", "big apple", r.choice(words)]) + r.choice(joins) for _ in range(r.randrange(60)))
        out.append((text, r.choice(["en", "en", "en", "fr", "", None])))
    return [*out, (None, "en"), ("", None), (" \t.", "fr")]


def frame(spark, some, parts=3):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(some)], DOCS).repartition(parts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(1, 40))
def test_walk_equals_plain_counts(numbers, batch):
    positions = np.array([*numbers, 0], np.int32)
    word, block, bits = c.bitmaps(positions)
    n = int(positions.max()) + 1
    packed = [c._packed(a) for a in (np.bincount(word, minlength=n)[1:].astype(np.int32), np.diff(block, prepend=np.int32(0)), bits)]
    known = np.array([w for w in range(1, n) if w != 3], np.int64)  # word 3 is not frequent
    shard = c.Shard(*packed, (known - 1).astype(np.int64), known * 1000)
    pack = lambda a, b: (a * 1000) << 32 | (b * 1000)
    runs = lambda k: Counter(tuple(numbers[i : i + k]) for i in range(len(numbers) - k + 1) if not {0, 3} & set(numbers[i : i + k]))
    held, c.BATCH_BLOCKS = c.BATCH_BLOCKS, batch
    try:
        pairs = Counter()
        for found, m in c.pairs_of(shard):
            for p, k in zip(found.tolist(), m.tolist(), strict=True):
                assert p not in pairs  # one row of each pair
                pairs[p] += k
        assert pairs == {pack(a, b): k for (a, b), k in runs(2).items()}
        some = sorted(runs(2))[::2]
        longer = Counter()
        for p, rest, m in c.longer_of(shard, np.array([pack(*p) for p in reversed(some)], np.int64)):
            for a, b, k in zip(p.tolist(), rest.tolist(), m.tolist(), strict=True):
                ids = (a >> 32, a & c._LOW, b >> 32, b & c._LOW)
                longer[tuple(w // 1000 for w in ids if w != c._LOW)] += k
        want = Counter()
        for k in (3, 4):
            for run, m in runs(k).items():
                if all(run[i : i + 2] in some for i in range(k - 1)):
                    want[run] += m
        assert longer == want
    finally:
        c.BATCH_BLOCKS = held


@pytest.mark.parametrize(("positions", "least", "top"), [(c.SHARD_POSITIONS, 5, 2000), (300, 5, 2000), (40, 2, 7)])
def test_equals_brute_force(spark, positions, least, top):
    some = prose(60)
    assert got(c.collocations(frame(spark, some), least=least, top=top, positions=positions)) == brute(some, least, top)


def test_one_phrase_in_a_third_of_all_rows(spark, monkeypatch):
    from gridloom.llm import common

    monkeypatch.setattr(common, "HEAVY_ROWS", 3)
    monkeypatch.setattr(common, "HEAVY_KEYS", 20)
    some = prose(40, 1) + [("new york city of the big apple", "en")] * 20
    assert got(c.collocations(frame(spark, some, 12), least=4, positions=50)) == brute(some, 4, 2000)


def test_a_common_word_fills_several_batches(spark, monkeypatch):
    monkeypatch.setattr(c, "BATCH_BLOCKS", 3)
    some = [("of the city " * 200, "en"), ("the city of the sun", "en")] * 3
    assert got(c.collocations(frame(spark, some, 2), least=4)) == brute(some, 4, 2000)


def test_long_texts_are_taken_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK_BYTES", 64)
    r = random.Random(2)
    text = " ".join(r.choice(["a", "bb", "ccc.", "d" * 300]) for _ in range(5000))
    numbers = c.Words({c.SEPARATOR: 0})
    parts = list(c.word_numbers([text], numbers))
    assert len(parts) > 10
    names = list(numbers)
    assert [names[i] for i in np.concatenate(parts)] == text.replace(".", " .").encode().split() + [b"."]
    assert got(c.collocations(frame(spark, [(text, "en")]), positions=1000)) == brute([(text, "en")], 30, 2000)


def test_odd_rows_and_empty(spark):
    odd = [(r["text"], r["lang"]) for r in rows(odd_docs(spark))]
    assert got(c.collocations(clashing(odd_docs(spark)), least=2)) == brute(odd, 2, 2000)
    assert c.collocations(odd_docs(spark).limit(0)).count() == 0


def test_scores_pass_64_bits(spark):
    big = 10**14
    words = spark.createDataFrame([(1, "en", "a", 3 * big), (2, "en", "b", 2 * big)], "id long, lang string, word string, f long")
    phrases = spark.createDataFrame([(1, 2, -1, -1, 2 * big - 1)], "w1 long, w2 long, w3 long, w4 long, f long")
    assert rows(c.scored_phrases(words, phrases))[0]["score"] == 2_000_000 * (2 * big - 1) // (5 * big)


def test_sql_agrees_with_brute_force(spark, tmp_path):
    some = prose(150, 5)
    docs = frame(spark, some)
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    sql = duckdb.sql(c.ORACLE_SQL.replace("FROM documents", f"FROM '{tmp_path}/documents.parquet'")).df()
    assert sorted(sql[list(NAMES)].itertuples(index=False, name=None)) == brute(some, 30, 2000)
