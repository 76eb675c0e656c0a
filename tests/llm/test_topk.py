from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, rows

from gridloom.llm.topk import ORACLE_SQL, _bytes, _distances, _numbers, exact_scores, search_cell, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, k=5):
    """Every row but the query's own is a candidate."""
    ok = []
    for i, v, _ in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for row, (i, q) in enumerate(ok):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for other, (j, v) in enumerate(ok) if other != row and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows(df))


def by_sql(tmp_path, df):
    import duckdb

    df.write.parquet(f"{tmp_path}/embeddings")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
    at = con.sql(ORACLE_SQL)
    return sorted(tuple(r[at.columns.index(c)] for c in ("query_id", "rank", "vec_id", "score")) for r in at.fetchall())


@pytest.mark.parametrize("kind", ["random", "clustered", "ties"])
def test_equals_brute_force(spark, kind):
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(16)] for _ in range(6)]
    vectors = []
    for i in range(700):
        v = {"random": lambda: [r.gauss(0, 0.2) for _ in range(16)], "clustered": lambda: [c + r.gauss(0, 0.03) for c in r.choice(centres)], "ties": lambda: [float(r.randrange(2)) for _ in range(16)]}[kind]()
        vectors.append((i, v, 0))
    assert got(top_k(spark.createDataFrame(vectors, SCHEMA))) == brute(vectors)


def test_small_cells_and_blocks(spark):
    r = random.Random(4)
    vectors = [(i, [r.gauss(0, 0.2) for _ in range(8)], 0) for i in range(400)]
    assert got(top_k(spark.createDataFrame(vectors, SCHEMA), cell_rows=16, block_rows=3)) == brute(vectors)


def test_far_cells_are_never_shipped(spark, monkeypatch):
    """In tight clusters most pairs of a cell and a block go by their bound, and the result stays exact."""
    import gridloom.llm.topk as module

    seen = []

    near_pairs = module.near_pairs

    def counted(cells, blocks, *more):
        pairs = near_pairs(cells, blocks, *more)
        seen.append((pairs.count(), cells.count() * blocks.count()))
        return pairs

    monkeypatch.setattr(module, "near_pairs", counted)
    r = random.Random(5)
    centres = [[r.gauss(0, 2) for _ in range(16)] for _ in range(12)]
    vectors = [(i, [c + r.gauss(0, 0.02) for c in centres[i % 12]], 0) for i in range(1200)]
    assert got(top_k(spark.createDataFrame(vectors, SCHEMA), cell_rows=40, block_rows=1)) == brute(vectors)
    assert seen[0][0] < 0.25 * seen[0][1], seen


def test_far_vectors_and_pivots(spark):
    """A few vectors far out, of which some become pivots, beside clusters of short ones."""
    r = random.Random(6)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    for far in (4e3, 4e6):
        vectors = [(i, [(far if i % 8 == 0 and j == 0 else 0) + c + r.gauss(0, 0.05) for j, c in enumerate(r.choice(centres))], 0) for i in range(1200)]
        assert got(top_k(spark.createDataFrame(vectors, SCHEMA), cell_rows=50, block_rows=4)) == brute(vectors)


@pytest.mark.parametrize("norm", [1e6, 1e8, 1e9, 2e9])
def test_bounds_hold_with_a_pivot_far_out(norm):
    r = np.random.default_rng(2)
    pivots = np.zeros((1, 8))
    pivots[0, 0] = norm
    wrong = 0
    for _ in range(10):
        x = r.normal(0, 500, (300, 8)).round().astype(np.int64)
        q = r.normal(0, 500, (40, 8)).round().astype(np.int64)
        far = lambda v: _distances(v, pivots).astype(np.float32)
        queries = {"row": -np.arange(1, 41), "v": q, "far": far(q), "floor": np.full(40, -np.inf)}
        i, j, _ = search_cell(queries, {"row": np.arange(300), "id": np.arange(300), "v": x, "far": far(x)}, 5)
        scores = q @ x.T
        for a in range(40):
            wrong += j[i == a].tolist() != sorted(range(300), key=lambda b: (-scores[a, b], b))[:5]
    assert not wrong


def test_packed_rows_of_any_width():
    parts = [np.array([[1, -2], [32767, -32768]]), np.array([[40000, 1]]), np.array([[1 << 40, -1]]), np.zeros((0, 2), int)]
    column = pa.chunked_array([_bytes(m) for m in parts])
    assert np.array_equal(_numbers(column, 2), np.concatenate(parts))
    assert [len(b) for b in column.to_pylist()] == [4, 4, 8, 16]


def test_vectors_travel_less(spark, monkeypatch):
    """Without clusters every cell meets every block: a candidate's copies are the blocks, and its bytes are narrow."""
    import gridloom.llm.topk as module

    r = np.random.default_rng(7)
    vectors = [(i * 50, [float(x) for x in r.normal(0, 0.2, 64)], 0) for i in range(2600)]
    df = spark.createDataFrame(vectors, SCHEMA)
    moved = []

    def noted(df, name, own=module.written):
        out = own(df, name)
        if name == "pivot-pairs":
            moved.append(out.select("cell", "block").distinct().count() / max(1, out.select("cell").distinct().count()))
        if name == "pivot-cells":
            moved.append(out.selectExpr("avg(octet_length(v))").first()[0])
        return out

    monkeypatch.setattr(module, "written", noted)
    top_k(df, cell_rows=800).count()
    width, copies = moved
    old_width, old_copies = 8 * 64, -(-len(vectors) // 1024)
    assert old_width * old_copies >= 8 * width * copies


def test_too_long_vectors_raise(spark):
    with pytest.raises(Exception, match="64 bits"):
        top_k(spark.createDataFrame([(0, [1e9, 1.0], 0), (1, [1.0, 1.0], 0)], SCHEMA)).count()


def test_repeated_ids_equal_the_sql(spark, tmp_path):
    first = [(0, 1.0), (7, 0.9), (7, 0.5), (8, 0.7), (50, 0.2), (50, 0.3), (100, 1.0)]
    vectors = [(i, [x, 0.1], 0) for i, x in first]
    df = spark.createDataFrame(vectors, SCHEMA)
    found = got(top_k(df))
    assert found == brute(vectors) == by_sql(tmp_path, df)
    assert [r[2:] for r in found if r[0] == 0][:2] == [(100, 256 * 256 + 25 * 25), (7, 256 * 230 + 25 * 25)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [0.1, 0.2], 1), (1, None, 1), (2, [0.1, None], 1), (3, [nan, 0.0], 1), (4, [inf, 0.0], 1), (None, [0.3, 0.3], 1), (5, [-0.5, 0.25], 1), (6, [0.9, 0.9], 1), (6, [0.9, 0.9], 1), (7, [0.1, 0.2], 1), (50, [0.0, 0.0], 1)]
    df = spark.createDataFrame(vectors, SCHEMA)
    assert got(top_k(clashing(df))) == brute(vectors)
    assert top_k(df.limit(0)).count() == 0
    assert got(top_k(spark.createDataFrame([(0, [1.0], 0)], SCHEMA))) == []
    mixed = spark.createDataFrame([(0, [1.0], 0), (1, [1.0, 1.0], 0), (2, [0.5], 0)], SCHEMA)
    assert got(top_k(mixed)) == [(0, 1, 2, 256 * 128)]


def test_scores_stay_exact_when_large():
    a = np.array([[1 << 30, 3, -7]], dtype=np.int64)
    assert exact_scores(a, a).tolist() == [[(1 << 60) + 9 + 49]]
    q = {"row": np.array([0]), "v": a, "far": np.zeros((1, 0), np.float32), "floor": np.array([-np.inf])}
    x = {"row": np.array([1, 2]), "id": np.array([1, 2]), "v": np.array([[1 << 30, 2, 0], [1 << 30, 3, 0]], dtype=np.int64), "far": np.zeros((2, 0), np.float32)}
    assert search_cell(q, x, 1)[1].tolist() == [1]


def test_elimination_skips_far_candidates():
    """With tight clusters and pivots in them, most candidates are never scored."""
    r = np.random.default_rng(1)
    centres = r.normal(0, 200, (8, 32)).round()
    x = (centres[r.integers(0, 8, 2000)] + r.normal(0, 3, (2000, 32)).round()).astype(np.int64)
    far = np.sqrt(((x[:, None, :] - centres[None]) ** 2).sum(2)).astype(np.float32)
    lower = np.abs(far[0][None] - far).max(1)
    upper = 0.5 * ((x[0] ** 2).sum() + (x**2).sum(1) - lower**2) + 3
    best = np.sort(x[1:] @ x[0])[-5]
    assert (upper >= best).mean() < 0.4
