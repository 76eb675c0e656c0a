"""Exact top-k search by inner product with pivot-table elimination.

Components are floored to integers first. For integer vectors ``2 <q, x> = |q|^2 + |x|^2 - d(q, x)^2``, and by the triangle
inequality ``d(q, x) >= |d(q, p) - d(x, p)|`` for any pivot p. The table of distances to the pivots is computed once, so
each query has an upper bound of every candidate's score without touching its vector. Each query also has a floor: the
k-th best score in a sample of ``SAMPLE`` rows, of which the pivots are the first.

Elimination has two steps. Candidates are dealt to cells of about ``cell_rows`` rows by their nearest pivots, queries to
blocks of about ``block_rows`` in the same way. A cell and a block know the least and the greatest distance to every pivot,
their largest norm and (the block) its lowest floor; a block gets the vectors of those cells only whose bound reaches the
floor, so far cells are dropped before any vector moves. Inside a cell candidates are scored in order of their own bound,
until the next bound is below the k-th best score. A gap between two distances counts less what rounding can have added
to it, bounds carry a margin, and scores are exact, so the result is exact, however far out pivots or vectors are. Vectors
travel in the narrowest integers that hold them. Neither all queries nor all candidates are ever in one place, and only the
sample is on the driver.

Defined cases: null vectors, those with a null or non-finite component and null ids take no part; vectors are compared
with those of their own length only; every row is a candidate and a query is not its own, so rows that repeat an id or a
vector all count, and a repeated query id has a ranking for each of its rows; ties go to the smaller id; an empty table
gives no rows; other columns are ignored. Vectors whose products might pass 64 bits (a norm of 2^31 or more after
flooring) raise an error. Tables in the scratch folder stay unless the caller opens a ``scratch_scope``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import slices, table, written

PIVOTS, SAMPLE = 32, 2048
#: Rows in a cell, numbers in a block of queries, candidates scored at first, rows measured and queries answered at once.
CELL, BLOCK_NUMBERS, CHUNK, ROWS = 4096, 1 << 20, 128, 1024
#: Cells in each of the groups among which the comparison of cells with blocks is dealt out, and pivots in a cell's code.
DEAL_CELLS, DEPTH = 1024, 3
#: Share of a distance (a 32-bit number) that rounding can have added to it, and more.
ROUNDING = 2.0**-22


def quantised(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, dim, v array<bigint>) of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"), F.size(v).alias("dim"), F.transform(v, lambda x: F.floor(x * F.lit(float(scale)))).alias("v")
    )


def _bytes(m: np.ndarray) -> pa.Array:
    """Each row's numbers as bytes, in the narrowest integers that hold all of them."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    data = np.ascontiguousarray(m.astype(kind))
    offsets = np.arange(len(m) + 1, dtype=np.int32) * (m.shape[1] * data.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _numbers(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """The rows that ``_bytes`` has packed, whose widths may differ."""
    out = np.empty((len(column), dim), dtype=np.int64)
    width = np.array(pa.compute.binary_length(column)) // max(dim, 1)
    for kind in (np.int16, np.int32, np.int64):
        some = np.flatnonzero(width == np.dtype(kind).itemsize)
        if len(some):
            out[some] = np.frombuffer(b"".join(column.take(pa.array(some)).to_pylist()), kind).reshape(len(some), dim)
    return out


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim)


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))


def _norms(m: np.ndarray) -> np.ndarray:
    return (m.astype(np.float64) ** 2).sum(axis=1)


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(_norms(v)[:, None] + _norms(pivots)[None, :] - 2 * (v.astype(np.float64) @ pivots.astype(np.float64).T), 0))


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a with those of b; floating point only where every sum is exact in it."""
    largest = math.sqrt(_norms(a).max(initial=0) * _norms(b).max(initial=0))
    kind = np.float32 if largest < 2**23 else np.float64 if largest < 2**52 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def search_cell(queries: dict, cell: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query numbers, candidate numbers, scores): the k best of the cell's candidates for each query, fewer if others are
    as good."""
    q, x = queries["v"], cell["v"]
    lower, gap = np.zeros((len(q), len(x)), dtype=np.float32), np.empty((len(q), len(x)), dtype=np.float32)
    for p in range(queries["far"].shape[1]):
        of_q, of_x = queries["far"][:, p], cell["far"][:, p]
        np.subtract(of_q[:, None], of_x[None, :], out=gap)
        np.abs(gap, out=gap)
        gap -= np.float32(ROUNDING) * max(of_q.max(initial=0), of_x.max(initial=0))
        np.maximum(lower, gap, out=lower)
    q2, x2 = _norms(q), _norms(x)
    upper = 0.5 * (q2[:, None] + x2[None, :] - lower.astype(np.float64) ** 2) + _margin(q2.max(initial=0), x2.max(initial=0))
    largest = math.sqrt(q2.max(initial=0) * x2.max(initial=0))
    kind = np.float32 if largest < 2**23 else np.float64 if largest < 2**52 else np.int64
    qk, xk = q.astype(kind), x.astype(kind)
    out = [(np.zeros(0, dtype=np.int64),) * 3]
    for i in range(len(q)):
        left = np.flatnonzero((upper[i] >= queries["floor"][i]) & (cell["row"] != queries["row"][i]))
        order = left[np.argsort(-upper[i, left], kind="stable")]
        best = found = np.zeros(0, dtype=np.int64)
        at, step = 0, CHUNK
        while at < len(order) and (len(best) < k or upper[i, order[at]] >= best[k - 1]):
            some = order[at : at + step]
            best, found = np.concatenate([best, (xk[some] @ qk[i]).astype(np.int64)]), np.concatenate([found, some])
            top = np.lexsort((cell["id"][found], -best))[:k]
            best, found = best[top], found[top]
            at, step = at + step, step * 2
        out.append((np.full(len(found), i), found, best))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _margin(q2, x2):
    """What is left of rounding in a score's bound, and more: of norms, and of distances far smaller than the norms."""
    return 2.0 + 1e-5 * (q2 + x2)


def _placed(rows: DataFrame, name: str, size: int, n: int) -> DataFrame:
    """``rows`` with the column ``name``: the numbers of their nearest pivots, as many as make groups of about ``size``, and
    a part by a hash where a group is larger than that."""
    depth = max(0, min(DEPTH, round(math.log(max(1.0, n / size)) / math.log(PIVOTS))))
    code = F.aggregate(F.slice("nearest", 1, depth), F.lit(0).cast("long"), lambda a, p: a * PIVOTS + p) if depth else F.lit(0).cast("long")
    coded = rows.withColumn("code", code)
    sizes = coded.groupBy("dim", "code").agg(F.ceil(F.count("*") / F.lit(size)).alias("parts"))
    part = F.pmod(F.xxhash64(F.lit("deal"), "row"), F.col("parts"))
    return coded.join(sizes, ["dim", "code"]).withColumn(name, F.col("code") * F.lit(1 << 40) + part).drop("code", "parts")


def _summary(rows: DataFrame, name: str, pivots: int, *more: Column) -> DataFrame:
    """For each cell or block: its largest squared norm and the range of its distances to every pivot."""
    ranges = [f(F.get("far", F.lit(p))).alias(f"{name}_{edge}{p}") for p in range(pivots) for f, edge in ((F.min, "lo"), (F.max, "hi"))]
    return rows.groupBy("dim", name).agg(F.max("norm2").alias(f"{name}_norm2"), *ranges, *more)


def near_pairs(cells: DataFrame, blocks: DataFrame, pivots: int, deals: int = 64) -> DataFrame:
    """(dim, cell, block) for the summaries of cells and blocks whose bound reaches the block's floor. Cells are dealt in
    ``deals`` groups, each of which meets all blocks."""
    edge = lambda name: F.col(name).cast("double")
    gaps = [edge(f"{a}_lo{p}") * (1 - ROUNDING) - edge(f"{b}_hi{p}") * (1 + ROUNDING) for p in range(pivots) for a, b in (("cell", "block"), ("block", "cell"))]
    gap = F.greatest(F.lit(0.0), F.lit(0.0), *[F.coalesce(g, F.lit(0.0)) for g in gaps])
    bound = (F.col("block_norm2") + F.col("cell_norm2") - gap * gap) / 2 + _margin(F.col("block_norm2"), F.col("cell_norm2"))
    dealt = cells.withColumn("deal", F.pmod(F.xxhash64("cell"), F.lit(deals)).cast("int"))
    asked = blocks.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    return dealt.join(asked, ["dim", "deal"]).where(bound >= F.col("floor")).select("dim", "cell", "block")


def top_k(
    vectors: DataFrame, is_query: str = "vec_id % 50 = 0", k: int = 5, *, id_col: str = "vec_id", vec_col: str = "embedding",
    scale: int = 256, cell_rows: int = CELL, block_rows: int | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other vectors for each row with ``is_query`` (on vec_id). A block
    has ``block_rows`` queries, by default as many as make ``BLOCK_NUMBERS``, but 1,024 at least."""
    rows = quantised(vectors, id_col=id_col, vec_col=vec_col, scale=scale)
    head = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).toArrow()  # a bounded sample
    dim = head["dim"][0].as_py() if head.num_rows else 0
    sample = _matrix(head.filter(pa.compute.equal(head["dim"], dim))["v"], dim) if dim else np.zeros((0, 0), dtype=np.int64)
    pivots = sample[:PIVOTS]
    block_rows = block_rows or max(1024, BLOCK_NUMBERS // max(dim, 1))

    def measure(batches):
        for batch in slices(batches, ROWS):
            for d in np.unique(batch.column(1).to_numpy()).tolist():
                part = batch.filter(pa.array(batch.column(1).to_numpy() == d))
                v = _matrix(part.column(2), d)
                if _norms(v).max(initial=0) >= 2.0**62:
                    raise ValueError("a vector's norm is 2^31 or more: scores might pass 64 bits")
                far = _distances(v, pivots) if d == dim else np.zeros((len(v), 0))
                floor = np.full(len(v), -np.inf)
                asked = np.flatnonzero(part.column(3).to_numpy(zero_copy_only=False))
                if d == dim and len(sample) > k and len(asked):  # one more than k, as the query itself may be in the sample
                    floor[asked] = -np.sort(-exact_scores(v[asked], sample), axis=1)[:, k]
                nearest = np.argsort(far, axis=1, kind="stable")[:, :DEPTH].astype(np.int64)
                more = [_lists(far.astype(np.float32)), _lists(nearest), pa.array(_norms(v)), pa.array(floor)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _bytes(v), part.column(3), *more], names=names)

    schema = "vec_id long, dim int, v binary, asked boolean, far array<float>, nearest array<bigint>, norm2 double, floor double"
    names = [c.split()[0] for c in schema.split(", ")]
    marked = rows.withColumn("asked", F.expr(f"coalesce({is_query}, false)"))
    # A row's number is only told apart from others' after it is written, so a task that runs again may change it before.
    table_ = written(marked.mapInArrow(measure, schema).withColumn("row", F.monotonically_increasing_id()), "pivot-table")
    n, n_queries = table_.agg(F.count("*"), F.count_if("asked")).first()
    dealt = written(_placed(table_, "cell", cell_rows, n).drop("asked", "floor", "nearest"), "pivot-cells")
    asked = written(_placed(table_.where("asked"), "block", block_rows, n_queries).drop("asked", "nearest"), "pivot-blocks")
    cells, blocks = _summary(dealt, "cell", len(pivots)), _summary(asked, "block", len(pivots), F.min("floor").alias("floor"))
    pairs = written(near_pairs(cells, blocks, len(pivots), max(64, -(-n // (cell_rows * DEAL_CELLS)))), "pivot-pairs")

    def arrays(t: pa.Table) -> dict:
        d = t["dim"][0].as_py()
        return {"row": t["row"].to_numpy(), "id": t["vec_id"].to_numpy(), "v": _numbers(t["v"], d), "far": _matrix(t["far"], len(pivots) if d == dim else 0)}

    def one(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, dtype=np.int64)] * 4
        if left.num_rows and right.num_rows:
            qs, xs = arrays(left), arrays(right)
            qs["floor"] = left["floor"].to_numpy()
            found = []
            for at in range(0, left.num_rows, ROWS):
                i, j, score = search_cell({c: a[at : at + ROWS] for c, a in qs.items()}, xs, k)
                found.append((qs["row"][i + at], qs["id"][i + at], xs["id"][j], score))
            out = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_row", "query_id", "vec_id", "score"), out, strict=True)})

    keys = ("dim", "cell", "block")
    left, right = asked.join(pairs, ["dim", "block"]), dealt.join(pairs, ["dim", "cell"])
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(one, "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH v AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.id, q.vec_id AS query_id, x.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.id <> x.id AND len(q.v) = len(x.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
