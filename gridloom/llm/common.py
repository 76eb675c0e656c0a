"""Helpers that the corpus operators share: scratch tables, Arrow batches, joins with heavy keys, small column idioms."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ``[\x20\x09-\x0D]`` as a Java character class and as Python bytes.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: Rows that a Python worker takes from an Arrow batch at once. Spark bounds the bytes of a batch by itself
#: (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB), so the session's settings stay as they are.
ARROW_ROWS = 256
#: Most keys that ``lookup`` treats as heavy, and rows that a key must have for it.
HEAVY_KEYS, HEAVY_ROWS = 10_000, 10_000
#: Most rows of a few numbers each that are broadcast once they have been counted: some 20 MB.
SMALL_ROWS = 500_000
#: The column in which operators keep a hash of the whole text, to tell rows of one identifier apart.
TEXT_HASH = "_text_hash"
#: Lists of the scratch folders written since each ``scratch_scope`` began that is open in this thread or task.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``). Only a local master may leave it unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or ""):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file:///tmp/checkpoints"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared scratch folder, which the open scopes delete when they end."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes.get():
        scope.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Lineage is cut at the files, so lost executors cost only the tasks after them, and the sizes of the
    files let Spark decide by itself what is small enough to broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Scratch folders that the same thread (or asynchronous task) writes inside are deleted at the end, but for what the
    scope's ``keep`` has written. What other threads write meanwhile is not the scope's."""
    paths: list[str] = []
    outer = _scopes.get()
    token = _scopes.set((*outer, paths))

    def keep(df: DataFrame, name: str) -> DataFrame:
        inside = _scopes.set(tuple(scope for scope in _scopes.get() if scope is not paths))  # only outer scopes delete it
        try:
            return written(df, name)
        finally:
            _scopes.reset(inside)

    try:
        yield keep
    finally:
        _scopes.reset(token)
        delete_paths(spark, paths)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``rows`` rows at most, without copies; empty ones are left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` for a function of some rows; no shuffle, memory bounded by the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield fn(part)

    return df.mapInArrow(run, schema)


def lookup(left: DataFrame, right: DataFrame, on: list[str], *, rows: str, total: int, spread: list[str], stored: bool = True) -> DataFrame:
    """``left`` inner-joined with ``right``, which has one row for each key and in ``rows`` the key's rows in ``left``.

    Keys with ``HEAVY_ROWS`` rows or more, and at least one in ``HEAVY_KEYS`` of ``total``, are broadcast: there are
    ``HEAVY_KEYS`` of them at most, whatever the data. Their rows of ``left`` are dealt by a hash of ``spread``
    instead of the key, so no task gets all rows of a heavy key. The first key is a long; no key is null. Where no key is
    heavy it is a plain join, which takes a look at ``right`` if it is ``stored``.
    """
    limit = max(HEAVY_ROWS, -(-total // HEAVY_KEYS))
    values = [c for c in right.columns if c not in on and c != rows]
    if total < limit or (stored and right.where(F.col(rows) >= limit).isEmpty()):
        return left.join(right.select(*on, *values), on).select(*left.columns, *values)
    heavy_name = {c: free_name(left, f"_heavy_{c}") for c in values}
    is_heavy, first = free_name(left, "_is_heavy"), free_name(left, f"_first_{on[0]}")
    heavy = right.where(F.col(rows) >= limit).select(*on, F.lit(True).alias(is_heavy), *[F.col(c).alias(heavy_name[c]) for c in values])
    light = right.where(F.col(rows) < limit).select(F.col(on[0]).alias(first), *on[1:], *values)
    marked = left.join(F.broadcast(heavy), on, "left")
    marked = marked.withColumn(first, F.when(F.col(is_heavy), F.xxhash64(*spread)).otherwise(F.col(on[0])))
    found = marked.join(light.withColumn("_found", F.lit(True)), [first, *on[1:]], "left").where(F.col(is_heavy) | F.col("_found"))
    return found.select(*[F.col(c) for c in left.columns], *[F.when(F.col(is_heavy), F.col(heavy_name[c])).otherwise(F.col(c)).alias(c) for c in values])


def whole_text(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``: the folds that the queries hold out by. A null key is fold 0's text ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def if_small(df: DataFrame) -> DataFrame:
    """A written table of a few numeric columns, to be broadcast if it is counted to be small, else joined by a shuffle."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def best_rows(df: DataFrame, by: list[str], entry: Column, limit: int, *, fan: int = 16) -> DataFrame:
    """(by, best): the ``limit`` smallest entries of each key, in order, as an array. ``df`` is stored.

    Parts of some ``fan * limit`` rows are cut to ``limit`` first, then ``fan`` parts at a time are merged, so no task holds more
    than that of a key, however many rows the key has.
    """
    parts = max(1, -(-df.count() // (fan * limit)))
    cut = lambda entries: F.slice(F.sort_array(entries), 1, limit).alias("best")
    best = df.select(*by, entry.alias("entry")).withColumn("part", F.pmod(F.xxhash64("entry"), F.lit(parts)))
    best = best.groupBy(*by, "part").agg(cut(F.collect_list("entry")))
    while parts > 1:
        parts = -(-parts // fan)
        best = best.groupBy(*by, F.pmod("part", F.lit(parts)).alias("part")).agg(cut(F.flatten(F.collect_list("best"))))
    return best.drop("part")


def keep_one(docs: DataFrame, marked: DataFrame, classes: DataFrame, keep: Callable[[DataFrame, str], DataFrame], *, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest identifier, then text hash; a null identifier comes
    last, and of rows with the same identifier and text one stays.

    ``marked(doc_id, _text_hash, class)`` has a row for each row of ``docs``, ``classes(class, n, root)`` each class with
    its rows and its component. Only rows of components with several rows are looked at. What the result reads is
    written by ``keep``.
    """
    sizes = classes.groupBy("root").agg(F.sum("n").alias("rows"))
    several = written(classes.join(sizes.where("rows > 1"), "root").select("class", "n", "root"), "keep-classes")
    found = written(lookup(marked, several, ["class"], rows="n", total=marked.count(), spread=["doc_id", TEXT_HASH]).select("doc_id", TEXT_HASH, "root"), "keep-rows")
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", TEXT_HASH)
    best = written(found.groupBy("root").agg(F.min(rank).alias("best"), F.count("*").alias("n")), "keep-best")
    ranked = lookup(found.select("root", rank.alias("rank")).distinct(), best, ["root"], rows="n", total=found.count(), spread=["rank"])
    gone = keep(ranked.where(F.col("rank") != F.col("best")).select("rank.doc_id", f"rank.{TEXT_HASH}"), "keep-gone")
    again = found.groupBy("doc_id", TEXT_HASH).count().where("count > 1")
    again = keep(again.join(if_small(gone), [again["doc_id"].eqNullSafe(gone["doc_id"]), again[TEXT_HASH] == gone[TEXT_HASH]], "left_anti").drop("count"), "keep-repeated")

    own, out = free_name(docs, TEXT_HASH), docs.columns
    is_row = lambda left, right: left[id_col].cast("long").eqNullSafe(right["doc_id"]) & (left[own] == right[TEXT_HASH])
    kept = docs.withColumn(own, F.xxhash64(whole_text(text_col)))
    kept = kept.join(if_small(gone), is_row(kept, gone), "left_anti")
    if again.isEmpty():
        return kept.select(*out)
    single = kept.join(again, is_row(kept, again), "left_anti").select(*out)
    repeated = kept.join(again, is_row(kept, again), "left_semi").groupBy(id_col, own).agg(F.min_by(F.struct(*out), F.xxhash64(*out)).alias("row"))
    return single.unionByName(repeated.select("row.*"))
