"""Exact duplicates by a content sort.

Texts are normalised (A-Z to lower case, nothing else), range-partitioned by sampled splitters over their leading bytes,
their hash and the descending identifier, and sorted within partitions, where Spark spills to disk by itself. Equal texts
are then neighbours, also where a large group crosses splitters: the identifier in the range key cuts such a group over
as many partitions as its rows need. A pass over each sorted partition compares every text with the one before it, byte
for byte. Only the groups at the ends of partitions can go on in the next one; their partial counts, at most a few a
partition, are added up and joined back.

Defined cases: a null text is an empty one; of rows with the same text the one with the largest identifier stays (a null
identifier is smaller than any other), and of repeated rows with that identifier exactly one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import free_name, map_batches, slices, table, whole_text, written
from gridloom.llm.line_dedup import ascii_lower

#: Leading bytes of the text in the range key; splitters are sent to the driver, so they stay short.
HEAD = 48
_DIGEST = "doc_id long, text_sha256 string, keep_id long, group_size long, first boolean, part int, edge boolean"


def _normalise(batch: pa.RecordBatch) -> pa.RecordBatch:
    import xxhash

    norm = [t.as_py().encode().lower() for t in batch.column(1)]  # bytes.lower() changes A-Z only
    columns = [batch.column(0), pa.array([t[:HEAD] for t in norm], pa.binary()), pa.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in norm], pa.int64()), pa.array(norm, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "head", "hash", "norm"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition to digests. Of a run only its identifiers are held."""
    part = TaskContext.get().partitionId()
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    first_key: tuple | None = None
    key: tuple | None = None
    norm = sha = None
    ids: list[int | None] = []
    held: list[tuple] = []  # runs under the present key: they are edges if no other key follows
    ready: list[tuple] = []

    def close() -> None:
        if ids:
            held.append((sha, ids))

    def flush(last: bool) -> None:
        for digest, members in held:
            edge = last or key == first_key
            ready.extend((m, digest, members[0], len(members), i == 0, part, edge) for i, m in enumerate(members))
        held.clear()

    for batch in slices(batches):
        for doc, head, hashed, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text != norm or (head, hashed) != key:
                close()
                if (head, hashed) != key:
                    flush(False)
                    key = (head, hashed)
                    first_key = first_key or key
                norm, sha, ids = text, hashlib.sha256(text).hexdigest(), []
            ids.append(doc)
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), _TYPES, strict=True)], names=names)
            ready = []
    close()
    flush(True)
    if ready:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), _TYPES, strict=True)], names=names)


_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.bool_()]


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = map_batches(docs.select(F.col(id_col).cast("long"), whole_text(text_col)), _normalise, "doc_id long, head binary, hash long, norm binary")
    down = F.col("doc_id").desc_nulls_last()
    ordered = rows.repartitionByRange("head", "hash", down).sortWithinPartitions("head", "hash", "norm", down)
    digests = written(ordered.mapInArrow(_runs, _DIGEST), "exact-digests")

    segments = digests.where("edge").groupBy("text_sha256", "part").agg(F.max("keep_id").alias("k"), F.max("group_size").alias("n"))
    # Bounded by the number of range partitions: a group that goes on in the next partition is the last of this one.
    crossing = segments.groupBy("text_sha256").agg(F.max("k").alias("all_keep"), F.sum("n").alias("all_size"), F.min("part").alias("first_part"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    return digests.join(F.broadcast(crossing), "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("first_part").isNull(), F.col("keep_id")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.coalesce("all_size", "group_size").alias("group_size"),
        (F.col("first") & (F.col("part") == F.coalesce("first_part", "part"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text: that with the largest identifier, a null one only where there is no other; of
    rows with the same identifier and text one stays."""
    own = free_name(docs, "_sha")
    kept = exact_groups(docs, id_col=id_col, text_col=text_col).where("kept").select("doc_id", "text_sha256")
    marked = docs.withColumn(own, F.sha2(ascii_lower(whole_text(text_col)).cast("binary"), 256))
    is_kept = marked[id_col].cast("long").eqNullSafe(kept["doc_id"]) & (marked[own] == kept["text_sha256"])
    return marked.join(kept, is_kept, "left_semi").dropDuplicates([id_col, own]).drop(own)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)
"""
