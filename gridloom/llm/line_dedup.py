"""Line dedup over levelled sorted runs of line hashes.

A *run* is a table of line keys, bucketed and sorted by key: 96 bits of hash, the documents and lines that hold it, the
largest identifier among them, and ``seen``: whether an earlier run had the key already. ``LineRuns`` keeps runs in levels.
A new batch is merged with the runs by an anti-join, in buckets, so nothing of the runs is shuffled again: keys without a
partner are new and make up the batch's run proper, the others are *hits* on earlier runs. As soon as a level holds
``fanout`` runs they are compacted, bucket by bucket, into one run of the next level. The state is files in the shared
folder, nothing else.

The result is read off the anti-join's verdicts: a key that no later batch hit is judged by its own run alone, and only
keys with hits are added up over runs. Lines are dropped by position: hits are counted before they are shuffled, repeated
keys are joined back to (document, position) rows with hot lines by broadcast, and a document's dropped positions are a
bit map.

Everything is DataFrame code. Defined cases: a null or empty text is one empty line; each row counts as a document of
its own unless it repeats another row's identifier and text; a null identifier is smaller than any other; an empty table
gives no rows; other columns stay as they are.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import SPACE_BYTES, free_name, lookup, scratch_path, table, whole_text, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a position map held in one long.
WORD = 62
KEYS = ("h1", "h2")


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case and nothing else; texts of ASCII alone take the faster way."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_BYTES.decode())))


def line_hashes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20) -> DataFrame:
    """(doc, text_hash, pos, h1, h2) of every line whose key has ``min_chars`` code points or more."""
    text = whole_text(text_col)
    # The hash in a step before the lines, or every line's row would carry the text along and hash it again.
    whole = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("text_hash"), F.split(text, "\n", -1).alias("lines"))
    lines = whole.select("doc", "text_hash", F.posexplode("lines").alias("pos", "line"))
    keyed = lines.select("doc", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("doc", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))


class LineRuns:
    """Levelled runs in the scratch folder: ``levels[i]`` holds the runs of level ``i``, oldest first.

    Runs are bucketed tables, with as many buckets as the session has shuffle partitions, so that a batch meets them
    where its own shuffle puts it. ``close`` takes them out of the catalogue.
    """

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.names: list[str] = []
        self.compactions = 0

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, hashes: DataFrame) -> None:
        """Merge a batch of line hashes with the runs and add it as a run of level 0."""
        in_docs = hashes.groupBy("h1", "h2", "doc", "text_hash").agg(F.count("*").alias("lines"))
        batch = in_docs.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.sum("lines").alias("n_lines"), F.max("doc").alias("keeper"))
        seen = F.lit(False)
        for i, run in enumerate(self.runs()):  # a key is new in one run only, so at most one of these finds it
            batch = batch.join(run.where("not seen").select("h1", "h2", F.lit(True).alias(f"in_{i}")), ["h1", "h2"], "left")
            seen = seen | F.col(f"in_{i}").isNotNull()
        self._put(batch.select(*KEYS, "n_docs", "n_lines", "keeper", seen.alias("seen")), 0)

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        self.names.append(name)
        run.write.bucketBy(self.buckets, *KEYS).sortBy(*KEYS).option("path", scratch_path(self.spark, f"line-run-{level}")).saveAsTable(name)
        self.levels[level].append(self.spark.table(name))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self.compactions += 1
            self._put(_added_up(full), level + 1)

    def repeated(self, min_docs: int) -> DataFrame:
        """(h1, h2, n_docs, n_lines, keeper) of keys in at least ``min_docs`` documents of all batches."""
        hits = _added_up([run.where("seen") for run in self.runs()]).select(*KEYS, *[F.col(c).alias(f"hit_{c}") for c in ("n_docs", "n_lines", "keeper")])
        new = reduce(DataFrame.unionByName, [run.where("not seen") for run in self.runs()])
        plus = lambda c: F.col(c) + F.coalesce(f"hit_{c}", F.lit(0))
        both = new.join(hits, [*KEYS], "left").select(*KEYS, plus("n_docs").alias("n_docs"), plus("n_lines").alias("n_lines"), F.greatest("keeper", "hit_keeper").alias("keeper"))
        return both.where(F.col("n_docs") >= min_docs)

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _added_up(runs: list[DataFrame]) -> DataFrame:
    """One row per key; it is new if it is new in one of the runs."""
    every = reduce(DataFrame.unionByName, runs)
    return every.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_lines").alias("n_lines"), F.max("keeper").alias("keeper"), F.bool_and("seen").alias("seen"))


def repeated_lines(hashes: DataFrame, *, min_docs: int = 3, batches: int = 5, fanout: int = 2) -> DataFrame:
    """(h1, h2, n_docs, n_lines, keeper) of lines in at least ``min_docs`` documents. ``hashes`` have a ``batch`` from 0 to
    ``batches`` - 1 and are taken batch by batch, as they would come in over time; which batch a document is in does not
    change the result."""
    runs = LineRuns(hashes.sparkSession, fanout)
    try:
        for i in range(batches):
            runs.add(hashes.where(F.col("batch") == i))
        return written(runs.repeated(min_docs), "line-repeated")
    finally:
        runs.close()


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, batches: int = 5) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and two columns more: n_lines before, and n_dropped."""
    spark = docs.sparkSession
    hashes = line_hashes(docs, id_col=id_col, text_col=text_col, min_chars=min_chars)
    hashes = hashes.withColumn("batch", F.pmod(F.xxhash64("doc", "text_hash"), F.lit(batches)).cast("int"))
    path = scratch_path(spark, "line-hashes")
    hashes.write.partitionBy("batch").parquet(path)
    hashes = spark.read.schema(hashes.schema).parquet(path)
    repeated = repeated_lines(hashes, min_docs=min_docs, batches=batches)
    lines = hashes.select("doc", "text_hash", "pos", *KEYS)
    gone = lookup(lines, repeated.select(*KEYS, "n_lines", "keeper"), [*KEYS], rows="n_lines", total=hashes.count(), spread=["doc", "text_hash", "pos"])
    gone = gone.where(~F.col("doc").eqNullSafe(F.col("keeper")))
    words = gone.groupBy("doc", "text_hash", F.expr(f"pos div {WORD}").cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("bits"))
    # Words of 62 positions, with zeros where there is none: the position's word is found by its number.
    sparse = words.groupBy("doc", "text_hash").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("sparse"), F.sum(F.bit_count("bits")).alias("n"))
    gap = lambda x, last: F.array_repeat(F.lit(0).cast("long"), x["word"] - F.coalesce(last["word"], F.lit(-1)) - 1)
    filled = lambda x, last: F.when(x.isNotNull(), F.concat(gap(x, last), F.array(x["bits"]))).otherwise(F.array().cast("array<bigint>"))
    # Each entry with the one before it: an index into ``sparse`` inside the lambda would sort it anew for every entry.
    dense = F.flatten(F.zip_with("sparse", F.concat(F.array(F.lit(None).cast("struct<word:int,bits:bigint>")), "sparse"), filled))

    doc, text_hash, mask, n, own_hash = (free_name(docs, f"_{c}") for c in ("doc", "text_hash", "mask", "n", "own_hash"))
    masks = sparse.select("doc", "text_hash", dense.alias("mask"), "n").toDF(doc, text_hash, mask, n)
    text = whole_text(text_col)
    keyed = docs.withColumn(own_hash, F.xxhash64(text))
    joined = keyed.join(masks, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(own_hash) == F.col(text_hash)), "left")
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda line, i: F.getbit(F.coalesce(F.get(F.col(mask), F.floor(i / F.lit(WORD)).cast("int")), F.lit(0).cast("long")), i % F.lit(WORD)) == 0)
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    return joined.select(
        *[F.when(F.col(mask).isNotNull(), F.array_join(kept, "\n")).otherwise(text).alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.size(lines).cast("long").alias(n_lines),
        F.coalesce(n, F.lit(0)).cast("long").alias(n_dropped),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
