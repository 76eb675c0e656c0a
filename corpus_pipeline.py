"""The corpus pipeline: quality, line dedup, near dedup, mixing, packing.

Every stage takes the rows that the stage before kept and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each stage's rows to the shared folder, so that a stage reads files and lost executors
cost its own tasks only; what a stage left in the shared folder besides is deleted when its rows are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import line_dedup, mixing, packing, quality, simhash
from gridloom.llm.common import scratch_scope, table

#: The classifier's rejections and line removals cannot be written in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go. It learns from labels outside the held-out fold.

    Null and empty texts are scored like others; repeated rows share a score; an empty table stays empty."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~quality.held_out_fold())
    return quality.keep_good(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat in three documents or more stay in one; n_chars follows the text.

    A null text becomes an empty one; a row counts as a document of its own unless it repeats identifier and text."""
    kept = line_dedup.dedup_lines(docs)
    columns = [F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return kept.select(*columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8 or more) stays, that with the smallest
    doc_id. Fingerprints are linked by operator 10's walk of tries, checked on whole sets; a search by prefixes adds the
    pairs of that similarity that are too far apart for the walk.

    Texts without words are alike; a null doc_id comes last; of rows with the same doc_id and text one stays."""
    return simhash.drop_near_duplicates(docs, width=5, similarity=0.8)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, so that sources have shares in proportion to the square root of their sizes.

    A null source is a source; copies keep all columns, the doc_id too."""
    return mixing.mix_sources(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, each of a length that is a power of two.

    A null text is empty; every document ends in id 0, so an empty one is that id."""
    return packing.pack_power_of_two(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
