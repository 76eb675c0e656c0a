"""Curated state: the mapping of sheet rows to records, the coverage report of collections, and repairs from triaged tasks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import OTHER_TOPIC
from gridloom.functions.numbers import cell_row
from gridloom.functions.text import normalize_title, stable_id
from gridloom.operators.keyed import keep_last, top_k, upsert
from gridloom.operators.rules import classify


def row_mapping(cells: DataFrame, records: DataFrame, seq: str = "record_id") -> DataFrame:
    """(source_sheet, source_row, export_row, policy_id): which record each row of an exported sheet stands for. Of records
    with the same sheet and row the last by ``seq`` counts; rows without a record are left out."""
    known = keep_last(records.where("source_sheet <> '' AND source_row <> 0"), ["source_sheet", "source_row"], seq)
    rows = cells.select("source_sheet", "source_row").distinct()
    return rows.join(known.select("source_sheet", "source_row", F.col("record_id").alias("policy_id")), ["source_sheet", "source_row"]).select("source_sheet", "source_row", F.col("source_row").alias("export_row"), "policy_id")


def _one_row(measures: Mapping[str, DataFrame]) -> DataFrame:
    """Counts, each of one row and column, side by side: stacked and pivoted, so nothing is multiplied."""
    rows = reduce(DataFrame.unionByName, [df.toDF("n").select(F.lit(name).alias("name"), F.col("n").cast("long").alias("n")) for name, df in measures.items()])
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in measures])


def collection_report(taxonomy: DataFrame, mappings: DataFrame, staging: DataFrame, catalog: DataFrame, records: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row of coverage counts with ``passed``: every staged sheet is mapped and every mapped one staged, every staged
    cell is in the catalogue, and every record has a collection.

    ``taxonomy`` has collection, subcollection; ``mappings`` and ``staging`` source_sheet; ``catalog`` collection (null
    where a cell has none); ``assigned`` record_id, collection, subcollection.
    """
    count, distinct = (lambda df: df.agg(F.count("*"))), (lambda df, *c: df.agg(F.count_distinct(*c)))
    sheets, mapped = staging.select("source_sheet").distinct(), mappings.select("source_sheet").distinct()
    row = _one_row({
        "collection_count": distinct(taxonomy, "collection"),
        "subcollection_count": distinct(taxonomy.where("subcollection IS NOT NULL"), "collection", "subcollection"),
        "staging_sheet_count": count(sheets),
        "mapped_sheet_count": count(mapped),
        "staging_cell_count": count(staging),
        "catalog_cell_count": count(catalog),
        "unmapped_sheet_count": count(sheets.join(mapped, "source_sheet", "left_anti")),
        "unknown_sheet_count": count(mapped.join(sheets, "source_sheet", "left_anti")),
        "unmapped_cell_count": count(catalog.where("collection IS NULL")),
        "record_count": count(records),
        "classified_record_count": distinct(assigned, "record_id"),
        "subclassified_record_count": distinct(assigned.where("subcollection IS NOT NULL"), "record_id"),
        "record_collection_relation_count": count(assigned),
    })
    passed = (F.col("unmapped_sheet_count") == 0) & (F.col("unknown_sheet_count") == 0) & (F.col("catalog_cell_count") == F.col("staging_cell_count")) & (F.col("classified_record_count") == F.col("record_count"))
    return row.withColumn("unclassified_record_count", F.col("record_count") - F.col("classified_record_count")).withColumn("passed", passed)


def collection_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("collection").agg(F.count_distinct("record_id").alias("record_count"))


def _reparsed(tasks: DataFrame, condition: Column) -> DataFrame:
    return tasks.where((F.col("automation_status") == "auto_reparsed") & condition)


def repaired_titles(records: DataFrame, tasks: DataFrame) -> DataFrame:
    """``records`` with the titles that triage read out of texts, and their normal forms; of several for a record the one
    of the last task by id."""
    found = _reparsed(tasks, (F.col("review_type") == "missing_title") & F.col("record_id").isNotNull() & (F.coalesce("suggested_value", F.lit("")) != ""))
    last = keep_last(found, ["record_id"], "task_id").select(F.col("record_id").alias("_id"), F.col("suggested_value").alias("_title"))
    joined = records.join(last, records["record_id"].cast("string") == F.col("_id"), "left")
    fresh = {"title": F.coalesce("_title", "title"), "title_normalized": F.when(F.col("_title").isNotNull(), normalize_title(F.col("_title"))).otherwise(F.col("title_normalized"))}
    return joined.select(*[fresh[c].alias(c) if c in fresh else F.col(c) for c in records.columns])


def repaired_links(features: DataFrame, tasks: DataFrame, overlay: DataFrame, sheet: str) -> DataFrame:
    """The overlay of links (source_cell, source_row, record_id, classification_source, confidence) with those that triage
    found: a row's record for each of its cells on ``sheet`` that has none. A cell's last link counts."""
    found = _reparsed(tasks, F.col("field_name").startswith("policy_features") & (F.coalesce("suggested_value", F.lit("")) != ""))
    rows = keep_last(found.withColumn("source_row", cell_row(F.col("source_cell"))).where("source_row <> 0"), ["source_row"], "task_id")
    open_cells = features.where((F.col("source_sheet") == sheet) & F.col("record_id").isNull()).select("source_cell", F.regexp_substr("source_cell", F.lit(r"\d+")).try_cast("bigint").alias("source_row"))
    links = open_cells.join(rows.select("source_row", F.col("suggested_value").alias("record_id")), "source_row").select(
        "source_cell", "source_row", "record_id", F.lit("deterministic_auto_match").alias("classification_source"), F.lit(0.9).alias("confidence"))
    return upsert(overlay, links, ["source_cell"], "source_row")


def repaired_topics(terms: DataFrame, records: DataFrame, tasks: DataFrame, rules: dict[str, list[str]] | None = None, text: Sequence[str] = ("title", "summary", "full_text")) -> DataFrame:
    """``terms`` with the topics of records whose doubtful ones were read again: the catch-all topic is superseded, the
    topics found are added, and the last of (record, term, source) counts."""
    ids = _reparsed(tasks, (F.col("review_type") == "low_confidence") & F.col("record_id").isNotNull()).select("record_id").distinct()
    whole = F.array_join(F.transform(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in text]), lambda x: x), " ")
    asked = records.withColumn("record_id", F.col("record_id").cast("string")).join(ids, "record_id", "left_semi")
    found = asked.select("record_id", F.explode(classify(whole, rules)).alias("t")).where(F.col("t.topic") != OTHER_TOPIC)
    fresh = found.select(
        "record_id", stable_id(F.lit("topic"), F.col("t.topic"), prefix="TERM").alias("term_id"), F.lit("topic").alias("taxonomy_name"), F.col("t.topic").alias("term_name"), F.lit("rule").alias("classification_source"),
        F.col("t.confidence").cast("double").alias("confidence"), F.col("t.evidence_excerpt").alias("evidence_excerpt"), F.lit("auto_verified").alias("review_status"))
    hit = terms.join(asked.select("record_id", F.lit(True).alias("_asked")), "record_id", "left")
    over = F.col("_asked") & (F.col("taxonomy_name") == "topic") & (F.col("term_name") == OTHER_TOPIC)
    old = hit.withColumn("review_status", F.when(over, "superseded_auto").otherwise(F.col("review_status"))).drop("_asked")
    both = old.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return top_k(both, ["record_id", "term_id", "classification_source"], [F.desc("_new")]).drop("_new")
