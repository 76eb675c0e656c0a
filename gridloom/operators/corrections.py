"""Corrections from review, routed to the tables they are meant for.

A correction (record_id, field_name, new_value, decision, seq) names its target by the field's prefix, and a cell by a
locator behind ``@``. Of several for one record and field the last counts, and only if it is approved or corrected. Five
targets follow, each corrected in one pass over its table: corrections become one row for each key, joined once.

Corrections act in the order in which their record and field first came up (``order``), so where several mean one cell
the last of that order counts. Applying the same set again changes nothing: every target says which of its rows change, by comparing with what is there.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import MATCH_SHEET
from gridloom.operators.keyed import keep_last
from gridloom.sources.sinks import publish_all
from gridloom.sources.versioned import snapshot

#: Decisions that take effect, and what fields start with by target.
EFFECTIVE = ("approved", "corrected")
RECORD_FIELDS = {"records.title": "title", "records.full_text": "full_text", "records.primary_source_url": "primary_source_url"}
TERM_PREFIX, FEATURE_FIELD, RULE_FIELD, CANDIDATE_FIELD = "record_terms.term_name:", "policy_features.record_id", "city_policy_rules.rule_text", "t4_match_candidates.candidate_record_id"
TARGETS = ("records", "record_terms", "policy_features", "city_policy_rules", "t4_match_candidates")
CHANGED = "_changed"


def routed(corrections: DataFrame) -> DataFrame:
    """The corrections that count, with ``target``, their ``order`` and what field and locator say: column, term_id, sheet,
    cell, row."""
    ordered = corrections.withColumn("order", F.min("seq").over(Window.partitionBy("record_id", "field_name")))
    last = keep_last(ordered, ["record_id", "field_name"], "seq").where(F.col("decision").isin(*EFFECTIVE))
    base, locator = F.substring_index("field_name", "@", 1), F.regexp_extract("field_name", "(?s)^[^@]*@(.*)$", 1)
    corrected, has_record = F.col("decision") == "corrected", F.coalesce("record_id", F.lit("")) != ""
    at_cell = corrected & (locator != "")
    row = F.regexp_extract(locator, r"ROW:(\d+)", 1)
    target = (
        F.when(corrected & has_record & base.isin(*RECORD_FIELDS), "records")
        .when(base.startswith(TERM_PREFIX) & has_record, "record_terms")
        .when((base == FEATURE_FIELD) & at_cell, "policy_features")
        .when((base == RULE_FIELD) & at_cell, "city_policy_rules")
        .when((base == CANDIDATE_FIELD) & (row != ""), "t4_match_candidates")
    )
    parts = {
        "target": target,
        "column": F.when(base.isin(*RECORD_FIELDS), F.substring_index(base, ".", -1)),
        "term_id": F.when(base.startswith(TERM_PREFIX), F.substring(base, len(TERM_PREFIX) + 1, 1 << 20)),
        "sheet": F.when(F.contains(locator, F.lit("!")), F.regexp_extract(locator, "(?s)^(.*)!", 1)).otherwise(""),
        "cell": F.substring_index(locator, "!", -1),
        "row": F.when(row != "", row.cast("long")),
    }
    return last.withColumns(parts).where("target IS NOT NULL")


def _set(df: DataFrame, new: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``df`` with new values where the first column of a pair says so; ``_changed`` where a value is not the old one."""
    changed = F.lit(False)
    for c, (hit, value) in new.items():
        changed = changed | (F.coalesce(hit, F.lit(False)) & ~F.col(c).eqNullSafe(value))
    values = {c: F.when(F.coalesce(hit, F.lit(False)), value).otherwise(F.col(c)) for c, (hit, value) in new.items()}
    return df.withColumn(CHANGED, changed).withColumns(values)


def correct_records(records: DataFrame, routes: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Titles, texts and URLs; records in ``reviewed(record_id)`` become ``reviewed``."""
    columns = list(RECORD_FIELDS.values())
    mine = routes.where("target = 'records'").groupBy("record_id")
    wide = mine.agg(*[F.max(F.when(F.col("column") == c, F.struct(F.col("new_value").alias("v")))).alias(f"_{c}") for c in columns])
    done = reviewed.select("record_id").distinct().withColumn("_reviewed", F.lit(True))
    joined = records.join(wide, "record_id", "left").join(done, "record_id", "left")
    new = {c: (F.col(f"_{c}").isNotNull(), F.col(f"_{c}.v")) for c in columns}
    new["manual_review_status"] = (F.col("_reviewed"), F.lit("reviewed"))
    return _set(joined, new).select(*records.columns, CHANGED)


def correct_terms(terms: DataFrame, routes: DataFrame) -> DataFrame:
    """A term's new name if it is corrected; either way it is manual, certain, and has the decision as its status."""
    mine = routes.where("target = 'record_terms'").select("record_id", "term_id", F.col("new_value").alias("_name"), F.col("decision").alias("_decision"))
    hit = F.col("_decision").isNotNull()
    new = {
        "term_name": (F.col("_decision") == "corrected", F.col("_name")),
        "classification_source": (hit, F.lit("manual")),
        "confidence": (hit, F.lit(1.0)),
        "review_status": (hit, F.col("_decision")),
    }
    return _set(terms.join(mine, ["record_id", "term_id"], "left"), new).select(*terms.columns, CHANGED)


def _last_by_cell(routes: DataFrame, target: str) -> DataFrame:
    mine = keep_last(routes.where(F.col("target") == target), ["sheet", "cell"], "order")
    return mine.select("order", F.col("sheet").alias("source_sheet"), F.col("cell").alias("source_cell"), F.col("new_value").alias("_value"), F.lit(True).alias("_hit"))


def correct_features(features: DataFrame, routes: DataFrame) -> DataFrame:
    """The record of a cell's features, or of a row of the matched sheet if a candidate was decided on later."""
    by_cell = features.join(_last_by_cell(routes, "policy_features"), ["source_sheet", "source_cell"], "left")
    rows = keep_last(routes.where("target = 't4_match_candidates'"), ["row"], "order")
    rows = rows.select(F.col("row").alias("_row"), F.col("new_value").alias("_candidate"), F.col("order").alias("_decided"))
    number = F.when(F.col("source_sheet") == MATCH_SHEET, F.regexp_extract("source_cell", r"(\d+)", 1))
    by_row = by_cell.withColumn("_row", F.when(number != "", number.cast("long"))).join(rows, "_row", "left")
    later = F.col("_decided").isNotNull() & (F.col("order").isNull() | (F.col("_decided") > F.col("order")))
    value = F.when(later, F.col("_candidate")).otherwise(F.col("_value"))
    return _set(by_row, {"record_id": (later | F.col("_hit"), value)}).select(*features.columns, CHANGED)


def correct_rules(rules: DataFrame, routes: DataFrame) -> DataFrame:
    """A cell's rule text; a cell without a rule gets one, of the dimension ``manual_review``."""
    mine = _last_by_cell(routes, "city_policy_rules")
    known = _set(rules.join(mine, ["source_sheet", "source_cell"], "left"), {"rule_text": (F.col("_hit"), F.col("_value"))}).select(*rules.columns, CHANGED)
    fresh = mine.join(rules.select("source_sheet", "source_cell"), ["source_sheet", "source_cell"], "left_anti")
    given = {"rule_text": F.col("_value"), "policy_dimension": F.lit("manual_review"), "source_sheet": F.col("source_sheet"), "source_cell": F.col("source_cell")}
    added = fresh.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rules.schema.fields], F.lit(True).alias(CHANGED))
    return known.unionByName(added)


def correct_candidates(candidates: DataFrame, routes: DataFrame) -> DataFrame:
    """The decided candidate of a row has the decision as its status."""
    mine = routes.where("target = 't4_match_candidates'").select(F.col("row").alias("source_row"), F.col("new_value").alias("candidate_record_id"), F.col("decision").alias("_decision"), "order")
    last = keep_last(mine, ["source_row", "candidate_record_id"], "order").drop("order")
    joined = candidates.join(last, ["source_row", "candidate_record_id"], "left")
    return _set(joined, {"review_status": (F.col("_decision").isNotNull(), F.col("_decision"))}).select(*candidates.columns, CHANGED)


def corrected(tables: Mapping[str, DataFrame], corrections: DataFrame, reviewed: DataFrame) -> dict[str, DataFrame]:
    """Every one of ``TARGETS`` that ``tables`` has, corrected, with the column ``_changed``."""
    routes = routed(corrections)
    each = {
        "records": lambda df: correct_records(df, routes, reviewed),
        "record_terms": lambda df: correct_terms(df, routes),
        "policy_features": lambda df: correct_features(df, routes),
        "city_policy_rules": lambda df: correct_rules(df, routes),
        "t4_match_candidates": lambda df: correct_candidates(df, routes),
    }
    return {name: each[name](tables[name]) for name in TARGETS if name in tables}


@dataclass(frozen=True)
class Applied:
    """Rows changed by table, and the version that the tables had before, None if nothing changed."""

    changed: dict[str, int]
    history: str | None


def apply_corrections(spark: SparkSession, folder: str, corrections: DataFrame, reviewed: DataFrame, keys: Mapping[str, str]) -> Applied:
    """Correct the tables in ``folder``. Those that change are copied to a version of their own first, then replaced
    together (``sinks.publish_all``); ``keys`` has the column by which each table's rows must be unique."""
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in keys}
    new = corrected(tables, corrections, reviewed)
    counts = {name: df.where(CHANGED).count() for name, df in new.items()}
    changed = {name: n for name, n in counts.items() if n}
    if not changed:
        return Applied({}, None)
    history = snapshot(spark, folder, sorted(changed))
    publish_all({f"{folder}/{name}": (new[name].drop(CHANGED), keys[name]) for name in changed}, f"{folder}/_corrections")
    return Applied(changed, history)
