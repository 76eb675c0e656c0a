"""Review tasks: producers, deterministic ids, listing, statistics, diagnosis, triage and verdicts as expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import MATCH_SHEET, OTHER_TOPIC
from gridloom.functions.numbers import cell_row, is_blank
from gridloom.functions.text import first_line_title, strip, task_id
from gridloom.functions.urls import is_valid_url
from gridloom.operators.keyed import insert_ignore, keep_first, left_join_some, top_k
from gridloom.operators.rules import classify
from gridloom.plans.library import is_official

COLUMNS = ("task_id", "record_id", "review_type", "field_name", "source_sheet", "source_cell", "old_value", "suggested_value", "confidence", "status", "evidence_url")


def tasks(df: DataFrame, review_type: str, field: str | Column, **values: Column) -> DataFrame:
    """Tasks of one type from the rows of ``df``; what is not given is null. The id depends on what the task is about only."""
    text = lambda n: values.get(n, F.lit(None)).cast("string")
    name = F.lit(field) if isinstance(field, str) else field
    rows = df.select(
        F.lit(review_type).alias("review_type"), text("record_id").alias("record_id"), name.alias("field_name"), *[text(n).alias(n) for n in ("source_sheet", "source_cell", "old_value", "suggested_value", "evidence_url")],
        values.get("confidence", F.lit(None)).cast("double").alias("confidence"), F.lit("pending").alias("status"),
    )
    return rows.withColumn("task_id", task_id(*[F.col(c) for c in ("review_type", "record_id", "field_name", "source_sheet", "source_cell")])).select(*COLUMNS)


def record_tasks(records: DataFrame) -> DataFrame:
    """Missing titles and texts and invalid URLs, in one pass over the records."""
    cell = F.concat(F.lit("ROW:"), F.col("source_row").cast("string"))
    checks = [
        ("missing_title", "records.title", is_blank(F.col("title")), "title", "primary_source_url"),
        ("missing_source", "records.full_text", is_blank(F.col("full_text")), "full_text", "primary_source_url"),
        ("invalid_url", "records.primary_source_url", ~is_valid_url(F.col("primary_source_url")), "primary_source_url", None),
    ]
    one = [
        F.when(bad, F.struct(F.lit(kind).alias("review_type"), F.lit(field).alias("field_name"), F.col(old).cast("string").alias("old_value"), (F.col(url) if url else F.lit(None)).cast("string").alias("evidence_url")))
        for kind, field, bad, old, url in checks
    ]
    rows = records.select(F.col("record_id").cast("string").alias("record_id"), "source_sheet", cell.alias("source_cell"), F.explode(F.filter(F.array(*one), lambda x: x.isNotNull())).alias("t")).select("record_id", "source_sheet", "source_cell", "t.*")
    rows = rows.withColumns({"suggested_value": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double"), "status": F.lit("pending")})
    return rows.withColumn("task_id", task_id(*[F.col(c) for c in ("review_type", "record_id", "field_name", "source_sheet", "source_cell")])).select(*COLUMNS)


def low_confidence_tasks(terms: DataFrame, least: float = 0.65) -> DataFrame:
    return tasks(terms.where(F.col("confidence") < least), "low_confidence", F.concat(F.lit("record_terms.term_name:"), F.col("term_id")), record_id=F.col("record_id"), source_cell=F.col("term_id"), old_value=F.col("term_name"), suggested_value=F.col("term_name"), confidence=F.col("confidence"))


def duplicate_tasks(records: DataFrame) -> DataFrame:
    """A task for each record whose hash another one has too: hashes are counted first, then met by a semi join."""
    repeated = records.where("content_hash IS NOT NULL").groupBy("content_hash").count().where("count > 1").select("content_hash")
    return tasks(records.join(repeated, "content_hash", "left_semi"), "duplicate_record", "records.content_hash", record_id=F.col("record_id"), source_sheet=F.col("source_sheet"), source_cell=F.concat(F.lit("ROW:"), F.col("source_row").cast("string")), old_value=F.col("content_hash"))


def unmatched_tasks(features: DataFrame) -> DataFrame:
    return tasks(features.where("record_id IS NULL"), "unmatched_t4", "policy_features.record_id", source_sheet=F.col("source_sheet"), source_cell=F.col("source_cell"), old_value=F.col("feature_value"))


def candidate_tasks(candidates: DataFrame, sheet: str) -> DataFrame:
    """A task for each pending match candidate, with its score as confidence."""
    cell = F.concat(F.lit("ROW:"), F.col("row_number").cast("string"), F.lit(":"), F.col("candidate_record_id").cast("string"))
    return tasks(candidates.where("review_status = 'pending'"), "unmatched_t4", "t4_match_candidates.candidate_record_id", source_sheet=F.lit(sheet), source_cell=cell, old_value=F.col("candidate_record_id"), suggested_value=F.col("candidate_record_id"), confidence=F.col("match_score") / 100)


def unexplained_tasks(cells: DataFrame, mapped: DataFrame) -> DataFrame:
    """Staged cells that no rule was read from: an anti join."""
    return tasks(cells.join(mapped.select("source_cell"), "source_cell", "left_anti"), "unexplained_t2", "city_policy_rules.rule_text", source_sheet=F.col("source_sheet_name"), source_cell=F.col("source_cell"), old_value=F.col("cell_value"), suggested_value=F.col("original_field_name"))


def flagged_tasks(df: DataFrame, field: str, sheet: str, key: str, old: str) -> DataFrame:
    """Tasks for rows that a step marked ``needs_review``."""
    record = F.col("record_id") if "record_id" in df.columns else F.lit(None)
    confidence = F.col("confidence") if "confidence" in df.columns else F.lit(None)
    return tasks(df.where("needs_review"), "other", field, record_id=record, source_sheet=F.lit(sheet), source_cell=F.col(key), old_value=F.col(old), confidence=confidence)


def generate(producers: list[DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """All tasks of the producers, each id once; with those that exist, those stay as they are and new ones join them."""
    found = top_k(reduce(DataFrame.unionByName, producers), ["task_id"], [F.asc("review_type")])
    return found if existing is None else insert_ignore(existing, found, ["task_id"])


def listed(all_tasks: DataFrame, review_type: str | None = None, status: str | None = "pending", automation_status: str | None = None, limit: int = 1000, offset: int = 0) -> DataFrame:
    """A page of tasks: pending first, then by type and id. Status 'completed' is all but pending."""
    if review_type and review_type != "all":
        all_tasks = all_tasks.where(F.col("review_type") == review_type)
    if status == "completed":
        all_tasks = all_tasks.where("status <> 'pending'")
    elif status and status != "all":
        all_tasks = all_tasks.where(F.col("status") == status)
    if automation_status and automation_status != "all":
        all_tasks = all_tasks.where(F.coalesce("automation_status", F.lit("pending_diagnosis")) == automation_status)
    return all_tasks.orderBy(F.when(F.col("status") == "pending", 0).otherwise(1), "review_type", "task_id").offset(max(0, offset)).limit(max(1, limit))


def histogram(all_tasks: DataFrame, columns: list[str]) -> DataFrame:
    """Counts and shares by value for several columns at once: one pass, unpivoted before it is counted."""
    rows = all_tasks.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    counted = rows.groupBy("field", "value").agg(F.count("*").alias("n"))
    totals = counted.groupBy("field").agg(F.sum("n").alias("total"))
    return counted.join(totals, "field").select("field", "value", "n", F.round(F.col("n") / F.col("total"), 4).alias("share"))


DECISIONS = ("approved", "corrected", "rejected", "ignored")


def decide(all_tasks: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tasks after the decisions, correction log). ``decisions``: task_id, decision, new_value, reviewer, review_note,
    evidence_url, seq; the last one of a task counts. A decision must be one of ``DECISIONS``, and a correction needs a
    value: otherwise the read fails."""
    ok = F.col("decision").isin(*DECISIONS) & ((F.col("decision") != "corrected") | F.col("new_value").isNotNull())
    checked = decisions.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit("unsupported decision, or a correction without a value")).cast("boolean")))
    last = top_k(checked, ["task_id"], [F.desc("seq")]).select("task_id", "decision", "new_value", "reviewer", "review_note", F.col("evidence_url").alias("new_evidence"))
    joined = all_tasks.join(last, "task_id", "left")
    done = F.col("decision").isNotNull()
    value = F.when(F.col("decision") == "corrected", F.col("new_value")).otherwise(F.col("old_value"))
    after = joined.select(
        *[c for c in all_tasks.columns if c not in ("status", "suggested_value", "evidence_url")], F.coalesce("decision", "status").alias("status"), F.when(done, value).otherwise(F.col("suggested_value")).alias("suggested_value"), F.coalesce("new_evidence", "evidence_url").alias("evidence_url"),
        F.when(F.col("decision") == "rejected", "rejected").when(done, "auto_verified").alias("decided_status"),
    )
    log = joined.where(done).select("task_id", "record_id", F.coalesce("field_name", F.lit("other")).alias("field_name"), "old_value", value.alias("new_value"), "decision", "reviewer", "review_note")
    return after, log


def reviewed_records(records: DataFrame, all_tasks: DataFrame) -> DataFrame:
    """Records that had tasks and have none pending any more become ``reviewed``."""
    state = all_tasks.where("record_id IS NOT NULL").groupBy("record_id").agg(F.count_if(F.col("status") == "pending").alias("_pending"))
    joined = records.join(state.withColumnRenamed("record_id", "_rid"), records["record_id"].cast("string") == F.col("_rid"), "left")
    return joined.select(*[F.when(F.col("_pending") == 0, "reviewed").otherwise(F.col(c)).alias(c) if c == "manual_review_status" else F.col(c) for c in records.columns])


def diagnose(text: Column, url: Column, parse_status: Column, has_attachments: Column, dynamic: Column, repairs: Column) -> Column:
    """struct(diagnosis, confidence, repairable), first rule that holds."""
    t = F.coalesce(text, F.lit(""))
    blank = strip(t) == ""
    d = lambda name, confidence, ok: F.struct(F.lit(name).alias("diagnosis"), (confidence if isinstance(confidence, Column) else F.lit(confidence)).cast("double").alias("confidence"), F.lit(ok).alias("repairable"))
    return (
        F.when(F.coalesce(parse_status, F.lit("")) == "parser_error", d("parser_error", 0.99, True))
        .when(F.coalesce(has_attachments, F.lit(False)) & (t == ""), d("attachment_missing", 0.95, True))
        .when(F.coalesce(dynamic, F.lit(False)) & (F.char_length(t) < 80), d("dynamic_page_missing", 0.92, True))
        .when(F.coalesce(repairs, F.lit(0)) > 0, d("segmentation_error", F.least(F.lit(0.99), F.lit(0.85) + repairs * F.lit(0.02)), True))
        .when(blank & (F.coalesce(url, F.lit("")) != ""), d("source_content_missing", 0.9, True))
        .when(blank, d("true_information_missing", 0.85, False))
        .otherwise(d("source_content_missing", 0.72, True))
    )


def verdict(official_status: Column, conflicts: Column, completeness: Column, agreement: Column, first: Column, second: Column | None = None, supported: Column | None = None, second_conflicts: Column | None = None) -> Column:
    """struct(status, confidence). ``conflicts`` is whether title, city or date conflict; ``second`` is the confidence of a
    second review, null without one, ``supported`` whether it supports all six fields."""
    second = F.lit(None).cast("double") if second is None else second
    supported = F.lit(False) if supported is None else supported
    second_conflicts = F.lit(False) if second_conflicts is None else second_conflicts
    official = F.coalesce(is_official(official_status), F.lit(False))
    base = official.cast("double") * 0.25 + completeness * 0.25 + agreement.cast("double") * 0.25 + first * 0.25
    final = (base + second) / 2
    out = lambda s, c: F.struct(F.lit(s).alias("status"), c.alias("confidence"))
    reviewed = (base >= 0.7) & second.isNotNull()
    return (
        F.when(conflicts, out("manual_review_required", F.least(base, F.lit(0.69))))
        .when(official & (completeness >= 0.85) & agreement & (base >= 0.9), out("auto_verified", F.round(base, 4)))
        .when(reviewed & supported & ~second_conflicts & (final >= 0.9), out("auto_verified", F.round(final, 4)))
        .when(reviewed & ~second_conflicts & (final >= 0.7), out("pending_diagnosis", F.round(final, 4)))
        .when(reviewed, out("manual_review_required", F.round(final, 4)))
        .otherwise(out("manual_review_required", F.round(base, 4)))
    )


#: Cells of a matrix sheet that are layout, by their value or the end of their heading.
LAYOUT_VALUE, LAYOUT_HEADING = "目录", "政策现状"


def triage_signals(tasks: DataFrame, records: DataFrame, cells: DataFrame, features: DataFrame, candidates: DataFrame, match_sheet: str = MATCH_SHEET) -> DataFrame:
    """``tasks`` with what ``triage`` looks at, found in the tables by joins, each with one row for its key.

    ``records`` (record_id, title, summary, full_text, primary_source_url); ``cells`` of the matrix sheet (source_cell,
    cell_value, original_field_name, is_merged); ``features`` (record_id, source_sheet, source_cell); ``candidates``
    (source_row, candidate_record_id, match_score, review_status). Of the feature tasks of one row, the one with the
    smallest task_id is the first. Texts are read for the records of tasks that look at them only.
    """
    needed = tasks.where(F.col("review_type").isin("missing_title", "missing_source", "low_confidence")).select("record_id").distinct()
    words = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "summary", "full_text")])
    none = F.lit(None)
    found = diagnose(F.col("full_text"), F.col("primary_source_url"), none.cast("string"), none.cast("boolean"), none.cast("boolean"), none.cast("int"))
    told = records.join(needed, "record_id", "left_semi").select(
        "record_id", F.col("full_text").alias("text"), found.alias("_d"), F.exists(classify(words), lambda x: x["topic"] != OTHER_TOPIC).alias("topics_found")
    ).select("record_id", "text", "topics_found", F.col("_d.repairable").alias("repairable"), F.col("_d.confidence").alias("diagnosis_confidence"))

    value, header = F.btrim(F.coalesce("cell_value", F.lit(""))), F.btrim(F.coalesce("original_field_name", F.lit("")))
    laid_out = keep_first(cells, ["source_cell"], "source_cell").select("source_cell", "is_merged", value.alias("cell_value"), header.alias("header"), ((value == LAYOUT_VALUE) | header.endswith(LAYOUT_HEADING)).alias("is_heading"))

    linked = features.where((F.col("source_sheet") == match_sheet) & F.col("record_id").isNotNull()).select(F.regexp_extract("source_cell", r"(\d+)", 1).try_cast("bigint").alias("_row")).where("_row IS NOT NULL").distinct()
    pending = candidates.where("review_status = 'pending'").select(F.col("source_row").cast("bigint").alias("_row"), F.col("match_score").cast("double").alias("score"), "candidate_record_id")
    two = top_k(pending, ["_row"], [F.desc("score"), F.asc("candidate_record_id")], 2, rank="_n").groupBy("_row")
    rank = lambda n: F.max(F.when(F.col("_n") == n, F.col("score")))
    best = two.agg(rank(1).alias("best"), (rank(1) - F.coalesce(rank(2), F.lit(0.0))).alias("margin"))

    placed = tasks.withColumn("_row", F.when(F.col("review_type") == "unmatched_t4", cell_row(F.col("source_cell"))))
    is_feature = F.coalesce(F.col("field_name").startswith("policy_features") & F.col("_row").isNotNull(), F.lit(False))
    first = placed.where(is_feature).groupBy("_row").agg(F.min("task_id").alias("_first"))
    matched = F.when(F.col("review_type") == "unexplained_t2", F.col("source_cell")).alias("_cell")
    joined = left_join_some(placed.withColumn("_cell", matched), [laid_out.withColumnRenamed("source_cell", "_cell")], "_cell", "task_id")
    joined = left_join_some(joined, [linked.withColumn("already_linked", F.lit(True)), best, first], "_row", "task_id")
    joined = left_join_some(joined, [told], "record_id", "task_id")  # texts come last, so they move once
    return joined.withColumn("first_in_row", F.coalesce(is_feature & (F.col("task_id") == F.col("_first")), F.lit(False))).drop("_row", "_cell", "_first")


def triage(all_tasks: DataFrame) -> DataFrame:
    """Tasks with automation_status, diagnostic_confidence and suggested_value by the ladder of their type.

    Besides the task's columns the rows carry what the ladder looks at: text, is_merged, cell_value, header, is_heading,
    repairable, diagnosis_confidence, topics_found, already_linked, best, margin, first_in_row. What a type does not look
    at may be null.
    """
    t, old = F.col("review_type"), F.col("old_value")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    unique_high = (F.coalesce("best", F.lit(0.0)) >= 90) & (F.coalesce("margin", F.lit(0.0)) >= 3)
    share = F.coalesce(F.col("best") / 100, F.lit(0.5))
    noise = yes("is_merged") & (is_blank(F.col("cell_value")) | F.coalesce(F.col("cell_value") == F.col("header"), F.lit(False)) | yes("is_heading"))
    title = first_line_title(F.col("text"))
    feature, candidate = F.col("field_name") == "policy_features.record_id", F.col("field_name") == "t4_match_candidates.candidate_record_id"
    r = lambda s, c, v=F.lit(None).cast("string"): F.struct(F.lit(s).alias("automation_status"), (c if isinstance(c, Column) else F.lit(c)).cast("double").alias("diagnostic_confidence"), v.alias("suggestion"))
    unmatched = (
        F.when(yes("already_linked"), r("auto_verified", 0.99))
        .when(feature & ~yes("first_in_row") & ~unique_high, r("rejected", 0.99))
        .when(feature & unique_high, r("auto_reparsed", share))
        .when(candidate & unique_high, r("auto_verified", share))
        .when(F.col("best") < 70, r("manual_review_required", share))
        .otherwise(r("pending_diagnosis", share))
    )
    ladder = (
        F.when(t == "unexplained_t2", F.when(noise, r("rejected", 0.98)).otherwise(r("auto_repaired_segmentation", 0.90)))
        .when(t == "missing_source", F.when(yes("repairable"), r("pending_diagnosis", F.col("diagnosis_confidence"))).otherwise(r("manual_review_required", F.col("diagnosis_confidence"))))
        .when(t == "missing_title", F.when(title.isNotNull(), r("auto_reparsed", 0.93, title)).otherwise(r("manual_review_required", 0.60)))
        .when(t == "invalid_url", F.when(is_blank(old), r("pending_diagnosis", 0.92)).otherwise(r("pending_diagnosis", 0.75)))
        .when(t == "low_confidence", F.when(yes("topics_found"), r("auto_reparsed", 0.91)).otherwise(r("manual_review_required", 0.65)))
        .when(t == "unmatched_t4", unmatched)
        .when((t == "other") & F.col("field_name").startswith("policy_applicable_cities"), r("rejected", 0.99))
        .when((t == "other") & F.contains("field_name", F.lit("canonical_source")), r("auto_recovered_secondary", 0.90))
        .otherwise(r("manual_review_required", F.coalesce("confidence", F.lit(0.5))))
    )
    return all_tasks.withColumn("_l", ladder).withColumns({
        "automation_status": F.col("_l.automation_status"), "diagnostic_confidence": F.round("_l.diagnostic_confidence", 4), "suggested_value": F.coalesce("_l.suggestion", "suggested_value"),
    }).drop("_l")
