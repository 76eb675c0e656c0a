from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import MATCH_SHEET
from gridloom.operators import corrections as c
from gridloom.sources import versioned

SCHEMAS = {
    "records": "record_id string, title string, full_text string, primary_source_url string, manual_review_status string",
    "record_terms": "term_key string, record_id string, term_id string, term_name string, classification_source string, confidence double, review_status string",
    "policy_features": "feature_key string, record_id string, source_sheet string, source_cell string",
    "city_policy_rules": "jurisdiction_id long, policy_dimension string, rule_text string, source_cell string, source_sheet string",
    "t4_match_candidates": "match_key string, source_row long, candidate_record_id string, review_status string",
}
ROWS = {
    "records": [("R1", "old", "text", None, "pending"), ("R2", "b", "text", "u", "pending"), ("R3", None, None, None, "reviewed")],
    "record_terms": [("1", "R1", "T1", "name", "rule", 0.5, "pending"), ("2", "R1", "T2", "name", "rule", 0.5, "pending"), ("3", "R2", "T1", "name", "rule", 0.5, "pending")],
    "policy_features": [("1", "R1", "s!t", "A1"), ("2", "R1", MATCH_SHEET, "B7"), ("3", "R1", MATCH_SHEET, "C7"), ("4", "R1", "other", "B7"), ("5", None, "s!t", "A2")],
    "city_policy_rules": [(1, "dim", "old", "B1", "r"), (2, "dim", "same", "B2", "r")],
    "t4_match_candidates": [("1", 7, "R1", "pending"), ("2", 7, "R2", "pending"), ("3", 8, "R1", "pending")],
}
KEYS = {"records": "record_id", "record_terms": "term_key", "policy_features": "feature_key", "city_policy_rules": "source_cell", "t4_match_candidates": "match_key"}
CHANGES = [
    ("R1", "records.title", "first", "corrected"),
    ("R1", "records.title", "second", "corrected"),
    ("R2", "records.title", "never", "approved"),  # approved values are not set
    ("R2", "records.full_text", "never", "ignored"),
    ("R3", "records.primary_source_url", "https://a.org", "corrected"),
    (None, "records.title", "no record", "corrected"),
    ("R1", "record_terms.term_name:T1", "New", "corrected"),
    ("R2", "record_terms.term_name:T1", "not this", "approved"),
    ("R9", "policy_features.record_id@s!t!A2", "R2", "corrected"),
    ("R9", "policy_features.record_id", "no cell", "corrected"),
    ("", "city_policy_rules.rule_text@r!B1", "new rule", "corrected"),
    ("", "city_policy_rules.rule_text@r!B2", "same", "corrected"),
    ("", "city_policy_rules.rule_text@q!B9", "added", "corrected"),
    ("R1", "t4_match_candidates.candidate_record_id@T!ROW:7", "R2", "approved"),
    ("R1", "t4_match_candidates.candidate_record_id@T!ROWS", "R2", "approved"),
    ("R1", "nothing.known", "x", "corrected"),
]


@pytest.fixture
def changes(spark):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(CHANGES)], "seq long, record_id string, field_name string, new_value string, decision string")


def test_one_change_set_reaches_five_tables(spark, changes):
    tables = {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in ROWS.items()}
    new = c.corrected(tables, changes, spark.createDataFrame([("R2",), ("R3",)], "record_id string"))
    assert {name: df.columns[:-1] for name, df in new.items()} == {name: df.columns for name, df in tables.items()}
    got = {name: {tuple(r) for r in df.collect()} for name, df in new.items()}
    assert got["records"] == {("R1", "second", "text", None, "pending", True), ("R2", "b", "text", "u", "reviewed", True), ("R3", None, None, "https://a.org", "reviewed", True)}
    assert got["record_terms"] == {("1", "R1", "T1", "New", "manual", 1.0, "corrected", True), ("2", "R1", "T2", "name", "rule", 0.5, "pending", False), ("3", "R2", "T1", "name", "manual", 1.0, "approved", True)}
    assert got["policy_features"] == {("1", "R1", "s!t", "A1", False), ("2", "R2", MATCH_SHEET, "B7", True), ("3", "R2", MATCH_SHEET, "C7", True), ("4", "R1", "other", "B7", False), ("5", "R2", "s!t", "A2", True)}
    assert got["city_policy_rules"] == {(1, "dim", "new rule", "B1", "r", True), (2, "dim", "same", "B2", "r", False), (None, "manual_review", "added", "B9", "q", True)}
    assert got["t4_match_candidates"] == {("1", 7, "R1", "pending", False), ("2", 7, "R2", "approved", True), ("3", 8, "R1", "pending", False)}


def test_applying_twice_changes_nothing_and_the_version_before_can_be_read(spark, changes, tmp_path):
    folder = f"file://{tmp_path}"
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(f"{folder}/{name}")
    reviewed = spark.createDataFrame([("R2",)], "record_id string")
    first = c.apply_corrections(spark, folder, changes, reviewed, KEYS)
    assert first.changed == {"records": 3, "record_terms": 2, "policy_features": 3, "city_policy_rules": 2, "t4_match_candidates": 1}
    second = c.apply_corrections(spark, folder, changes, reviewed, KEYS)
    assert second == c.Applied({}, None) and versioned.versions(spark, folder) == [first.history]
    old = versioned.read_version(spark, folder, first.history, "records")
    assert {tuple(r) for r in old.collect()} == set(ROWS["records"])
    assert spark.read.parquet(f"{folder}/records").where("record_id = 'R1'").first()["title"] == "second"

    more = spark.createDataFrame([(99, "R1", "records.title", "third", "corrected")], changes.schema)
    third = c.apply_corrections(spark, folder, more, reviewed, KEYS)
    assert third.changed == {"records": 1} and versioned.versions(spark, folder) == [first.history, third.history]
    assert versioned.read_version(spark, folder, third.history, "records").where("record_id = 'R1'").first()["title"] == "second"


def test_the_later_of_two_ways_to_a_cell_counts(spark):
    features = spark.createDataFrame([("1", "R1", MATCH_SHEET, "B7")], SCHEMAS["policy_features"])
    rows = [("a", f"policy_features.record_id@{MATCH_SHEET}!B7", "cell", "corrected"), ("b", "t4_match_candidates.candidate_record_id@x!ROW:7", "row", "approved")]
    for order, want in ((rows, "row"), (rows[::-1], "cell"), ([*rows[::-1], ("b", *rows[1][1:2], "row again", "approved")], "cell")):
        changes = spark.createDataFrame([(i, *r) for i, r in enumerate(order)], "seq long, record_id string, field_name string, new_value string, decision string")
        assert c.correct_features(features, c.routed(changes)).first()["record_id"] == want


def test_signals_of_triage_are_found_in_the_tables(spark):
    from gridloom.operators import review

    task = "task_id string, review_type string, record_id string, field_name string, source_cell string, old_value string, suggested_value string, confidence double"
    feature, candidate = "policy_features.record_id", "t4_match_candidates.candidate_record_id"
    tasks = [
        ("a", "unexplained_t2", None, "cell", "B1", None, None, None), ("b", "unexplained_t2", None, "cell", "B2", None, None, None), ("c", "unexplained_t2", None, "cell", "B9", None, None, None),
        ("d", "missing_source", "R1", "records.full_text", None, None, None, None), ("e", "missing_source", "R2", "records.full_text", None, None, None, None),
        ("f", "missing_title", "R3", "records.title", None, None, None, None), ("g", "low_confidence", "R3", "t", None, None, None, None), ("h", "low_confidence", "R1", "t", None, None, None, None),
        ("i", "unmatched_t4", None, feature, "A7", None, None, None), ("j", "unmatched_t4", None, feature, "C7", None, None, None), ("k", "unmatched_t4", None, candidate, "ROW:8:R2", None, None, None),
        ("l", "unmatched_t4", None, feature, "A9", None, None, None), ("m", "unmatched_t4", None, feature, "A10", None, None, None), ("n", "unmatched_t4", None, feature, "D10", None, None, None),
    ]
    records = [("R1", None, None, None, None), ("R2", None, None, "", "https://a.org"), ("R3", None, "关于限购的通知", "A usable first line\nmore", None)]
    cells = [("B1", " 目录 ", "x", True), ("B2", "value", "x", True), ("B2", "value", "x", True)]
    features = [("R1", MATCH_SHEET, "A9"), (None, MATCH_SHEET, "A7"), ("R1", "other", "A7")]
    candidates = [(7, "R1", 80.0, "pending"), (8, "R2", 95.0, "pending"), (8, "R1", 91.0, "pending"), (8, "R3", 99.0, "approved"), (10, "R1", 60.0, "pending")]
    found = review.triage_signals(
        spark.createDataFrame(tasks, task), spark.createDataFrame(records, "record_id string, title string, summary string, full_text string, primary_source_url string"),
        spark.createDataFrame(cells, "source_cell string, cell_value string, original_field_name string, is_merged boolean"), spark.createDataFrame(features, "record_id string, source_sheet string, source_cell string"),
        spark.createDataFrame(candidates, "source_row int, candidate_record_id string, match_score double, review_status string"),
    )
    assert found.count() == len(tasks)
    got = {r["task_id"]: (r["automation_status"], r["diagnostic_confidence"]) for r in review.triage(found).collect()}
    assert got == {
        "a": ("rejected", 0.98), "b": ("auto_repaired_segmentation", 0.9), "c": ("auto_repaired_segmentation", 0.9), "d": ("manual_review_required", 0.85), "e": ("pending_diagnosis", 0.9),
        "f": ("auto_reparsed", 0.93), "g": ("auto_reparsed", 0.91), "h": ("manual_review_required", 0.65), "i": ("pending_diagnosis", 0.8), "j": ("rejected", 0.99), "k": ("auto_verified", 0.95),
        "l": ("auto_verified", 0.99), "m": ("manual_review_required", 0.6), "n": ("rejected", 0.99),
    }


def test_tasks_without_keys_do_not_all_go_to_one_task(spark):
    from gridloom.operators import review

    plain = spark.newSession()
    for k, v in {"adaptive.enabled": "false", "autoBroadcastJoinThreshold": "-1", "shuffle.partitions": "4"}.items():
        plain.conf.set(f"spark.sql.{k}", v)
    tasks = plain.createDataFrame([(f"T{i}", "other", None, "x", None) for i in range(400)], "task_id string, review_type string, record_id string, field_name string, source_cell string")
    one = lambda row, schema: plain.createDataFrame([row], schema)
    found = review.triage_signals(
        tasks, one(("R1", None, None, "text", None), "record_id string, title string, summary string, full_text string, primary_source_url string"), one(("B1", "value", "x", True), "source_cell string, cell_value string, original_field_name string, is_merged boolean"),
        one(("R1", MATCH_SHEET, "A9"), "record_id string, source_sheet string, source_cell string"), one((7, "R1", 80.0, "pending"), "source_row int, candidate_record_id string, match_score double, review_status string"),
    )
    dealt = [r["count"] for r in found.withColumn("_task", F.spark_partition_id()).groupBy("_task").count().collect()]
    assert sum(dealt) == 400 and max(dealt) < 200


def test_matrices_of_several_sheets(spark):
    from gridloom.operators import ingest

    cells = [("a", 1, 3, "甲政策现状", "C1"), ("a", 2, 3, "dim", "C2"), ("a", 5, 3, "rule", "C5"), ("a", 5, 4, "next", "D5"), ("b", 1, 4, "乙政策现状", "D1"), ("b", 5, 3, "no city", "C5"), ("b", 5, 4, "other", "D5"), ("b", 3, 4, "third", "D3")]
    df = spark.createDataFrame(cells, "sheet string, row int, col int, value string, source_cell string")
    got = {(r["sheet"], r["city_name"], r["policy_dimension"], r["rule_text"]) for r in ingest.matrix_rules(df, first_row=4).collect()}
    assert got == {("a", "甲", "dim", "rule"), ("a", "甲", None, "next"), ("b", "乙", "third", "other")}
    one = ingest.matrix_rules(df.where("sheet = 'a'").drop("sheet"), first_row=4)
    assert "sheet" not in one.columns and one.count() == 2
