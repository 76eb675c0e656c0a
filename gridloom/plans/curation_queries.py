"""Queries for sources, sinks, curation, review and places that need inputs of their own, each beside its SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import numbers, text
from gridloom.operators import curation, geography, review
from gridloom.plans.operator_queries import _CITIES, _CITY_SCHEMA, _PLACES, Tables, _all_tasks, _placed, scratch
from gridloom.sources import rules as rule_sources
from gridloom.sources import sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        SQL[name] = sql
        return fn

    return register


def _values(rows: list[tuple], columns: str) -> str:
    cell = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"{v}::DOUBLE" if isinstance(v, float) else str(v) if isinstance(v, int) else "'" + v + "'"
    return f"(VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS t({columns})"


# ---- sources and sinks -------------------------------------------------------------------------------------------

@query("s05_count_and_preview", "SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n, least(20, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')) AS shown, true AS all_selected")
def _(t):
    """The count, and a preview of 20 rows without an order: how many it has and that all of them were selected."""
    count, rows = tables.preview(t.orders.select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus") == "F")
    seen = rows.agg(F.count("*").alias("shown"), F.coalesce(F.bool_and(F.col("o_orderstatus") == "F"), F.lit(True)).alias("all_selected"))
    both = count.select("n", F.lit(None).cast("bigint").alias("shown"), F.lit(None).cast("boolean").alias("all_selected")).unionByName(seen.select(F.lit(None).cast("bigint").alias("n"), "shown", "all_selected"))
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query("s07_contract_csv", "SELECT n_nationkey, n_name, nullif(CASE WHEN n_nationkey % 3 > 0 THEN n_name ELSE '' END, '') AS note FROM nation")
def _(t):
    path = scratch(t.spark, "contract") + ".csv"
    n = t.nation.count()
    t.nation.select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 3 > 0, F.col("n_name")).alias("note")).write.option("header", True).csv(path)
    schema = T.StructType.fromDDL("n_nationkey int, n_name string, note string")
    return tables.read_contract_csv(t.spark, path, schema, "n_nationkey", n, (F.col("n_nationkey") >= 0, "a negative key"))


@query("s10_rule_sources", "SELECT c_custkey AS record_id, s.collection, s.subcollection, s.mapping_role FROM customer JOIN " + _values([("BUILDING", "a", "x", "primary"), ("BUILDING", "b", None, "secondary"), ("MACHINERY", "c", "y", "primary")], "sheet, collection, subcollection, mapping_role") .replace("AS t(", "AS s(") + " ON c_mktsegment = s.sheet")
def _(t):
    """Sheet mappings kept as JSON in a store, read, and joined to records."""
    path = scratch(t.spark, "rules") + ".json"
    config = {"BUILDING": {"primary": {"collection": "a", "subcollection": "x"}, "secondary": [{"collection": "b", "subcollection": None}]}, "MACHINERY": {"primary": {"collection": "c", "subcollection": "y"}}}
    t.spark.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(path)
    sheets = rule_sources.sheet_mappings(t.spark, rule_sources.read_rules(t.spark, path))
    return t.customer.join(sheets, F.col("c_mktsegment") == F.col("source_sheet")).select(F.col("c_custkey").alias("record_id"), "collection", "subcollection", "mapping_role")


@query("s14_stata_names", "SELECT * FROM " + _values([("a name with spaces, and more than 32 letters", "a_name_with_spaces__and_more_tha"), ("a name with spaces; and more than 32 words", "a_name_with_spaces__and_more_t_2"), ("x", "x"), ("x!", "x_")], "name, short"))
def _(t):
    names = sinks.stata_names(["a name with spaces, and more than 32 letters", "a name with spaces; and more than 32 words", "x", "x!"])
    return t.spark.createDataFrame(list(names.items()), "name string, short string")


@query("s16_csv_round_trip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    path = sinks.export(t.customer.select("c_custkey", "c_name", "c_acctbal"), scratch(t.spark, "out") + ".csv")
    return t.spark.read.csv(path, header=True, schema="c_custkey bigint, c_name string, c_acctbal double")


@query("s20_table_existence", "SELECT r_regionkey, r_name, NULL::VARCHAR AS absent, 0::BIGINT AS rows_of_missing FROM region")
def _(t):
    """A table that is there, with a column it lacks, and the rows of one that is not there."""
    found = tables.read_or_empty(t.spark, f"{t.sf_dir}/region.parquet", "r_regionkey int, r_name string, absent string")
    return found.withColumn("rows_of_missing", F.lit(tables.read_or_empty(t.spark, f"{t.sf_dir}/no_such_table.parquet", "a int").count()).cast("bigint"))


@query("u02_merge_of_tables", "SELECT 'customer' AS name, c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS v FROM customer UNION ALL SELECT 'supplier', s_suppkey, 'old' FROM supplier UNION ALL SELECT 'supplier', s_suppkey + 1000000, 'new' FROM supplier WHERE s_suppkey % 3 = 0")
def _(t):
    """Two tables published together, then a merge of changes into both published together again."""
    from gridloom.operators.keyed import upsert

    at = {n: scratch(t.spark, n) for n in ("customer", "supplier", "manifest")}
    first = {"customer": t.customer.select(F.col("c_custkey").cast("bigint").alias("k"), F.lit("old").alias("v")), "supplier": t.supplier.select(F.col("s_suppkey").cast("bigint").alias("k"), F.lit("old").alias("v"))}
    sinks.publish_all({at[n]: (df, "k") for n, df in first.items()}, at["manifest"])
    changes = {"customer": first["customer"].where("k % 2 = 0").select("k", F.lit("new").alias("v")), "supplier": first["supplier"].where("k % 3 = 0").select(F.col("k") + 1000000, F.lit("new")).toDF("k", "v")}
    sinks.publish_all({at[n]: (upsert(t.spark.read.parquet(at[n]), changes[n], ["k"], "k"), "k") for n in first}, at["manifest"])
    return tables.stacked([t.spark.read.parquet(at[n]).select(F.lit(n).alias("name"), "k", "v") for n in first])


# ---- scalar functions --------------------------------------------------------------------------------------------

_DATED = "(SELECT o_orderkey, 'on ' || year(o_orderdate) || CASE o_orderkey % 3 WHEN 0 THEN '-' WHEN 1 THEN '/' ELSE '.' END || month(o_orderdate) || '-' || day(o_orderdate) || CASE WHEN o_orderkey % 5 = 0 THEN ' or 1999-13-45' ELSE '' END AS s, o_orderdate, o_orderkey % 7 = 0 AS glued FROM orders)"


@query("f10_date_variants", f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS any_century, CASE WHEN year(o_orderdate) >= 2000 THEN CAST(o_orderdate AS DATE) END AS this_century, CASE WHEN NOT glued THEN CAST(o_orderdate AS DATE) END AS bounded,
  NULL::DATE AS too_short FROM {_DATED}""")
def _(t):
    d = F.to_date("o_orderdate")
    sep = F.element_at(F.array(F.lit("-"), F.lit("/"), F.lit(".")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    s = F.concat(F.when(F.col("o_orderkey") % 7 == 0, "on 1").otherwise("on "), F.year(d).cast("string"), sep, F.month(d).cast("string"), F.lit("-"), F.dayofmonth(d).cast("string"), F.when(F.col("o_orderkey") % 5 == 0, " or 1999-13-45").otherwise(""))
    c = F.col("s")
    return t.orders.select("o_orderkey", s.alias("s")).select("o_orderkey", numbers.parse_date(c).alias("any_century"), numbers.parse_date(F.regexp_replace(c, " or .*", ""), years="20").alias("this_century"), numbers.parse_date(F.regexp_replace(c, " or .*", ""), bounded=True).alias("bounded"), numbers.parse_date(c, within=8).alias("too_short"))


@query("f17_document_number", "SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN '建房' || CASE c_custkey % 3 WHEN 0 THEN '〔' WHEN 1 THEN '[' ELSE '(' END || (2000 + c_custkey % 30) || CASE c_custkey % 3 WHEN 0 THEN '〕' WHEN 1 THEN ']' ELSE ')' END || (1 + c_custkey % 500) || '号' END AS number FROM customer")
def _(t):
    k = F.col("c_custkey")
    pair = lambda *w: F.element_at(F.array(*[F.lit(x) for x in w]), (k % 3 + 1).cast("int"))
    number = F.concat(F.lit(" 见建房"), pair("〔", "[", "("), (2000 + k % 30).cast("string"), pair("〕", "]", ")"), (1 + k % 500).cast("string"), F.lit("号，和其他"))
    whole = F.when(k % 4 > 0, F.concat(F.lit("按 "), F.replace(number, F.lit("见"), F.lit("")))).otherwise("没有文号 2021 号")
    return t.customer.select("c_custkey", numbers.document_number(whole).alias("number"))


@query("f21_slug_and_redact", "SELECT c_custkey, 'a_b-' || c_custkey || '_x' AS slug, 'https://h.org/p/' || c_custkey AS redacted FROM customer")
def _(t):
    k = F.col("c_custkey").cast("string")
    return t.customer.select("c_custkey", text.slug(F.concat(F.lit(" a  b-"), k, F.lit("?!x "))).alias("slug"), text.redact_query(F.concat(F.lit("https://h.org/p/"), k, F.lit("?token=1#top"))).alias("redacted"))


# ---- curation ----------------------------------------------------------------------------------------------------

@query("j20_row_mapping", "SELECT source AS source_sheet, doc_id % 100 AS source_row, doc_id % 100 AS export_row, max(doc_id) AS policy_id FROM documents WHERE source IS NOT NULL AND doc_id % 100 BETWEEN 2 AND 60 GROUP BY 1, 2")
def _(t):
    records = t.documents.select(F.col("doc_id").alias("record_id"), F.col("source").alias("source_sheet"), (F.col("doc_id") % 100).alias("source_row"))
    cells = t.documents.select(F.col("source").alias("source_sheet"), F.explode(F.sequence(F.lit(2).cast("bigint"), F.lit(60).cast("bigint"))).alias("source_row")).distinct()
    return curation.row_mapping(cells, records)


@query("d11_coverage_report", """SELECT (SELECT count(DISTINCT substr(p_brand, 7, 1)) FROM part) AS collection_count, (SELECT count(DISTINCT p_brand) FROM part) AS subcollection_count, (SELECT count(DISTINCT c_mktsegment) FROM customer) AS staging_sheet_count, (SELECT count(DISTINCT c_mktsegment) FROM customer WHERE c_mktsegment <> 'BUILDING') + 1 AS mapped_sheet_count,
  (SELECT count(*) FROM customer) AS staging_cell_count, (SELECT count(*) FROM customer) AS catalog_cell_count, (SELECT count(DISTINCT c_mktsegment) FROM customer WHERE c_mktsegment = 'BUILDING') AS unmapped_sheet_count, 1::BIGINT AS unknown_sheet_count,
  (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') AS unmapped_cell_count, (SELECT count(*) FROM supplier) AS record_count, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 > 0) AS classified_record_count, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 > 1) AS subclassified_record_count,
  (SELECT count(*) FROM supplier WHERE s_suppkey % 4 > 0) + (SELECT count(*) FROM supplier WHERE s_suppkey % 4 > 1) AS record_collection_relation_count, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 0) AS unclassified_record_count, false AS passed""")
def _(t):
    taxonomy = t.part.select(F.concat(F.lit("c"), F.substring("p_brand", 7, 1)).alias("collection"), F.col("p_brand").alias("subcollection"))
    cells = t.customer.select(F.col("c_mktsegment").alias("source_sheet"))
    mappings = cells.where("source_sheet <> 'BUILDING'").unionByName(t.spark.createDataFrame([("nowhere",)], "source_sheet string"))
    catalog = cells.select(F.when(F.col("source_sheet") != "BUILDING", F.col("source_sheet")).alias("collection"))
    k = F.col("s_suppkey")
    assigned = t.supplier.where(k % 4 > 0).select(k.alias("record_id"), F.lit("a").alias("collection"), F.lit(None).cast("string").alias("subcollection")).unionByName(t.supplier.where(k % 4 > 1).select(k.alias("record_id"), F.lit("b").alias("collection"), F.lit("x").alias("subcollection")))
    return curation.collection_report(taxonomy, mappings, cells, catalog, t.supplier.select(k.alias("record_id")), assigned)


@query("d11_collection_counts", "SELECT source AS collection, count(DISTINCT doc_id) AS record_count FROM documents GROUP BY source")
def _(t):
    return curation.collection_counts(t.documents.select(F.col("source").alias("collection"), F.col("doc_id").alias("record_id")))


def _repair_tasks(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    kinds = F.element_at(F.array(F.lit("missing_title"), F.lit("low_confidence"), F.lit("unmatched_t4")), (k % 3 + 1).cast("int"))
    return t.documents.select(
        F.concat(F.lit("T"), F.lpad(k.cast("string"), 9, "0")).alias("task_id"), kinds.alias("review_type"), (k - k % 2).cast("string").alias("record_id"), F.when(k % 4 < 3, "auto_reparsed").otherwise("pending_diagnosis").alias("automation_status"),
        F.when(k % 3 == 2, "policy_features.record_id").otherwise("records.title").alias("field_name"), F.concat(F.lit("B"), (k % 50).cast("string")).alias("source_cell"), F.when(k % 5 > 0, F.concat(F.lit("S "), k.cast("string"))).alias("suggested_value"))


_REPAIRS = """WITH k AS (SELECT doc_id, 'T' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS task_id, doc_id % 3 AS kind, CAST(doc_id - doc_id % 2 AS VARCHAR) AS record_id, doc_id % 50 AS row, CASE WHEN doc_id % 5 > 0 THEN 'S ' || doc_id END AS s FROM documents WHERE doc_id % 4 < 3)"""


@query("d19_repaired_titles", f"""{_REPAIRS}, f AS (SELECT record_id, max_by(s, task_id) AS s FROM k WHERE kind = 0 AND s IS NOT NULL GROUP BY 1)
  SELECT d.doc_id AS record_id, coalesce(s, 'old ' || d.doc_id) AS title, coalesce(lower(replace(s, ' ', '')), 'old') AS title_normalized FROM documents d LEFT JOIN f ON CAST(d.doc_id AS VARCHAR) = f.record_id""")
def _(t):
    records = t.documents.select(F.col("doc_id").alias("record_id"), F.concat(F.lit("old "), F.col("doc_id").cast("string")).alias("title"), F.lit("old").alias("title_normalized"))
    return curation.repaired_titles(records, _repair_tasks(t))


@query("d19_repaired_links", f"""{_REPAIRS}, f AS (SELECT row, max_by(s, task_id) AS s FROM k WHERE kind = 2 AND s IS NOT NULL AND row <> 0 GROUP BY 1), l AS (SELECT 'C' || p_partkey AS source_cell, CAST(p_partkey AS BIGINT) AS source_row, s AS record_id FROM part JOIN f ON p_partkey = row WHERE p_partkey % 3 > 0),
  o AS (SELECT 'C' || p_partkey AS source_cell, CAST(p_partkey AS BIGINT) AS source_row, 'before' AS record_id FROM part WHERE p_partkey < 20)
  SELECT *, 'deterministic_auto_match' AS classification_source, 0.9::DOUBLE AS confidence FROM l UNION ALL SELECT *, 'earlier', 0.5 FROM o WHERE source_cell NOT IN (SELECT source_cell FROM l)""")
def _(t):
    k = F.col("p_partkey")
    cell = F.concat(F.lit("C"), k.cast("string")).alias("source_cell")
    features = t.part.select(cell, F.lit("sheet 4").alias("source_sheet"), F.when(k % 3 == 0, "linked").alias("record_id"))
    overlay = t.part.where(k < 20).select(cell, k.cast("bigint").alias("source_row"), F.lit("before").alias("record_id"), F.lit("earlier").alias("classification_source"), F.lit(0.5).alias("confidence"))
    return curation.repaired_links(features, _repair_tasks(t), overlay, "sheet 4")


@query("d19_repaired_topics", f"""{_REPAIRS}, asked AS (SELECT DISTINCT record_id FROM k WHERE kind = 1), d AS (SELECT CAST(doc_id AS VARCHAR) AS record_id, text FROM documents),
  x AS (SELECT record_id, 'and' AS term_name FROM d WHERE contains(text, ' and ') AND record_id IN (SELECT record_id FROM asked) UNION ALL SELECT record_id, 'de' FROM d WHERE contains(text, ' de ') AND record_id IN (SELECT record_id FROM asked))
  SELECT record_id, term_name, 'rule' AS classification_source, 0.9::DOUBLE AS confidence, 'auto_verified' AS review_status FROM x
  UNION ALL SELECT record_id, '其他', 'rule', 0.5, CASE WHEN record_id IN (SELECT record_id FROM asked) THEN 'superseded_auto' ELSE 'unreviewed' END FROM d""")
def _(t):
    records = t.documents.select(F.col("doc_id").cast("string").alias("record_id"), F.col("text").alias("full_text"))
    terms = records.select("record_id", F.lit("TERM_OTHER").alias("term_id"), F.lit("topic").alias("taxonomy_name"), F.lit("其他").alias("term_name"), F.lit("rule").alias("classification_source"), F.lit(0.5).alias("confidence"), F.lit("").alias("evidence_excerpt"), F.lit("unreviewed").alias("review_status"))
    found = curation.repaired_topics(terms, records, _repair_tasks(t), {"and": [" and "], "de": [" de "]}, ["full_text"])
    return found.select("record_id", "term_name", "classification_source", "confidence", "review_status")


# ---- review ------------------------------------------------------------------------------------------------------

def _every_task(t: Tables) -> DataFrame:
    """Tasks of all producers."""
    key = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    terms = t.labels.where("quality IS NOT NULL").select(F.col("doc_id").alias("record_id"), key("T", "quality").alias("term_id"), key("q", "quality").alias("term_name"), ((F.col("doc_id") % 10) / F.lit(10.0)).alias("confidence"))
    features = t.events.select(F.when(F.col("user_id") % 7 > 0, F.col("user_id")).alias("record_id"), F.lit("sheet 4").alias("source_sheet"), key("A", "event_id").alias("source_cell"), F.col("event_type").alias("feature_value"))
    candidates = t.part.select(F.col("p_partkey").alias("row_number"), F.col("p_size").alias("candidate_record_id"), F.when(F.col("p_partkey") % 3 == 0, "pending").otherwise("approved").alias("review_status"), (F.col("p_size") * 2).alias("match_score"))
    cells = t.supplier.select(F.lit("sheet 2").alias("source_sheet_name"), key("B", "s_suppkey").alias("source_cell"), F.col("s_name").alias("cell_value"), F.lit("rule text").alias("original_field_name"), "s_suppkey")
    places = t.customer.select(F.col("c_custkey").alias("record_id"), key("C", "c_custkey").alias("cell"), F.col("c_name").alias("old"), F.lit(0.5).alias("confidence"), (F.col("c_custkey") % 11 == 0).alias("needs_review"))
    sources = t.nation.select(key("N", "n_nationkey").alias("cell"), F.col("n_name").alias("old"), (F.col("n_nationkey") % 5 == 0).alias("needs_review"))
    answers = t.pages.select(F.col("page_id").alias("record_id"), key("P", "page_id").alias("cell"), F.col("url").alias("old"), (F.col("page_id") % 9 == 0).alias("needs_review"))
    return review.generate([
        _all_tasks(t), review.low_confidence_tasks(terms), review.unmatched_tasks(features), review.candidate_tasks(candidates, "sheet 4"), review.unexplained_tasks(cells, cells.where("s_suppkey % 2 = 0")),
        review.flagged_tasks(places, "policy_applicable_cities.city_id", "cities", "cell", "old"), review.flagged_tasks(sources, "canonical_source.url", "sources", "cell", "old"), review.flagged_tasks(answers, "llm.answer", "answers", "cell", "old")])


_EVERY = """WITH r AS (SELECT CAST(doc_id AS VARCHAR) AS record_id, CASE WHEN doc_id % 6 > 0 THEN 't' || doc_id END AS title, CASE WHEN doc_id % 4 > 0 THEN text END AS full_text, CASE doc_id % 5 WHEN 0 THEN 'ftp://x' WHEN 1 THEN NULL ELSE 'https://x.org/1' END AS url, source, 'ROW:' || (doc_id % 100) AS cell, md5(text) AS h FROM documents),
  k AS (SELECT 'missing_title' AS review_type, record_id, 'records.title' AS field_name, source, cell, title AS old_value, NULL AS suggested_value, NULL::DOUBLE AS confidence FROM r WHERE title IS NULL
    UNION ALL SELECT 'missing_source', record_id, 'records.full_text', source, cell, full_text, NULL, NULL FROM r WHERE full_text IS NULL OR trim(full_text) = ''
    UNION ALL SELECT 'invalid_url', record_id, 'records.primary_source_url', source, cell, url, NULL, NULL FROM r WHERE url IS NULL OR url NOT LIKE 'http%'
    UNION ALL SELECT 'duplicate_record', record_id, 'records.content_hash', source, cell, h, NULL, NULL FROM r WHERE h IN (SELECT h FROM r GROUP BY h HAVING count(*) > 1)
    UNION ALL SELECT 'low_confidence', CAST(doc_id AS VARCHAR), 'record_terms.term_name:T' || quality, NULL, 'T' || quality, 'q' || quality, 'q' || quality, (doc_id % 10) / 10.0::DOUBLE FROM labels WHERE quality IS NOT NULL AND doc_id % 10 <= 6
    UNION ALL SELECT 'unmatched_t4', NULL, 'policy_features.record_id', 'sheet 4', 'A' || event_id, event_type, NULL, NULL FROM events WHERE user_id % 7 = 0
    UNION ALL SELECT 'unmatched_t4', NULL, 't4_match_candidates.candidate_record_id', 'sheet 4', 'ROW:' || p_partkey || ':' || p_size, CAST(p_size AS VARCHAR), CAST(p_size AS VARCHAR), p_size * 2 / 100.0::DOUBLE FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT 'unexplained_t2', NULL, 'city_policy_rules.rule_text', 'sheet 2', 'B' || s_suppkey, s_name, 'rule text', NULL FROM supplier WHERE s_suppkey % 2 = 1
    UNION ALL SELECT 'other', CAST(c_custkey AS VARCHAR), 'policy_applicable_cities.city_id', 'cities', 'C' || c_custkey, c_name, NULL, 0.5 FROM customer WHERE c_custkey % 11 = 0
    UNION ALL SELECT 'other', NULL, 'canonical_source.url', 'sources', 'N' || n_nationkey, n_name, NULL, NULL FROM nation WHERE n_nationkey % 5 = 0
    UNION ALL SELECT 'other', CAST(page_id AS VARCHAR), 'llm.answer', 'answers', 'P' || page_id, url, NULL, NULL FROM pages WHERE page_id % 9 = 0),
  tasks AS (SELECT DISTINCT ON (task_id) * FROM (SELECT 'REV_' || upper(substr(sha256(review_type || '|' || coalesce(record_id, '') || '|' || field_name || '|' || coalesce(source, '') || '|' || coalesce(cell, '')), 1, 24)) AS task_id, record_id, review_type, field_name, source AS source_sheet, cell AS source_cell, old_value, suggested_value, confidence FROM k))"""


@query("d12_all_producers", f"{_EVERY} SELECT task_id, record_id, review_type, field_name, source_sheet, source_cell, suggested_value, round(confidence, 4) AS confidence FROM tasks")
def _(t):
    return _every_task(t).select("task_id", "record_id", "review_type", "field_name", "source_sheet", "source_cell", "suggested_value", F.round("confidence", 4).alias("confidence"))


@query("d12_histograms", f"{_EVERY} SELECT 'review_type' AS field, review_type AS value, count(*) AS n FROM tasks GROUP BY 2 UNION ALL SELECT 'field_name', field_name, count(*) FROM tasks GROUP BY 2")
def _(t):
    return review.histogram(_every_task(t), ["review_type", "field_name"]).drop("share")


@query("d18_triage_all_signals", f"""{_EVERY}, x AS (SELECT *, CAST('0x' || substr(task_id, 5, 6) AS BIGINT) AS k FROM tasks), y AS (SELECT *, k % 100 AS best, k % 6 AS margin, k % 100 >= 90 AND k % 6 >= 3 AS high, (k % 100) / 100.0::DOUBLE AS share, (k % 10) / 10.0::DOUBLE AS dc FROM x),
  z AS (SELECT *, CASE
    WHEN review_type = 'unexplained_t2' THEN CASE WHEN k % 2 = 0 AND (k % 5 < 2 OR k % 7 = 0) THEN 'rejected:0.98' ELSE 'auto_repaired_segmentation:0.9' END
    WHEN review_type = 'missing_source' THEN CASE WHEN k % 2 = 1 THEN 'pending_diagnosis:' ELSE 'manual_review_required:' END || dc
    WHEN review_type = 'missing_title' THEN CASE WHEN k % 3 = 0 THEN 'auto_reparsed:0.93' ELSE 'manual_review_required:0.6' END
    WHEN review_type = 'invalid_url' THEN CASE WHEN old_value IS NULL THEN 'pending_diagnosis:0.92' ELSE 'pending_diagnosis:0.75' END
    WHEN review_type = 'low_confidence' THEN CASE WHEN k % 3 = 1 THEN 'auto_reparsed:0.91' ELSE 'manual_review_required:0.65' END
    WHEN review_type = 'unmatched_t4' THEN CASE WHEN k % 13 = 0 THEN 'auto_verified:0.99' WHEN field_name LIKE 'policy_features%' AND k % 4 = 0 AND NOT high THEN 'rejected:0.99' WHEN field_name LIKE 'policy_features%' AND high THEN 'auto_reparsed:' || share
      WHEN field_name LIKE 't4_match%' AND high THEN 'auto_verified:' || share WHEN best < 70 THEN 'manual_review_required:' || share ELSE 'pending_diagnosis:' || share END
    WHEN field_name LIKE 'policy_applicable_cities%' THEN 'rejected:0.99' WHEN field_name LIKE '%canonical_source%' THEN 'auto_recovered_secondary:0.9' ELSE 'manual_review_required:' || coalesce(confidence, 0.5) END AS v FROM y)
  SELECT task_id, split_part(v, ':', 1) AS automation_status, round(CAST(split_part(v, ':', 2) AS DOUBLE), 4) AS diagnostic_confidence, CASE WHEN review_type = 'missing_title' AND k % 3 = 0 THEN 'A first line of a text' ELSE suggested_value END AS suggested_value FROM z""")
def _(t):
    """The whole ladder: every signal takes its values, drawn from digits of the task's id."""
    k = F.conv(F.substring("task_id", 5, 6), 16, 10).cast("bigint")
    signals = {
        "text": F.when(k % 3 == 0, "A first line of a text"), "is_merged": k % 2 == 0, "cell_value": F.when(k % 5 == 0, "").when(k % 5 == 1, "head").otherwise("value"), "header": F.lit("head"), "is_heading": k % 7 == 0, "repairable": k % 2 == 1,
        "diagnosis_confidence": (k % 10) / F.lit(10.0), "topics_found": k % 3 == 1, "already_linked": k % 13 == 0, "best": (k % 100).cast("double"), "margin": (k % 6).cast("double"), "first_in_row": k % 4 > 0}
    return review.triage(_every_task(t).withColumns(signals)).select("task_id", "automation_status", "diagnostic_confidence", "suggested_value")


# ---- places: what the rules say of each of the eight texts, worked out by hand ----------------------------------------

_PLACE_ROWS = [
    (0, 1, "广州", "广东省广州市", "广东省", "44", "广州市", "440100", "CITY_440100", None, None, "city", "city_alias", 1.0, False),
    (1, 1, "江苏省昆山市", "江苏省昆山市", "江苏省", "32", "昆山市", "320500", None, "昆山市", "苏州市", "county_level_city", "province_city_parse", 0.9, False),
    (2, 1, "全国", "全国", None, None, None, None, None, None, None, "national", "national_rule", 1.0, False),
    (3, 1, "河南省郑州市航空港区", "河南省郑州市航空港区", "河南省", "41", "郑州市", "410100", "CITY_410100", "航空港区", None, "county", "city_alias", 1.0, False),
    (4, 1, "上海", "上海市", "上海市", "31", "上海市", "310000", "CITY_310000", None, None, "city", "city_alias", 1.0, False),
    (5, 1, "河南省", "河南省", "河南省", "41", None, None, None, None, None, "province", "province_rule", 0.8, False),
    (6, 1, "某地", "某地", None, None, None, None, None, None, None, "unknown", "unmatched", 0.65, True),
    (7, 1, "广东省深圳市", "广东省深圳市", "广东省", "44", "深圳市", None, None, None, None, "city", "province_city_parse", 0.9, False),
    (7, 2, "苏州", "江苏省苏州市", "江苏省", "32", "苏州市", "320500", "CITY_320500", None, None, "city", "city_alias", 1.0, False),
]
_SCOPE_ROWS = [
    (0, "CITY_440100", "alias", 1.0, "city", None, False),
    (3, "CITY_410100", "alias", 0.9, "district", "航空港区", False),
    (4, "CITY_310000", "alias", 1.0, "city", None, False),
    (5, "CITY_410100", "province_scope", 0.75, "province", None, True),
    (7, "CITY_320500", "alias", 0.9, "city", None, False),
]
_PLACE_COLUMNS = "place, part_number, geography_original, name_normalized, province_name, province_code, city_name, city_code, city_id, county_name, parent_city_name, jurisdiction_level, match_method, match_confidence, needs_review"
_PLACED = f"(SELECT c_custkey AS record_id, c_custkey % {len(_PLACES)} AS place FROM customer)"


@query("d06_normalize_geography", f"SELECT record_id, t.* EXCLUDE (place) FROM {_PLACED} AS c JOIN {_values(_PLACE_ROWS, _PLACE_COLUMNS)} ON c.place = t.place")
def _(t):
    return geography.normalize_geography(_placed(t), "place", t.spark.createDataFrame(_CITIES, _CITY_SCHEMA))


@query("d08_match_scope_cities", f"SELECT record_id, t.* EXCLUDE (place) FROM {_PLACED} AS c JOIN {_values(_SCOPE_ROWS, 'place, city_id, match_method, confidence, jurisdiction_level, district_name, needs_review')} ON c.place = t.place")
def _(t):
    return geography.match_scope_cities(_placed(t), "place", t.spark.createDataFrame(_CITIES, _CITY_SCHEMA))
