"""From staged rows and cells to records: the directory sheet, topic sheets, city matrices. Projections of one frame each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.numbers import parse_date
from gridloom.functions.text import clean_text, content_hash, normalize_title, stable_id
from gridloom.functions.urls import normalize_url, source_status
from gridloom.operators.keyed import replace_with_default
from gridloom.operators.rules import classify, infer_direction

#: The words that mark a draft for consultation, and the whole country.
CONSULTATION_WORD, NATION_WORD = "征求意见", "全国"
#: Words in a sheet's name that make its records central.
CENTRAL_SHEET_WORDS = ["中央", "全国", "央行"]
#: What the topic sheets hold.
SHEET_KINDS: list[tuple[str, str]] = [
    ("T5 供给侧措施", "policy_document"),
    ("T7 中央经济工作会议", "meeting_statement"),
    ("T8 中央政治局会议", "meeting_statement"),
    ("T9 全国住建工作会议", "meeting_statement"),
    ("T10 政府工作报告", "government_report"),
    ("T11 2007年以来历届全国党代会", "meeting_statement"),
    ("T12 央行、银保监会、证监会、住建部2014年至今政策梳理", "policy_document"),
    ("房地产项目白名单（城市情况）", "programme_event"),
    ("房地产项目白名单（企业情况）", "enterprise_event"),
    ("PSL专项贷款", "financing_event"),
    ("附录1 疫情期间政策跟踪", "policy_document"),
]


@dataclass(frozen=True)
class Ingested:
    records: DataFrame
    jurisdictions: DataFrame
    terms: DataFrame
    legacy: DataFrame


def directory_records(rows: DataFrame, aliases: DataFrame, sheet: str) -> Ingested:
    """Records of a directory sheet with their places, topics and old categories.

    ``rows``: source_row, raw_date, geography, title, category, summary, full_text, url, notes. ``aliases``: name,
    standard name. Rows without any value are left out. Cleaning is done once; all four tables are read from it.
    """
    values = ("raw_date", "geography", "title", "category", "summary", "full_text", "notes")
    used = rows.where(F.coalesce(*[F.col(c) for c in (*values, "url")]).isNotNull())
    cleaned = used.select("source_row", *[clean_text(F.col(c)).alias(c) for c in values], normalize_url(F.col("url")).alias("url"))
    text = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "category", "summary", "full_text")])
    base = cleaned.withColumns({"record_date": parse_date(F.col("raw_date")), "text": text})
    base = base.withColumn("record_id", stable_id(F.col("record_date"), F.col("geography"), F.col("title"), F.col("url"), prefix="POL", clean=False))
    status = source_status(F.col("url"), F.col("text"))
    draft = F.contains("text", F.lit(CONSULTATION_WORD))
    records = base.select(
        "record_id", F.lit("policy_document").alias("record_type"), "title", normalize_title(F.col("title"), cleaned=True).alias("title_normalized"), "record_date", F.col("record_date").alias("issuance_date"), F.col("raw_date").alias("record_date_original"),
        F.when(draft, "consultation").otherwise("issued").alias("status"), infer_direction(F.col("text")).alias("direction"), "summary", "full_text", F.when(F.col("geography").isNotNull() & (F.col("geography") != NATION_WORD), "local").otherwise("central").alias("official_level"),
        F.when(draft, "consultation_draft").otherwise(status["status"]).alias("official_status"), status["quality"].alias("source_quality"), F.col("url").alias("primary_source_url"), content_hash(F.col("title"), F.col("summary"), F.col("full_text"), clean=False).alias("content_hash"),
        F.lit(sheet).alias("source_sheet"), "source_row", F.when(F.col("title").isNull() | F.col("url").isNull(), "pending").otherwise("unreviewed").alias("manual_review_status"), "notes", F.col("geography").alias("geography_original"), F.col("category").alias("legacy_category"),
    )
    places = replace_with_default(base.select("record_id", F.col("geography").alias("name"), F.col("geography").alias("standard"), "geography"), aliases, "name", "standard")
    jurisdictions = places.select(
        "record_id", stable_id(F.col("standard"), prefix="JUR", clean=False).alias("jurisdiction_id"), F.col("geography").alias("geography_original"), F.col("standard").alias("jurisdiction_name"), F.lit("issuing_jurisdiction").alias("relation_type"),
        F.when(F.col("standard") != F.col("geography"), "alias").otherwise("exact").alias("match_method"), F.when(F.col("standard").isNotNull(), 1.0).otherwise(0.0).alias("match_confidence"),
    )
    topics = base.select("record_id", F.explode(classify(F.col("text"))).alias("t"))
    terms = topics.select("record_id", stable_id(F.lit("topic"), F.col("t.topic"), prefix="TERM", clean=False).alias("term_id"), F.lit("topic").alias("taxonomy_name"), F.col("t.topic").alias("term_name"), F.lit("rule").alias("classification_source"), F.col("t.confidence").alias("confidence"), F.col("t.evidence_excerpt").alias("evidence_excerpt"), F.lit("unreviewed").alias("review_status"))
    legacy = base.where("category IS NOT NULL").select("record_id", F.lit("legacy_category").alias("annotation_type"), F.col("category").alias("annotation_value"), F.lit(sheet).alias("source_sheet"), "source_row")
    return Ingested(records, jurisdictions, terms, legacy)


def _first(values: Column, test) -> Column:
    return F.get(F.filter(values, test), F.lit(0))


def sheet_records(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """Records of topic sheets whose columns differ: the first cell that has a date, the first that is a URL, the first
    other text of more than 5 characters as title.

    ``rows``: sheet, row, cells array<string>; ``kinds``: sheet, record_type. Cells are cleaned by position before.
    """
    cleaned = rows.select("sheet", "row", F.posexplode("cells").alias("pos", "cell")).select("sheet", "row", "pos", clean_text(F.col("cell")).alias("cell")).where("cell IS NOT NULL")
    back = cleaned.groupBy("sheet", "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "cell"))), lambda x: x["cell"]).alias("cells"))
    raw_date = _first(F.col("cells"), lambda v: parse_date(v).isNotNull())
    url = _first(F.col("cells"), lambda v: v.startswith("http://") | v.startswith("https://"))
    title = F.coalesce(_first(F.col("cells"), lambda v: ~v.startswith("http") & (F.char_length(v) > 5)), F.format_string("%s第%s行", F.col("sheet"), F.col("row")))
    picked = back.join(kinds, "sheet").select("sheet", "row", "record_type", raw_date.alias("raw_date"), url.alias("raw_url"), F.substring(title, 1, 500).alias("title"), F.array_join("cells", " | ").alias("full_text"))
    day, link = parse_date(F.col("raw_date")), normalize_url(F.col("raw_url"))
    central = F.lit(False)
    for w in CENTRAL_SHEET_WORDS:
        central = central | F.contains("sheet", F.lit(w))
    base = picked.withColumns({"record_date": day, "url": link})
    status = source_status(F.col("url"), F.col("full_text"))
    return base.select(
        stable_id(F.col("sheet"), F.col("row"), F.col("record_date"), F.col("title"), clean=False).alias("record_id"), "record_type", "title", normalize_title(F.col("title"), cleaned=True).alias("title_normalized"), "record_date", F.col("raw_date").alias("record_date_original"),
        F.when(F.year("record_date") < 2020, "historical").otherwise("issued").alias("status"), infer_direction(F.col("full_text")).alias("direction"), F.substring("full_text", 1, 2000).alias("summary"), "full_text", F.when(central, "central").otherwise("local").alias("official_level"),
        status["status"].alias("official_status"), status["quality"].alias("source_quality"), F.col("url").alias("primary_source_url"), content_hash(F.col("full_text"), clean=False).alias("content_hash"), F.col("sheet").alias("source_sheet"), F.col("row").alias("source_row"),
    )


def matrix_rules(cells: DataFrame, mark: str = "政策现状", first_row: int = 3, first_column: int = 3) -> DataFrame:
    """Rules of city matrices, wide to long: a heading in row 1 holds for the columns up to the next one, row 2 (or 3)
    names the dimension. ``cells``: row, col, value, source_cell, and sheet where there are several."""
    sheet = F.col("sheet") if "sheet" in cells.columns else F.lit("")
    place = ["_sheet", "col"]
    clean = cells.select(sheet.alias("_sheet"), "row", "col", clean_text(F.col("value")).alias("value"), "source_cell")
    heading = F.when(F.contains("value", F.lit(mark)), F.btrim(F.substring_index("value", mark, 1)))
    heads = clean.where("row = 1").select(*place, heading.alias("city"))
    across = Window.partitionBy("_sheet").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    columns = clean.select(*place).distinct().join(heads, place, "left").withColumn("city", F.last("city", ignorenulls=True).over(across))
    named = lambda row: F.max(F.when(F.col("row") == row, F.col("value")))
    dimensions = clean.where("row IN (2, 3)").groupBy(*place).agg(F.coalesce(named(2), named(3)).alias("policy_dimension"))
    body = clean.where((F.col("row") >= first_row) & (F.col("col") >= first_column) & F.col("value").isNotNull())
    return body.join(columns, place).where("city IS NOT NULL").join(dimensions, place, "left").select(*([F.col("_sheet").alias("sheet")] if "sheet" in cells.columns else []), stable_id(F.col("city"), prefix="JUR", clean=False).alias("jurisdiction_id"), F.col("city").alias("city_name"), "policy_dimension", F.col("value").alias("rule_text"), "source_cell")
