"""Queries over the research views on the star schema, each beside its SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.plans import search, views
from gridloom.plans.library import Library, star_sql

LAST_MONTH = dt.date(2001, 8, 1)
FIRST_MONTH = dt.date(1998, 1, 1)

#: Means of cents, which often lie half-way between two rounded values: they are nudged up before rounding, in SQL too.
NUDGED = ("policy_strength_mean", "data_completeness_score", "confidence_mean")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded, as sums of them depend on the order of rows."""
    digits = {"policy_strength_sum": 2, "policy_strength_max": 2, **dict.fromkeys(NUDGED, 4)}
    return df.select(*[F.round(F.col(c) + (1e-7 if c in NUDGED else 0.0), digits.get(c, 5)).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def add(name: str, sql: str, fn: Callable[[Library], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(fn(Library.from_star(spark, sf_dir)))
    SQL[name] = star_sql(sql)


_MONTH = "CAST(year(record_date) AS INTEGER) AS year, CAST(month(record_date) AS INTEGER) AS month"
_OFFICIAL = "official_status IN ('official', 'official_reprint')"


def _distinct_if(condition: str, name: str) -> str:
    return f"count(DISTINCT CASE WHEN {condition} THEN record_id END) AS {name}"


def _has(*terms: str) -> str:
    names = ", ".join(f"'{t}'" for t in terms)
    return f"EXISTS (SELECT 1 FROM terms t WHERE t.record_id = base.record_id AND t.term_name IN ({names}))"


_DIRECTIONS = ", ".join(_distinct_if(f"direction = '{d}'", f"{d}_count") for d in ("tightening", "loosening", "supportive"))
_STRENGTH = "round(sum(policy_strength), 2) AS policy_strength_sum, round(max(policy_strength), 2) AS policy_strength_max"
_CITY_MONTH = f""", panel AS (SELECT min(city_code) AS city_code, city_name, province, {_MONTH}, count(DISTINCT record_id) AS policy_count,
  {_distinct_if(_OFFICIAL, "official_policy_count")}, {_DIRECTIONS},
  {_distinct_if(_has("ECONOMY"), "purchase_restriction_count")}, {_distinct_if(_has("STANDARD"), "sale_restriction_count")},
  {_distinct_if(_has("SMALL", "MEDIUM"), "mortgage_count")}, {_distinct_if(_has("LARGE"), "provident_fund_count")},
  {_distinct_if(_has("PROMO"), "subsidy_count")}, {_distinct_if(_has("Brand#1"), "talent_policy_count")},
  {_distinct_if("legacy_category LIKE '%BUILD%'", "supply_side_count")}, {_distinct_if(_has("Brand#2", "Brand#3"), "urban_renewal_count")},
  sum(policy_strength) AS policy_strength_sum, max(policy_strength) AS policy_strength_max, avg(CAST(source_quality AS DOUBLE)) AS source_quality_mean
  FROM (SELECT DISTINCT record_id, record_date, province, city_name, city_code, direction, official_status, source_quality, legacy_category, policy_strength FROM geography_base
        WHERE record_date IS NOT NULL AND city_name IS NOT NULL AND jurisdiction_level IN ('city', 'county', 'county_level_city')) base
  GROUP BY city_name, province, year(record_date), month(record_date))"""
_PANEL_SUMS = ("policy_count", "official_policy_count", "tightening_count", "loosening_count", "supportive_count", "purchase_restriction_count", "sale_restriction_count", "mortgage_count", "provident_fund_count", "subsidy_count", "talent_policy_count", "supply_side_count", "urban_renewal_count")
_PANEL_COUNTS = ", ".join(_PANEL_SUMS)
_PANEL_ROUNDED = f"city_code, city_name, province, year, month, {_PANEL_COUNTS}, round(policy_strength_sum, 2) AS policy_strength_sum, round(policy_strength_max, 2) AS policy_strength_max, round(source_quality_mean, 5) AS source_quality_mean"

add("view_city_month_panel", f"{_CITY_MONTH} SELECT {_PANEL_ROUNDED} FROM panel", views.city_month_panel)
add("view_city_year_panel", f"""{_CITY_MONTH} SELECT city_code, city_name, province, year, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _PANEL_SUMS)},
  round(sum(policy_strength_sum), 2) AS policy_strength_sum, round(max(policy_strength_max), 2) AS policy_strength_max, round(avg(source_quality_mean), 5) AS source_quality_mean
  FROM panel GROUP BY city_code, city_name, province, year""", views.city_year_panel)
add("view_province_month_panel", f""" SELECT province, {_MONTH}, count(DISTINCT record_id) AS policy_count, {_distinct_if(_OFFICIAL, "official_policy_count")}, {_DIRECTIONS}, {_STRENGTH},
  round(avg(CAST(source_quality AS DOUBLE)), 5) AS source_quality_mean FROM geography_base WHERE record_date IS NOT NULL AND province IS NOT NULL GROUP BY province, year(record_date), month(record_date)""", views.province_month_panel)
add("view_national_month_panel", f""" SELECT {_MONTH}, count(DISTINCT record_id) AS policy_count, {_distinct_if(_OFFICIAL, "official_policy_count")}, {_DIRECTIONS},
  round(avg(CAST(source_quality AS DOUBLE)), 5) AS source_quality_mean FROM records WHERE record_date IS NOT NULL GROUP BY year(record_date), month(record_date)""", views.national_month_panel)
add("view_event_study", f"{_CITY_MONTH} SELECT {_PANEL_ROUNDED}, 0 AS event_time FROM panel", views.event_study)
add("view_intensity_index", f"{_CITY_MONTH} SELECT {_PANEL_ROUNDED}, round(policy_strength_sum * coalesce(source_quality_mean, 0) / 5, 5) AS standardized_intensity FROM panel", views.intensity_index)
add("view_policy_master", " SELECT * FROM policy_master", views.policy_master)
add("view_latest_version", " SELECT * FROM policy_master", views.policy_master)
add("view_topic_long", " SELECT record_id, record_date, title, taxonomy_name, term_name FROM records JOIN terms USING (record_id)", views.topic_long)
add("view_instrument_long", " SELECT record_id, record_date, title, taxonomy_name, term_name FROM records JOIN terms USING (record_id) WHERE taxonomy_name = 'instrument'", views.instrument_long)
add("view_geography_long", """ SELECT r.record_id, record_date, title, g.geography_original, province_name, city_name, CAST(NULL AS VARCHAR) AS parent_city_name, city_code, CAST(NULL AS VARCHAR) AS county_name, jurisdiction_level
  FROM records r JOIN geographies g ON r.record_id = g.record_id""", views.geography_long)
add("view_geography_base", """ SELECT record_id, record_date, title, record_type, direction, official_status, source_quality, legacy_category, source_sheet, geography_original,
  province, city_name, city_code, CAST(NULL AS VARCHAR) AS county_name, jurisdiction_level, round(policy_strength, 5) AS policy_strength FROM geography_base""", views.geography_base)
add("view_timeline", " SELECT g.city_name, g.record_date, g.record_id, g.title, g.direction, g.source_quality, t.term_name AS topic FROM geography_base g LEFT JOIN terms t ON g.record_id = t.record_id", views.city_timeline)
add("view_data_quality", """ SELECT count(*) AS record_count, count(*) FILTER (WHERE title IS NULL) AS missing_title_count, count(*) FILTER (WHERE full_text IS NULL) AS missing_full_text_count,
  count(*) FILTER (WHERE primary_source_url IS NULL) AS missing_url_count, count(*) FILTER (WHERE manual_review_status = 'pending') AS pending_review_count FROM records""", views.data_quality)
add("view_official_statements", " SELECT * FROM records WHERE record_type IN ('official_statement', 'meeting_statement', 'government_report')", views.official_statements)
add("view_supply_side", " SELECT * FROM policy_master WHERE legacy_category LIKE '%BUILD%'", views.supply_side)
add("view_demand_side", " SELECT * FROM policy_master WHERE legacy_category NOT LIKE '%BUILD%' OR legacy_category IS NULL", views.demand_side)
add("view_white_list_events", " SELECT * FROM records WHERE source_sheet LIKE 'sheet%'", lambda lib: views.sheet_events(lib, prefix="sheet"))
add("view_financing_events", " SELECT * FROM records WHERE source_sheet = 'sheet 2'", lambda lib: views.sheet_events(lib, sheet="sheet 2"))
add("view_urban_renewal", " SELECT DISTINCT r.* FROM records r JOIN terms t USING (record_id) WHERE t.term_name IN ('Brand#2', 'Brand#3')", views.urban_renewal)
add("view_source_quality", " SELECT record_id, title, official_status, source_quality, primary_source_url FROM records", views.source_quality)
add("view_collection_long", """ SELECT record_id, record_date, title, record_type, official_status, direction, source_quality, primary_source_url, source_sheet, collection_code, subcollection_code, confidence, review_status, is_primary
  FROM records JOIN collections USING (record_id)""", views.collection_long)
add("view_library_summary", """ SELECT collection_code, subcollection_code, count(DISTINCT record_id) AS record_count, round(avg(confidence) + 1e-7, 4) AS confidence_mean,
  count(DISTINCT CASE WHEN review_status = 'pending' THEN record_id END) AS pending_review_count FROM collections GROUP BY collection_code, subcollection_code""", views.library_summary)
_SHEETS = [(f"sheet {i}", f"kind {i % 2}") for i in range(1, 11)]
add("view_source_coverage", f""", sheets(source_sheet, source_kind) AS (VALUES {", ".join(map(str, _SHEETS))})
  SELECT s.source_sheet, s.source_kind, count(e.source_cell) AS staging_cell_count, count(e.source_cell) FILTER (WHERE e.is_formula) AS formula_count, count(e.source_cell) FILTER (WHERE e.is_merged) AS merged_cell_count
  FROM sheets s LEFT JOIN staging e ON s.source_sheet = e.source_sheet_name GROUP BY ALL""", lambda lib: views.source_coverage(lib, lib.records.sparkSession.createDataFrame(_SHEETS, "source_sheet string, source_kind string")))
add("view_information_completeness", """ SELECT (SELECT count(DISTINCT source_sheet_name) FROM staging) AS staging_sheet_count, (SELECT count(*) FROM staging) AS staging_cell_count, (SELECT count(*) FROM records) AS record_count,
  (SELECT count(DISTINCT record_id) FROM collections) AS classified_record_count, (SELECT count(*) FROM collections) AS record_collection_relation_count""", views.information_completeness)

_SCOPE = f""", base AS (SELECT r.record_id, r.record_date, r.title, r.full_text, r.direction, r.official_status, r.source_quality, r.primary_source_url, c.city_id, c.city_name, c.province_name AS province,
    c.city_tier_existing, c.city_scale_2020, a.needs_review, CAST(coalesce(p.mandatory_strength, 0) AS DOUBLE) AS policy_strength
  FROM records r JOIN applicable a USING (record_id) JOIN cities c USING (city_id) LEFT JOIN policies p USING (record_id) WHERE r.record_date >= DATE '{FIRST_MONTH}'),
scope AS (SELECT base.*, {_has("ECONOMY")} AS purchase_limit, {_has("STANDARD")} AS sale_limit, {_has("SMALL", "MEDIUM")} AS commercial_mortgage, {_has("LARGE")} AS hpf_policy, {_has("Brand#1")} AS talent_policy, {_has("PROMO")} AS subsidy,
  EXISTS (SELECT 1 FROM collections x WHERE x.record_id = base.record_id AND x.collection_code IN ('Brand#4', 'Brand#5')) AS supply_side,
  EXISTS (SELECT 1 FROM collections x WHERE x.record_id = base.record_id AND x.subcollection_code = 'PROMO') AS urban_renewal,
  EXISTS (SELECT 1 FROM collections x WHERE x.record_id = base.record_id AND x.collection_code = 'Brand#6') AS financing FROM base)"""
_FLAGS = ("purchase_limit", "sale_limit", "commercial_mortgage", "hpf_policy", "talent_policy", "subsidy", "supply_side", "urban_renewal", "financing")
_P = lambda condition: f"count(DISTINCT CASE WHEN {condition} THEN p.record_id END)"
_GRID = f"""{_SCOPE}, grid AS (SELECT c.*, CAST(m AS DATE) AS month_start FROM cities c CROSS JOIN generate_series(TIMESTAMP '{FIRST_MONTH}', TIMESTAMP '{LAST_MONTH}', INTERVAL 1 MONTH) t(m)),
month AS (SELECT g.city_id, g.city_name, g.province_name AS province, g.city_tier_existing, g.city_scale_2020, CAST(year(g.month_start) AS INTEGER) AS year, CAST(month(g.month_start) AS INTEGER) AS month,
  count(DISTINCT p.record_id) AS policy_count, {_P("p." + _OFFICIAL)} AS official_policy_count, {_P("p.record_id IS NOT NULL AND p.official_status NOT IN ('official', 'official_reprint')")} AS secondary_only_count,
  {_P("p.direction IN ('loosening', 'supportive')")} AS easing_count, {_P("p.direction = 'tightening'")} AS tightening_count, {_P("p.direction = 'neutral'")} AS neutral_count,
  {", ".join(f"{_P('p.' + f)} AS {f}_count" for f in _FLAGS)}, coalesce(sum(p.policy_strength), 0) AS policy_strength_sum, avg(p.policy_strength) AS policy_strength_mean, count(DISTINCT p.record_id) > 0 AS has_policy,
  CASE WHEN count(DISTINCT p.record_id) = 0 THEN 0.0::DOUBLE ELSE round(0.6::DOUBLE * {_P("p." + _OFFICIAL)} / count(DISTINCT p.record_id) + 0.2::DOUBLE * {_P("p.full_text IS NOT NULL")} / count(DISTINCT p.record_id)
    + 0.2::DOUBLE * {_P("p.primary_source_url IS NOT NULL")} / count(DISTINCT p.record_id), 4) END AS data_completeness_score
  FROM grid g LEFT JOIN scope p ON g.city_id = p.city_id AND date_trunc('month', p.record_date) = g.month_start AND NOT p.needs_review GROUP BY ALL)"""
_GRID_COUNTS = ("policy_count", "official_policy_count", "secondary_only_count", "easing_count", "tightening_count", "neutral_count", *(f"{f}_count" for f in _FLAGS))
add("view_scope_cities", f"{_SCOPE} SELECT * REPLACE (round(policy_strength, 5) AS policy_strength) FROM scope", lambda lib: views.scope_cities(lib, FIRST_MONTH))
add("view_city_month_grid", f"{_GRID} SELECT * REPLACE (round(policy_strength_sum, 2) AS policy_strength_sum, round(policy_strength_mean + 1e-7, 4) AS policy_strength_mean, round(data_completeness_score + 1e-7, 4) AS data_completeness_score) FROM month", lambda lib: views.grid_panel(lib, LAST_MONTH, FIRST_MONTH))
add("view_city_year_grid", f"""{_GRID} SELECT city_id, city_name, province, city_tier_existing, city_scale_2020, year, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _GRID_COUNTS)}, round(sum(policy_strength_sum), 2) AS policy_strength_sum,
  round(avg(policy_strength_mean) + 1e-7, 4) AS policy_strength_mean, bool_or(has_policy) AS has_policy, round(avg(data_completeness_score) + 1e-7, 4) AS data_completeness_score FROM month GROUP BY ALL""", lambda lib: views.grid_year_panel(lib, LAST_MONTH, FIRST_MONTH))

add("view_event_window", f"""{_CITY_MONTH}, t AS (SELECT city_name, min(year * 12 + month) AS t0 FROM panel WHERE talent_policy_count > 0 GROUP BY city_name)
  SELECT {_PANEL_ROUNDED}, CAST(year * 12 + month - t0 AS INTEGER) AS event_time FROM panel JOIN t USING (city_name) WHERE year * 12 + month - t0 BETWEEN -12 AND 24""",
    lambda lib: views.event_window(views.city_month_panel(lib), "city_name", F.col("talent_policy_count") > 0))

# Search and statistics.
_NARROW = ", ".join(search.NARROW)
add("api_search", """ SELECT * FROM policy_master WHERE (title ILIKE '%high%' OR summary ILIKE '%high%' OR full_text ILIKE '%high%') AND (city_name ILIKE '%nation_1%' OR geography_original ILIKE '%nation_1%')
  AND record_date >= DATE '1996-01-01' AND record_date <= DATE '1999-12-31' AND (topics ILIKE '%promo%' OR topics ILIKE '%small%') AND direction IN ('loosening', 'tightening') AND official_status IN ('official', 'official_reprint')
  ORDER BY record_date DESC NULLS LAST, record_id, city_name LIMIT 200""",
    lambda lib: search.search(lib, "high", "nation_1", dt.date(1996, 1, 1), dt.date(1999, 12, 31), ["promo", "small"], ["loosening", "tightening"], True, 200))
add("api_search_narrow", f" SELECT {_NARROW} FROM policy_master WHERE title ILIKE '%urgent%' OR summary ILIKE '%urgent%' OR full_text ILIKE '%urgent%' ORDER BY record_date DESC NULLS LAST, record_id, city_name LIMIT 1000", lambda lib: search.search(lib, "urgent", include_full_text=False))
add("api_get", " SELECT * FROM policy_master WHERE record_id = 77 ORDER BY city_name LIMIT 1", lambda lib: search.get(lib, 77))
add("api_timeline", " SELECT g.city_name, g.record_date, g.record_id, g.title, g.direction, g.source_quality, t.term_name AS topic FROM geography_base g LEFT JOIN terms t ON g.record_id = t.record_id WHERE g.city_name ILIKE '%nation_2%' AND t.term_name = 'PROMO'", lambda lib: search.timeline(lib, "nation_2", "PROMO"))
for _g, _e in (("year", "CAST(year(record_date) AS INTEGER)"), ("province", "city_name"), ("topic", "topics"), ("direction", "direction"), ("source_quality", "source_quality")):
    add(f"api_stats_{_g}", f" SELECT {_e} AS {_g}, count(*) AS policy_count FROM policy_master GROUP BY 1", lambda lib, g=_g: search.stats(lib, [g]))
add("api_stats_year_direction", " SELECT CAST(year(record_date) AS INTEGER) AS year, direction, count(*) AS policy_count FROM policy_master GROUP BY 1, 2", lambda lib: search.stats(lib, ["year", "direction"]))
add("api_dated_month", f"{_CITY_MONTH} SELECT {_PANEL_ROUNDED} FROM panel WHERE (year > 1997 OR (year = 1997 AND month >= 3)) AND (year < 1999 OR (year = 1999 AND month <= 6))", lambda lib: search.dated(views.city_month_panel(lib), "1997-03", "1999-06"))
add("api_dated_year", f""" SELECT province, year, CAST(sum(policy_count) AS BIGINT) AS policy_count FROM (SELECT province, CAST(year(record_date) AS INTEGER) AS year, count(DISTINCT record_id) AS policy_count FROM geography_base GROUP BY ALL)
  WHERE year >= 1996 AND year <= 1998 GROUP BY ALL""", lambda lib: search.dated(views.province_month_panel(lib).groupBy("province", "year").agg(F.sum("policy_count").alias("policy_count")), "1996-05", "1998-02"))
_SLICE = """, slice AS (SELECT r.*, c.city_id, c.city_name, c.province_name AS province FROM records r JOIN applicable a USING (record_id) JOIN cities c USING (city_id)
  WHERE NOT needs_review AND record_date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30' AND direction IN ('loosening', 'tightening') AND EXISTS (SELECT 1 FROM terms t WHERE t.record_id = r.record_id AND t.term_name = 'PROMO')
    AND EXISTS (SELECT 1 FROM collections x WHERE x.record_id = r.record_id AND x.subcollection_code = 'SMALL'))"""


def _slice(lib: Library) -> DataFrame:
    return search.sliced(lib, dt.date(1996, 1, 1), dt.date(2000, 6, 30), directions=["loosening", "tightening"], term="PROMO", subcollection="SMALL")


add("ui_slice_totals", f"{_SLICE} SELECT count(DISTINCT record_id) AS record_count, count(DISTINCT city_id) AS city_count, count(*) AS link_count FROM slice", lambda lib: search.slice_totals(_slice(lib)))
add("ui_slice_trend", f"{_SLICE} SELECT {_MONTH}, count(DISTINCT record_id) AS record_count FROM slice GROUP BY 1, 2", lambda lib: search.slice_by(_slice(lib), F.year("record_date").alias("year"), F.month("record_date").alias("month")))
add("ui_slice_ranking", f"{_SLICE} SELECT city_name, province, count(DISTINCT record_id) AS record_count FROM slice GROUP BY 1, 2", lambda lib: search.slice_by(_slice(lib), F.col("city_name"), F.col("province")))
add("ui_slice_details", f"{_SLICE} SELECT record_id, record_date, title, direction, official_status, source_quality, primary_source_url, city_id, city_name, province FROM slice", _slice)
add("ui_source_health", " SELECT official_status, count(*) AS record_count, count(primary_source_url) AS with_url_count, count(full_text) AS with_text_count, round(avg(CAST(source_quality AS DOUBLE)), 5) AS source_quality_mean FROM records GROUP BY 1", search.source_health)

_METRICS = f"""count(DISTINCT record_id) AS policy_count, {_distinct_if(_OFFICIAL, "official_policy_count")}, {_distinct_if("direction = 'tightening'", "tightening_count")}, {_distinct_if("direction IN ('loosening', 'supportive')", "easing_count")},
  round(avg(CASE WHEN {_OFFICIAL} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 5) AS official_share, round(avg(CAST(source_quality AS DOUBLE)), 5) AS source_quality_mean"""
for _level, _region in (("nation", "'nation'"), ("province", "province"), ("city", "city_name")):
    _base = """, base AS (SELECT DISTINCT g.record_id, record_date, province, city_name, direction, official_status, source_quality, policy_strength FROM geography_base g
      WHERE record_date IS NOT NULL AND year(record_date) = 1998 AND EXISTS (SELECT 1 FROM terms t WHERE t.record_id = g.record_id AND t.taxonomy_name = 'topic' AND t.term_name = 'PROMO'))"""
    add(f"api_region_ranking_{_level}", f"{_base} SELECT {_region} AS region, {_METRICS} FROM base GROUP BY 1 ORDER BY policy_count DESC, region LIMIT 10 OFFSET {2 if _level == 'city' else 0}", lambda lib, v=_level: search.region_panel(lib, v, year=1998, topic="PROMO", limit=10, offset=2 if v == "city" else 0).ranking)
    add(f"api_region_trend_{_level}", f"{_base} SELECT {_MONTH}, {_METRICS} FROM base GROUP BY 1, 2", lambda lib, v=_level: search.region_panel(lib, v, year=1998, topic="PROMO").trend)
    add(f"api_region_total_{_level}", f"{_base} SELECT count(DISTINCT {_region}) AS total FROM base", lambda lib, v=_level: search.region_panel(lib, v, year=1998, topic="PROMO").total)
