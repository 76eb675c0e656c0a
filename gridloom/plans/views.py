"""Research views over a ``Library``: masters, long tables, panels, grids, coverage.

A record's flags (does any of its terms belong to a measure?) are pivoted once by record and joined once, instead of one
existence test for each measure. Panels first collapse to one row per record and cell, so distinct counts become plain
sums, and no plan expands its input for several distinct aggregates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.library import Library, is_official

CITY_LEVELS = ("city", "county", "county_level_city")


def term_flags(lib: Library) -> DataFrame:
    """record_id and one boolean for each measure over terms: one pass, one row per record."""
    m = lib.measures
    wanted = {
        "purchase_restriction": m.purchase_restriction, "sale_restriction": m.sale_restriction, "mortgage": m.mortgage, "provident_fund": m.provident_fund,
        "subsidy": m.subsidy, "talent": m.talent, "urban_renewal": m.urban_renewal,
    }
    every = sorted({t for terms in wanted.values() for t in terms})
    return lib.terms.where(F.col("term_name").isin(*every)).groupBy("record_id").agg(*[F.bool_or(F.col("term_name").isin(*terms)).alias(name) for name, terms in wanted.items()])


def collection_flags(lib: Library) -> DataFrame:
    m = lib.measures
    code, sub = F.col("collection_code"), F.col("subcollection_code")
    return lib.collections.groupBy("record_id").agg(
        F.bool_or(code.isin(*m.supply_collections)).alias("supply_side"), F.bool_or(sub.isin(*m.renewal_subcollections)).alias("renewal"), F.bool_or(code.isin(*m.financing_collections)).alias("financing")
    )


def topics_by_record(lib: Library, separator: str = "、") -> DataFrame:
    """Terms of each record in one string, sorted: aggregated before any join, so wide text is never grouped by."""
    return lib.terms.select("record_id", "term_name").distinct().groupBy("record_id").agg(F.concat_ws(separator, F.array_sort(F.collect_list("term_name"))).alias("topics"))


def policy_master(lib: Library) -> DataFrame:
    places = lib.jurisdictions.select("record_id", F.col("jurisdiction_name").alias("city_name"))
    return lib.records.join(places, "record_id", "left").join(topics_by_record(lib), "record_id", "left")


def topic_long(lib: Library) -> DataFrame:
    return lib.records.select("record_id", "record_date", "title").join(lib.terms, "record_id")


def instrument_long(lib: Library) -> DataFrame:
    return topic_long(lib).where(F.col("taxonomy_name") == "instrument")


def geography_long(lib: Library) -> DataFrame:
    return lib.records.select("record_id", "record_date", "title").join(lib.geographies, "record_id")


def geography_base(lib: Library) -> DataFrame:
    g = lib.geographies.select("record_id", F.col("province_name").alias("province"), F.coalesce("parent_city_name", "city_name").alias("city_name"), "city_code", "county_name", "jurisdiction_level")
    strength = F.coalesce("mandatory_strength", F.lit(0)).cast("double").alias("policy_strength")
    own = lib.records.select("record_id", "record_date", "title", "record_type", "direction", "official_status", "source_quality", "legacy_category", "source_sheet", "geography_original")
    return own.join(g, "record_id").join(lib.policies, "record_id", "left").select(*own.columns, *g.columns[1:], strength)


def city_timeline(lib: Library) -> DataFrame:
    base = geography_base(lib).select("record_id", "city_name", "record_date", "title", "direction", "source_quality")
    return base.join(lib.terms.select("record_id", F.col("term_name").alias("topic")), "record_id", "left").select("city_name", "record_date", "record_id", "title", "direction", "source_quality", "topic")


def _when_count(condition: Column, name: str) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long").alias(name)


_DIRECTIONS = ("tightening", "loosening", "supportive")


def _panel(base: DataFrame, keys: list[str], flags: dict[str, Column], strength: bool = True, code: bool = False) -> DataFrame:
    """Counts of distinct records by cell. ``base`` has distinct rows; one record may have several in a cell."""
    first = [F.bool_or(is_official()).alias("official"), *[F.bool_or(F.col("direction") == d).alias(d) for d in _DIRECTIONS], *[F.bool_or(c).alias(f"is_{n}") for n, c in flags.items()]]
    first += [F.sum(F.col("source_quality").cast("double")).alias("q_sum"), F.count("source_quality").alias("q_n")]
    first += [F.sum("policy_strength").alias("s_sum"), F.max("policy_strength").alias("s_max")] if strength else []
    first += [F.min("city_code").alias("code")] if code else []
    cells = base.groupBy(*keys, "record_id").agg(*first)
    second = [F.count("*").alias("policy_count"), _when_count(F.col("official"), "official_policy_count"), *[_when_count(F.col(d), f"{d}_count") for d in _DIRECTIONS], *[_when_count(F.col(f"is_{n}"), f"{n}_count") for n in flags]]
    second += [F.sum("s_sum").alias("policy_strength_sum"), F.max("s_max").alias("policy_strength_max")] if strength else []
    second += [(F.sum("q_sum") / F.nullif(F.sum("q_n"), F.lit(0))).alias("source_quality_mean")]
    out = cells.groupBy(*keys).agg(*([F.min("code").alias("city_code")] if code else []), *second)
    return out


def _month(c: str = "record_date") -> list[Column]:
    return [F.year(c).alias("year"), F.month(c).alias("month")]


def city_month_panel(lib: Library) -> DataFrame:
    base = geography_base(lib).where(F.col("record_date").isNotNull() & F.col("city_name").isNotNull() & F.col("jurisdiction_level").isin(*CITY_LEVELS))
    base = base.select("record_id", "record_date", "province", "city_name", "city_code", "direction", "official_status", "source_quality", "legacy_category", "policy_strength").distinct()
    flagged = base.join(term_flags(lib), "record_id", "left").select("*", *_month())
    flags = {
        "purchase_restriction": F.col("purchase_restriction"), "sale_restriction": F.col("sale_restriction"), "mortgage": F.col("mortgage"), "provident_fund": F.col("provident_fund"),
        "subsidy": F.col("subsidy"), "talent_policy": F.col("talent"), "supply_side": F.col("legacy_category").like(lib.measures.supply_pattern), "urban_renewal": F.col("urban_renewal"),
    }
    return _panel(flagged, ["city_name", "province", "year", "month"], flags, code=True)


#: Columns that a year adds up over its months; the rest are the largest or the mean of the monthly means.
def city_year_panel(lib: Library) -> DataFrame:
    month = city_month_panel(lib)
    sums = [c for c in month.columns if c.endswith(("_count", "_sum"))]
    return month.groupBy("city_code", "city_name", "province", "year").agg(*[F.sum(c).alias(c) for c in sums], F.max("policy_strength_max").alias("policy_strength_max"), F.avg("source_quality_mean").alias("source_quality_mean"))


def province_month_panel(lib: Library) -> DataFrame:
    base = geography_base(lib).where(F.col("record_date").isNotNull() & F.col("province").isNotNull())
    base = base.select("record_id", "record_date", "province", "direction", "official_status", "source_quality", "legacy_category", "policy_strength").distinct()
    return _panel(base.select("*", *_month()), ["province", "year", "month"], {})


def national_month_panel(lib: Library) -> DataFrame:
    return _panel(lib.records.where("record_date IS NOT NULL").select("*", *_month()), ["year", "month"], {}, strength=False)


def event_study(lib: Library) -> DataFrame:
    return city_month_panel(lib).withColumn("event_time", F.lit(0))


def intensity_index(lib: Library) -> DataFrame:
    return city_month_panel(lib).withColumn("standardized_intensity", F.col("policy_strength_sum") * F.coalesce("source_quality_mean", F.lit(0.0)) / F.lit(5.0))


def data_quality(lib: Library) -> DataFrame:
    return lib.records.agg(
        F.count("*").alias("record_count"), F.count_if(F.col("title").isNull()).alias("missing_title_count"), F.count_if(F.col("full_text").isNull()).alias("missing_full_text_count"),
        F.count_if(F.col("primary_source_url").isNull()).alias("missing_url_count"), F.count_if(F.col("manual_review_status") == "pending").alias("pending_review_count"),
    )


def official_statements(lib: Library) -> DataFrame:
    return lib.records.where(F.col("record_type").isin("official_statement", "meeting_statement", "government_report"))


def supply_side(lib: Library) -> DataFrame:
    return policy_master(lib).where(F.col("legacy_category").like(lib.measures.supply_pattern))


def demand_side(lib: Library) -> DataFrame:
    return policy_master(lib).where(~F.col("legacy_category").like(lib.measures.supply_pattern) | F.col("legacy_category").isNull())


def sheet_events(lib: Library, prefix: str | None = None, sheet: str | None = None) -> DataFrame:
    """Records of one source sheet, or of all whose name starts with ``prefix``."""
    c = F.col("source_sheet")
    return lib.records.where(c.startswith(prefix) if prefix is not None else c == sheet)


def urban_renewal(lib: Library) -> DataFrame:
    """Records with a renewal term; a semi join, so nothing has to be made distinct again."""
    return lib.records.join(lib.terms.where(F.col("term_name").isin(*lib.measures.urban_renewal)), "record_id", "left_semi")


def source_quality(lib: Library) -> DataFrame:
    return lib.records.select("record_id", "title", "official_status", "source_quality", "primary_source_url")


def collection_long(lib: Library) -> DataFrame:
    own = lib.records.select("record_id", "record_date", "title", "record_type", "official_status", "direction", "source_quality", "primary_source_url", "source_sheet")
    return own.join(lib.collections, "record_id")


def library_summary(lib: Library) -> DataFrame:
    rows = lib.collections.groupBy("collection_code", "subcollection_code", "record_id").agg(F.sum("confidence").alias("c"), F.count("confidence").alias("n"), F.bool_or(F.col("review_status") == "pending").alias("pending"))
    return rows.groupBy("collection_code", "subcollection_code").agg(F.count("*").alias("record_count"), (F.sum("c") / F.sum("n")).alias("confidence_mean"), _when_count(F.col("pending"), "pending_review_count"))


def source_coverage(lib: Library, sheets: DataFrame) -> DataFrame:
    """Staged cells of each mapped sheet; sheets without cells stay with zeros. Cells are counted before the join."""
    cells = lib.staging.groupBy(F.col("source_sheet_name").alias("source_sheet")).agg(F.count("source_cell").alias("c"), F.count_if(F.col("is_formula") & F.col("source_cell").isNotNull()).alias("f"), F.count_if(F.col("is_merged") & F.col("source_cell").isNotNull()).alias("m"))
    counted = [F.coalesce(a, F.lit(0)).cast("long").alias(b) for a, b in (("c", "staging_cell_count"), ("f", "formula_count"), ("m", "merged_cell_count"))]
    return sheets.join(cells, "source_sheet", "left").select(*sheets.columns, *counted)


def information_completeness(lib: Library) -> DataFrame:
    """One row from several tables; each is aggregated alone, and one-row tables are put side by side."""
    staged = lib.staging.agg(F.count_distinct("source_sheet_name").alias("staging_sheet_count"), F.count("*").alias("staging_cell_count"))
    records = lib.records.agg(F.count("*").alias("record_count"))
    related = lib.collections.agg(F.count_distinct("record_id").alias("classified_record_count"), F.count("*").alias("record_collection_relation_count"))
    return staged.crossJoin(records).crossJoin(related)


def month_spine(spark, first: dt.date, last: dt.date, step: str = "1 month") -> DataFrame:
    """Month starts from ``first`` to ``last``, both included; none if ``last`` is before ``first``."""
    return spark.range(int(first <= last)).select(F.explode(F.expr(f"sequence(DATE'{first}', DATE'{max(first, last)}', INTERVAL {step})")).alias("month_start"))


def scope_cities(lib: Library, since: dt.date = dt.date(2018, 1, 1)) -> DataFrame:
    """Record by applicable city, with nine flags from two pivots of the bridge tables."""
    recent = lib.records.where(F.col("record_date") >= F.lit(since))
    flags = {"purchase_limit": "purchase_restriction", "sale_limit": "sale_restriction", "commercial_mortgage": "mortgage", "hpf_policy": "provident_fund", "talent_policy": "talent", "subsidy": "subsidy"}
    pivoted = term_flags(lib).select("record_id", *[F.col(old).alias(new) for new, old in flags.items()])
    joined = recent.join(lib.applicable, "record_id").join(lib.cities, "city_id")
    joined = joined.join(pivoted, "record_id", "left").join(collection_flags(lib), "record_id", "left").join(lib.policies, "record_id", "left")
    names = [*flags, "supply_side", "renewal", "financing"]
    return joined.select(
        "record_id", "record_date", "title", "full_text", "direction", "official_status", "source_quality", "primary_source_url", "city_id", "city_name", F.col("province_name").alias("province"), "city_tier_existing", "city_scale_2020", "needs_review",
        *[F.coalesce(n, F.lit(False)).alias("urban_renewal" if n == "renewal" else n) for n in names], F.coalesce("mandatory_strength", F.lit(0)).cast("double").alias("policy_strength"),
    )


def grid_panel(lib: Library, last: dt.date, first: dt.date = dt.date(2018, 1, 1)) -> DataFrame:
    """Every city in scope by every month from ``first`` to ``last``, with zeros where nothing happened.

    Records are aggregated to (city, month) first; the grid, cities by months, is joined to that small table.
    """
    rows = scope_cities(lib, first).where(~F.col("needs_review")).withColumn("month_start", F.trunc("record_date", "MM"))
    flags = ("purchase_limit", "sale_limit", "commercial_mortgage", "hpf_policy", "talent_policy", "subsidy", "supply_side", "urban_renewal", "financing")
    d = F.col("direction")
    tests = {
        "official_policy": is_official(), "secondary_only": ~is_official(), "easing": d.isin("loosening", "supportive"), "tightening": d == "tightening", "neutral": d == "neutral",
        **{f: F.col(f) for f in flags}, "with_text": F.col("full_text").isNotNull(), "with_url": F.col("primary_source_url").isNotNull(),
    }
    per_record = rows.groupBy("city_id", "month_start", "record_id").agg(*[F.bool_or(c).alias(n) for n, c in tests.items()], F.sum("policy_strength").alias("s"), F.count("policy_strength").alias("n"))
    cells = per_record.groupBy("city_id", "month_start").agg(F.count("*").alias("policy_count"), *[_when_count(F.col(n), f"{n}_count") for n in tests], F.sum("s").alias("strength"), F.sum("n").alias("strengths"))
    grid = lib.cities.crossJoin(F.broadcast(month_spine(lib.records.sparkSession, first, last)))  # months are few: every city has every month
    n = F.coalesce("policy_count", F.lit(0))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    share = lambda w, c: F.lit(w) * F.col(c) / F.col("policy_count")
    counts = [f"{t}_count" for t in tests if not t.startswith("with_")]
    return grid.join(cells, ["city_id", "month_start"], "left").select(
        "city_id", "city_name", F.col("province_name").alias("province"), "city_tier_existing", "city_scale_2020", *_month("month_start"), zero(n).alias("policy_count"), *[zero(c).alias(c) for c in counts],
        F.coalesce("strength", F.lit(0.0)).alias("policy_strength_sum"), (F.col("strength") / F.col("strengths")).alias("policy_strength_mean"), (n > 0).alias("has_policy"),
        F.when(n == 0, 0.0).otherwise(F.round(share(0.6, "official_policy_count") + share(0.2, "with_text_count") + share(0.2, "with_url_count"), 4)).alias("data_completeness_score"),
    )


def grid_year_panel(lib: Library, last: dt.date, first: dt.date = dt.date(2018, 1, 1)) -> DataFrame:
    month = grid_panel(lib, last, first)
    counts = [c for c in month.columns if c.endswith("_count")]
    return month.groupBy("city_id", "city_name", "province", "city_tier_existing", "city_scale_2020", "year").agg(
        *[F.sum(c).alias(c) for c in counts], F.sum("policy_strength_sum").alias("policy_strength_sum"), F.avg("policy_strength_mean").alias("policy_strength_mean"), F.bool_or("has_policy").alias("has_policy"), F.avg("data_completeness_score").alias("data_completeness_score")
    )


def features_resolved(features: DataFrame, links: DataFrame) -> DataFrame:
    """Features with the record they belong to: the curated link, else the automatic one, and which of them it is."""
    auto = links.select("source_cell", F.col("record_id").alias("auto_id"))
    found = F.when(F.col("record_id").isNull() & F.col("auto_id").isNotNull(), "deterministic_auto_match").otherwise("curated")
    return features.join(auto, "source_cell", "left").select(F.coalesce("record_id", "auto_id").alias("record_id"), "feature_name", "feature_value", "source_cell", found.alias("link_source"))


def event_window(panel: DataFrame, entity: str, treated: Column, before: int = 12, after: int = 24) -> DataFrame:
    """An extension: months relative to an entity's first treated month, within ``before`` and ``after``."""
    t = F.col("year") * 12 + F.col("month")
    starts = panel.where(treated).groupBy(entity).agg(F.min(t).alias("treated_month"))
    return panel.join(starts, entity).withColumn("event_time", (t - F.col("treated_month")).cast("int")).where(F.col("event_time").between(-before, after)).drop("treated_month")
