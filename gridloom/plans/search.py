"""Search, timeline, statistics, dated ranges and the region panel: filters composed on the master views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.library import Library, is_official
from gridloom.plans.views import CITY_LEVELS, city_timeline, geography_base, policy_master, topics_by_record

#: Columns of a result without the full text; the scan then leaves that column alone.
NARROW = ("record_id", "record_date", "title", "summary", "city_name", "geography_original", "topics", "direction", "official_status", "source_quality", "primary_source_url", "source_sheet", "manual_review_status")


def contains(column: str, part: str, wildcards: bool = True) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` are wildcards unless told otherwise."""
    return F.col(column).ilike(f"%{part}%") if wildcards else F.contains(F.lower(column), F.lit(part.lower()))


def any_of(tests: Sequence[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def search(lib: Library, keyword: str | None = None, region: str | None = None, start_date: dt.date | None = None, end_date: dt.date | None = None, topics: Sequence[str] | None = None, direction: Sequence[str] | None = None, official_only: bool = False, limit: int = 1000, include_full_text: bool = True) -> DataFrame:
    """Matching records, newest first, ties by record_id and city. Tests on the records reach the scan as they are."""
    found = policy_master(lib)
    if keyword:
        found = found.where(any_of([contains(c, keyword) for c in ("title", "summary", "full_text")]))
    if region:
        found = found.where(any_of([contains(c, region) for c in ("city_name", "geography_original")]))
    if start_date:
        found = found.where(F.col("record_date") >= F.lit(start_date))
    if end_date:
        found = found.where(F.col("record_date") <= F.lit(end_date))
    if topics:
        found = found.where(any_of([contains("topics", t) for t in topics]))
    if direction:
        found = found.where(F.col("direction").isin(*direction))
    if official_only:
        found = found.where(is_official())
    if not include_full_text:
        found = found.select(*NARROW)
    return found.orderBy(F.desc_nulls_last("record_date"), F.asc_nulls_last("record_id"), F.asc_nulls_last("city_name")).limit(limit)


def get(lib: Library, record_id: object) -> DataFrame:
    """The record with that id (its first city by name), or no row."""
    return policy_master(lib).where(F.col("record_id") == F.lit(record_id)).orderBy(F.asc_nulls_last("city_name")).limit(1)


def timeline(lib: Library, region: str | None = None, topic: str | None = None) -> DataFrame:
    found = city_timeline(lib)
    if region:
        found = found.where(contains("city_name", region))
    if topic:
        found = found.where(F.col("topic") == topic)
    return found.orderBy(F.asc_nulls_last("record_date"), F.asc_nulls_last("record_id"), F.asc_nulls_last("topic"))


#: What ``stats`` may group by. A record counts once for each of its places.
GROUPS = {"year": F.year, "province": lambda _: F.col("city_name"), "topic": lambda _: F.col("topics"), "direction": lambda _: F.col("direction"), "source_quality": lambda _: F.col("source_quality")}


def stats(lib: Library, group_by: Sequence[str]) -> DataFrame:
    names = [g for g in group_by if g in GROUPS]
    if not names:
        raise ValueError("no supported group_by fields")
    needed = ["record_date", *(c for c in ("direction", "source_quality") if c in names)]
    counted = lib.records.select("record_id", *needed).join(lib.jurisdictions.select("record_id", F.col("jurisdiction_name").alias("city_name")), "record_id", "left")
    if "topic" in names:  # topics are put together for that alone
        counted = counted.join(topics_by_record(lib), "record_id", "left")
    return counted.groupBy(*[GROUPS[g]("record_date").alias(g) for g in names]).agg(F.count("*").alias("policy_count")).orderBy(*[F.asc_nulls_last(g) for g in names])


def dated(panel: DataFrame, start: str | dt.date | None = None, end: str | dt.date | None = None) -> DataFrame:
    """Rows of a panel between two months, or two years where it has no month column; both ends included."""
    monthly = "month" in panel.columns
    at = F.col("year") * 12 + F.col("month") if monthly else F.col("year")
    for bound, keep in ((start, lambda x: at >= x), (end, lambda x: at <= x)):
        if bound:
            y, m = map(int, str(bound)[:7].split("-"))
            panel = panel.where(keep(F.lit(y * 12 + m if monthly else y)))
    return panel


def sliced(
    lib: Library, start_date: dt.date | None = None, end_date: dt.date | None = None, provinces: Sequence[str] | None = None, cities: Sequence[str] | None = None, directions: Sequence[str] | None = None,
    official_only: bool = False, term: str | None = None, collection: str | None = None, subcollection: str | None = None, keyword: str | None = None, with_unreviewed: bool = False,
) -> DataFrame:
    """Records by the cities in scope that they apply to, under any of the filters. What asks whether a record has some
    term or collection is a semi join, before the records meet their cities."""
    found = lib.records
    if start_date:
        found = found.where(F.col("record_date") >= F.lit(start_date))
    if end_date:
        found = found.where(F.col("record_date") <= F.lit(end_date))
    if directions:
        found = found.where(F.col("direction").isin(*directions))
    if official_only:
        found = found.where(is_official())
    if keyword:
        found = found.where(any_of([contains(c, keyword) for c in ("title", "summary", "full_text")]))
    if term:
        found = found.join(lib.terms.where(F.col("term_name") == term), "record_id", "left_semi")
    for column, value in (("collection_code", collection), ("subcollection_code", subcollection)):
        if value:
            found = found.join(lib.collections.where(F.col(column) == value), "record_id", "left_semi")
    places = lib.cities
    if provinces:
        places = places.where(F.col("province_name").isin(*provinces))
    if cities:
        places = places.where(F.col("city_name").isin(*cities))
    links = lib.applicable if with_unreviewed else lib.applicable.where(~F.col("needs_review"))
    joined = found.join(links, "record_id").join(places, "city_id")
    return joined.select("record_id", "record_date", "title", "direction", "official_status", "source_quality", "primary_source_url", "city_id", "city_name", F.col("province_name").alias("province"))


def slice_totals(found: DataFrame) -> DataFrame:
    return found.agg(F.count_distinct("record_id").alias("record_count"), F.count_distinct("city_id").alias("city_count"), F.count("*").alias("link_count"))


def slice_by(found: DataFrame, *keys: Column) -> DataFrame:
    """Distinct records of a slice by the keys: once for each key and record, then counted."""
    rows = found.select(*keys, "record_id").distinct()
    return rows.groupBy(*[c for c in rows.columns if c != "record_id"]).agg(F.count("*").alias("record_count"))


def source_health(lib: Library) -> DataFrame:
    """Records by official status: how many have a URL and a text, and their mean quality."""
    return lib.records.groupBy("official_status").agg(
        F.count("*").alias("record_count"), F.count("primary_source_url").alias("with_url_count"), F.count("full_text").alias("with_text_count"), F.avg(F.col("source_quality").cast("double")).alias("source_quality_mean")
    )


@dataclass(frozen=True)
class RegionPanel:
    ranking: DataFrame
    trend: DataFrame
    total: DataFrame


def region_panel(lib: Library, level: str, province: str | None = None, city: str | None = None, year: int | None = None, topic: str | None = None, limit: int = 50, offset: int = 0) -> RegionPanel:
    """Ranking (paged), monthly trend and number of regions at a level: 'nation', 'province' or 'city'."""
    g = geography_base(lib).where("record_date IS NOT NULL")
    if province:
        g = g.where(F.col("province") == province)
    if city:
        g = g.where(F.col("city_name") == city)
    if year:  # a range of dates reaches the scan, the year of a date does not
        g = g.where(F.col("record_date").between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31))))
    if topic:
        g = g.join(lib.terms.where((F.col("taxonomy_name") == "topic") & (F.col("term_name") == topic)), "record_id", "left_semi")
    if level == "nation":
        region = F.lit("nation")
    elif level == "province":
        g, region = g.where("province IS NOT NULL"), F.col("province")
    elif level == "city":
        g, region = g.where(F.col("city_name").isNotNull() & F.col("jurisdiction_level").isin(*CITY_LEVELS)), F.col("city_name")
    else:
        raise ValueError(f"unsupported level: {level}")
    base = g.select("record_id", "record_date", "province", "city_name", "direction", "official_status", "source_quality", "policy_strength").distinct().withColumn("region", region)

    def measured(keys: list[Column]) -> DataFrame:
        official = F.coalesce(is_official(), F.lit(False))
        rows = base.groupBy(*keys, "record_id").agg(
            F.bool_or(official).alias("o"), F.bool_or(F.col("direction") == "tightening").alias("t"), F.bool_or(F.col("direction").isin("loosening", "supportive")).alias("e"),
            F.count("*").alias("n"), F.count_if(official).alias("n_o"), F.sum("source_quality").alias("q"), F.count("source_quality").alias("n_q"),
        )
        names = [c for c in rows.columns if c not in ("record_id", "o", "t", "e", "n", "n_o", "q", "n_q")]
        return rows.groupBy(*names).agg(
            F.count("*").alias("policy_count"), F.count_if("o").alias("official_policy_count"), F.count_if("t").alias("tightening_count"), F.count_if("e").alias("easing_count"),
            (F.sum("n_o") / F.sum("n")).alias("official_share"), (F.sum("q") / F.nullif(F.sum("n_q"), F.lit(0))).alias("source_quality_mean"),
        )

    ranking = measured([F.col("region")]).orderBy(F.desc("policy_count"), F.asc_nulls_last("region")).offset(offset).limit(limit)
    trend = measured([F.year("record_date").alias("year"), F.month("record_date").alias("month")]).orderBy("year", "month")
    return RegionPanel(ranking, trend, base.agg(F.count_distinct("region").alias("total")))
