"""The library as one object: open a folder of curated tables, search, count, take panels, export.

Every method returns a lazy DataFrame; nothing is collected and nothing is cached behind the caller's back. The views are
registered on demand as temporary views of their names, for SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import FINANCING_SHEET, WHITE_LIST_PREFIX
from gridloom.plans import search, views
from gridloom.plans.library import HOUSING, Library, Measures
from gridloom.sources import sinks
from gridloom.sources.tables import read_or_empty

#: First month of the grids.
GRID_START = dt.date(2018, 1, 1)


def grid_end(today: dt.date) -> dt.date:
    """The last month of a grid: the last month start before a month from ``today``."""
    last = dt.date(today.year + today.month // 12, today.month % 12 + 1, 1)
    return last if today.day > 1 else today


VIEWS: dict[str, Callable[[Library], DataFrame]] = {
    "v_policy_master": views.policy_master,
    "v_policy_topic_long": views.topic_long,
    "v_policy_instrument_long": views.instrument_long,
    "v_policy_geography_long": views.geography_long,
    "v_policy_geography_base": views.geography_base,
    "v_policy_collection_long": views.collection_long,
    "v_policy_library_summary": views.library_summary,
    "v_policy_latest_version": views.policy_master,
    "v_policy_source_quality": views.source_quality,
    "v_city_policy_timeline": views.city_timeline,
    "v_city_month_policy_panel": views.city_month_panel,
    "v_city_year_policy_panel": views.city_year_panel,
    "v_province_month_policy_panel": views.province_month_panel,
    "v_national_month_policy_panel": views.national_month_panel,
    "v_policy_event_study": views.event_study,
    "v_policy_intensity_index": views.intensity_index,
    "v_data_quality": views.data_quality,
    "v_official_statements": views.official_statements,
    "v_supply_side_measures": views.supply_side,
    "v_demand_side_measures": views.demand_side,
    "v_urban_renewal_policies": views.urban_renewal,
    "v_information_completeness": views.information_completeness,
    "v_policy_105_cities": views.scope_cities,
    "v_white_list_events": lambda lib: views.sheet_events(lib, prefix=WHITE_LIST_PREFIX),
    "v_psl_financing_events": lambda lib: views.sheet_events(lib, sheet=FINANCING_SHEET),
    "v_city_month_policy_panel_105": lambda lib: views.grid_panel(lib, grid_end(dt.date.today()), GRID_START),
    "v_city_year_policy_panel_105": lambda lib: views.grid_year_panel(lib, grid_end(dt.date.today()), GRID_START),
}


def _features(read: Callable[[str, str], DataFrame], lib: Library) -> DataFrame:
    features = read("policy_features", "record_id string, feature_name string, feature_value string, source_cell string")
    return views.features_resolved(features, read("auto_t4_links", "source_cell string, record_id string"))


def _coverage(read: Callable[[str, str], DataFrame], lib: Library) -> DataFrame:
    sheet = "source_sheet string, collection_code string, collection_name string, subcollection_code string, subcollection_name string, source_kind string"
    mapped = read("source_sheet_collections", f"{sheet}, mapping_role string").where("mapping_role = 'primary'")
    return views.source_coverage(lib, mapped.drop("mapping_role"))


#: Views that read curated tables which play no role in others: name, and a function of (reader of a table, library).
TABLE_VIEWS: dict[str, Callable[[Callable[[str, str], DataFrame], Library], DataFrame]] = {
    "v_policy_quantitative_measures": lambda read, lib: read("quantitative_measures", ""),
    "v_policy_relations": lambda read, lib: read("policy_relations", ""),
    "v_policy_features_resolved": _features,
    "v_source_collection_coverage": _coverage,
}


class Research:
    """Panels between two months (``YYYY-MM``) or dates, both included."""

    def __init__(self, lib: Library):
        self.lib = lib

    def city_month_panel(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return search.dated(views.city_month_panel(self.lib), start, end)

    def city_year_panel(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return search.dated(views.city_year_panel(self.lib), start, end)

    def city_month_grid(self, start: str | None = None, end: str | None = None, first: dt.date = GRID_START, last: dt.date | None = None) -> DataFrame:
        """Every city in scope by every month from ``first`` to ``last`` (next month by default), with zeros."""
        return search.dated(views.grid_panel(self.lib, last or grid_end(dt.date.today()), first), start, end)

    def city_year_grid(self, start: str | None = None, end: str | None = None, first: dt.date = GRID_START, last: dt.date | None = None) -> DataFrame:
        return search.dated(views.grid_year_panel(self.lib, last or grid_end(dt.date.today()), first), start, end)

    def event_window(self, topic: str, entity: str = "city_name", before: int = 12, after: int = 24) -> DataFrame:
        """Months of the city panel around each entity's first month with a record of the topic."""
        panel = views.city_month_panel(self.lib)
        months = views.city_timeline(self.lib).where(F.col("topic") == topic).select(F.col("city_name").alias("_city"), F.year("record_date").alias("_y"), F.month("record_date").alias("_m")).distinct()
        marked = panel.join(months, (F.col("city_name") == F.col("_city")) & (F.col("year") == F.col("_y")) & (F.col("month") == F.col("_m")), "left")
        treated = marked.select(*panel.columns, F.col("_city").isNotNull().alias("treated"))
        return views.event_window(treated, entity, F.col("treated"), before, after).drop("treated")


class Database:
    """``folder`` is where views find curated tables besides those of the library; without one they don't know them."""

    def __init__(self, lib: Library, folder: str | None = None):
        self.lib, self.folder = lib, folder
        self.research = Research(lib)

    @classmethod
    def open(cls, spark: SparkSession, folder: str, measures: Measures = HOUSING) -> Database:
        return cls(Library.from_curated(spark, folder, measures), folder)

    def table(self, name: str, schema: str = "") -> DataFrame:
        """A curated table; given a schema, its columns, and no rows if there is no such table."""
        spark, path = self.lib.records.sparkSession, f"{self.folder}/{name}.parquet"
        return read_or_empty(spark, path, schema) if schema else spark.read.parquet(path)

    def view(self, name: str) -> DataFrame:
        if name in TABLE_VIEWS and self.folder is not None:
            return TABLE_VIEWS[name](self.table, self.lib)
        if name not in VIEWS:
            raise ValueError(f"unknown view: {name}")
        return VIEWS[name](self.lib)

    def register(self, *names: str) -> None:
        """Views (all, if none is named) as temporary views of the session, for SQL."""
        for name in names or VIEWS:
            self.view(name).createOrReplaceTempView(name)

    def search(self, keyword: str | None = None, region: str | None = None, start_date: dt.date | None = None, end_date: dt.date | None = None, topics: Sequence[str] | None = None, direction: Sequence[str] | None = None, official_only: bool = False, limit: int = 1000, include_full_text: bool = True) -> DataFrame:
        return search.search(self.lib, keyword, region, start_date, end_date, topics, direction, official_only, limit, include_full_text)

    def get(self, record_id: object) -> DataFrame:
        return search.get(self.lib, record_id)

    def timeline(self, region: str | None = None, topic: str | None = None) -> DataFrame:
        return search.timeline(self.lib, region, topic)

    def stats(self, group_by: Sequence[str]) -> DataFrame:
        return search.stats(self.lib, group_by)

    def region_panel(self, level: str, **filters: object) -> search.RegionPanel:
        return search.region_panel(self.lib, level, **filters)

    def export(self, data: DataFrame | str, path: str, mode: str = "errorifexists") -> str:
        """A DataFrame, or a view by its name, written as the path's suffix says."""
        return sinks.export(self.view(data) if isinstance(data, str) else data, path, mode)
