"""Roles and their binding to physical tables.

A ``Library`` holds the DataFrames that views and operators work on, by role: dated records, their geographies, terms,
collections and strengths, the cities in scope and which records apply to which. ``from_star`` binds the roles to a star
schema of orders; other data bind by filling the same fields. Everything is lazy, but for a count of lines from the
files' footers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.columns import dealt
from gridloom.sources.tables import read_or_empty

OFFICIAL = ("official", "official_reprint")


@dataclass(frozen=True)
class Measures:
    """Which terms and collections count for which measure of a panel."""

    purchase_restriction: tuple[str, ...]
    sale_restriction: tuple[str, ...]
    mortgage: tuple[str, ...]
    provident_fund: tuple[str, ...]
    subsidy: tuple[str, ...]
    talent: tuple[str, ...]
    urban_renewal: tuple[str, ...]
    supply_pattern: str
    supply_collections: tuple[str, ...]
    renewal_subcollections: tuple[str, ...]
    financing_collections: tuple[str, ...]


#: The terms of the housing-policy panels.
HOUSING = Measures(
    purchase_restriction=("限购",),
    sale_restriction=("限售",),
    mortgage=("商业住房贷款", "限贷"),
    provident_fund=("公积金",),
    subsidy=("购房补贴",),
    talent=("人才住房",),
    urban_renewal=("城市更新", "城中村改造", "老旧小区改造", "危旧房改造"),
    supply_pattern="%供给%",
    supply_collections=("housing_urban_rural_development", "natural_resources"),
    renewal_subcollections=("urban_renewal",),
    financing_collections=("financial_regulation",),
)

#: The same measures over the star schema's part types and brands.
STAR = Measures(
    purchase_restriction=("ECONOMY",),
    sale_restriction=("STANDARD",),
    mortgage=("SMALL", "MEDIUM"),
    provident_fund=("LARGE",),
    subsidy=("PROMO",),
    talent=("Brand#1",),
    urban_renewal=("Brand#2", "Brand#3"),
    supply_pattern="%BUILD%",
    supply_collections=("Brand#4", "Brand#5"),
    renewal_subcollections=("PROMO",),
    financing_collections=("Brand#6",),
)


#: Role: curated table and the columns that views and operators read of it.
CURATED = {
    "records": ("records", "record_id string, record_date date, title string, summary string, full_text string, direction string, official_status string, source_quality int, primary_source_url string, record_type string, legacy_category string, source_sheet string, manual_review_status string, geography_original string"),
    "jurisdictions": ("record_jurisdictions", "record_id string, jurisdiction_name string, geography_original string"),
    "geographies": ("record_geographies_normalized", "record_id string, geography_original string, province_name string, city_name string, parent_city_name string, city_code string, county_name string, jurisdiction_level string"),
    "terms": ("record_terms", "record_id string, taxonomy_name string, term_name string"),
    "collections": ("record_collections", "record_id string, collection_code string, subcollection_code string, confidence double, review_status string, is_primary boolean"),
    "policies": ("policies", "record_id string, mandatory_strength double"),
    "cities": ("cities_105", "city_id string, city_name string, province_name string, city_tier_existing int, city_scale_2020 string"),
    "applicable": ("policy_applicable_cities", "record_id string, city_id string, needs_review boolean"),
    "staging": ("staging_excel_cells", "source_sheet_name string, source_cell string, is_formula boolean, is_merged boolean"),
}


def is_official(status: Column | str = "official_status") -> Column:
    return (F.col(status) if isinstance(status, str) else status).isin(*OFFICIAL)


@dataclass
class Library:
    records: DataFrame
    jurisdictions: DataFrame
    geographies: DataFrame
    terms: DataFrame
    collections: DataFrame
    policies: DataFrame
    cities: DataFrame
    applicable: DataFrame
    staging: DataFrame
    measures: Measures

    @classmethod
    def from_curated(cls, spark: SparkSession, folder: str, measures: Measures = HOUSING) -> Library:
        """The roles bound to a folder of curated Parquet tables, by their own names. Tables that are not there are empty."""
        read = {role: read_or_empty(spark, f"{folder}/{name}.parquet", schema) for role, (name, schema) in CURATED.items()}
        return cls(**read, measures=measures)

    @classmethod
    def from_star(cls, spark: SparkSession, sf_dir: str) -> Library:
        star = Star(spark, sf_dir)
        return cls(
            records=star.records, jurisdictions=star.geographies.select("record_id", F.col("city_name").alias("jurisdiction_name"), "geography_original"),
            geographies=star.geographies, terms=star.terms, collections=star.collections, policies=star.policies,
            cities=star.cities, applicable=star.applicable, staging=star.staging, measures=STAR,
        )


class Star:
    """The roles as projections of the star schema."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def places(self) -> DataFrame:
        """25 cities with their provinces."""
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    @cached_property
    def owned(self) -> DataFrame:
        customers = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        return self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))

    @cached_property
    def records(self) -> DataFrame:
        key, digit = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1)
        located = self.owned.join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
        return located.select(
            key.alias("record_id"),
            F.to_date("o_orderdate").alias("record_date"),
            F.concat(F.lit("Order "), key.cast("string"), F.lit(" "), F.col("o_orderpriority")).alias("title"),
            F.concat(F.col("c_mktsegment"), F.lit(" of "), F.col("n_name")).alias("summary"),
            F.when(key % 7 != 0, F.concat(F.lit("Full text of order "), key.cast("string"), F.lit(" in "), F.col("r_name"))).alias("full_text"),
            F.when(F.col("o_orderstatus") == "F", "loosening").when(F.col("o_orderstatus") == "O", "tightening").otherwise("supportive").alias("direction"),
            F.element_at(F.array(*[F.lit(x) for x in ("official", "official_reprint", "authoritative_media", "general_media", "unknown")]), digit.cast("int")).alias("official_status"),
            digit.cast("int").alias("source_quality"),
            F.when(key % 11 != 0, F.concat(F.lit("https://example.org/"), key.cast("string"))).alias("primary_source_url"),
            F.when(F.col("o_orderstatus") == "F", "policy_document").when(F.col("o_orderstatus") == "O", "official_statement").otherwise("meeting_statement").alias("record_type"),
            F.col("c_mktsegment").alias("legacy_category"),
            F.concat(F.lit("sheet "), digit).alias("source_sheet"),
            F.when(digit == "5", "pending").otherwise("approved").alias("manual_review_status"),
            F.concat_ws("/", "r_name", "n_name").alias("geography_original"),
        )

    @cached_property
    def geographies(self) -> DataFrame:
        owned = self.owned.select("o_orderkey", "c_nationkey")
        return owned.join(self.places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("o_orderkey").alias("record_id"), F.concat_ws("/", "r_name", "n_name").alias("geography_original"),
            F.col("r_name").alias("province_name"), F.col("n_name").alias("city_name"), F.lit(None).cast("string").alias("parent_city_name"),
            F.col("n_nationkey").cast("string").alias("city_code"), F.lit(None).cast("string").alias("county_name"), F.lit("city").alias("jurisdiction_level"),
        )

    @cached_property
    def items(self) -> DataFrame:
        """Lines with their parts, dealt by order: terms and collections are grouped by it, and nearly every line is a group."""
        parts = self.table("part").select("p_partkey", "p_type", "p_brand")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_returnflag")
        return dealt(lines.join(parts, F.col("l_partkey") == F.col("p_partkey")), lines.count(), "l_orderkey")

    @cached_property
    def terms(self) -> DataFrame:
        """Types are topics, brands are instruments; one row per record and term."""
        both = F.explode(F.array(F.struct(F.lit("topic").alias("taxonomy_name"), F.col("p_type").alias("term_name")), F.struct(F.lit("instrument").alias("taxonomy_name"), F.col("p_brand").alias("term_name"))))
        return self.items.select(F.col("l_orderkey").alias("record_id"), both.alias("t")).select("record_id", "t.taxonomy_name", "t.term_name").distinct()

    @cached_property
    def collections(self) -> DataFrame:
        return self.items.groupBy(F.col("l_orderkey").alias("record_id"), F.col("p_brand").alias("collection_code"), F.col("p_type").alias("subcollection_code")).agg(
            F.max(F.round(1 - F.col("l_discount"), 2)).alias("confidence"),
            F.when(F.bool_or(F.col("l_returnflag") == "R"), "pending").otherwise("approved").alias("review_status"),
            F.bool_or(F.col("l_linenumber") == 1).alias("is_primary"),
        )

    @cached_property
    def policies(self) -> DataFrame:
        return self.table("orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("record_id"), F.col("o_totalprice").alias("mandatory_strength"))

    @cached_property
    def cities(self) -> DataFrame:
        return self.places.select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name"), F.col("r_name").alias("province_name"),
            (F.col("n_nationkey") % 4).alias("city_tier_existing"), F.concat(F.lit("scale "), (F.col("n_nationkey") % 3).cast("string")).alias("city_scale_2020"),
        )

    @cached_property
    def applicable(self) -> DataFrame:
        suppliers = self.table("supplier").select("s_suppkey", "s_nationkey")
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
        return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("l_orderkey").alias("record_id"), F.col("s_nationkey").alias("city_id")).agg(
            F.bool_and(F.col("l_returnflag") == "R").alias("needs_review")
        )

    @cached_property
    def staging(self) -> DataFrame:
        return self.table("lineitem").select(
            F.concat_ws(" ", F.lit("sheet"), F.col("l_linenumber").cast("string")).alias("source_sheet_name"),
            F.concat_ws(".", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("source_cell"),
            (F.col("l_discount") > 0.05).alias("is_formula"), (F.col("l_tax") > 0.04).alias("is_merged"),
        )


#: The binding as SQL, for checking against another engine.
STAR_SQL = """
places AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
owned AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
records AS (SELECT o_orderkey AS record_id, CAST(o_orderdate AS DATE) AS record_date, 'Order ' || o_orderkey || ' ' || o_orderpriority AS title,
  c_mktsegment || ' of ' || n_name AS summary, CASE WHEN o_orderkey % 7 <> 0 THEN 'Full text of order ' || o_orderkey || ' in ' || r_name END AS full_text,
  CASE o_orderstatus WHEN 'F' THEN 'loosening' WHEN 'O' THEN 'tightening' ELSE 'supportive' END AS direction,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'official' WHEN '2' THEN 'official_reprint' WHEN '3' THEN 'authoritative_media' WHEN '4' THEN 'general_media' ELSE 'unknown' END AS official_status,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS source_quality, CASE WHEN o_orderkey % 11 <> 0 THEN 'https://example.org/' || o_orderkey END AS primary_source_url,
  CASE o_orderstatus WHEN 'F' THEN 'policy_document' WHEN 'O' THEN 'official_statement' ELSE 'meeting_statement' END AS record_type,
  c_mktsegment AS legacy_category, 'sheet ' || substr(o_orderpriority, 1, 1) AS source_sheet,
  CASE WHEN o_orderpriority LIKE '5%' THEN 'pending' ELSE 'approved' END AS manual_review_status, r_name || '/' || n_name AS geography_original
  FROM owned JOIN places ON c_nationkey = n_nationkey),
geographies AS (SELECT o_orderkey AS record_id, r_name || '/' || n_name AS geography_original, r_name AS province_name, n_name AS city_name,
  CAST(n_nationkey AS VARCHAR) AS city_code, 'city' AS jurisdiction_level FROM owned JOIN places ON c_nationkey = n_nationkey),
items AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey),
terms AS (SELECT DISTINCT l_orderkey AS record_id, 'topic' AS taxonomy_name, p_type AS term_name FROM items
  UNION SELECT DISTINCT l_orderkey, 'instrument', p_brand FROM items),
collections AS (SELECT l_orderkey AS record_id, p_brand AS collection_code, p_type AS subcollection_code, max(round(1 - l_discount, 2)) AS confidence,
  CASE WHEN bool_or(l_returnflag = 'R') THEN 'pending' ELSE 'approved' END AS review_status, bool_or(l_linenumber = 1) AS is_primary
  FROM items GROUP BY ALL),
policies AS (SELECT o_orderkey AS record_id, o_totalprice AS mandatory_strength FROM orders WHERE o_orderstatus = 'F'),
cities AS (SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS province_name, n_nationkey % 4 AS city_tier_existing, 'scale ' || (n_nationkey % 3) AS city_scale_2020 FROM places),
applicable AS (SELECT l_orderkey AS record_id, s_nationkey AS city_id, bool_and(l_returnflag = 'R') AS needs_review
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
staging AS (SELECT 'sheet ' || l_linenumber AS source_sheet_name, l_orderkey || '.' || l_linenumber AS source_cell, l_discount > 0.05 AS is_formula, l_tax > 0.04 AS is_merged FROM lineitem),
geography_base AS (SELECT r.*, g.province_name AS province, g.city_name, g.city_code, g.jurisdiction_level, CAST(coalesce(p.mandatory_strength, 0) AS DOUBLE) AS policy_strength
  FROM records r JOIN geographies g USING (record_id) LEFT JOIN policies p USING (record_id)),
record_topics AS (SELECT record_id, string_agg(DISTINCT term_name, '、' ORDER BY term_name) AS topics FROM terms GROUP BY record_id),
policy_master AS (SELECT r.*, g.city_name, t.topics FROM records r LEFT JOIN geographies g USING (record_id) LEFT JOIN record_topics t USING (record_id))"""


def star_sql(body: str) -> str:
    """A statement over the bound roles; ``body`` may open with more tables as ``, name AS (...)``."""
    return f"WITH {STAR_SQL.strip()}{body}"
