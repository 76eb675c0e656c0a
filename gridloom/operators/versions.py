"""Incremental runs: versions of documents, resuming, and planning again without losing what is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.keyed import upsert


def detect_versions(fetched: DataFrame, versions: DataFrame) -> DataFrame:
    """Fetched (item_id, canonical_url, content_hash) with status and is_material_change against the known versions.

    The same item with the same hash is ``unchanged``; anything else is a ``new_version``, material if the URL is known
    with another hash.
    """
    known = versions.select("item_id", "content_hash").distinct().withColumn("_same", F.lit(True))
    urls = versions.groupBy("canonical_url").agg(F.min("content_hash").alias("_lo"), F.max("content_hash").alias("_hi"))
    other = F.coalesce((F.col("_lo") != F.col("content_hash")) | (F.col("_hi") != F.col("content_hash")), F.lit(False))
    return fetched.join(known, ["item_id", "content_hash"], "left").join(urls, "canonical_url", "left").select(
        *fetched.columns, F.when(F.col("_same"), "unchanged").otherwise("new_version").alias("version_status"), (F.col("_same").isNull() & other).alias("is_material_change")
    )


def resume(items: DataFrame, run_id: object) -> DataFrame:
    """What a stopped run has still to do."""
    return items.where((F.col("run_id") == F.lit(run_id)) & (F.col("status") == "pending"))


def replan(old: DataFrame, planned: DataFrame, key: str, kept: list[str]) -> DataFrame:
    """Planned rows replace old ones with the same key, but ``kept`` columns stay as they were first."""
    known = old.select(key, *[F.col(c).alias(f"_{c}") for c in kept])
    merged = planned.join(known, key, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in kept else F.col(c) for c in planned.columns])
    return upsert(old, merged, [key], key)


def set_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """New values where the condition holds (null does not), the old ones elsewhere."""
    return df.withColumns({c: F.when(F.coalesce(condition, F.lit(False)), v).otherwise(F.col(c)) for c, v in values.items()})


def checkpoint_row(done: DataFrame, order: str = "seq") -> DataFrame:
    """The progress of each run: last item, number processed, and whether nothing is pending."""
    finished = F.col("status") != "pending"
    return done.groupBy("run_id").agg(F.max_by(F.when(finished, F.col("item_id")), F.when(finished, F.col(order))).alias("last_item"), F.count_if(finished).alias("processed"), (F.count_if(~finished) == 0).alias("complete"))


def enable_recommended(sources: DataFrame, limit: int = 20) -> DataFrame:
    """Sources that are recommended and off are switched on, the first ``limit`` by id."""
    chosen = sources.where("recommended_enabled AND NOT crawl_enabled").orderBy("source_id").limit(limit).select("source_id", F.lit(True).alias("_on"))
    return sources.join(chosen, "source_id", "left").withColumn("crawl_enabled", F.coalesce("_on", "crawl_enabled")).drop("_on")


def disable_unhealthy(sources: DataFrame, least: float = 50.0) -> DataFrame:
    return sources.withColumn("crawl_enabled", F.col("crawl_enabled") & (F.coalesce("source_health_score", F.lit(0.0)) >= least))


def job_size(cities: Column, topics: Column, mode: Column, cap: Column, actions: int = 8, all_cities: int = 105) -> Column:
    """Queries that a job will make: cities by topics by actions, at most ``cap``; none in modes that do not search."""
    n_cities = F.when(F.coalesce(cities, F.lit(0)) > 0, cities).when(mode == "historical_105", all_cities).otherwise(1)
    n_topics = F.greatest(F.coalesce(topics, F.lit(0)), F.lit(1))
    return F.when(mode.isin("web_discovery", "historical_105", "smart"), F.least(n_cities * n_topics * actions, cap)).otherwise(0)


def cache_lookup(texts: DataFrame, cache: DataFrame, version: str, ready: bool = False) -> DataFrame:
    """Texts by hash with the last complete result of that version; ``status`` says what is to be done with the others."""
    found = cache.where((F.col("schema_version") == version) & (F.col("status") == "complete")).groupBy("content_sha256").agg(F.max_by("output_json", "seq").alias("output_json"))
    return texts.join(found, "content_sha256", "left").withColumn("status", F.when(F.col("output_json").isNotNull(), "complete").otherwise("to_call" if ready else "awaiting_api_key"))
