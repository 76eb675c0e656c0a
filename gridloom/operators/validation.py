"""Validation: a report of one row, and expectations on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.library import Library


def report(lib: Library, main_sheet: str, confidence_below: float = 0.65) -> DataFrame:
    """Counts of what is missing, repeated, invalid or unclassified. Every table is read once; one-row results are put
    side by side."""
    main = F.col("source_sheet") == main_sheet
    url = F.col("primary_source_url")
    records = lib.records.agg(
        F.count("*").alias("record_count"), F.count_if(main).alias("main_count"), F.count_if(main & F.col("full_text").isNull()).alias("main_missing_text"), F.min(F.when(main, F.col("record_date"))).alias("main_date_min"), F.max(F.when(main, F.col("record_date"))).alias("main_date_max"),
        F.count_if(url.isNotNull() & ~url.startswith("http://") & ~url.startswith("https://")).alias("invalid_url_count"), F.count_if(F.col("manual_review_status") == "pending").alias("pending_review_count"),
        F.count_if(F.col("record_date").isNull()).alias("date_anomaly_count"),
    )
    related = lib.collections.agg(
        F.count_distinct("collection_code").alias("collection_count"), F.count_distinct(F.concat("collection_code", F.lit("."), "subcollection_code")).alias("subcollection_count"), F.count_distinct("record_id").alias("classified_count"),
        F.count_if(F.col("confidence") < confidence_below).alias("low_confidence_count"),
    )
    cities = lib.cities.agg(F.count("*").alias("city_count"), F.count_distinct("city_id").alias("city_unique_count"))
    return records.crossJoin(related).crossJoin(cities).withColumn("unclassified_count", F.col("record_count") - F.col("classified_count"))


def passed(row: DataFrame, *expectations: Column) -> DataFrame:
    """The report with ``passed``: whether all expectations hold."""
    ok = F.lit(True)
    for e in expectations:
        ok = ok & F.coalesce(e, F.lit(False))
    return row.withColumn("passed", ok)


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("duplicate_group_count"))
