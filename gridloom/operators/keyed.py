"""Row choice and merging by key: first, last, best, top k, margins, upserts, corrections. Order is always explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.columns import free


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows of each key in the given order. Spark cuts to k before the shuffle as well as after it."""
    number = rank or free(df, "_rank")
    ranked = df.withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(number) <= k)
    return ranked if rank else ranked.drop(number)


def keep_first(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return top_k(df, keys, [F.asc_nulls_last(seq)])


def keep_last(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return top_k(df, keys, [F.desc_nulls_last(seq)])


def best_by(df: DataFrame, keys: Sequence[str], value: str, seq: str) -> DataFrame:
    """The row with the largest value of each key, the earliest of equals: a later row must be strictly larger."""
    return top_k(df, keys, [F.desc_nulls_last(value), F.asc_nulls_last(seq)])


def best_and_margin(df: DataFrame, keys: Sequence[str], score: str, seq: str, default: float = 0.0) -> DataFrame:
    """The best row of each key with ``margin``, its lead over the second best (over ``default`` where there is none)."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score), F.asc_nulls_last(seq))
    led = df.withColumn("margin", F.col(score) - F.lead(score, 1, default).over(w)).withColumn("_rank", F.row_number().over(w))
    return led.where("_rank = 1").drop("_rank")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Rows of both by key, the new one where both have it, the last by ``seq`` within one. Columns that one side lacks
    are null there. A merge of whole snapshots: plain files have no update in place."""
    side = free(old, "_side")
    both = old.withColumn(side, F.lit(0)).unionByName(new.withColumn(side, F.lit(1)), allowMissingColumns=True)
    return top_k(both, keys, [F.desc(side), F.desc_nulls_last(seq)]).drop(side)


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows, and new ones whose key is not there yet."""
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"))


def replace_with_default(df: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """``value`` replaced by the mapping's value for the key where the mapping has the key, even by null."""
    hit = mapping.select(F.col(key), F.col(value).alias("_new"), F.lit(True).alias("_hit"))
    return df.join(hit, key, "left").withColumn(value, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(value))).drop("_new", "_hit")


def apply_corrections(df: DataFrame, corrections: DataFrame, key: str, fields: Sequence[str], seq: str) -> DataFrame:
    """Field by field, the last correction of (key, field_name, new_value) by ``seq``; one pivot and one join for all of
    them, however many fields are corrected. Applying the same ones again changes nothing."""
    last = keep_last(corrections.where(F.col("field_name").isin(*fields)), [key, "field_name"], seq)
    wide = last.groupBy(key).agg(*[F.max(F.when(F.col("field_name") == f, F.struct(F.col("new_value").alias("v")))).alias(f"_{f}") for f in fields])
    kinds = dict(df.dtypes)
    joined = df.join(wide, key, "left")
    fixed = {f: F.when(F.col(f"_{f}").isNotNull(), F.col(f"_{f}.v").cast(kinds[f])).otherwise(F.col(f)) for f in fields}
    return joined.select(*[fixed.get(c, F.col(c)).alias(c) for c in df.columns])


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, whose read fails if a key repeats: for the right side of a many-to-one join."""
    counted = df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    return counted.where(F.when(F.col("_n") > 1, F.raise_error(F.lit(f"key ({', '.join(keys)}) repeats")).cast("boolean")).otherwise(True)).drop("_n")


def link_if_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``left`` with the value of the one right row that has its keys; null where there are none or several."""
    only = right.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")
    return left.join(only, list(keys), "left")


def left_join_some(left: DataFrame, rights: Sequence[DataFrame], key: str, spread: str) -> DataFrame:
    """``left`` left-joined by ``key`` with each of ``rights``, where many rows on the left may have no key: these are
    dealt by a hash of ``spread``, not all to the one task that null keys go to."""
    deal = free(left, "_deal")
    keyed = lambda c: F.xxhash64(c.cast("string"))
    joined = left.withColumn(deal, keyed(F.coalesce(F.col(key).cast("string"), F.col(spread).cast("string"))))
    for right in rights:
        joined = joined.join(right.withColumn(deal, keyed(F.col(key))), [key, deal], "left")
    return joined.drop(deal)


def learn_unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that always go with one and the same value, and that value."""
    return df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_max")).where(F.col(value) == F.col("_max")).drop("_max")


def forward_fill(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """``value`` taken from the last row before that has one, within the keys."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(w))


def first_seen(df: DataFrame, keys: Sequence[str], seq: str, name: str = "first_seen") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(seq)) == 1)


def pivot_cells(cells: DataFrame, row: str, column: str, value: str, names: Sequence[str], seq: str) -> DataFrame:
    """Key-value cells to one row each, columns known in advance; the last value of a cell counts."""
    return cells.groupBy(row).pivot(column, list(names)).agg(F.max_by(value, seq))


def both_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and which: the check of configuration against data."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("left")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("right")))
