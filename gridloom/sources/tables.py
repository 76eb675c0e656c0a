"""Reading: Parquet, globs of files with differing columns, CSV under a contract, binary files, text and JSON lines."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.intervals import interval_join


def register(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    """A temporary view for each Parquet table of a folder, under the table's name."""
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store Spark reads it from."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of ``schema`` of a Parquet table, null where it lacks one; no rows where there is no such table."""
    wanted = T.StructType.fromDDL(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], wanted)
    found = spark.read.parquet(path)
    return found.select(*[(F.col(f.name) if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Files or folders of Parquet whose columns differ: all columns by name, null where a file lacks one."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def stacked(frames: Iterable[DataFrame]) -> DataFrame:
    """Tables one after another by column name; what one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_count(df: DataFrame) -> DataFrame:
    """Number of files that rows come from."""
    return df.select(F.input_file_name().alias("f")).agg(F.count_distinct("f").alias("file_count"))


def guarded(df: DataFrame, *rules: tuple[Column, str]) -> DataFrame:
    """``df``, whose read fails with the rule's message at the first row where a rule does not hold."""
    for ok, message in rules:
        df = df.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
    return df


def read_contract_csv(spark: SparkSession, path: str, schema: T.StructType, key: str, rows: int | None = None, *rules: tuple[Column, str]) -> DataFrame:
    """A CSV of a small dimension with a fixed schema: empty fields are null, the key is unique, the number of rows is as
    expected and every row meets the rules; otherwise this raises ``ValueError``."""
    df = spark.read.csv(path, header=True, schema=schema, nullValue="", encoding="UTF-8", mode="FAILFAST")
    broken = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"r{i}") for i, (ok, _) in enumerate(rules)]
    found = df.agg(F.count("*").alias("n"), F.count_distinct(key).alias("k"), *broken).first()
    if found["n"] != found["k"] or (rows is not None and found["n"] != rows):
        raise ValueError(f"{path}: {found['n']} rows, {found['k']} different values of {key}")
    for i, (_, message) in enumerate(rules):
        if found[f"r{i}"]:
            raise ValueError(f"{path}: {message} ({found[f'r{i}']} rows)")
    return df


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files, each read whole by one task: for files of moderate size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def preview(df: DataFrame, condition: Column | None = None, rows: int = 20) -> tuple[DataFrame, DataFrame]:
    """(count, first rows) of what the condition selects."""
    found = df if condition is None else df.where(condition)
    return found.agg(F.count("*").alias("n")), found.limit(rows)


def cells_in_merged_ranges(cells: DataFrame, ranges: DataFrame) -> DataFrame:
    """Staged cells (sheet, row, col, ...) with the merged range they lie in and whether they are its anchor.

    Ranges (sheet, row0, col0, row1, col1, name) meet the cells by an interval join over rows, whatever their size.
    """
    named = ranges.select("sheet", F.col("name").alias("merged_range"), "row0", "col0", "row1", "col1")
    inside = interval_join(cells.select("sheet", "row", "col").distinct(), named, ["sheet"], "row", "row0", "row1").where("col BETWEEN col0 AND col1")
    hits = inside.select("sheet", "row", "col", "merged_range", "row0", "col0")
    anchor = F.coalesce((F.col("row") == F.col("row0")) & (F.col("col") == F.col("col0")), F.lit(False))
    return cells.join(hits, ["sheet", "row", "col"], "left").select(*cells.columns, "merged_range", anchor.alias("is_anchor"), F.col("merged_range").isNotNull().alias("is_merged"))
