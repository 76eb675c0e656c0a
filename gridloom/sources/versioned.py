"""Versions of tables in a folder: copies, made before tables are replaced, that can be read back."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from gridloom.sources.sinks import file_system, move

_HISTORY = "_history"


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the versions there are, oldest first."""
    fs, there = file_system(spark, f"{folder}/{_HISTORY}")
    if not fs.exists(there):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(there)]
    return sorted(n for n in names if n.isdigit())


def snapshot(spark: SparkSession, folder: str, names: Iterable[str]) -> str:
    """Copy the tables as they are; the version's name. A copy that breaks off is not seen and is written anew."""
    known = versions(spark, folder)
    version = f"{int(known[-1]) + 1 if known else 0:08}"
    building = f"{folder}/{_HISTORY}/{version}.building"
    fs, fresh = file_system(spark, building)
    fs.delete(fresh, True)
    for name in names:
        spark.read.parquet(f"{folder}/{name}").write.parquet(f"{building}/{name}")
    move(fs, fresh, file_system(spark, f"{folder}/{_HISTORY}/{version}")[1])
    return version


def read_version(spark: SparkSession, folder: str, version: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{_HISTORY}/{version}/{name}")
