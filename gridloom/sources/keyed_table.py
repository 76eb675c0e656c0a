"""A table of one row for each key that is kept up to date by batches: files by hash of the key, of which a batch rewrites
only those it touches, and a log of committed epochs that makes replays harmless.

Layout of the folder: ``data/`` has a folder for each commit with the buckets it wrote, ``log/`` one small JSON file for
each commit, which names the epoch, its writer and, for every bucket, the folder that holds it now. A commit is there
when its log file is: the file is renamed into place last. Readers take the last log file, so they see whole commits
only. There is one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.columns import free
from gridloom.operators.keyed import keep_last, upsert
from gridloom.sources.sinks import file_system, move

_BUCKET = "bucket"


@dataclass(frozen=True)
class Commit:
    number: int
    epochs: dict[str, int]
    buckets: dict[int, str]
    schema: T.StructType


class KeyedTable:
    """``keys`` name a row, ``seq`` orders rows of a key: the last one stays. ``buckets`` is fixed by the first commit."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], seq: str, buckets: int = 32):
        self.spark, self.path, self.keys, self.seq, self.buckets = spark, path.rstrip("/"), list(keys), seq, buckets

    def _log(self) -> list[int]:
        fs, folder = file_system(self.spark, f"{self.path}/log")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _commit(self, number: int) -> Commit:
        fs, file = file_system(self.spark, f"{self.path}/log/{number:012}.json")
        stream = fs.open(file)
        try:
            found = json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()
        return Commit(number, found["epochs"], {int(b): p for b, p in found["buckets"].items()}, T.StructType.fromJson(found["schema"]))

    def last(self) -> Commit | None:
        numbers = self._log()
        return self._commit(numbers[-1]) if numbers else None

    def read(self, commit: Commit | None = None) -> DataFrame:
        """The rows of the last commit, or of the one given."""
        commit = commit or self.last()
        if commit is None:
            raise FileNotFoundError(f"{self.path} has no commit")
        return self._rows(commit, commit.buckets)

    def _rows(self, commit: Commit, buckets: Sequence[int] | dict[int, str]) -> DataFrame:
        paths = [f"{self.path}/data/{commit.buckets[b]}" for b in buckets]
        return self.spark.read.schema(commit.schema).parquet(*paths) if paths else self.spark.createDataFrame([], commit.schema)

    def merge(self, batch: DataFrame, epoch: int, writer: str = "batch") -> list[int]:
        """Merge a batch; the buckets that were written. An epoch that ``writer`` has committed before is left alone."""
        before = self.last()
        if before and before.epochs.get(writer, -1) >= epoch:
            return []
        n = len(before.buckets) and max(before.buckets) + 1 if before else self.buckets
        bucket = free(batch, "_bucket")
        new = keep_last(batch, self.keys, self.seq).withColumn(bucket, F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int"))
        new = new.persist()
        try:
            touched = sorted(r[0] for r in new.select(bucket).distinct().collect())  # as many as there are buckets, at most
            if before and not touched:
                self._write_log(Commit(before.number + 1, {**before.epochs, writer: epoch}, before.buckets, before.schema))
                return []
            if before is None:
                touched = list(range(n))
            old = self._rows(before, touched) if before else self.spark.createDataFrame([], batch.schema)
            rows = upsert(old, new.drop(bucket), self.keys, self.seq).withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int"))
            folder = f"{epoch:012}-{uuid.uuid4().hex}"
            schema = rows.drop(_BUCKET).schema
            rows.repartition(len(touched), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{folder}")
            self._fill_gaps(schema, folder, touched)
            now = {**(before.buckets if before else {}), **{b: f"{folder}/{_BUCKET}={b}" for b in touched}}
            self._write_log(Commit(before.number + 1 if before else 0, {**(before.epochs if before else {}), writer: epoch}, now, schema))
            return touched
        finally:
            new.unpersist()

    def _fill_gaps(self, schema: T.StructType, folder: str, touched: list[int]) -> None:
        """A bucket without rows has no folder from Spark: it gets an empty one."""
        for b in touched:
            fs, there = file_system(self.spark, f"{self.path}/data/{folder}/{_BUCKET}={b}")
            fs.mkdirs(there)

    def _write_log(self, commit: Commit) -> None:
        name = f"{self.path}/log/{commit.number:012}"
        fs, fresh = file_system(self.spark, f"{name}.{uuid.uuid4().hex}.new")
        _, here = file_system(self.spark, f"{name}.json")
        stream = fs.create(fresh, True)
        try:
            stream.write(bytearray(json.dumps({"epochs": commit.epochs, "buckets": commit.buckets, "schema": json.loads(commit.schema.json())}).encode()))
        finally:
            stream.close()
        if fs.exists(here):
            raise FileExistsError(f"{name}: another writer has committed")
        move(fs, fresh, here)

    def vacuum(self, keep: int = 2) -> int:
        """Delete the log and the buckets that only commits before the last ``keep`` have; the number of folders deleted."""
        numbers = self._log()
        stay = {p.split("/")[0] for n in numbers[-keep:] for p in self._commit(n).buckets.values()}
        fs, data = file_system(self.spark, f"{self.path}/data")
        for n in numbers[:-keep]:
            fs.delete(file_system(self.spark, f"{self.path}/log/{n:012}.json")[1], True)
        gone = [f.getPath() for f in fs.listStatus(data) if f.getPath().getName() not in stay] if numbers else []
        for folder in gone:
            fs.delete(folder, True)
        return len(gone)
