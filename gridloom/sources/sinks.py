"""Writing: export by suffix, a file for each row, nested columns made safe for CSV, releases with a manifest, and publishing
in one step."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.sources.tables import file_hashes


def csv_safe(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields])


def stata_names(columns: Iterable[str]) -> dict[str, str]:
    """Names of at most 32 letters, digits and underscores; where two become the same, the later one gets a number."""
    out: dict[str, str] = {}
    for c in columns:
        base = name = re.sub(r"[^a-zA-Z0-9_]", "_", c)[:32]
        i = 1
        while name in out.values():
            i += 1
            name = f"{base[: 32 - len(str(i)) - 1]}_{i}"
        out[c] = name
    return out


def export(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write as the suffix says: csv, parquet, jsonl or ndjson, each as a folder of parts."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        csv_safe(df).write.mode(mode).option("header", True).csv(path)
    elif suffix == "parquet":
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    elif suffix in ("jsonl", "ndjson", "json"):
        df.write.mode(mode).json(path)
    else:
        raise ValueError(f"unsupported export: {suffix}")
    return path


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


#: Folders that ``write_files`` deals files to: enough for Spark to list them in tasks.
FOLDERS = 256


def _is_reached(uri: str) -> bool:
    try:
        stores.FileSystem.from_uri(uri)
    except (pa.ArrowException, ValueError, OSError):
        return False
    return True


def write_files(df: DataFrame, folder: str) -> None:
    """A file in ``folder`` for each row of ``df(name string, text string)``, of the text and a newline. Names are unique and have
    no slash. The files are all there when this returns; a task that is run again writes its own anew.

    Spark's writers make a folder for each value, start processes for each file's rights, and the driver moves all of
    them. So tasks put the files into ``FOLDERS`` folders themselves, where Arrow reaches the store; elsewhere Spark writes
    them, each in a folder that has its name.
    """
    fs, path = file_system(df.sparkSession, folder)
    uri = re.sub("^file:/+", "/", fs.makeQualified(path).toString())
    given = df.select("name", F.coalesce("text", F.lit("")).alias("text"))
    if not _is_reached(uri):
        given.write.partitionBy("name").text(folder)
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = stores.FileSystem.from_uri(uri)
        made = set()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                inside = f"{root}/{zlib.crc32(name.encode()) % FOLDERS:03d}"
                if inside not in made:
                    store.create_dir(inside)
                    made.add(inside)
                with store.open_output_stream(f"{inside}/{name}") as file:
                    file.write(text + b"\n")
            yield pa.RecordBatch.from_pydict({"files": [batch.num_rows]})

    fs.mkdirs(path)
    given.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, "files long").write.format("noop").mode("overwrite").save()


def move(fs, here, there) -> None:
    if not fs.rename(here, there):
        raise OSError(f"{here} could not be renamed to {there}")


def _swap(spark: SparkSession, path: str) -> None:
    """Put the new table beside ``path`` in its place. At every step the old table or the new one is there, the old one
    perhaps under ``.old``; calling this again goes on where it stopped."""
    fs, here = file_system(spark, path)
    _, fresh = file_system(spark, f"{path}.building")
    _, old = file_system(spark, f"{path}.old")
    if fs.exists(fresh):
        if fs.exists(here):
            fs.delete(old, True)
            move(fs, here, old)
        move(fs, fresh, here)
    elif not fs.exists(here) and fs.exists(old):
        move(fs, old, here)
    fs.delete(old, True)


def publish(df: DataFrame, path: str, checks: Iterable[Callable[[DataFrame], bool]] = ()) -> None:
    """Replace a table at ``path``: written beside it, read back, checked, then renamed. If a check fails, the old table
    stays as it is."""
    spark = df.sparkSession
    building = f"{path}.building"
    df.write.mode("overwrite").parquet(building)
    written = spark.read.parquet(building)
    for check in checks:
        if not check(written):
            fs, fresh = file_system(spark, building)
            fs.delete(fresh, True)
            raise ValueError(f"{path}: a check of the new table failed")
    _swap(spark, path)


def _note(spark: SparkSession, manifest: str, paths: Iterable[str], state: str) -> None:
    fresh = f"{manifest}.new"
    spark.createDataFrame([(path, state) for path in paths], "path string, state string").coalesce(1).write.mode("overwrite").json(fresh)
    fs, here = file_system(spark, manifest)
    fs.delete(here, True)
    move(fs, file_system(spark, fresh)[1], here)


def finish_publish(spark: SparkSession, manifest: str) -> bool:
    """Finish a swap of ``publish_all`` that broke off, as its manifest says; whether there was one. To be called before
    the tables are read again."""
    fs, here = file_system(spark, manifest)
    if not fs.exists(here):
        return False
    paths = [r["path"] for r in spark.read.schema("path string, state string").json(manifest).where("state = 'prepared'").collect()]
    for path in paths:
        _swap(spark, path)
    if paths:
        _note(spark, manifest, paths, "committed")
    return bool(paths)


def publish_all(tables: Mapping[str, tuple[DataFrame, str]], manifest: str) -> None:
    """Replace several tables (path: rows and their key) together. All are written beside the old ones and checked first:
    a key that is null or repeats stops it before any table changes. ``manifest`` says which tables are meant and whether
    the swap is ``prepared`` or ``committed``; ``finish_publish`` ends one that broke off in between, and so does this."""
    spark = next(iter(tables.values()))[0].sparkSession
    finish_publish(spark, manifest)
    for path, (df, key) in tables.items():
        building = f"{path}.building"
        df.write.mode("overwrite").parquet(building)
        n, filled, distinct = spark.read.parquet(building).agg(F.count("*"), F.count(key), F.count_distinct(key)).first()
        if not n == filled == distinct:
            raise ValueError(f"{path}: {n} rows, {filled} keys, {distinct} different ones")
    _note(spark, manifest, tables, "prepared")
    for path in tables:
        _swap(spark, path)
    _note(spark, manifest, tables, "committed")


def release(spark: SparkSession, views: Mapping[str, DataFrame], path: str) -> DataFrame:
    """A release that is never changed: each view as Parquet and CSV, and a manifest with size and hash of every file.

    All of it is written beside ``path`` and renamed last, so a release that is there is whole; what a stopped run has left
    beside it is cleared first.
    """
    fs, here = file_system(spark, path)
    if fs.exists(here):
        raise FileExistsError(path)
    building = f"{path.rstrip('/')}.building"
    _, fresh = file_system(spark, building)
    fs.delete(fresh, True)
    for name, df in views.items():
        df.write.option("compression", "zstd").parquet(f"{building}/parquet/{name}")
        csv_safe(df).write.option("header", True).csv(f"{building}/csv/{name}")
    hashed = file_hashes(spark, building)
    inside = F.concat(F.lit(f"{path.rstrip('/')}/"), F.substring_index("path", ".building/", -1))
    hashed.withColumn("path", inside).write.json(f"{building}/manifest")
    move(fs, fresh, here)
    return spark.read.schema(hashed.schema).json(f"{path}/manifest")
