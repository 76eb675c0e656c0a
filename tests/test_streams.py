from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridloom.sources import sinks
from gridloom.sources.keyed_table import KeyedTable
from gridloom.streaming import events as streams
from gridloom.streaming import versions

KEYED = "k string, seq long, v string"


def rows_of(table):
    return sorted((r["k"], r["seq"], r["v"]) for r in table.read().collect())


def test_only_touched_buckets_are_written_and_replays_are_left_alone(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "seq", buckets=16)
    with pytest.raises(FileNotFoundError):
        table.read()
    first = spark.createDataFrame([(f"k{i}", 1, "a") for i in range(200)] + [(None, 1, "none")], KEYED)
    assert table.merge(first, 0) == list(range(16))
    before = table.last()

    second = spark.createDataFrame([("k3", 2, "b"), ("k3", 3, "c"), ("k7", 0, "older"), ("new", 1, "n"), (None, 2, "null")], KEYED)
    touched = table.merge(second, 1)
    assert 1 <= len(touched) <= 4
    after = table.last()
    assert sorted(b for b in after.buckets if after.buckets[b] != before.buckets[b]) == touched
    now = {r[0]: r[1:] for r in rows_of_nullable(table)}
    assert now["k3"] == (3, "c") and now["new"] == (1, "n") and now[None] == (2, "null") and len(now) == 202
    assert now["k7"] == (0, "older")  # a batch is newer than what is there, whatever its seq

    assert table.merge(second, 1) == [] and table.last() == after  # a replay
    assert table.merge(first, 0) == [] and table.last() == after
    assert table.merge(first.limit(0), 2) == [] and table.last().buckets == after.buckets and table.last().epochs == {"batch": 2}
    assert table.merge(spark.createDataFrame([("k1", 9, "z")], KEYED), 0, writer="other") and table.last().epochs == {"batch": 2, "other": 0}


def rows_of_nullable(table):
    return [(r["k"], r["seq"], r["v"]) for r in table.read().collect()]


def test_old_commits_can_be_read_until_they_are_cleared(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "seq", buckets=2)
    commits = []
    for i in range(4):
        table.merge(spark.createDataFrame([("k", i, str(i))], KEYED), i)
        commits.append(table.last())
    assert [table.read(c).first()["v"] for c in commits] == list("0123")
    assert table.vacuum(keep=2) >= 1
    assert rows_of(table) == [("k", 3, "3")] and table.read(commits[2]).first()["v"] == "2"
    assert len(table._log()) == 2


def test_a_commit_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "seq", buckets=2)
    table.merge(spark.createDataFrame([("k", 0, "old")], KEYED), 0)

    def stop(_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(table, "_write_log", stop)
    with pytest.raises(RuntimeError):
        table.merge(spark.createDataFrame([("k", 1, "new")], KEYED), 1)
    again = KeyedTable(spark, f"file://{tmp_path}/t", ["k"], "seq", buckets=2)
    assert rows_of(again) == [("k", 0, "old")]
    assert again.merge(spark.createDataFrame([("k", 1, "new")], KEYED), 1)
    assert rows_of(again) == [("k", 1, "new")]


def test_upsert_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    folder, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    put = lambda rows: spark.createDataFrame(rows, KEYED).coalesce(1).write.mode("append").parquet(folder)
    run = lambda: streams.upsert_stream(spark.readStream.schema(KEYED).option("maxFilesPerTrigger", 1).parquet(folder), out, ["k"], "seq", f"{out}-state", 8).awaitTermination()
    put([("a", 1, "x"), ("b", 1, "x")])
    run()
    put([("a", 2, "y")])
    run()
    table = KeyedTable(spark, out, ["k"], "seq")
    assert rows_of(table) == [("a", 2, "y"), ("b", 1, "x")]
    before = table.last()
    run()
    assert table.last() == before


FETCHED = "canonical_url string, item_id string, content_hash string, retrieved_at timestamp"


def plain_versions(sightings):
    """What the same sightings give when they are taken one after the other."""
    known: dict[tuple, list] = {}
    for url, item, content, at in sightings:
        entry = known.get((url, item, content))
        if entry is None:
            entry = known[url, item, content] = [at, at, 0, any(u == url and h != content for u, _, h in known)]
        entry[0], entry[1], entry[2] = min(entry[0], at), max(entry[1], at), entry[2] + 1
    return {k: tuple(v) for k, v in known.items()}


def test_versions_in_micro_batches_equal_one_pass(spark, tmp_path):
    r = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    sightings = [(f"u{r.randrange(6)}", f"i{r.randrange(8)}", f"h{r.randrange(4)}", start + dt.timedelta(minutes=i)) for i in range(300)]
    folder, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    read = lambda: spark.readStream.schema(FETCHED).option("maxFilesPerTrigger", 1).parquet(folder)
    table = versions.versions_table(spark, out)
    got = lambda: {(x["canonical_url"], x["item_id"], x["content_hash"]): (x["first_seen_at"], x["last_seen_at"], x["times_seen"], x["is_material_change"]) for x in table.read().collect()}
    for part in range(3):  # a run for each part, which stops and goes on from the checkpoint
        rows = [*sightings[part * 100 : part * 100 + 100], (None, "i", "h", start), ("u", None, "h", start)]
        spark.createDataFrame(rows, FETCHED).coalesce(1).write.mode("append").parquet(folder)
        versions.keep_versions(read(), out, f"{out}-state").awaitTermination()
        assert got() == plain_versions(sightings[: part * 100 + 100])
    before = table.last()
    versions.keep_versions(read(), out, f"{out}-state").awaitTermination()
    assert table.last() == before


def test_two_new_hashes_of_one_batch_see_each_other(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [("u", "i", "second", at + dt.timedelta(hours=1)), ("u", "i", "first", at), ("v", "i", "first", at)]
    spark.createDataFrame(rows, FETCHED).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    versions.keep_versions(spark.readStream.schema(FETCHED).parquet(f"file://{tmp_path}/in"), f"file://{tmp_path}/out", f"file://{tmp_path}/state").awaitTermination()
    got = {(r["canonical_url"], r["content_hash"]): r["is_material_change"] for r in versions.versions_table(spark, f"file://{tmp_path}/out").read().collect()}
    assert got == {("u", "first"): False, ("u", "second"): True, ("v", "first"): False}


def test_a_release_is_whole_or_not_there(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/r"
    views = {"one": spark.range(2), "two": spark.range(3).withColumn("x", F.array("id"))}

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(sinks, "move", stop)
        with pytest.raises(OSError, match="stopped"):
            sinks.release(spark, {"left": spark.range(1), **views}, path)
    assert not (tmp_path / "r").exists() and (tmp_path / "r.building").exists()
    manifest = sinks.release(spark, views, path).collect()
    names = {p["path"].removeprefix("file:").split("/r/")[1].rsplit("/", 1)[0] for p in manifest if "part-" in p["path"]}
    assert names == {"csv/one", "csv/two", "parquet/one", "parquet/two"}  # nothing of the run that stopped
    import hashlib

    for p in manifest:
        with open("/" + p["path"].removeprefix("file:").lstrip("/"), "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == p["sha256"]
    with pytest.raises(FileExistsError):
        sinks.release(spark, views, path)
