from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.functions import sql
from gridloom.sources import adapters


def test_functions_by_name(spark):
    sql.register(spark)
    sql.register(spark)  # again, in the same session
    row = spark.sql("SELECT url_domain('https://me@WWW.a.org:80/x') AS d, url_domain('x') AS none, days_apart(DATE'2024-01-03', DATE'2024-01-01') AS n, first_int('No. 12 of 30') AS i, first_int('none') AS no, text_excerpt('abc word def', 'word', 2, 3) AS e, text_excerpt('x', 'word', 2, 3) AS ne").first()
    assert tuple(row) == ("a.org", "", 2, 12, None, "c word de", None)


def test_runs_of_a_whole_table(spark):
    rows = [("a", 3, "y"), ("a", 1, "x"), ("a", 2, "x"), ("a", 4, None), ("a", 5, None), ("b", 1, "x"), (None, 1, "z"), (None, 2, "z")]
    spark.createDataFrame(rows, "k string, at int, v string").repartition(3).createOrReplaceTempView("runs_in")
    sql.register(spark)
    df = spark.sql("SELECT * FROM change_runs(TABLE(runs_in), 'k', 'at', 'v')")
    assert df.dtypes == [("k", "string"), ("v", "string"), ("run_start", "int"), ("run_end", "int"), ("n_rows", "bigint")]
    want = {("a", "x", 1, 2, 2), ("a", "y", 3, 3, 1), ("a", None, 4, 5, 2), ("b", "x", 1, 1, 1), (None, "z", 1, 2, 2)}
    assert {tuple(r) for r in df.collect()} == want
    assert spark.sql("SELECT * FROM change_runs(TABLE(SELECT * FROM runs_in WHERE false), 'k', 'at', 'v')").count() == 0
    with pytest.raises(Exception, match="no column nope"):
        spark.sql("SELECT * FROM change_runs(TABLE(runs_in), 'nope', 'at', 'v')").collect()


def test_a_folder_of_files_in_batch_and_as_a_stream(spark, tmp_path):
    folder = tmp_path / "files"
    (folder / "deep").mkdir(parents=True)
    (folder / "a.html").write_text("<title>A</title><p>" + "a sentence of some length. " * 3)
    (folder / "deep" / "b.HTM").write_bytes(b"<p>bad \xff byte</p>")
    (folder / "c.txt").write_text("plain")
    adapter = adapters.DirectoryAdapter(f"file://{folder}")
    found = adapter.discover(spark)
    assert found.columns == ["source", "path", "modified_at", "length"] and {r["path"].rsplit("/", 1)[1]: r["length"] for r in found.collect()}["c.txt"] == 5
    assert adapters.DirectoryAdapter(f"file://{folder}", pattern="*.txt").discover(spark).count() == 1
    assert adapters.DirectoryAdapter(f"file://{folder}", since=(dt.datetime.now() + dt.timedelta(days=2)).isoformat(timespec="seconds")).discover(spark).count() == 0

    records = adapters.normalize(adapters.parse_html(adapter.fetch(spark)))
    got = {r["path"].rsplit("/", 1)[1]: r for r in records.collect()}
    assert set(got) == {"a.html", "b.HTM"} and got["a.html"]["title"] == "A" and got["b.HTM"]["full_text"] == "bad � byte"
    assert len({r["content_hash"] for r in got.values()}) == 2 and all(len(r["content_hash"]) == 64 for r in got.values())

    out, state = f"file://{tmp_path}/out", f"file://{tmp_path}/state"
    run = lambda: adapter.stream(spark, 1).writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    run()
    (folder / "d.txt").write_text("later")
    run()
    names = sorted(r["path"].rsplit("/", 1)[1] for r in spark.read.parquet(out).select("path").collect())
    assert names == ["a.html", "b.HTM", "c.txt", "d.txt"]  # each once


def test_small_files_are_few_micro_batches(spark, tmp_path):
    """A stream of files is bounded by bytes, unless a number of files is given."""
    folder = tmp_path / "small"
    folder.mkdir()
    for i in range(40):
        (folder / f"{i}.txt").write_text("x" * 100)
    adapter = adapters.DirectoryAdapter(f"file://{folder}")

    def batches(name, **bound):
        run = adapter.stream(spark, **bound).writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/{name}-state").trigger(availableNow=True).start(f"file://{tmp_path}/{name}")
        run.awaitTermination()
        assert spark.read.parquet(f"file://{tmp_path}/{name}").count() == 40
        return len([p for p in (tmp_path / f"{name}-state" / "commits").iterdir() if p.name.isdigit()])

    assert batches("default") == 1 and batches("bytes", bytes_at_once=1000) == 4 and batches("files", files_at_once=20) == 2


@pytest.mark.parametrize("reached", [True, False])
def test_a_file_for_each_row(spark, tmp_path, monkeypatch, reached):
    """In few folders, however many files; one after another by Spark where the store is out of reach."""
    from gridloom.sources import sinks

    if not reached:
        monkeypatch.setattr(sinks, "_is_reached", lambda uri: False)
    n, folder = (2000 if reached else 20), tmp_path / "a b%20c"
    rows = spark.range(n).select(F.concat(F.lit("f-"), "id").alias("name"), F.when(F.col("id") > 0, F.concat(F.lit("é "), "id")).alias("text"))
    sinks.write_files(rows, f"file://{folder}")
    files = [p for p in folder.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))]
    named = {(p.name if reached else p.parent.name.removeprefix("name=")): p.read_text() for p in files}
    assert len(files) == n and named == {f"f-{i}": f"é {i}\n" if i else "\n" for i in range(n)}
    if reached:
        assert len([p for p in folder.rglob("*") if p.is_dir()]) <= sinks.FOLDERS


def test_pages_that_share_an_identifier_are_files_of_their_own(spark, tmp_path):
    from gridloom.plans.crawl_queries import QUERIES

    rows = [(1, "a"), (1, "bc"), (1, "bc"), (-2, "é"), (None, "none")]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"file://{tmp_path}/pages.parquet")
    got = [(r["mode"], r["page_id"], r["length"]) for r in QUERIES["s23_directory_adapter"](spark, f"file://{tmp_path}").collect()]
    assert sorted(got, key=str) == sorted([(mode, i, len(html.encode()) + 1) for i, html in rows for mode in ("batch", "stream")], key=str)


def test_a_micro_batch_is_as_large_as_all_cores_take(spark, tmp_path):
    folder = tmp_path / "large"
    folder.mkdir()
    for i in range(3):
        with (folder / f"{i}.bin").open("wb") as file:
            file.truncate(50 << 20)
    listed = adapters.DirectoryAdapter(f"file://{folder}").stream(spark).drop("content")
    listed.writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start(f"file://{tmp_path}/out").awaitTermination()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 3
    assert len([p for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit()]) == 1


def test_small_files_are_few_tasks(spark, tmp_path):
    """A task for a few files each takes longer to start than to run."""
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(300):
        (folder / f"{i}.txt").write_text("x")
    adapter, kept = adapters.DirectoryAdapter(f"file://{folder}"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    try:
        for found in (adapter.discover(spark), adapter.fetch(spark)):
            assert found.count() == 300 and found.rdd.getNumPartitions() == adapters.TASKS_PER_CORE * 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
