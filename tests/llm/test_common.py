from __future__ import annotations

import pyarrow as pa
import pytest

from gridloom.llm import common


def test_lookup_splits_heavy_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_ROWS", 50)
    monkeypatch.setattr(common, "HEAVY_KEYS", 4)
    left = spark.createDataFrame([(k, "x", i) for i in range(900) for k in [(i % 3) and i % 40]], "k long, b string, i long")
    counts = left.groupBy("k", "b").count().withColumnRenamed("count", "n").collect()
    right = spark.createDataFrame([(r["k"], r["b"], r["n"], r["k"] * 10) for r in counts if r["k"] != 5] + [(77, "x", 0, 1)], "k long, b string, n long, v long")
    got = common.lookup(left, right, ["k", "b"], rows="n", total=900, spread=["i"])
    assert got.columns == ["k", "b", "i", "v"]
    want = sorted((r["k"], r["i"], r["k"] * 10) for r in left.collect() if r["k"] != 5)
    assert sorted((r["k"], r["i"], r["v"]) for r in got.collect()) == want


def test_scratch_needs_a_shared_folder_off_one_machine():
    class Session:
        def __init__(self, **conf):
            self.conf = conf

    for master, folder in (("local[4]", None), ("local", None), ("yarn", "hdfs:///shared/"), ("local-cluster[3,2,1024]", "file:///s")):
        assert common.scratch_dir(Session(**{"spark.master": master, "spark.checkpoint.dir": folder})) == (folder or "file:///tmp/checkpoints").rstrip("/")
    for master in ("yarn", "local-cluster[3,2,1024]", None):
        with pytest.raises(ValueError, match="checkpoint"):
            common.scratch_dir(Session(**{"spark.master": master}))


def test_scope_deletes_what_was_written_inside(spark):
    import os

    kept = common.written(spark.range(3), "kept")
    with common.scratch_scope(spark):
        inner = common.written(spark.range(3), "inner")
        path = inner.inputFiles()[0].removeprefix("file:").replace("///", "/")
        assert inner.count() == 3 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path)) and kept.count() == 3


def test_scopes_inside_scopes(spark):
    """What an inner scope keeps stays until the outer one ends, and what the outer one keeps stays for good."""
    with common.scratch_scope(spark) as outer:
        with common.scratch_scope(spark) as inner:
            gone = common.written(spark.range(2), "gone")
            middle = inner(spark.range(3), "middle")
        assert middle.count() == 3
        with pytest.raises(Exception, match="(?i)not exist|not found|FILE_NOT_EXIST"):
            gone.collect()
        last = outer(middle.union(middle), "last")
    assert last.count() == 6 and not common._scopes.get()
    with pytest.raises(Exception, match="(?i)not exist|not found|FILE_NOT_EXIST"):
        middle.collect()


def test_scopes_of_two_threads_leave_each_other_alone(spark):
    import os
    import threading

    both_open, first_closed = threading.Barrier(2), threading.Event()
    seen: dict[str, object] = {}
    folder = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file:").replace("///", "/"))

    def first():
        with common.scratch_scope(spark):
            both_open.wait(60)
            seen["first"] = folder(common.written(spark.range(3), "first"))
        first_closed.set()

    def second():
        with common.scratch_scope(spark):
            table = common.written(spark.range(4), "second")
            both_open.wait(60)
            first_closed.wait(60)
            seen["rows"], seen["second"] = table.count(), folder(table)

    threads = [threading.Thread(target=f) for f in (first, second)]
    outside = common.written(spark.range(5), "outside")
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert seen["rows"] == 4 and outside.count() == 5
    assert not os.path.exists(seen["first"]) and not os.path.exists(seen["second"])


def test_slices_bound_the_rows_and_leave_settings_alone(spark):
    batch = pa.RecordBatch.from_arrays([pa.array(range(600))], names=["x"])
    assert [p.num_rows for p in common.slices(iter([batch, batch.slice(0, 0)]))] == [256, 256, 88]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    assert common.map_batches(spark.range(10), lambda b: b, "id long").count() == 10
    assert spark.conf.get(key) == before
