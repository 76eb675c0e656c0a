from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.sources import sinks, tables
from gridloom.sources.keyed_table import KeyedTable
from gridloom.streaming import events as streams


def test_contract_csv(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("code", T.StringType()), T.StructField("n", T.IntegerType())])
    path = tmp_path / "c.csv"
    path.write_text("id,code,n\na,110000,1\nb,220000,\n", encoding="utf-8")
    six = (F.col("code").rlike(r"^\d{6}$"), "a code has six digits")
    assert [tuple(r) for r in tables.read_contract_csv(spark, str(path), schema, "id", 2, six).collect()] == [("a", "110000", 1), ("b", "220000", None)]
    for bad, text in ((3, "id,code,n\na,110000,1\n"), (2, "id,code,n\na,110000,1\na,110001,1\n"), (1, "id,code,n\na,11,1\n")):
        path.write_text(text, encoding="utf-8")
        with pytest.raises(ValueError):
            tables.read_contract_csv(spark, str(path), schema, "id", bad, six)


def test_register_merge_stack_preview(spark, sf, tmp_path):
    tables.register(spark, sf, ["region", "nation"])
    assert spark.sql("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").first()[0] == 25
    spark.range(2).withColumn("a", F.lit(1)).write.parquet(f"file://{tmp_path}/x")
    spark.range(3).withColumn("b", F.lit(2)).write.parquet(f"file://{tmp_path}/y")
    merged = tables.read_merged(spark, f"file://{tmp_path}/x", f"file://{tmp_path}/y")
    assert sorted(merged.columns) == ["a", "b", "id"] and merged.count() == 5
    n, head = tables.preview(merged, F.col("b") == 2, 2)
    assert n.first()["n"] == 3 and head.count() == 2


def test_guarded(spark):
    df = spark.range(3)
    assert tables.guarded(df, (F.col("id") >= 0, "no negative id")).count() == 3
    with pytest.raises(Exception, match="small ids only"):
        tables.guarded(df, (F.col("id") < 2, "small ids only")).collect()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], {"k": 1}, "x,\"y\"")], "id int, list array<string>, m map<string,int>, s string")
    sinks.export(df, f"file://{tmp_path}/o.csv")
    back = spark.read.csv(f"file://{tmp_path}/o.csv", header=True).first()
    assert json.loads(back["list"].replace('\\"', '"')) == ["a", "b"]
    sinks.export(df, f"file://{tmp_path}/o.jsonl")
    assert spark.read.json(f"file://{tmp_path}/o.jsonl").first()["list"] == ["a", "b"]
    names = sinks.stata_names(["x" * 40, "x" * 41, "a b"])
    assert len(set(names.values())) == 3 and all(len(n) <= 32 for n in names.values())
    with pytest.raises(ValueError):
        sinks.export(df, "x.what")


def test_publish_and_release(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    sinks.publish(spark.range(3), path)
    sinks.publish(spark.range(5), path, [lambda d: d.count() == 5])
    with pytest.raises(ValueError):
        sinks.publish(spark.range(1), path, [lambda d: d.count() == 2])
    assert spark.read.parquet(path).count() == 5
    sinks.release(spark, {"one": spark.range(2)}, f"file://{tmp_path}/r")
    with pytest.raises(FileExistsError):
        sinks.release(spark, {"one": spark.range(2)}, f"file://{tmp_path}/r")
    assert tables.file_hashes(spark, f"file://{tmp_path}/r/parquet").where("length(sha256) = 64").count() > 0


def test_streams(spark, tmp_path):
    rows = [(i % 6, dt.datetime(2024, 1, 1, i % 24), "a", float(i)) for i in range(12)]
    schema = "event_id long, ts timestamp, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in")
    streams.deduplicated(stream, delay="10 days").writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/s1").trigger(availableNow=True).start(f"file://{tmp_path}/out").awaitTermination()
    assert spark.read.schema(schema).parquet(f"file://{tmp_path}/out").count() == 6
    for _ in range(2):  # a second run finds nothing new
        streams.upsert_stream(stream, f"file://{tmp_path}/snap", ["event_id"], "value", f"file://{tmp_path}/s2").awaitTermination()
    assert {(r["event_id"], r["value"]) for r in KeyedTable(spark, f"file://{tmp_path}/snap", ["event_id"], "value").read().collect()} == {(i, float(i + 6)) for i in range(6)}
    live = streams.tumbling(stream, width="6 hours")
    assert live.isStreaming and streams.tumbling(spark.createDataFrame(rows, schema), width="6 hours").agg(F.sum("n")).first()[0] == 12


def test_rule_sources(spark, tmp_path):
    from gridloom.sources import rules

    (tmp_path / "r.json").write_text('{"sheets": {"s": {"primary": {"collection": "a", "subcollection": "x"}, "secondary": [{"collection": "b"}]}}, "taxonomy": {"a": {"subcollections": ["x", "y"]}, "b": {}}, "rules": [{"id": 1, "collection": "a", "keywords": ["k"]}]}')
    found = rules.read_rules(spark, f"file://{tmp_path}/r.json")
    assert [tuple(r) for r in rules.sheet_mappings(spark, found["sheets"]).collect()] == [("s", "a", "x", "primary", 0), ("s", "b", None, "secondary", 1)]
    assert {tuple(r) for r in rules.taxonomy(spark, found["taxonomy"]).collect()} == {("a", "x"), ("a", "y"), ("b", None)}
    (rule,) = rules.collection_rules(found["rules"])
    assert (rule.rule_id, rule.keywords, rule.confidence, rule.gate) == ("1", ("k",), 0.8, None)


def test_a_swap_that_stops_half_way_is_finished(spark, tmp_path, monkeypatch):
    """Stopped before any rename, one table or several may be old; none is ever gone, and finishing makes all new."""
    one = lambda *k: spark.createDataFrame([(x,) for x in k], "k int")
    keys = lambda path: sorted(r["k"] for r in spark.read.parquet(path).collect())
    real = sinks.move
    for stop in range(1, 8):
        a, b, manifest = (f"file://{tmp_path}/{stop}/{n}" for n in ("a", "b", "manifest"))
        sinks.publish_all({a: (one(1), "k"), b: (one(2), "k")}, manifest)
        moves = []

        def counted(fs, here, there, moves=moves, stop=stop):
            moves.append(str(there))
            if len(moves) == stop:
                raise OSError("stopped")
            real(fs, here, there)

        monkeypatch.setattr(sinks, "move", counted)
        try:
            sinks.publish_all({a: (one(7), "k"), b: (one(8), "k")}, manifest)
        except OSError:
            pass
        monkeypatch.setattr(sinks, "move", real)
        finished = sinks.finish_publish(spark, manifest)
        assert (keys(a), keys(b)) in ([([7], [8])] if finished or len(moves) < stop or stop > 1 else [([1], [2])]), (stop, finished)
        assert not sinks.finish_publish(spark, manifest)
