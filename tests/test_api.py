from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.__main__ import main, parser
from gridloom.api import VIEWS, Database, grid_end
from gridloom.plans import search, views
from gridloom.plans.library import CURATED, STAR, Library
from gridloom.sources.sinks import publish_all
from gridloom.sources.tables import exists, read_or_empty


@pytest.fixture(scope="module")
def star(spark, sf):
    return Library.from_star(spark, sf)


@pytest.fixture(scope="module")
def folder(spark, star, tmp_path_factory):
    """The star schema's roles as curated tables."""
    path = str(tmp_path_factory.mktemp("curated"))
    for role, (name, _) in CURATED.items():
        getattr(star, role).write.parquet(f"{path}/{name}.parquet")
    return path


def rows(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def test_search_and_stats_over_curated_tables(spark, star, folder):
    db = Database.open(spark, folder, STAR)
    got = db.search("high", start_date=dt.date(1996, 1, 1), official_only=True, limit=50)
    want = search.search(star, "high", start_date=dt.date(1996, 1, 1), official_only=True, limit=10_000)
    assert 0 < got.count() <= 50
    assert {int(r["record_id"]) for r in got.collect()} <= {r["record_id"] for r in want.collect()}
    assert all(r["official_status"] in ("official", "official_reprint") for r in got.collect())
    assert rows(db.stats(["year", "direction"])) == rows(search.stats(star, ["year", "direction"]))
    assert db.get("77").count() == 1 and db.get("no such record").count() == 0
    assert db.timeline(topic="PROMO").count() == search.timeline(star, topic="PROMO").count()
    with pytest.raises(ValueError):
        db.stats(["nothing"])


def test_panels_over_curated_tables(spark, star, folder):
    db = Database.open(spark, folder, STAR)
    got, want = (p.select("city_name", "year", "month", "policy_count", "urban_renewal_count") for p in (db.research.city_month_panel("1997-03", "1998-02"), search.dated(views.city_month_panel(star), "1997-03", "1998-02")))
    assert rows(got) == rows(want) and got.count() > 0
    grid = db.research.city_month_grid("2000-01", "2000-12", first=dt.date(1998, 1, 1), last=dt.date(2001, 8, 1))
    assert grid.groupBy("city_id").count().agg(F.min("count"), F.max("count"), F.count("*")).first()[:] == (12, 12, 25)
    assert db.research.city_year_grid(first=dt.date(2001, 1, 1), last=dt.date(2000, 1, 1)).count() == 0
    window = db.research.event_window("PROMO")
    assert window.where("event_time < -12 OR event_time > 24").count() == 0
    assert window.where("event_time = 0").select("city_name").distinct().count() == window.select("city_name").distinct().count() > 0
    assert db.region_panel("city", year=1998).total.first()[0] > 0


def test_all_views_without_any_table(spark, tmp_path):
    db = Database.open(spark, str(tmp_path / "nothing"))
    for name in VIEWS:
        assert db.view(name).count() <= 1
    db.register("v_policy_master")
    assert spark.sql("SELECT * FROM v_policy_master").count() == 0
    with pytest.raises(ValueError):
        db.view("v_no_such")


def test_export_by_view_name(spark, folder, tmp_path):
    db = Database.open(spark, folder, STAR)
    path = db.export("v_policy_library_summary", str(tmp_path / "summary.parquet"))
    assert spark.read.parquet(path).count() == db.view("v_policy_library_summary").count()


def test_grid_end():
    assert grid_end(dt.date(2026, 7, 15)) == dt.date(2026, 8, 1)
    assert grid_end(dt.date(2026, 12, 2)) == dt.date(2027, 1, 1)
    assert grid_end(dt.date(2026, 7, 1)) == dt.date(2026, 7, 1)


def test_command_line(capsys):
    args = parser().parse_args(["data", "search", "word", "--start", "2020-01-01", "--topic", "a", "--topic", "b"])
    assert args.start == dt.date(2020, 1, 1) and args.topic == ["a", "b"]
    main(["data", "views"])
    assert "v_city_month_policy_panel" in capsys.readouterr().out


def test_read_or_empty(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert not exists(spark, path)
    assert read_or_empty(spark, path, "a string, b int").count() == 0
    spark.createDataFrame([(1, "x")], "a int, other string").write.parquet(path)
    assert [tuple(r) for r in read_or_empty(spark, path, "a string, b int").collect()] == [("1", None)]


def test_publish_all_changes_every_table_or_none(spark, tmp_path):
    a, b, manifest = (str(tmp_path / n) for n in ("a", "b", "manifest"))
    table = lambda *keys: spark.createDataFrame([(k,) for k in keys], "k int")
    publish_all({a: (table(1, 2), "k"), b: (table(3), "k")}, manifest)
    assert {r["state"] for r in spark.read.json(manifest).collect()} == {"committed"}
    with pytest.raises(ValueError):
        publish_all({a: (table(7), "k"), b: (table(8, 8), "k")}, manifest)
    assert sorted(r["k"] for r in spark.read.parquet(a).collect()) == [1, 2]
    assert [r["k"] for r in spark.read.parquet(b).collect()] == [3]


def test_views_over_other_curated_tables(spark, folder, tmp_path):
    import shutil

    there = f"{tmp_path}/curated"
    shutil.copytree(folder, there)
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{there}/{name}.parquet")
    put("quantitative_measures", [("R1", 2.5)], "record_id string, value double")
    put("policy_features", [("R1", "f", "v", "A1"), (None, "f", "w", "A2"), (None, "f", "x", "A3")], "record_id string, feature_name string, feature_value string, source_cell string")
    put("auto_t4_links", [("A2", "R2")], "source_cell string, record_id string")
    put("source_sheet_collections", [("sheet 1", "c", "primary"), ("nowhere", "c", "primary"), ("sheet 1", "d", "secondary")], "source_sheet string, collection_code string, mapping_role string")
    db = Database.open(spark, there, STAR)
    assert db.view("v_policy_quantitative_measures").first()[:] == ("R1", 2.5)
    assert {(r["source_cell"], r["record_id"], r["link_source"]) for r in db.view("v_policy_features_resolved").collect()} == {("A1", "R1", "curated"), ("A2", "R2", "deterministic_auto_match"), ("A3", None, "curated")}
    coverage = {r["source_sheet"]: r["staging_cell_count"] for r in db.view("v_source_collection_coverage").collect()}
    assert set(coverage) == {"sheet 1", "nowhere"} and coverage["nowhere"] == 0
    assert db.view("v_white_list_events").count() == 0 == db.view("v_psl_financing_events").count()
    assert db.view("v_city_year_policy_panel_105").count() > 0
    with pytest.raises(Exception, match="(?i)path.not.found|not exist"):
        db.view("v_policy_relations").count()
    with pytest.raises(ValueError, match="unknown view"):
        Database(db.lib).view("v_policy_relations")
