from __future__ import annotations

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from gridloom.operators import geography, keyed, matching, pages, review, validation, versions
from gridloom.plans import search, views
from gridloom.plans.library import HOUSING, Library


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def lib(spark, sf):
    return Library.from_star(spark, sf)


# ---- keyed ----


def test_upsert_is_idempotent_and_keeps_the_last(spark):
    old = spark.createDataFrame([("A", "pending", 1), ("B", "done", 2)], "k string, s string, seq int")
    new = spark.createDataFrame([("A", "fetched", 3, "x"), ("A", "failed", 2, "y")], "k string, s string, seq int, more string")
    once = keyed.upsert(old, new, ["k"], "seq")
    assert rows(once, "k") == [("A", "fetched", 3, "x"), ("B", "done", 2, None)]
    assert rows(keyed.upsert(once, new, ["k"], "seq"), "k") == rows(once, "k")


def test_merges(spark):
    a = spark.createDataFrame([("k", 0.9, 1), ("k", 0.9, 2), ("k", 0.5, 0)], "k string, v double, seq int")
    assert rows(keyed.best_by(a, ["k"], "v", "seq")) == [("k", 0.9, 1)]
    assert rows(keyed.best_and_margin(a.where("seq < 2"), ["k"], "v", "seq").select("seq", F.round("margin", 3))) == [(1, 0.4)]
    assert rows(keyed.best_and_margin(a.where("seq = 0"), ["k"], "v", "seq").select("margin")) == [(0.5,)]
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, n int")
    fixes = spark.createDataFrame([(1, "name", "x", 1), (1, "name", "y", 2), (2, "n", "7", 1), (3, "n", "9", 1), (2, "other", "z", 1)], "id int, field_name string, new_value string, seq int")
    once = keyed.apply_corrections(table, fixes, "id", ["name", "n"], "seq")
    assert rows(once, "id") == [(1, "y", 1), (2, "b", 7)]
    assert rows(keyed.apply_corrections(once, fixes, "id", ["name", "n"], "seq"), "id") == rows(once, "id")
    mapping = spark.createDataFrame([(1, None)], "id int, name string")
    assert rows(keyed.replace_with_default(table, mapping, "id", "name").select("id", "name"), "id") == [(1, None), (2, "b")]


def test_unique_right_side(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(Exception, match="repeats"):
        keyed.require_unique(df, ["k"]).collect()


def test_versions(spark):
    known = spark.createDataFrame([("a", "u", "h1")], "item_id string, canonical_url string, content_hash string")
    seen = spark.createDataFrame([("a", "u", "h1"), ("a", "u", "h2"), ("b", "w", "h1")], known.schema)
    got = rows(versions.detect_versions(seen, known).select("item_id", "content_hash", "version_status", "is_material_change"), "item_id", "content_hash")
    assert got == [("a", "h1", "unchanged", False), ("a", "h2", "new_version", True), ("b", "h1", "new_version", False)]


# ---- places ----

CITIES = [
    ("CITY_440100", "广州市", "广州", "广东省", "440100", "prefecture", "广州|广州市"),
    ("CITY_320500", "苏州市", "苏州", "江苏省", "320500", "prefecture", "苏州"),
    ("CITY_410100", "郑州市", "郑州", "河南省", "410100", "prefecture", "郑州|郑州市|河南省郑州市"),
    ("CITY_310000", "上海市", "上海", "上海市", "310000", "municipality", "上海|上海市"),
]
CITY = "city_id string, city_name string, city_name_short string, province_name string, city_code string, administrative_level string, aliases string"


def test_geography(spark):
    cities = spark.createDataFrame(CITIES, CITY)
    df = spark.createDataFrame(list(enumerate(["广州", "江苏省昆山市", "全国", "上海", "河南省", "某地", "广东省深圳市、苏州", "", None])), "record_id int, place string")
    got = {(r["record_id"], r["part_number"]): r for r in geography.normalize_geography(df, "place", cities).collect()}
    assert (got[0, 1]["city_name"], got[0, 1]["province_name"], got[0, 1]["match_confidence"]) == ("广州市", "广东省", 1.0)
    assert (got[1, 1]["jurisdiction_level"], got[1, 1]["parent_city_name"], got[1, 1]["city_code"]) == ("county_level_city", "苏州市", "320500")
    assert got[2, 1]["jurisdiction_level"] == "national" and got[3, 1]["city_name"] == "上海市"
    assert (got[4, 1]["jurisdiction_level"], got[4, 1]["match_confidence"]) == ("province", 0.8)
    assert got[5, 1]["needs_review"] and got[6, 1]["city_name"] == "深圳市" and got[6, 2]["city_id"] == "CITY_320500"
    assert len(got) == 8
    learned = spark.createDataFrame([("某某市", "江西省")], "city_name string, province_name string")
    one = geography.normalize_geography(spark.createDataFrame([(1, "某某市")], "record_id int, place string"), "place", cities, learned).first()
    assert (one["province_name"], one["match_confidence"], one["match_method"]) == ("江西省", 0.9, "province_city_parse")


def test_each_different_place_is_read_once(spark, monkeypatch):
    from gridloom.functions.text import clean_text

    cities, read = spark.createDataFrame(CITIES, CITY), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(t):
        read.add(1)
        return t

    monkeypatch.setattr(geography, "clean_text", lambda c: clean_text(counted(c)))
    links = spark.range(600).select(F.col("id").alias("record_id"), (F.col("id") % 3).alias("jurisdiction_id"), F.when(F.col("id") % 3 == 0, "广州").otherwise("苏州").alias("place"))
    assert geography.normalize_geography(links, "place", cities).count() == 600
    assert geography.learn_city_provinces(links, "place", cities).count() > 0
    assert read.value < 60
    twice = spark.createDataFrame([(1, "广州"), (1, "苏州")], "record_id int, place string")
    assert rows(geography.normalize_geography(twice, "place", cities).select("geography_original", "city_name"), "city_name") == [("广州", "广州市"), ("苏州", "苏州市")]


def test_scope(spark):
    cities = spark.createDataFrame(CITIES, CITY)
    df = spark.createDataFrame([(1, "河南省郑州市航空港区"), (2, "河南省"), (3, "上海"), (4, "无")], "record_id int, place string")
    got = rows(geography.match_scope_cities(df, "place", cities).select("record_id", "city_id", "confidence", "district_name", "needs_review"), "record_id")
    assert got == [(1, "CITY_410100", 0.9, "航空港区", False), (2, "CITY_410100", 0.75, None, True), (3, "CITY_310000", 1.0, None, False)]


# ---- matching and review ----


def test_candidates(spark):
    d = dt.date(2024, 5, 1)
    left = spark.createDataFrame([(1, "武汉", d, "关于优化政策的通知", None), (2, "武汉", d, None, None), (3, "武汉", None, "完全无关", "r9")], "row_number int, block string, row_date date, row_title string, linked_id string")
    right = spark.createDataFrame([("r1", "武汉", d, "关于优化政策的通知", 1), ("r2", "武汉", dt.date(2024, 8, 1), "关于优化政策的通知", 2), ("r3", "武汉", None, "关于优化政策的通知", 3), ("r9", "武汉", d, "x", 4), ("r5", "长沙", d, "关于优化政策的通知", 5)], "record_id string, block string, record_date date, record_title string, seq int")
    got = matching.match_candidates(left, right).collect()
    one = [(r["candidate_record_id"], r["match_score"]) for r in sorted(got, key=lambda r: -r["match_score"]) if r["row_number"] == 1]
    assert one[0][1] == 100.0 and {c for c, _ in one} >= {"r1", "r3"} and "r2" not in {c for c, _ in one} and "r5" not in {c for c, _ in one}
    assert [(r["candidate_record_id"], r["review_status"]) for r in got if r["row_number"] == 3] == [("r9", "approved")]
    assert all(55 <= r["match_score"] <= 100 for r in got) and max(sum(r["row_number"] == i for r in got) for i in (1, 2, 3)) <= 3


def test_source_scores(spark):
    fields = "title string, document_number string, issuing_agency string, day date, region string, text string"
    d = dt.date(2024, 1, 1)
    base = ("标题", "1号", "部", d, "北", "全文")
    cases = [base, ("标题", "2号", "部", d, "北", "全文"), ("标题", None, None, dt.date(2024, 1, 5), None, None), ("标题", "1号", "部", dt.date(2024, 6, 1), "北", "全文")]
    df = spark.createDataFrame([(i, base, c) for i, c in enumerate(cases)], f"i int, r struct<{fields.replace(' ', ':').replace(',:', ',')}>, c struct<{fields.replace(' ', ':').replace(',:', ',')}>")
    got = {r["i"]: (r["score"], r["has_conflict"]) for r in df.select("i", matching.source_score().alias("s")).select("i", "s.*").collect()}
    assert got[0] == (1.0, False) and got[1][1] and got[1][0] <= 0.69 and got[2] == (round((0.25 + 0.05) / 0.35, 4), False) and got[3][1]


def test_acceptance(spark):
    cases = [("a", 0.95, False, "official", 1), ("a", 0.5, False, "official", 2), ("b", 0.95, False, "general_media", 1), ("c", 0.95, False, "official", 1), ("c", 0.93, False, "official", 2), ("d", 0.87, False, "official_reprint", 1), ("e", 0.86, False, "official", 1), ("f", 0.99, True, "official", 1)]
    df = spark.createDataFrame(cases, "k string, score double, has_conflict boolean, official_status string, seq int")
    got = rows(matching.accept_best(df, ["k"]).select("k", "decision"), "k")
    assert got == [("a", "recover"), ("b", "low_confidence"), ("c", "candidate_conflict"), ("d", "low_confidence"), ("e", "recover"), ("f", "candidate_conflict")]


def test_source_score_meets_all_candidates(spark, tmp_path):
    """A near copy at 50 has the same day and, by its number, no document number, like the record at 0."""
    from gridloom.plans.operator_queries import QUERIES

    cases = [(0, "one title of a notice"), (8, "something else entirely"), (50, "one title of a notice"), (51, "unlike all others")]
    spark.createDataFrame(cases, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["item_id"]: r for r in QUERIES["d20_source_score"](spark, str(tmp_path)).collect()}
    assert sorted(got) == [0, 8, 50, 51]
    assert (got[0]["seq"], got[0]["margin"], got[0]["decision"]) == (0, 0.0, "candidate_conflict")
    assert got[50]["seq"] == 0 and got[50]["margin"] == 0.0


def test_verdicts(spark):
    df = spark.createDataFrame([("official", False, 0.85, True, 0.72, 0.98), ("official", True, 1.0, True, 1.0, 1.0), ("official", False, 1.0, True, 1.0, None), ("unknown", False, 0.1, False, 0.1, None)], "o string, c boolean, comp double, a boolean, f double, s double")
    got = [tuple(r) for r in df.select(review.verdict(F.col("o"), F.col("c"), F.col("comp"), F.col("a"), F.col("f"), F.col("s"), F.lit(True)).alias("v")).select("v.*").collect()]
    assert got[0][0] == "auto_verified" and got[0][1] >= 0.9
    assert got[1] == ("manual_review_required", 0.69) and got[2] == ("auto_verified", 1.0) and got[3][0] == "manual_review_required"


def test_review_tasks_are_idempotent(spark):
    records = spark.createDataFrame([(1, None, " ", "x y", "s", 3, "h"), (2, "t", "text", "https://a.b", "s", 4, "h")], "record_id int, title string, full_text string, primary_source_url string, source_sheet string, source_row int, content_hash string")
    found = review.generate([review.record_tasks(records), review.duplicate_tasks(records)])
    assert sorted(r["review_type"] for r in found.collect()) == ["duplicate_record", "duplicate_record", "invalid_url", "missing_source", "missing_title"]
    again = review.generate([review.record_tasks(records)], found.withColumn("status", F.lit("approved")))
    assert again.count() == 5 and again.where("status = 'approved'").count() == 5
    first, second = (review.listed(found, limit=2, offset=o) for o in (0, 2))
    assert not {r["task_id"] for r in first.collect()} & {r["task_id"] for r in second.collect()}
    assert review.listed(found, status="completed").count() == 0


def test_more_task_producers(spark):
    terms = spark.createDataFrame([("r", "t1", "n", 0.5), ("r", "t2", "n", 0.9)], "record_id string, term_id string, term_name string, confidence double")
    features = spark.createDataFrame([(None, "v", "s", "A1"), ("r", "v", "s", "A2")], "record_id string, feature_value string, source_sheet string, source_cell string")
    cells = spark.createDataFrame([("A1", "v", "f", "T2"), ("A2", "v", "f", "T2")], "source_cell string, cell_value string, original_field_name string, source_sheet_name string")
    cand = spark.createDataFrame([(9, "r", 88.0, "pending"), (9, "q", 70.0, "approved")], "row_number int, candidate_record_id string, match_score double, review_status string")
    flagged = spark.createDataFrame([("x", "r", "c", True), ("y", "r", "c", False)], "id string, record_id string, city_id string, needs_review boolean")
    made = review.generate([
        review.low_confidence_tasks(terms), review.unmatched_tasks(features), review.unexplained_tasks(cells, features.where("source_cell = 'A2'")), review.candidate_tasks(cand, "T4"), review.flagged_tasks(flagged, "policy_applicable_cities.city_id", "scope", "id", "city_id"),
    ])
    assert sorted((r["review_type"], r["source_cell"]) for r in made.collect()) == [("low_confidence", "t1"), ("other", "x"), ("unexplained_t2", "A1"), ("unmatched_t4", "A1"), ("unmatched_t4", "ROW:9:r")]


# ---- pages ----


def merged(spark, blocks):
    df = spark.createDataFrame([([dict(zip(("text", "kind", "page"), b, strict=True)) for b in blocks],)], f"b array<{pages.BLOCK}>")
    r = df.select(pages.merge_blocks(F.col("b")).alias("m")).first()["m"]
    return [b["text"] for b in r["blocks"]], r["repairs"]


def test_block_merge(spark):
    assert merged(spark, [("本通知自发布之日起", "text", 1), ("正式施行。", "text", 2)]) == (["本通知自发布之日起正式施行。"], 1)
    assert merged(spark, [("A sentence that is long enough here.", "text", 1), ("Short.", "text", 1)]) == (["A sentence that is long enough here.\nShort."], 1)
    assert merged(spark, [("A heading without an end", "text", 1), ("Heading", "heading", 1), ("", "text", 1)]) == (["A heading without an end", "Heading"], 0)
    assert merged(spark, []) == ([], 0)


def plain_merge(blocks, least=24):
    out, repairs = [], 0
    for text, kind, page in blocks:
        if not text:
            continue
        if not out:
            out.append([text, kind, page])
            continue
        last = out[-1]
        short = len(text) < least or len(last[0]) < least
        sentence = kind != "heading" and (last[0][-1] not in pages.END_PUNCTUATION or (page != last[2] and short))
        if sentence or (short and kind not in ("heading", "table")):
            last[0] += ("" if sentence else "\n") + text
            repairs += 1
        else:
            out.append([text, kind, page])
    return [b[0] for b in out], repairs


def test_block_merge_equals_a_plain_fold(spark):
    r = random.Random(4)
    cases = [[("".join(r.choice("ab 。") for _ in range(r.choice([0, 3, 10, 24, 40]))).strip(), r.choice(["text", "text", "heading", "table"]), r.randrange(3)) for _ in range(r.randrange(12))] for _ in range(60)]
    cases = [[(" ".join(t.split()), k, p) for t, k, p in c] for c in cases]
    df = spark.createDataFrame([(i, [dict(zip(("text", "kind", "page"), b, strict=True)) for b in c]) for i, c in enumerate(cases)], f"i int, b array<{pages.BLOCK}>")
    got = {x["i"]: ([b["text"] for b in x["m"]["blocks"]], x["m"]["repairs"]) for x in df.select("i", pages.merge_blocks(F.col("b")).alias("m")).collect()}
    assert got == {i: plain_merge(c) for i, c in enumerate(cases)}


def test_long_pages_merge_in_linear_time(spark):
    began = time.perf_counter()
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.struct(F.concat(F.lit("a block of some length that ends. "), i.cast("string")).alias("text"), F.lit("text").alias("kind"), F.lit(1).alias("page"))).alias("b"))
    m = df.select(pages.merge_blocks(F.col("b")).alias("m")).select(F.size("m.blocks"), "m.repairs").first()
    assert m[0] + m[1] == 20_000 and time.perf_counter() - began < 60


def test_matching_by_periods_equals_all_pairs(spark):
    """Periods only cut what the band refuses anyway."""
    r = random.Random(6)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(300)) if r.random() < 0.8 else None
    left = [(i, r.choice("ab"), day(), None, f"r{i}" if i % 5 == 0 else None) for i in range(60)]
    right = [(f"r{i}", r.choice("ab"), day(), None, i) for i in range(80)]
    got = matching.match_candidates(spark.createDataFrame(left, "row_number int, block string, row_date date, row_title string, linked_id string"), spark.createDataFrame(right, "record_id string, block string, record_date date, record_title string, seq int")).collect()
    want = set()
    for n, block, row_date, _, linked in left:
        scored = []
        for rid, b, d, _, seq in right:
            apart = abs((d - row_date).days) if d and row_date else None
            if b == block and (apart is None or apart <= 45):
                score = 100.0 if rid == linked else max(0.0, 100.0 - 4.0 * (apart or 0)) if row_date else 0.0
                if score >= 55:
                    scored.append((-score, seq, rid))
        want |= {(n, rid, -s) for s, _, rid in sorted(scored)[:3]}
    assert {(x["row_number"], x["candidate_record_id"], x["match_score"]) for x in got} == want


def test_pages(spark):
    html = "<html><head><title>T &amp; U</title><script>var a='<p>no</p>'</script></head><body><nav><a href='/nav'>Nav</a></nav><article><h1>Head</h1><p>First <b>bold</b> text that goes on.<p>Second<ul><li>item<li>two</ul><a href='/x/?utm_a=1#f'>X</a><a href='f.pdf'>File</a></article><a href='https://other.org/'>O</a></body></html>"
    df = spark.createDataFrame([(1, "https://a.org/p", html), (2, "https://a.org/q", None), (3, "https://a.org/r", "plain")], "page_id long, url string, html string")
    parsed = pages.parse_pages(df)
    one = parsed.where("page_id = 1").first()
    assert one["title"] == "T & U" and [b["text"] for b in one["blocks"]] == ["Head", "First bold text that goes on.", "Second", "item", "two"]
    links = {r["canonical_url"] for r in pages.discover_links(parsed).collect()}
    assert links == {"https://a.org/nav", "https://a.org/f.pdf"}  # a link with a fragment is skipped, another host too
    assert [r["href"] for r in pages.attachments(parsed).collect()] == ["f.pdf"]
    assert pages.page_records(parsed).count() == 3


# ---- views ----


def test_panel_totals(lib):
    base = views.geography_base(lib)
    assert views.city_month_panel(lib).agg(F.sum("policy_count")).first()[0] == base.count()
    assert views.city_year_panel(lib).agg(F.sum("policy_count")).first()[0] == base.count()
    grid = views.grid_panel(lib, dt.date(1998, 12, 1), dt.date(1998, 1, 1))
    assert grid.count() == 25 * 12 and grid.where("has_policy <> (policy_count > 0)").count() == 0
    confirmed = views.scope_cities(lib, dt.date(1998, 1, 1)).where("NOT needs_review AND record_date < DATE'1999-01-01'")
    assert grid.agg(F.sum("policy_count")).first()[0] == confirmed.select("record_id", "city_id").distinct().count()


def test_record_with_two_codes_counts_once_but_adds_twice(lib):
    both = lib.geographies.where("record_id = 3").withColumn("city_code", F.lit("other"))
    twice = Library(**{**lib.__dict__, "geographies": lib.geographies.unionByName(both)})
    a, b = views.city_month_panel(lib), views.city_month_panel(twice)
    assert a.agg(F.sum("policy_count")).first()[0] == b.agg(F.sum("policy_count")).first()[0]
    strength = views.geography_base(lib).where("record_id = 3").first()["policy_strength"]
    assert b.agg(F.sum("policy_strength_sum")).first()[0] == pytest.approx(a.agg(F.sum("policy_strength_sum")).first()[0] + strength)


def test_housing_measures(lib):
    assert HOUSING.purchase_restriction == ("限购",) and len(HOUSING.urban_renewal) == 4


def test_search(lib):
    assert search.search(lib, limit=7).count() == 7
    assert search.search(lib, official_only=True, limit=10_000).where("official_status NOT IN ('official', 'official_reprint')").count() == 0
    assert "full_text" not in search.search(lib, include_full_text=False).columns
    with pytest.raises(ValueError):
        search.stats(lib, ["nothing"])
    with pytest.raises(ValueError):
        search.region_panel(lib, "moon")
    assert search.get(lib, -1).count() == 0
    one = search.region_panel(lib, "city", province="NOWHERE")
    assert one.ranking.count() == 0 and one.total.first()["total"] == 0
    pages_ = [search.region_panel(lib, "city", limit=10, offset=o).ranking for o in (0, 10)]
    assert not {r["region"] for r in pages_[0].collect()} & {r["region"] for r in pages_[1].collect()}


def test_pushdown(lib):
    plan = search.search(lib, start_date=dt.date(1998, 1, 1), direction=["loosening"])._jdf.queryExecution().executedPlan().toString()
    assert "o_orderdate" in plan and "PushedFilters: [IsNotNull(o_custkey)" in plan
    narrow = search.search(lib, include_full_text=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Full text of order" not in narrow


def test_validation(lib):
    got = validation.passed(validation.report(lib, "sheet 1"), F.col("city_count") == 25, F.col("record_count") > 0).first()
    assert got["passed"] and not validation.passed(validation.report(lib, "sheet 1"), F.col("city_count") == 105).first()["passed"]


# ---- ingest and decisions ----


def test_directory_ingest(spark):
    from gridloom.operators import ingest

    rows_ = [(2, "2024年5月17日", "穗", "《关于 限购 的通知》", "供给侧", "放宽", "正文 征求意见", "https://gov.cn/a/", "n"), (3, None, None, None, None, None, None, None, None), (4, "bad", "全国", "标题", None, None, None, None, None)]
    df = spark.createDataFrame(rows_, "source_row int, raw_date string, geography string, title string, category string, summary string, full_text string, url string, notes string")
    out = ingest.directory_records(df, spark.createDataFrame([("穗", "广州市")], "name string, standard string"), "T1")
    got = {r["source_row"]: r for r in out.records.collect()}
    assert set(got) == {2, 4}
    assert got[2]["record_date"] == dt.date(2024, 5, 17) and got[2]["title_normalized"] == "关于限购的通知" and got[2]["official_status"] == "consultation_draft" and got[2]["status"] == "consultation"
    assert got[2]["direction"] == "loosening" and got[2]["primary_source_url"] == "https://gov.cn/a" and got[4]["manual_review_status"] == "pending" and got[4]["official_level"] == "central"
    assert {(r["jurisdiction_name"], r["match_method"]) for r in out.jurisdictions.collect()} == {("广州市", "alias"), ("全国", "exact")}
    assert {r["term_name"] for r in out.terms.collect()} == {"限购", "其他"} and out.legacy.count() == 1


def test_sheet_ingest(spark):
    from gridloom.operators import ingest

    cells = [("T7 中央经济工作会议", 5, [None, "2019-03-04", "http://gov.cn/x", "a title of some length", "放宽"]), ("T5 供给侧措施", 6, ["短", None, None, None, None])]
    df = spark.createDataFrame(cells, "sheet string, row int, cells array<string>")
    got = {r["source_row"]: r for r in ingest.sheet_records(df, spark.createDataFrame(ingest.SHEET_KINDS, "sheet string, record_type string")).collect()}
    assert (got[5]["title"], got[5]["status"], got[5]["official_level"], got[5]["record_type"], got[5]["official_status"]) == ("2019-03-04", "historical", "central", "meeting_statement", "official")
    assert got[6]["title"] == "T5 供给侧措施第6行" and got[6]["record_date"] is None and got[6]["full_text"] == "短"


def test_decisions(spark):
    made = spark.createDataFrame([("t1", "1", "f", "old", None, None, "pending"), ("t2", "1", "f", "old", "s", None, "pending"), ("t3", "2", "f", "o", None, None, "pending")], "task_id string, record_id string, field_name string, old_value string, suggested_value string, evidence_url string, status string")
    chosen = spark.createDataFrame([("t1", "rejected", None, "r", None, None, 1), ("t1", "corrected", "new", "r", None, "u", 2), ("t2", "approved", None, "r", None, None, 1)], "task_id string, decision string, new_value string, reviewer string, review_note string, evidence_url string, seq int")
    after, log = review.decide(made, chosen)
    got = {r["task_id"]: (r["status"], r["suggested_value"], r["evidence_url"], r["decided_status"]) for r in after.collect()}
    assert got == {"t1": ("corrected", "new", "u", "auto_verified"), "t2": ("approved", "old", None, "auto_verified"), "t3": ("pending", None, None, None)}
    assert log.count() == 2
    records = spark.createDataFrame([(1, "unreviewed"), (2, "unreviewed"), (3, "unreviewed")], "record_id int, manual_review_status string")
    assert rows(review.reviewed_records(records, after), "record_id") == [(1, "reviewed"), (2, "unreviewed"), (3, "unreviewed")]
    for bad in (("t1", "maybe", None), ("t1", "corrected", None)):
        with pytest.raises(Exception, match="unsupported decision"):
            review.decide(made, spark.createDataFrame([(*bad, "r", None, None, 1)], chosen.schema))[0].collect()


def test_learned_provinces(spark):
    cities = spark.createDataFrame(CITIES, CITY)
    df = spark.createDataFrame([("江西省赣州市",), ("江西省赣州市章贡区",), ("江西省某市",), ("湖南省某市",)], "place string")
    got = dict(rows(geography.learn_city_provinces(df, "place", cities)))
    assert got["赣州市"] == "江西省" and "某市" not in got and got["广州市"] == "广东省"
