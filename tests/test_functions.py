from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from gridloom.functions import fuzzy, numbers, text, urls
from gridloom.operators import rules


def over(spark, fn, values, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(fn(F.col("x"))).collect()]


def test_clean_text(spark):
    got = over(spark, text.clean_text, ["  武汉\t市  ", "Ａ​Ｂ  c", "　x　", "", " \t", None, "é", "ﬁ"])
    assert got == ["武汉 市", "AB c", "x", None, None, None, "é", "fi"]


def test_normalize_title(spark):
    assert over(spark, text.normalize_title, ["《关于 城市更新 的通知》", "A “b” 'C'", None]) == ["关于城市更新的通知", "abc", None]


def test_ids_and_hashes(spark):
    df = spark.createDataFrame([("a  b", None, 3)], "a string, b string, c int")
    row = df.select(text.stable_id(F.col("a"), F.col("b"), F.col("c")).alias("i"), text.content_hash(F.col("a"), F.col("b")).alias("h"), text.task_id(F.col("a"), F.col("b")).alias("t")).first()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert row["i"] == "REC_" + sha("a b||3")[:20].upper() and row["h"] == sha("a b\n") and row["t"] == "REV_" + sha("a  b|")[:24].upper()


def test_parse_date(spark):
    values = ["2024年5月17日", "on 1999-2-3.", "2024/13/40", "2024-02-30", "x", None, "12024-01-05", "1899-01-01"]
    assert over(spark, numbers.parse_date, values) == [dt.date(2024, 5, 17), dt.date(1999, 2, 3), None, None, None, None, dt.date(2024, 1, 5), None]
    assert over(spark, lambda c: numbers.parse_date(c, years="20"), ["1999-2-3", "2001.2.3"]) == [None, dt.date(2001, 2, 3)]
    assert over(spark, lambda c: numbers.parse_date(c, bounded=True), ["12024-01-05"]) == [None]
    assert over(spark, lambda c: numbers.parse_date(c, within=5), ["xx 2024-01-05"]) == [None]


def test_numbers(spark):
    assert over(spark, numbers.first_int, ["a12b3", "x", None, "9" * 30]) == [12, None, None, None]
    assert over(spark, numbers.cell_row, ["AB12", "ROW:7", "12", None]) == [12, 7, None, None]
    got = over(spark, numbers.measure, ["首付1,200.5万元", "up to 3%", "none"])
    assert [tuple(g) for g in got] == [(1200.5, "万元", "CNY"), (3.0, "%", None), (None, None, None)]
    assert over(spark, numbers.document_number, ["见京建发〔2023〕15号文", "x"]) == ["见京建发〔2023〕15号", None]


def test_urls(spark):
    assert over(spark, urls.canonical_url, ["HTTPS://WWW.GOV.CN/a/?utm_source=x&b=2#part", "https://x.org", "https://x.org/?spm=1&q=", "no url"]) == ["https://gov.cn/a?b=2", "https://x.org/", "https://x.org/?q=", "no url"]
    assert over(spark, urls.normalize_url, ["HTTPS://WWW.GOV.CN/a/?b=2&a=%E4%B8%AD&utm_x=1#p", "plain  text", "https://x.org/?q="]) == ["https://www.gov.cn/a?a=%E4%B8%AD&b=2", "plain text", "https://x.org"]
    assert over(spark, urls.is_valid_url, ["https://a.b", "http://", "ftp://a", "https://a b", "", None]) == [True, False, False, False, False, False]
    assert over(spark, urls.domain, ["https://u@WWW.a.org:80/x", "none"]) == ["a.org", ""]
    got = over(spark, lambda c: urls.classify_domain(c)["agency_type"], ["gov.cn", "x.gov.cn", "a.qq.com", "qq.com.evil.org"])
    assert got == ["central_government", "local_government", "media_or_aggregator", "unknown"]
    assert over(spark, urls.harvest, ["see https://a.org/x，and HTTP://b.org"]) == [["https://a.org/x", "HTTP://b.org"]]


def test_source_status(spark):
    rows = [("https://gov.cn/x", "传闻"), ("https://gov.cn/x", "t"), ("https://cls.cn", "t"), ("https://x.org", "t"), (None, "内部 传闻"), (None, "t")]
    df = spark.createDataFrame(rows, "u string, t string").select(urls.source_status(F.col("u"), F.col("t")).alias("s")).select("s.*")
    assert [tuple(r) for r in df.collect()] == [("rumour", 0), ("official", 5), ("authoritative_media", 3), ("general_media", 2), ("internal_unverified", 0), ("unknown", 0)]


def test_text_pieces(spark):
    assert over(spark, lambda c: text.chunks(c, 3), ["abcdefg", "", "abc"]) == [["abc", "def", "g"], [""], ["abc"]]
    assert over(spark, lambda c: text.chunks(c, 3, first=2), ["abcdefg"]) == [["abc", "def"]]
    assert over(spark, text.split_parts, ["a、 b,,c；/"]) == [["a", "b", "c"]]
    assert over(spark, text.first_line_title, ["A title long enough\nmore", "short\nx", "这是一个完整的句子。\nx", ""]) == ["A title long enough", None, None, None]
    assert over(spark, text.slug, ["T1 房地产/政策 (x)"]) == ["T1_房地产_政策_x"]
    assert over(spark, text.redact_query, ["https://a/b?key=1#x"]) == ["https://a/b"]


def test_rules(spark):
    got = over(spark, rules.classify, ["进一步放宽限购，城市更新", "其它", ""])
    assert [[t["topic"] for t in g] for g in got] == [["城市更新", "限购"], ["其他"], ["其他"]]
    assert got[0][1]["evidence_excerpt"] == "进一步放宽限购，城市更新" and got[1][0]["confidence"] == 0.5
    assert over(spark, rules.infer_direction, ["进一步放宽住房政策", "支持购房补贴", "暂停支持", "x"]) == ["loosening", "supportive", "tightening", "unknown"]


@pytest.mark.parametrize("a, b, ratio", [("this is a test", "this is a test!", 96.55172413793103), ("", "", 100.0), ("abc", "", 0.0), ("kitten", "sitting", 61.53846153846154)])
def test_indel_ratio(a, b, ratio):
    assert fuzzy.indel_ratio(a, b) == pytest.approx(ratio)


def test_fuzzy_families():
    assert fuzzy.partial_ratio("this is a test", "this is a test!") == 100
    assert fuzzy.weighted_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == pytest.approx(95)
    assert fuzzy.token_set_ratio("a b c", "c b a d") == 100
    assert 0 <= fuzzy.weighted_ratio("abc", "completely different and much longer") <= 100
    brute = lambda x, y: max(sum(1 for _ in s) for s in [[]]) if not x or not y else _lcs(x, y)
    for x, y in (("banana", "ananas"), ("政策通知", "通知政策"), ("", "x")):
        assert fuzzy.lcs_length(x, y) == brute(x, y)


def _lcs(x: str, y: str) -> int:
    row = [0] * (len(y) + 1)
    for a in x:
        new = [0]
        for j, b in enumerate(y):
            new.append(row[j] + 1 if a == b else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_partial_ratio_is_that_of_every_part(monkeypatch):
    """Parts left out by their bound are never the best, and long texts don't cost a comparison for each character."""
    import random

    from gridloom.functions.fuzzy import indel_ratio, partial_ratio

    r = random.Random(4)
    for _ in range(1500):
        alphabet = r.choice(["ab", "abc ", "abcdefgh  ", "é漢😀 a"])
        a, b = ("".join(r.choice(alphabet) for _ in range(r.randrange(1, most))) for most in (25, 60))
        a, b = sorted((a, b), key=len)
        assert partial_ratio(a, b) == max(indel_ratio(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))
    a, b = ("".join(r.choice("abcdefghijklmnop ") for _ in range(n)) for n in (300, 20_000))
    compared, common = [], fuzzy._common
    monkeypatch.setattr(fuzzy, "_common", lambda *x: compared.append(1) or common(*x))
    assert 0 < fuzzy.partial_ratio(a, b) < 80 and len(compared) < len(b) / 8


def test_ascii_texts_are_not_sent_to_python(spark, monkeypatch):
    from gridloom.functions import text

    sent = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(t):
        sent.add(t is not None)
        return t

    monkeypatch.setattr(text, "_nfkc", counted, raising=False)
    df = spark.createDataFrame([("plain",), ("Ａ",), ("é",), ("",), (None,)], "s string")
    df.select(text.nfkc(F.col("s")).alias("n")).collect()
    assert sent.value == 2
    monkeypatch.undo()
    assert [r["n"] for r in df.select(text.nfkc(F.col("s")).alias("n")).collect()] == ["plain", "A", "é", "", None]
