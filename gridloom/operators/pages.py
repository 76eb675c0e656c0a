"""Web pages: text, blocks and links from HTML, merging of broken blocks, completeness, source health.

HTML is read by a small stdlib helper (``html.py``), one page at a time inside an Arrow pass; everything after it is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.urls import absolute_url, authority, canonical_url
from gridloom.operators.html import read_page
from gridloom.operators.keyed import top_k

#: Punctuation that ends a block.
END_PUNCTUATION = "。！？；.!?;：:"
#: Endings of attached files, and the word that marks them.
ATTACHMENT_SUFFIXES = [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".zip", ".rar"]
ATTACHMENT_WORD = "附件"
BLOCK = "struct<text:string,kind:string,page:int>"
LINK = "struct<href:string,label:string,is_next:boolean,date_hint:date,skipped:boolean>"
PAGE = f"page_id long, url string, title string, blocks array<{BLOCK}>, loose string, links array<{LINK}>, dynamic boolean"


_LINK = pa.struct([("href", pa.string()), ("label", pa.string()), ("is_next", pa.bool_()), ("date_hint", pa.date32()), ("skipped", pa.bool_())])
_BLOCK = pa.struct([("text", pa.string()), ("kind", pa.string()), ("page", pa.int32())])


def parse_pages(pages: DataFrame) -> DataFrame:
    """``PAGE`` rows for pages(page_id, url, html)."""

    def run(batches):
        for batch in batches:
            found = [read_page(h) for h in batch.column(2).to_pylist()]
            if not found:
                continue
            blocks = [[{"text": text, "kind": kind, "page": 1} for text, kind in p.blocks] for p in found]
            columns = [
                batch.column(0), batch.column(1), pa.array([p.title for p in found], pa.string()), pa.array(blocks, pa.list_(_BLOCK)), pa.array([p.loose for p in found], pa.string()),
                pa.array([[vars(link) for link in p.links] for p in found], pa.list_(_LINK)), pa.array([p.dynamic for p in found]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "title", "blocks", "loose", "links", "dynamic"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, PAGE)


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once, as a lambda's variable, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def merge_blocks(blocks: Column, min_chars: int = 24) -> Column:
    """struct(blocks, repairs) of an array of (text, kind, page): a block joins the one before if that does not end a
    sentence (or the sentence goes on over a page), or if one of them is short; headings start anew, and tables are not
    joined for being short.

    The fold carries the length and the end of the block that is open and marks each block as a start, joined or joined by
    a new line; texts are put together once, run by run.
    """
    cleaned = F.filter(F.transform(blocks, lambda b: F.struct(F.btrim(F.regexp_replace(F.replace(b["text"], F.lit("\r"), F.lit("")), "[ \\t\u3000]+", " "), F.lit(" \n")).alias("text"), b["kind"].alias("kind"), b["page"].alias("page"))), lambda b: b["text"] != "")
    empty = F.struct(F.array().cast("array<int>").alias("marks"), F.lit(0).alias("length"), F.lit("").alias("end"), F.lit(None).cast("int").alias("page"))

    def step(acc: Column, b: Column) -> Column:
        cross = F.coalesce(b["page"] != acc["page"], F.lit(False))
        runs_on = ~F.contains(F.lit(END_PUNCTUATION), acc["end"])
        short = (F.char_length(b["text"]) < min_chars) | (acc["length"] < min_chars)
        heading = F.coalesce(b["kind"] == "heading", F.lit(False))
        sentence = ~heading & (runs_on | (cross & short))
        joined = sentence | (short & ~F.coalesce(b["kind"].isin("heading", "table"), F.lit(False)))
        mark = F.when((acc["length"] == 0) | ~joined, 0).when(sentence, 1).otherwise(2)
        return _bound(mark, lambda m: F.struct(
            F.concat(acc["marks"], F.array(m)).alias("marks"), (F.when(m == 0, 0).otherwise(acc["length"] + m - 1) + F.char_length(b["text"])).alias("length"),
            F.right(b["text"], F.lit(1)).alias("end"), F.when(m == 0, b["page"]).otherwise(acc["page"]).cast("int").alias("page")))

    def put(c: Column, marks: Column) -> Column:
        pieces = F.zip_with(c, marks, lambda b, m: F.concat(F.when(m == 2, "\n").otherwise(""), b["text"]))
        starts = F.filter(F.sequence(F.lit(1), F.size(c)), lambda i: F.get(marks, i - 1) == 0)
        run = lambda x, s, k: F.struct(F.array_join(F.slice(x["pieces"], s, F.coalesce(F.get(x["starts"], k + 1), F.size(c) + 1) - s), "").alias("text"), F.get(c, s - 1)["kind"].alias("kind"), F.get(c, s - 1)["page"].alias("page"))
        return _bound(F.struct(pieces.alias("pieces"), starts.alias("starts")), lambda x: F.struct(F.transform(x["starts"], lambda s, k: run(x, s, k)).alias("blocks"), (F.size(c) - F.size(x["starts"])).alias("repairs")))

    none = F.struct(F.array().cast(f"array<{BLOCK}>").alias("blocks"), F.lit(0).alias("repairs"))
    return _bound(cleaned, lambda c: F.when(F.size(c) == 0, none).otherwise(_bound(F.aggregate(c, empty, step)["marks"], lambda marks: put(c, marks))))


def completeness(text: Column, title: Column) -> Column:
    share = F.least(F.lit(1.0), F.char_length(text) / F.lit(800.0))
    return F.round(F.when(F.coalesce(F.contains(text, title), F.lit(False)), F.least(F.lit(1.0), share + F.lit(0.1))).otherwise(share), 4)


def page_records(parsed: DataFrame) -> DataFrame:
    """One row per page: merged text, or the loose text where no block has any, number of blocks and repairs, completeness, parse status."""
    merged = parsed.withColumn("m", merge_blocks(F.col("blocks")))
    joined = F.array_join(F.transform("m.blocks", lambda b: b["text"]), "\n\n")
    text = F.when(joined == "", F.coalesce("loose", F.lit(""))).otherwise(joined)
    full = merged.select("page_id", "url", "title", text.alias("full_text"), F.size("m.blocks").alias("n_blocks"), F.col("m.repairs").alias("n_repairs"), "dynamic")
    return full.withColumn("completeness_score", completeness(F.col("full_text"), F.col("title"))).withColumn("parse_status", F.when(F.char_length("full_text") >= 40, "parsed").otherwise("partial"))


#: Link words and file endings that lead to no document.
SKIP_WORDS = ["登录", "注册", "首页", "javascript:", "mailto:", "#"]
SKIP_SUFFIXES = [".jpg", ".jpeg", ".png", ".gif", ".css", ".js", ".zip", ".rar"]


def page_links(parsed: DataFrame) -> DataFrame:
    """Links to other pages of the same host: (page_id, page, from_url, pos, target, canonical_url, title_hint, is_next,
    date_hint); ``page`` is the canonical URL of the page they are on."""
    links = parsed.select("page_id", F.col("url").alias("from_url"), canonical_url(F.col("url")).alias("page"), F.posexplode("links").alias("pos", "link")).select("page_id", "from_url", "page", "pos", "link.*")
    skip = F.lit(False)
    for w in SKIP_WORDS:
        skip = skip | F.contains(F.lower("href"), F.lit(w)) | F.contains("label", F.lit(w))
    there = links.where((F.col("href") != "") & ~skip).withColumn("target", absolute_url(F.col("from_url"), F.col("href")))
    there = there.where(authority(F.col("target")) == authority(F.col("from_url")))
    path = F.lower(F.regexp_replace("target", "[?#].*$", ""))
    for s in SKIP_SUFFIXES:
        there = there.where(~path.endswith(s))
    named = there.withColumn("canonical_url", canonical_url(F.col("target"))).where(F.col("canonical_url") != F.col("page"))
    return named.select("page_id", "page", "from_url", "pos", "target", "canonical_url", F.nullif("label", F.lit("")).alias("title_hint"), "is_next", "date_hint")


def discover_links(parsed: DataFrame) -> DataFrame:
    """Links of each page to other pages of its host, each canonical URL once, the first one found."""
    return top_k(page_links(parsed), ["canonical_url"], [F.asc("page_id"), F.asc("pos")]).select("canonical_url", "page_id", "target", "title_hint")


def attachments(parsed: DataFrame) -> DataFrame:
    """Links that lead to attached files, outside navigation: (page_id, href, label, attachment_url)."""
    links = parsed.select("page_id", "url", F.explode("links").alias("link")).select("page_id", "url", "link.*").where("NOT skipped")
    path, is_file = F.lower(F.regexp_replace("href", "[?].*$", "")), F.lit(False)
    for s in ATTACHMENT_SUFFIXES:
        is_file = is_file | path.endswith(s)
    found = links.where((F.col("href") != "") & (is_file | F.contains("label", F.lit(ATTACHMENT_WORD))))
    label = F.when(F.col("label") == "", F.col("href")).otherwise(F.col("label"))
    return found.select("page_id", "url", "href", label.alias("label"), absolute_url(F.coalesce("url", F.lit("")), F.col("href")).alias("attachment_url"))


def health_score(official: Column, accessible: Column, has_links: Column, body_ok: Column, listed: Column) -> Column:
    """struct(score, recommended) of a source, out of 100."""
    points = sum((F.when(c, w).otherwise(0.0) for c, w in ((official, 25.0), (accessible, 25.0), (has_links, 20.0), (body_ok, 20.0), (listed, 10.0))), F.lit(0.0))
    return F.struct(points.alias("score"), (official & accessible & body_ok & has_links & (points >= 80)).alias("recommended"))
