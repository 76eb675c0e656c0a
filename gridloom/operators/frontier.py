"""Link discovery over several pages: from a source's list pages along "next page" links, to all other links found.

Most list pages lead to one next page and are led to by one, so they stand in runs. A run is found as a whole, by pointers
to the page before that are doubled until they reach the run's beginning: a run of a thousand pages takes ten joins. What is
walked step by step are the pages where runs meet or part, and the seeds. Each such page has, for each source, its depth and
the choices that led there (a seed, then one for each page that parts); the least of these is how a breadth-first queue
comes to it. Steps join the pages that became better with the runs that begin there, until none does; cycles end there.
Every step is a folder of its own, so lineage doesn't grow.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.urls import canonical_url
from gridloom.operators.keyed import top_k
from gridloom.sources.scratch import stored

def _runs(edges: DataFrame, heads: DataFrame) -> DataFrame:
    """(page, head, far, first): for each page of a run the head it begins after, how far behind it the page is, and the run's
    first page. ``edges(page, to_page)``; ``heads(page)`` are the pages that are in no run. Cycles without a head are
    left out: nothing leads there."""
    back = edges.join(heads.select(F.col("page").alias("to_page")), "to_page", "left_anti").join(heads.select("page", F.lit(True).alias("at_head")), "page", "left")
    state = stored(back.select(F.col("to_page").alias("page"), F.col("page").alias("head"), F.lit(1).cast("long").alias("far"), F.when(F.col("at_head"), F.col("to_page")).alias("first")), "run-pointers")
    open_ = state.where("first IS NULL")
    most, reached = state.count(), 1
    while reached <= 2 * most and not open_.isEmpty():
        ahead = state.select(F.col("page").alias("head"), F.col("head").alias("further"), F.col("far").alias("more"), F.col("first").alias("known"))
        state = stored(open_.join(ahead, "head").select("page", F.col("further").alias("head"), (F.col("far") + F.col("more")).alias("far"), F.col("known").alias("first")).unionByName(state.where("first IS NOT NULL")), "run-pointers")
        open_ = state.where("first IS NULL")
        reached *= 2
    return state.where("first IS NOT NULL")


def walk_pages(links: DataFrame, known: DataFrame, seeds: DataFrame, max_pages: int | None = None) -> DataFrame:
    """(source_id, page, page_no, depth): the pages that each source comes to, in the order of a breadth-first queue.

    ``links`` are those of ``pages.page_links``, ``known(page)`` the canonical URLs of fetched pages (others can't be
    visited), ``seeds(source_id, url, seq)`` the list pages of each source. ``max_pages`` bounds every source's pages.
    """
    there = stored(known.select("page").distinct(), "known-pages")
    nexts = links.where("is_next").groupBy("page", F.col("canonical_url").alias("to_page")).agg(F.min("pos").alias("pos"))
    nexts = stored(nexts.join(there, "page", "left_semi").join(there.select(F.col("page").alias("to_page")), "to_page", "left_semi"), "next-pages")
    starts = seeds.select(F.col("source_id").cast("string"), canonical_url(F.col("url")).alias("page"), F.col("seq").cast("long").alias("seq")).join(there, "page", "left_semi")
    starts = starts.groupBy("source_id", "page").agg(F.min("seq").alias("seq"))
    turn = F.row_number().over(Window.partitionBy("source_id").orderBy("seq", "page"))
    found = stored(starts.select("source_id", "page", F.lit(0).cast("long").alias("depth"), F.array(turn).alias("path")), "seed-pages")

    forks = nexts.groupBy("page").count().where("count > 1").select("page")
    merges = nexts.groupBy("to_page").count().where("count > 1").select(F.col("to_page").alias("page"))
    heads = stored(forks.union(merges).union(found.select("page")).distinct(), "run-heads")
    choice = F.row_number().over(Window.partitionBy("page").orderBy("pos", "to_page"))
    choices = stored(nexts.join(forks, "page", "left_semi").select(F.col("page").alias("head"), F.col("to_page").alias("first"), choice.alias("choice")), "choices")
    runs = stored(_runs(nexts.select("page", "to_page"), heads), "runs").join(choices, ["head", "first"], "left")
    to_head = nexts.select("page", "to_page").join(heads.select(F.col("page").alias("to_page")), "to_page", "left_semi")
    ends = to_head.join(runs.select("page", "head", "far", "choice"), "page").select("head", "choice", F.col("to_page").alias("to_head"), (F.col("far") + 1).alias("far"))
    direct = to_head.join(heads, "page", "left_semi").select(F.col("page").alias("head"), F.col("to_page").alias("first")).join(choices, ["head", "first"], "left")
    steps = stored(ends.unionByName(direct.select("head", "choice", F.col("first").alias("to_head"), F.lit(1).cast("long").alias("far"))), "run-ends")

    chosen = F.when(F.col("choice").isNull(), F.col("path")).otherwise(F.concat("path", F.array("choice")))
    first_of = lambda df: df.groupBy("source_id", "page").agg(F.min(F.struct("depth", "path")).alias("b")).select("source_id", "page", "b.depth", "b.path")
    best, within = found, F.lit(True) if max_pages is None else F.col("depth") < max_pages
    while not found.isEmpty():
        reached = first_of(found.join(steps, found["page"] == steps["head"]).select("source_id", F.col("to_head").alias("page"), (F.col("depth") + F.col("far")).alias("depth"), chosen.alias("path")).where(within))
        old = best.select("source_id", "page", F.struct("depth", "path").alias("old"))
        found = stored(reached.join(old, ["source_id", "page"], "left").where("old IS NULL OR struct(depth, path) < old").drop("old"), "better-pages")
        best = stored(first_of(best.unionByName(found)), "best-pages")
    inner = best.join(runs.withColumnRenamed("page", "of_run"), best["page"] == F.col("head")).select("source_id", F.col("of_run").alias("page"), (F.col("depth") + F.col("far")).alias("depth"), chosen.alias("path"))
    number = F.row_number().over(Window.partitionBy("source_id").orderBy("depth", "path"))
    walked = best.unionByName(inner).withColumn("page_no", number.cast("long"))
    if max_pages is not None:
        walked = walked.where(F.col("page_no") <= max_pages)
    return stored(walked.select("source_id", "page", "page_no", F.col("depth").cast("int").alias("depth")), "visited-pages")


def discover(links: DataFrame, visited: DataFrame, *, since: dt.date | None = None, until: dt.date | None = None, max_candidates: int | None = None) -> DataFrame:
    """(source_id, canonical_url, url, parent_url, title_hint, date_hint, depth, discovery_score): what the visited pages
    link to, each target of a source once, as it is first found. Links with a date outside the window are left out;
    ``max_candidates`` of each source are kept, the first ones found."""
    there = links.where(~F.col("is_next"))
    for bound, outside in ((since, lambda d: F.col("date_hint") < d), (until, lambda d: F.col("date_hint") > d)):
        if bound is not None:
            there = there.where(F.col("date_hint").isNull() | ~outside(F.lit(bound)))
    entry = F.struct("page_no", "page_id", "pos", F.col("target").alias("url"), F.col("from_url").alias("parent_url"), "title_hint", "date_hint", "depth")
    first = visited.join(there, "page").groupBy("source_id", "canonical_url").agg(F.min_by(entry, F.struct("page_no", "page_id", "pos")).alias("e"))
    if max_candidates is not None:
        first = top_k(first, ["source_id"], [F.asc("e.page_no"), F.asc("e.page_id"), F.asc("e.pos")], max_candidates)
    score = F.when(F.col("e.date_hint").isNotNull(), 0.75).otherwise(0.6)
    return first.select("source_id", "canonical_url", *[f"e.{c}" for c in ("url", "parent_url", "title_hint", "date_hint", "depth")], score.alias("discovery_score"))
