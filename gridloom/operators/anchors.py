"""Many patterns in many texts at once, by anchors.

A pattern's anchor is its first two characters, or its only one. Of a text those positions are kept where some pattern's
anchor stands; they are joined to the patterns by equality, and the rest of the pattern is verified. So the work follows
the length of the texts and the number of such positions, not the number of patterns, and no substrings are spelled out.

Defined cases: null texts and null or empty patterns have no hits; the same pattern under several ids hits for each; hits
may overlap (``leftmost_longest`` picks those that don't); rows with a repeated key hit each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most anchors that tasks keep positions by; with more than that all positions go to the join.
MOST_ANCHORS = 200_000
#: Positions of a text looked at, and characters handed on, at once.
WINDOW, HANDED_ON = 1 << 18, 1 << 22


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


class _Anchors:
    def __init__(self, anchors: Sequence[str] | None):
        self.all = anchors is None
        codes = [_code_points(a) for a in anchors or ()]
        self.by_size = {size: np.array([sum(int(p) << 21 * i for i, p in enumerate(c)) for c in codes if len(c) == size], np.int64) for size in (1, 2)}

    def places(self, text: str) -> Iterator[tuple[int, np.ndarray]]:
        """(size, places) of anchors, window by window."""
        codes = _code_points(text)
        for at in range(0, len(codes), WINDOW):
            here, ahead = codes[at : at + WINDOW], codes[at + 1 : at + WINDOW + 1]
            for size, known in self.by_size.items():
                value = here if size == 1 else here[: len(ahead)] + (ahead << 21)
                found = np.arange(len(value)) if self.all else np.flatnonzero(np.isin(value, known)) if len(known) else ()
                if len(found):
                    yield size, found + at


def find_patterns(texts: DataFrame, patterns: DataFrame, *, key: str, text: str = "text", pattern_id: str = "pattern_id", pattern: str = "pattern") -> DataFrame:
    """(key, pattern_id, pattern, start, length): every place of every pattern, from 1, in code points."""
    known = patterns.select(F.col(pattern_id), F.col(pattern).cast("string").alias("_pattern")).where("_pattern <> ''")
    known = known.withColumns({"_anchor": F.substring("_pattern", 1, 2), "length": F.char_length("_pattern")})
    longest = known.agg(F.max("length")).first()[0] or 0
    some = [r[0] for r in known.select("_anchor").distinct().limit(MOST_ANCHORS + 1).collect()]
    anchors, at_once = _Anchors(some if len(some) <= MOST_ANCHORS else None), max(1, HANDED_ON // max(1, longest))
    keyed = texts.select(F.col(key), F.col(text).cast("string").alias("_text"))
    names = [key, "start", "_anchor", "_rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                value = batch.column(1)[i].as_py() or ""
                for size, places in anchors.places(value):
                    for begin in range(0, len(places), at_once):
                        part = places[begin : begin + at_once]
                        starts = part.tolist()
                        keys = batch.column(0).take(pa.array(np.full(len(part), i)))
                        columns = [keys, pa.array(part.astype(np.int32) + 1), pa.array([value[s : s + size] for s in starts], pa.string()), pa.array([value[s : s + longest] for s in starts], pa.string())]
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    placed = keyed.mapInArrow(run, f"`{key}` {keyed.schema[0].dataType.simpleString()}, start int, _anchor string, _rest string")
    hits = placed.join(known, "_anchor").where(F.startswith("_rest", "_pattern"))
    return hits.select(key, pattern_id, F.col("_pattern").alias("pattern"), "start", "length")


def leftmost_longest(hits: DataFrame, key: str) -> DataFrame:
    """Hits of ``find_patterns`` that don't overlap: from the left, at each place the longest. Chains of hits that overlap
    are resolved one by one; hits that touch no other are taken at once."""
    longest = hits.groupBy(key, "start").agg(F.max("length").alias("length"))
    before = Window.partitionBy(key).orderBy("start")
    reach = F.max(F.col("start") + F.col("length")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    chained = longest.withColumn("chain", F.sum(F.when(reach > F.col("start"), 0).otherwise(1)).over(before))
    entries = chained.groupBy(key, "chain").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("e"))
    none = F.struct(F.array().cast("array<struct<start:int,length:int>>").alias("kept"), F.lit(0).alias("end"))
    step = lambda acc, x: F.when(x["start"] >= acc["end"], F.struct(F.concat(acc["kept"], F.array(x)).alias("kept"), (x["start"] + x["length"]).alias("end"))).otherwise(acc)
    kept = entries.select(key, F.inline(F.aggregate("e", none, step)["kept"]))
    return hits.join(kept, [key, "start", "length"], "left_semi")
