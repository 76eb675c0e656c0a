"""Near duplicates by SimHash and a binary trie self-join.

Fingerprints: 64 bits over 4-word shingles, one Arrow pass over the texts, whose only output is (id, fingerprint).
Equal fingerprints are folded before anything is joined, so a group of copies costs one row.

Join: two fingerprints within 4 bits agree wholly in one of 5 blocks of the 64 bits, which is how a trie over all of them
is dealt to tasks. For each block the fingerprints that share its value form a binary trie; every trie, however small, is
walked by pairs of nodes that start as (root, root), go down together bit by bit, carry the number of bits in which their
paths differ, and are dropped as soon as that exceeds the budget. A task walks the tries of many groups at once. What
comes out of a group is one link from each linked fingerprint to the smallest one it reaches there, not all pairs, so
links grow with the fingerprints even where thousands are near each other. Components over these links equal those over
all pairs.

A group holds distinct fingerprints only, as 8 bytes each. Groups too large for one task are cut by blocks of the bits
that are still free, exactly as the 64 bits were at first: see ``groups``.

Defined cases: a null or empty text, or one of white space, has fingerprint 0, linked like any other; texts of fewer than
4 words are one shingle; repeated rows share a fingerprint; a null identifier is in no component's minimum unless there
is no other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm import near_copies
from gridloom.llm.common import TEXT_HASH, keep_one, lookup, map_batches, scratch_scope, table, whole_text, written
from gridloom.llm.components import connected_components
from gridloom.llm.shingles import fingerprint_of, shingle_hashes

#: Pairs of nodes that go down together, which bounds the memory of a step.
FRONTIER = 1 << 17
#: Fingerprints in a group that one task takes at once; larger groups are cut by more bits.
GROUP = 1 << 13
#: Fingerprints, of many groups, whose tries are walked at once.
FOREST = 1 << 16


def fingerprint(text: str, width: int = 4) -> int:
    return fingerprint_of(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp, a hash of the text): the fingerprint as a signed long with the unsigned one's bits."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), batch.column(2)], names=["doc_id", "fp", TEXT_HASH])

    text = whole_text(text_col)
    return map_batches(docs.select(F.col(id_col).cast("long"), text, F.xxhash64(text)), run, f"doc_id long, fp long, {TEXT_HASH} long")


class Forest:
    """Binary tries, one for each group, over leaves in the order of (group, fingerprint).

    A node of a depth is a range of leaves of one group that share that many leading bits; nodes are numbered in order, and
    only the ranges' starts are held. A node with one leaf ends its path: what is left of it is a single edge.
    """

    def __init__(self, groups: np.ndarray, leaves: np.ndarray):
        self.leaves = leaves
        self.opens = np.concatenate([[True], np.diff(groups) != 0])[: len(leaves)]
        self._starts: dict[int, np.ndarray] = {}
        self._sizes: dict[int, np.ndarray] = {}

    def starts(self, depth: int) -> np.ndarray:
        if depth not in self._starts:
            opens = self.opens.copy()
            if depth:
                opens[1:] |= np.diff(self.leaves >> np.uint64(64 - depth)) != 0
            self._starts[depth] = np.flatnonzero(opens)
        return self._starts[depth]

    def sizes(self, depth: int) -> np.ndarray:
        if depth not in self._sizes:
            self._sizes[depth] = np.diff(self.starts(depth), append=len(self.leaves))
        return self._sizes[depth]

    def descend(self, depth: int, a: np.ndarray, b: np.ndarray, bits: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of children of the pairs (a, b) of nodes that differ by ``budget`` bits at most, each pair once."""
        below = self.starts(depth + 1)
        bit = (self.leaves[below] >> np.uint64(63 - depth)) & np.uint64(1)
        first = np.searchsorted(below, self.starts(depth))
        children = np.diff(first, append=len(below))
        found = []
        for x in (0, 1):
            for y in (0, 1):
                keep = (children[a] > x) & (children[b] > y)
                if x > y:
                    keep &= a != b
                left, right = first[a[keep]] + x, first[b[keep]] + y
                more = bits[keep] + (bit[left] != bit[right])
                near = more <= budget
                found.append((left[near], right[near], more[near].astype(np.int8)))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def near_pairs(self, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Leaves i < j of one group within ``budget`` bits, in parts. Pairs of nodes go down together from (root, root) of
        every group, bit by bit, and are dropped when their paths differ by more than the budget."""
        roots = np.arange(len(self.starts(0)))
        stack = [(0, roots, roots, np.zeros(len(roots), dtype=np.int8))]  # depth, two nodes, the bits by which their paths differ
        while stack:
            depth, a, b, bits = stack.pop()
            if len(a) > FRONTIER:
                half = len(a) // 2
                stack += [(depth, a[:half], b[:half], bits[:half]), (depth, a[half:], b[half:], bits[half:])]
                continue
            ended = (self.sizes(depth)[a] == 1) & (self.sizes(depth)[b] == 1)
            i, j = self.starts(depth)[a[ended]], self.starts(depth)[b[ended]]
            near = (i < j) & (np.bitwise_count(self.leaves[i] ^ self.leaves[j]) <= budget)  # both paths' last edges at once
            yield i[near], j[near]
            if not ended.all():
                stack.append((depth + 1, *self.descend(depth, a[~ended], b[~ended], bits[~ended], budget)))


def trie_links(groups: np.ndarray, fps: np.ndarray, budget: int, met: list[np.ndarray] | None = None) -> np.ndarray:
    """For uint64 fingerprints, distinct in each group: the index of the smallest one of its group that each reaches over
    links of ``budget`` bits. ``met`` gets the pairs within the budget, as indexes, that make these links: a forest."""
    n = len(fps)
    order = np.lexsort((fps, groups))
    root = np.arange(n)

    def roots(i: np.ndarray) -> np.ndarray:
        at = root[i]
        while not np.array_equal(up := root[at], at):
            at = up
        root[i] = at
        return at

    for i, j in Forest(groups[order], fps[order]).near_pairs(budget):
        pair = np.stack([i, j])
        while len(i):
            i, j = roots(i), roots(j)
            apart = i != j
            i, j, pair = np.minimum(i, j)[apart], np.maximum(i, j)[apart], pair[:, apart]
            if met is not None:
                won = np.unique(j, return_index=True)[1]
                root[j[won]] = i[won]
                met.append(order[pair[:, won]])
            else:
                root[j] = i  # one of the pairs of a root wins; the others come again from where it leads
    out = np.empty(n, dtype=np.int64)
    out[order] = order[roots(np.arange(n))]
    return out


_LINKS = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _next_masks(mask: int, budget: int) -> list[int]:
    """``mask`` with one of ``budget`` + 1 blocks of its free bits added: whoever agrees under ``mask`` and is within the
    budget agrees under one of these, too."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // (budget + 1) for i in range(budget + 2)]
    return [mask | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False) if hi > lo]


def groups(distinct: DataFrame, budget: int = 4, limit: int = GROUP) -> DataFrame:
    """(turn, mask, value, fp): fingerprints by the bits they have under a mask. Any two within the budget share a group.

    Groups of over ``limit`` fingerprints are cut by more bits, turn after turn. A group whose mask leaves k bits free
    holds 2^k distinct fingerprints at most, so this ends with every group within the limit, whatever the data.
    """
    spark = distinct.sparkSession
    done: list[DataFrame] = []
    opened = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in _next_masks(0, budget)])).alias("mask"))
    while True:
        keyed = opened.select(F.lit(len(done)).alias("turn"), "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        large = written(keyed.groupBy("mask", "value").count().where(F.col("count") > limit).select("mask", "value"), "simhash-large")
        masks = [r["mask"] for r in large.select("mask").distinct().collect()]  # (budget + 1)^(turn + 1) at most
        if not masks:
            return reduce(DataFrame.unionByName, [*done, keyed])
        done.append(keyed.join(large, ["mask", "value"], "left_anti").select(*keyed.columns))
        finer = spark.createDataFrame([(m, _signed(x)) for m in masks for x in _next_masks(m & ((1 << 64) - 1), budget)], "mask long, finer long")
        opened = written(keyed.join(large, ["mask", "value"], "left_semi").join(F.broadcast(finer), "mask").select("fp", F.col("finer").alias("mask")).distinct(), "simhash-finer")


def near_links(distinct: DataFrame, budget: int = 4, limit: int = GROUP, pairs: bool = False) -> DataFrame:
    """Links (u, v) between fingerprints of ``distinct(fp)`` whose components are those of all pairs within ``budget`` bits;
    with ``pairs`` every link is such a pair itself.

    Rows are dealt by group and sorted by it; a task reads its groups one after another, 8 bytes a fingerprint, walks the
    tries of many groups at once, and returns at most one link for each of its rows.
    """

    def links(parts: list[np.ndarray]) -> pa.RecordBatch:
        groups_, fps = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        met = [np.zeros((2, 0), dtype=np.int64)]
        to = trie_links(groups_, fps.view(np.uint64), budget, met if pairs else None)
        if pairs:
            u, v = fps[np.concatenate(met, axis=1)]
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        own = np.flatnonzero(to != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[own]), pa.array(fps[to[own]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number = None, 0  # the group that is open, and its number in the task
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            turn, mask, value, fps = (c.to_numpy() for c in batch.columns)
            opens = np.concatenate([[(turn[0], mask[0], value[0]) != key], (np.diff(turn) != 0) | (np.diff(mask) != 0) | (np.diff(value) != 0)])
            groups_ = number + np.cumsum(opens)
            key, number = (turn[-1], mask[-1], value[-1]), int(groups_[-1])
            held.append(np.stack([groups_, fps]))
            size += len(fps)
            if size >= FOREST:  # all groups but the open one, which may go on
                rows = np.concatenate(held, axis=1)
                whole = int(np.searchsorted(rows[0], number))
                if whole:
                    yield links([rows[:, :whole]])
                held, size = [rows[:, whole:]], rows.shape[1] - whole
        if size:
            yield links(held)

    return groups(distinct, budget, limit).repartition("turn", "mask", "value").sortWithinPartitions("turn", "mask", "value").mapInArrow(run, _LINKS)


def _components(marked: DataFrame, budget: int) -> DataFrame:
    """(fp, n, root): every fingerprint of ``marked(fp)``, its rows, and the smallest one that it reaches."""
    classes = written(marked.groupBy("fp").agg(F.count("*").alias("n")), "fingerprint-classes")
    roots = connected_components(near_links(classes.select("fp"), budget)).withColumnRenamed("node", "fp")
    # Only fingerprints in components of more than one come back; the others stand for themselves.
    return classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4, budget: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable)."""
    marked = written(fingerprints(docs, id_col=id_col, text_col=text_col, width=width), "fingerprints")
    linked = written(_components(marked, budget).join(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp"), "fingerprint-roots")
    named = written(linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "n", "component_id"), "fingerprint-components")
    # A fingerprint that many documents have (that of empty texts, or of a mass of copies) is not one task's work.
    found = lookup(marked, named, ["fp"], rows="n", total=marked.count(), spread=["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4, budget: int = 4, similarity: float | None = None,
) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest identifier, then text hash; a null identifier comes
    last, and of rows with the same identifier and text one stays.

    With ``similarity`` (0.8), what the walk of the trie links is checked: texts are linked if the sets of their
    ``width``-word shingles have that Jaccard similarity or more. Pairs of 0.8 differ by up to 15 bits or so, which no walk
    of a trie can prune, so those that the walk leaves apart are looked for by prefixes (``near_copies``).
    """
    with scratch_scope(docs.sparkSession) as keep:
        if similarity is None:
            marked = written(fingerprints(docs, id_col=id_col, text_col=text_col, width=width), "fingerprints").withColumnRenamed("fp", "class")
            classes = _components(marked.withColumnRenamed("class", "fp"), budget).withColumnRenamed("fp", "class")
        else:
            marked, classes = near_copies.classes(docs, lambda fps: near_links(fps, budget, pairs=True), id_col=id_col, text_col=text_col, width=width, similarity=similarity)
        return keep_one(docs, marked, written(classes, "near-classes"), keep, id_col=id_col, text_col=text_col)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
