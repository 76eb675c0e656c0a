"""Near copies by exact Jaccard similarity of word shingles, for ``drop_near_duplicates(similarity=0.8)``.

Two texts are near copies if the sets of their 5-word shingles have a similarity of 0.8 or more; components over these
links are groups. Texts that the trie walk of operator 10 puts within its budget, by fingerprints of the same shingles, are
checked first, and what is linked then is one component from there on. All other pairs are found by prefixes: with shingles in one order for all texts, the first fifth (and
one) of both sets share a shingle. The order puts shingles that are frequent in a sample last; the sample decides how
large groups get, never what is found.

Texts whose prefixes share a shingle form a group. Groups of over ``TILE`` texts are cut into tiles, and each pair of tiles
is a piece of work of its own, so no task holds more than two tiles of a group. Pairs are bounded by sizes and by parity
maps: bit i says whether an odd number of the set's hashes are i modulo the bits, so what two sets share cancels out and
they differ by at least as many shingles as their maps by bits. Maps grow with the set, and the larger of two is folded to
the smaller. What is left is decided on the whole sets. A first pass looks only at two groups of each text, there only inside tiles, and takes each text's nearest;
a second looks at all groups, but only at pairs whose components still differ. So a cluster of thousands of near texts is
one component before its many groups are looked at, and pairs stay few.

Defined cases: texts are folded if their sets are equal (a 64-bit hash of the set); null, empty and blank texts have the
empty set; texts of fewer words than a shingle's are one shingle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import TEXT_HASH, if_small, lookup, map_batches, whole_text, written
from gridloom.llm.components import connected_components
from gridloom.llm.shingles import SEED, fingerprint_of, shingle_hashes

#: One text in so many counts towards the order; shingles in at least LEAST of them, up to MOST shingles, come last.
SAMPLE, LEAST, MOST = 16, 3, 100_000
#: 64-bit words of the smallest parity map; a set of over 80 hashes a word has one four times as large. Pairs compared at once.
WORDS, PAIRS = 16, 1 << 16
#: Texts in a tile of a group.
TILE = 1 << 11


def shingle_set(text: str, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def class_of(shingles: np.ndarray) -> int:
    """A hash of a whole set, as a signed long."""
    import xxhash

    key = xxhash.xxh64_intdigest(shingles.tobytes(), SEED)
    return key - (1 << 64) if key >> 63 else key


def parities(shingles: np.ndarray) -> np.ndarray:
    """The parity map of a set as 64-bit words."""
    words = WORDS
    while len(shingles) > 80 * words:
        words *= 4
    bits = np.bincount((shingles % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def folded(parity: np.ndarray, words: int) -> np.ndarray:
    """The map of the same set with fewer words."""
    while len(parity) > words:
        parity = parity[: len(parity) // 2] ^ parity[len(parity) // 2 :]
    return parity


class Similar:
    """A similarity of ``share`` / 100 or more, in whole numbers."""

    def __init__(self, similarity: float):
        self.share = round(100 * similarity)
        if not 50 <= self.share <= 100 or abs(self.share - 100 * similarity) > 1e-9:
            raise ValueError("similarity must be from 0.5 to 1, in hundredths")

    def __call__(self, n: np.ndarray, m: np.ndarray, differing: np.ndarray) -> np.ndarray:
        """Whether sets of these sizes, with so many shingles in only one of the two, reach it: (s - d) / (s + d) >= share."""
        return (100 + self.share) * differing <= (100 - self.share) * (n + m)

    def least(self, n):
        """The fewest shingles that a set, or what two sets share, must have beside a set of ``n``."""
        return -(-self.share * n // 100)


def _frequent(docs: DataFrame, text_col: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (in order) of frequent shingles and their counts in the sample."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, width) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["h"])

    sample = docs.select(whole_text(text_col).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).distinct()
    counts = map_batches(sample, run, "h long").groupBy("h").count().where(F.col("count") >= LEAST)
    found = counts.orderBy(F.desc("count"), "h").limit(MOST).toArrow()
    hashes, n = found["h"].to_numpy().view(np.uint64), found["count"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n[order]


def _marks(docs: DataFrame, id_col: str, text_col: str, width: int, similar: Similar) -> DataFrame:
    """(doc_id, _text_hash, class, size, bits, prefix, fp): a row for each row of ``docs``."""
    hashes, counts = _frequent(docs, text_col, width)

    def mark(text: str) -> tuple:
        repeated = shingle_hashes(text, width)
        s = np.unique(repeated)
        keep = len(s) - similar.least(len(s)) + 1 if len(s) else 0
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
            often = np.where(hashes[at] == s, counts[at], 0)
            rare = s[often == 0][:keep]  # in the order of hashes, as s is
            first = rare if len(rare) == keep else s[np.lexsort((s, often))[:keep]]
        else:
            first = s[:keep]
        return class_of(s), len(s), parities(s).tobytes(), first.view(np.int64), fingerprint_of(repeated)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, n, bits, prefix, fp = zip(*map(mark, batch.column(2).to_pylist()), strict=True)
        columns = [batch.column(0), batch.column(1), pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(bits, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(np.array(fp, dtype=np.uint64).view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    text = whole_text(text_col)
    schema = f"doc_id long, {TEXT_HASH} long, class long, size long, bits binary, prefix array<long>, fp long"
    return map_batches(docs.select(F.col(id_col).cast("long"), F.xxhash64(text), text), run, schema)


def group_pairs(key: np.ndarray, n: np.ndarray, bits: np.ndarray, part: np.ndarray, tile: np.ndarray, *, nearest: bool, similar: Similar) -> np.ndarray:
    """Pairs of keys in a group that may be similar and whose parts differ, in two tiles only across them; with ``nearest``
    one pair for each row at most. Rows are compared with those of no larger but large enough sets."""
    found = [np.zeros((2, 0), dtype=np.int64)]
    order = np.argsort(n, kind="stable")
    key, n, bits, part, tile = (x[order] for x in (key, n, bits, part, tile))
    across = (tile != tile[0]).any()
    words = np.array([len(p) for p in bits])
    levels = np.unique(words).tolist()
    at_least = {w: np.cumsum(words >= w) - 1 for w in levels}  # a row's place in the matrix of maps folded to w words
    maps = {w: np.stack([folded(p, w) for p in bits if len(p) >= w]) for w in levels}

    def bounds(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = n[x] - n[y]
        level = np.minimum(words[x], words[y])
        for w in np.unique(level).tolist():
            of = np.flatnonzero(level == w)
            step = max(1, PAIRS * WORDS // w)
            for at in range(0, len(of), step):
                some = of[at : at + step]
                i, j = at_least[w][x[some]], at_least[w][y[some]]
                out[some] = np.maximum(out[some], np.bitwise_count(maps[w][i] ^ maps[w][j]).sum(axis=1, dtype=np.int64))
        return out

    a = 0
    while a < len(key):
        low = int(np.searchsorted(n, similar.least(n[a])))
        b = min(len(key), a + max(1, PAIRS // (a - low + 64)))
        differs = part[a:b, None] != part[None, low:b]
        if across:
            differs &= tile[a:b, None] != tile[None, low:b]
        differs &= np.arange(low, b)[None, :] < np.arange(a, b)[:, None]
        i, j = np.nonzero(differs)
        for at in range(0, len(i), PAIRS):
            x, y = a + i[at : at + PAIRS], low + j[at : at + PAIRS]
            bound = bounds(x, y)
            ok = similar(n[x], n[y], bound)
            x, y, bound = x[ok], y[ok], bound[ok]
            if nearest:
                best = np.lexsort((bound, x))
                best = best[np.diff(x[best], prepend=-1) != 0]
                x, y = x[best], y[best]
            found.append(np.stack([key[x], key[y]]))
        a = b
    return np.concatenate(found, axis=1)


def _tiled(members: DataFrame, cross: bool) -> DataFrame:
    """``members`` with tile, low and high: which tile of its group a row is in, and the pair of tiles it is read with. A
    group of one tile is read once; a larger one by pairs of tiles, or only tile by tile unless ``cross``."""
    large = written(members.groupBy("h").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("tiles"), F.count("*").alias("n")).where("tiles > 1"), "near-large")
    if large.isEmpty():
        return members.withColumns({c: F.lit(0) for c in ("tile", "low", "high")})
    tiled = lookup(members, large, ["h"], rows="n", total=members.count(), spread=["class"])
    small = members.join(large, "h", "left_anti").withColumn("tiles", F.lit(1))
    placed = tiled.unionByName(small).withColumn("tile", F.pmod(F.xxhash64(F.lit("tile"), "class"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)) if cross else F.col("tile")
    return placed.withColumn("other", other).withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}).drop("other", "tiles")


def _candidates(members: DataFrame, marks: DataFrame, *, nearest: bool, similar: Similar) -> DataFrame:
    """Distinct pairs (a, b) from ``members(h, class, part)``; groups are read one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[list[np.ndarray]] = []

        def pairs(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            opens = (np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)
            edges = [0, *(np.flatnonzero(opens) + 1).tolist(), len(cols[0])]
            out, size = [], 0
            for a, b in zip(edges, edges[1:], strict=False):
                if b - a > 1 and (cols[6][a:b] != cols[6][a]).any():
                    out.append(group_pairs(*(c[a:b] for c in cols[3:]), nearest=nearest, similar=similar))
                    size += out[-1].shape[1]
                if out and (size > PAIRS or b == edges[-1]):
                    found = np.unique(np.sort(np.concatenate(out, axis=1), axis=0), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])
                    out, size = [], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            h, low, high, key, n, bits, part, tile = batch.columns
            maps = np.empty(len(bits), dtype=object)
            maps[:] = [np.frombuffer(p, dtype=np.uint64) for p in bits.to_pylist()]
            cols = [h.to_numpy(), low.to_numpy(), high.to_numpy(), key.to_numpy(), n.to_numpy(), maps, part.to_numpy(), tile.to_numpy()]
            first, last = (tuple(c[at] for c in cols[:3]) for at in (0, -1))
            if rest and tuple(c[0] for c in rest[0][:3]) == first == last:
                rest.append(cols)
                continue
            cols = [np.concatenate(c) for c in zip(*rest, cols, strict=True)]
            same = (cols[0] == last[0]) & (cols[1] == last[1]) & (cols[2] == last[2])
            whole = int(np.argmax(same))
            if whole:
                yield from pairs([c[:whole] for c in cols])
            rest = [[c[whole:] for c in cols]]
        if rest:
            yield from pairs([np.concatenate(c) for c in zip(*rest, strict=True)])

    keys = ("h", "low", "high")
    named = if_small(written(members.select("class").distinct(), "near-named"))
    sets = marks.select("class", "size", "bits").join(named, "class", "left_semi").dropDuplicates(["class"])
    wide = _tiled(members, not nearest).join(sets, "class")
    dealt = wide.select(*keys, "class", "size", "bits", "part", "tile").repartition(*keys).sortWithinPartitions(*keys, "class")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _sets(pairs: DataFrame, marks: DataFrame, docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """(class, shingles) of the classes in ``pairs``, from one text of each. Only those texts leave the scan."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
        found = pa.array([c == class_of(s) for c, s in zip(batch.column(0).to_pylist(), sets, strict=True)], pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["class", "shingles"]).filter(found)

    named = if_small(written(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "class"), "near-named"))
    texts = if_small(written(marks.join(named, "class", "left_semi").groupBy("class").agg(F.min(TEXT_HASH).alias(TEXT_HASH)), "near-texts"))
    text = whole_text(text_col).alias("text")
    found = docs.select(F.xxhash64(text).alias(TEXT_HASH), text).join(texts, TEXT_HASH).select("class", "text")
    return map_batches(found, run, "class long, shingles binary").dropDuplicates(["class"])


def _similar(pairs: DataFrame, sets: DataFrame, similar: Similar) -> DataFrame:
    """Those of ``pairs`` whose whole sets reach the similarity, as links (u, v)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        u, v, left, right = batch.columns
        keep = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
            keep.append(bool(similar(len(x), len(y), len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True)))))
        keep = pa.array(keep, pa.bool_())
        return pa.RecordBatch.from_arrays([u.filter(keep), v.filter(keep)], names=["u", "v"])

    asked = written(sets, "near-sets")
    side = lambda k, s: asked.select(F.col("class").alias(k), F.col("shingles").alias(s))
    return map_batches(pairs.join(side("a", "left"), "a").join(side("b", "right"), "b").select("a", "b", "left", "right"), run, "u long, v long")


def _walked(marks: DataFrame, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs (a, b) of classes that the walk ``near`` of fingerprints links: the smallest classes of two fingerprints, and
    those of one fingerprint with the smallest of it."""
    held = written(marks.select("fp", "class").distinct(), "near-walked")
    named = written(held.groupBy("fp").agg(F.min("class").alias("lead"), F.count("*").alias("n")), "near-fingerprints")
    same = lookup(held, named.where("n > 1"), ["fp"], rows="n", total=held.count(), spread=["class"]).select(F.col("lead").alias("a"), F.col("class").alias("b"))
    side = lambda k, c: named.select(F.col("fp").alias(k), F.col("lead").alias(c))
    across = near(named.select("fp")).distinct().join(side("u", "x"), "u").join(side("v", "y"), "v")
    return same.where("a <> b").unionByName(across.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct()


def classes(docs: DataFrame, near: Callable[[DataFrame], DataFrame], *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, _text_hash, class)`` for every row, and ``(class, n, root)`` for every class of equal sets. ``near`` gives
    pairs (u, v) of the fingerprints (fp) that it walks."""
    similar = Similar(similarity)
    marks = written(_marks(docs, id_col, text_col, width, similar), "near-marks")
    counts = marks.groupBy("class").agg(F.count("*").alias("n"))
    walked = written(_walked(marks, near), "near-trie-pairs")
    linked = written(_similar(walked, _sets(walked, marks, docs, text_col, width), similar), "near-trie-links")
    begun = written(connected_components(linked).select(F.col("node").alias("class"), F.col("root").alias("part")), "near-begun")
    dealt = marks.select(F.explode("prefix").alias("h"), "class", "doc_id")
    shared = dealt.groupBy("h").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("h", "n", F.lit(1).alias("group"))
    members = lookup(dealt, written(shared, "near-shared"), ["h"], rows="n", total=dealt.count(), spread=["class", "doc_id"])
    members = written(members.select("h", "class").distinct(), "near-members")
    # Near texts share many shingles: of the groups that hold just the same texts (by two hashes) one is looked at.
    held = members.groupBy("h").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64(F.lit(SEED), "class")).alias("y"))
    alone = written(held.where("n > 1").groupBy("n", "x", "y").agg(F.min("h").alias("h")).select("h", "n", F.lit(1).alias("group")), "near-alone")
    members = written(lookup(members, alone, ["h"], rows="n", total=members.count(), spread=["class"]).select("h", "class"), "near-groups")
    two = members.groupBy("class").agg(F.array_distinct(F.array(F.min("h"), F.max("h"))).alias("two"))
    some = written(two.join(begun, "class", "left").select(F.explode("two").alias("h"), "class", F.coalesce("part", "class").alias("part")), "near-two")
    pairs = written(_candidates(some, marks, nearest=True, similar=similar), "near-pairs")
    links = written(_similar(pairs, _sets(pairs, marks, docs, text_col, width), similar).unionByName(linked), "near-links")
    roots = connected_components(links).select(F.col("node").alias("class"), F.col("root").alias("part"))
    parts = written(members.join(roots, "class", "left").withColumn("part", F.coalesce("part", "class")), "near-parts")
    mixed = written(parts.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("h", "n", F.lit(1).alias("group")), "near-mixed")
    again = written(lookup(parts, mixed, ["h"], rows="n", total=parts.count(), spread=["class"]).select("h", "class", "part"), "near-again")
    more = written(_candidates(again, marks, nearest=False, similar=similar).join(pairs, ["a", "b"], "left_anti"), "near-more")
    roots = connected_components(links.unionByName(_similar(more, _sets(more, marks, docs, text_col, width), similar))).withColumnRenamed("node", "class")
    linked = counts.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    return marks.select("doc_id", TEXT_HASH, "class"), linked
