"""All pairs of texts whose ratio reaches a bound, without comparing all with all.

The ratio of texts of n and m characters is ``2 LCS / (n + m)``. At a ratio of at least t they are at most ``d = (1 - t)
(n + m)`` insertions and deletions apart, and the longer is at most ``(2 - t) / t`` times as long as the shorter. Each such
step takes at most q of a text's q-grams, so the texts share at least ``max(n, m) - (q - 1) - q d`` of them, copies counted
apart. For a text of n characters that is least where the other has n as well: ``c(n) = n - (q - 1) - 2 q (1 - t) n``. So of
its g grams, in any order that is the same for all texts, one of the first ``g - c(n) + 1`` is among the other's first ones
(prefix filtering). Rare grams come first in that order.

Grams are as long as leaves ``c`` large, from two characters up: the closer texts have to be, the longer. They serve all
pairs where ``c`` is at least 1 for both. In the others the shorter text has few characters, and so has
the longer: they meet by single characters in the same way, where ``c`` is at least 1 always. Together no pair is lost.
Grams meet between neighbouring classes of length only, which cuts hot grams; what has met is compared once.

From a ratio of ``PIECES_FROM`` on there is a sharper way. A text of n characters and one as long or longer are at most
``2 (1 - t) n / t`` steps apart. Cut into one piece more than that, the shorter one has a piece that no step touches: it
stands in the longer one as it is. Pieces are about nine characters at 0.95, and ten times fewer than grams. Each meets the
pieces' length of characters at every place of a longer text, by one hash of the characters, the class of length and the
range of places.

Count each step for the piece that it touches, or that comes next where it adds characters between two. Piece by piece, the
steps so far less the pieces so far begin at 0, fall by one at most, and end below 0. Where they first fall below 0, an
untouched piece j has exactly j steps before it, and the others after it. So it is displaced by j at most, by an odd number
if j is odd, and the steps that are left must make up for what then remains of the difference in length. No other place is
looked at. Texts that happen to share a piece there are told apart by how often they have each kind of character, before
their characters move: a step changes one of these numbers by one. Pairs are then dealt to tiles by a hash of either side, and
a tile gets each of its texts once: a group of texts that are all alike moves as its number of texts, not of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.fuzzy import indel_ratio_from
from gridloom.sources.scratch import stored

#: Bounds are computed in floating point: they are eased by this much.
_EASE = 1e-6
#: Longest grams in use.
LONGEST = 4
#: The least ratio at which texts meet by pieces.
PIECES_FROM = 0.9
#: Kinds of characters, by the last bits of their code points: Latin letters are a kind each.
KINDS = 32
#: Pairs in a tile, on average at most.
PAIRS = 25_000
#: Rows that a task puts out at once.
_ROWS = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _size(least: float) -> int:
    return max(2, min(LONGEST, math.floor(0.3 / (1 - least + _EASE))))


def _grams(text: Column, q: int) -> Column:
    characters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    n = F.greatest(F.size(characters) - (q - 1), F.lit(0))
    shifted = [F.slice(characters, F.lit(i), n) for i in range(1, q + 1)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y)), shifted)


def _needed(n: Column, q: int, least: float) -> Column:
    """The number of common q-grams that a text of ``n`` characters has at least with any other that reaches the ratio."""
    return F.ceil(n * (1 - 2 * q * (1 - least)) - (q - 1) - _EASE)


def _shortest(q: int, least: float) -> float:
    """Texts with fewer characters than this don't need any common q-gram."""
    return q / (1 - 2 * q * (1 - least)) + _EASE


def _first_grams(texts: DataFrame, q: int, least: float, counts: DataFrame) -> DataFrame:
    """(side, key, n, gram, copy) of the grams of each text that come first."""
    numbered = _numbered(texts, q).join(counts, "gram")
    ordered = numbered.groupBy("side", "key", "n").agg(F.array_sort(F.collect_list(F.struct("texts", "gram", "copy"))).alias("grams"))
    first = F.slice("grams", F.lit(1), F.greatest(F.size("grams") - _needed(F.col("n"), q, least) + 1, F.lit(0)).cast("int"))
    return ordered.select("side", "key", "n", F.inline(first)).drop("texts")


def _numbered(texts: DataFrame, q: int) -> DataFrame:
    counted = texts.select("side", "key", "n", F.explode(_grams(F.col("text"), q)).alias("gram")).groupBy("side", "key", "n", "gram").count()
    return counted.select("side", "key", "n", "gram", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("copy"))


def _meetings(texts: DataFrame, q: int, least: float) -> DataFrame:
    counts = _numbered(texts, q).groupBy("gram").agg(F.count("*").alias("texts"))
    first = _first_grams(texts, q, least, counts)
    ratio = (2 - least) / least * (1 + _EASE)
    place = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(ratio))).cast("int")
    lefts = first.where("side = 0").select(F.col("key").alias("left"), F.col("n").alias("left_n"), "gram", "copy", place.alias("place"))
    rights = first.where("side = 1").select(F.col("key").alias("right"), F.col("n").alias("right_n"), "gram", "copy", F.explode(F.array(place - 1, place, place + 1)).alias("place"))
    met = lefts.join(rights, ["gram", "copy", "place"])
    fits = F.greatest("left_n", "right_n") <= F.least("left_n", "right_n") * ratio
    return met.where(fits).select("left", "right").distinct()


def _steps(n: np.ndarray | int, least: float):
    """Insertions and deletions between a text of ``n`` characters and one as long or longer, at most."""
    return np.floor(2 * (1 - least) * n / least + _EASE).astype(np.int64)


def _hashed(characters: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` characters from each place on; what it confuses is told apart when texts are compared."""
    out = np.zeros(max(0, len(characters) - size + 1), dtype=np.uint64)
    for i in range(size):
        out = out * _FACTOR + characters[i : i + len(out)]
    return out


def _keyed(hashes: np.ndarray, *more: np.ndarray | int) -> np.ndarray:
    for x in more:
        hashes = (hashes ^ (hashes >> np.uint64(29))) * _FACTOR + np.asarray(x, dtype=np.int64).view(np.uint64)
    return (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32).view(np.int32)


class Pieces:
    """Where texts are cut, and which parts of others are looked at for the pieces."""

    def __init__(self, least: float):
        self.least, self.ratio = least, (2 - least) / least * (1 + _EASE)

    def place(self, n: int) -> int:
        """The class of length: a text is at most one class above any shorter one that it is similar to."""
        return math.floor(math.log(n) / math.log(self.ratio))

    def width(self, place: int) -> int:
        """Characters in a range of places, for texts of that class."""
        return math.floor(3 * (1 - self.least) * self.ratio ** min(place, math.log(1e9) / math.log(self.ratio))) + 1

    def pieces(self, characters: np.ndarray) -> tuple[np.ndarray, ...]:
        """(key, at, j) of a text's own pieces, for every class and range where they may stand in others."""
        n = len(characters)
        steps = int(_steps(n, self.least))
        size, j = n // (steps + 1), np.arange(steps + 1)
        at, longer = j * size, math.floor(n * (self.ratio - 1)) + 1
        lowest, highest = np.maximum(at - np.minimum(j, steps - j), 0), at + np.minimum(j, longer + steps - j)
        hashes, out = _hashed(characters, size)[at], []
        for place in (self.place(n), self.place(n) + 1):
            width = self.width(place)
            first, last = lowest // width, highest // width
            for i in range(int((last - first).max()) + 1):
                there = first + i <= last
                out.append((_keyed(hashes[there], size, place, first[there] + i), at[there], j[there]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def parts(self, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, at) of all parts of a text that are as long as the pieces of a text it may be similar to, no longer than it."""
        m = len(characters)
        place = self.place(m)
        n = np.arange(max(1, math.floor(m / self.ratio)), m + 1)
        out = []
        for size in np.unique(n // (_steps(n, self.least) + 1)).tolist():
            hashes = _hashed(characters, size)
            at = np.arange(len(hashes))
            out.append((_keyed(hashes, size, place, at // self.width(place)), at))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _as_characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _dealt(texts: DataFrame, how, *names: str) -> DataFrame:
    """(side, key, n, h, and integers by ``names``): what ``how`` says of each text's characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rows = [], 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                characters = _as_characters(text).astype(np.uint64)
                found = how(characters)
                held.append((i, len(characters), found))
                rows += len(found[0])
                if rows > _ROWS:
                    yield out(batch, held)
                    held, rows = [], 0
            if held:
                yield out(batch, held)

    def out(batch: pa.RecordBatch, held: list) -> pa.RecordBatch:
        sizes = [len(h) for _, _, (h, *_) in held]
        of = np.repeat([i for i, *_ in held], sizes)
        n = np.repeat([n for _, n, _ in held], sizes).astype(np.int32)
        h, *more = (np.concatenate(x) for x in zip(*(found for *_, found in held), strict=True))
        columns = [batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), pa.array(n), pa.array(h), *(pa.array(x.astype(np.int32)) for x in more)]
        return pa.RecordBatch.from_arrays(columns, names=["side", "key", "n", "h", *names])

    given = texts.select("side", "key", "text")
    return given.mapInArrow(run, f"side int, key {given.schema['key'].dataType.simpleString()}, n int, h int, {', '.join(f'{x} int' for x in names)}")


def _met_by_pieces(texts: DataFrame, least: float, alone: bool) -> DataFrame:
    """(left, right) of ``texts(side, key, text)`` that may reach the ratio: of both sides, or ``alone`` of the only one, the
    smaller key first."""
    cut = Pieces(least)
    short = _dealt(texts, cut.pieces, "at", "j").select("h", "j", *[F.col(c).alias(f"s_{c}") for c in ("side", "key", "n", "at")])
    long = _dealt(texts, cut.parts, "at").select("h", *[F.col(c).alias(f"l_{c}") for c in ("side", "key", "n", "at")])
    longer, shift, j = F.col("l_n") - F.col("s_n"), F.col("l_at") - F.col("s_at"), F.col("j")
    after = F.floor(F.lit(1 - least) * (F.col("l_n") + F.col("s_n")) + F.lit(_EASE)) - j
    fits = (F.abs(shift) <= j) & ((shift + j) % 2 == 0) & (F.abs(longer - shift) <= after)
    first = F.col("s_key") < F.col("l_key") if alone else F.col("s_side") == 0
    apart = F.col("s_key") != F.col("l_key") if alone else F.col("s_side") != F.col("l_side")
    # Pieces are far more than Spark takes a table of short texts for: they are not to be broadcast. Texts of one length would
    # meet twice.
    met = short.hint("merge").join(long, "h").where(apart & ((longer > 0) | ((longer == 0) & first)) & fits)
    return met.select(F.when(first, F.col("s_key")).otherwise(F.col("l_key")).alias("left"), F.when(first, F.col("l_key")).otherwise(F.col("s_key")).alias("right")).distinct()


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _kinds(text: pa.Array) -> pa.Array:
    counts = [np.bincount(_as_characters(x) % KINDS, minlength=KINDS).astype(np.int32) for x in text.to_pylist()]
    return pa.array(counts, pa.list_(pa.int32()))


@F.arrow_udf(T.LongType())
def _kinds_apart(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = (k.flatten().to_numpy().reshape(-1, KINDS) for k in (a, b))
    return pa.array(np.abs(x - y).sum(axis=1, dtype=np.int64))


def _near(met: DataFrame, lefts: DataFrame, rights: DataFrame, least: float) -> DataFrame:
    """What has met, without what can't reach the ratio by the numbers of each kind of character."""
    side = lambda df, name: df.select(F.col("key").alias(name), F.char_length("text").alias(f"{name}_n"), _kinds("text").alias(f"{name}_kinds"))
    both = met.join(side(lefts, "left"), "left").join(side(rights, "right"), "right")
    return both.where(_kinds_apart("left_kinds", "right_kinds") <= F.lit(1 - least) * (F.col("left_n") + F.col("right_n")) + F.lit(_EASE)).select("left", "right")


def _tiled(near: DataFrame, lefts: DataFrame, rights: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame]:
    """(tile, left, right) of all pairs, and (of_tile, side, key, text) of what each tile has pairs of."""
    across = math.ceil(math.sqrt(max(4 * tasks, near.count() / PAIRS)))
    pairs = near.withColumn("tile", F.pmod(F.xxhash64("left"), F.lit(across)) * across + F.pmod(F.xxhash64("right"), F.lit(across)))
    held = lambda df, name: pairs.select(F.col("tile").alias("of_tile"), F.col(name).alias("key")).distinct().join(df.select("key", "text"), "key").select("of_tile", F.lit(name).alias("side"), "key", "text")
    return pairs, held(lefts, "left").unionByName(held(rights, "right"))


def _scored(met: DataFrame, lefts: DataFrame, rights: DataFrame, least: float) -> DataFrame:
    """(left, right, ratio) of what has met and reaches the ratio."""
    near = stored(_near(met, lefts, rights, least), "similar-near")
    tasks = int(near.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs, texts = _tiled(near, lefts, rights, tasks)

    def score(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        of: dict[str, dict] = {"left": {}, "right": {}}
        for side, key, text in zip(*(texts[c].to_pylist() for c in ("side", "key", "text")), strict=True):
            of[side][key] = text
        ratios = [indel_ratio_from(of["left"][i], of["right"][j], 100 * least) for i, j in zip(pairs["left"].to_pylist(), pairs["right"].to_pylist(), strict=True)]
        scored = pairs.select(["left", "right"]).append_column("ratio", pa.array([None if x is None else x / 100 for x in ratios], pa.float64()))
        return scored.filter(pa.array([x is not None and x / 100 >= least - 1e-12 for x in ratios], pa.bool_()))

    kind = near.schema["left"].dataType.simpleString()
    # A number is given, as Spark would put small partitions together by their bytes.
    by_tile = lambda df, tile: df.repartition(tasks, tile).groupBy(tile)
    return by_tile(pairs, "tile").cogroup(by_tile(texts, "of_tile")).applyInArrow(score, f"left {kind}, right {kind}, ratio double")


def similar_pairs(left: DataFrame, right: DataFrame, least: float, *, left_key: str, right_key: str, text: str = "text") -> DataFrame:
    """(left_key, right_key, ratio) of all pairs with a ratio (of 1) of ``least`` or more, which is over 0.75. Keys are unique
    and of one type; null and empty texts are in no pair."""
    if not 0.75 < least <= 1:
        raise ValueError("least is over 0.75 and at most 1")
    side = lambda df, key, n: df.where(F.col(text) != "").select(F.lit(n).alias("side"), F.col(key).alias("key"), F.col(text).alias("text"), F.char_length(text).alias("n"))
    texts = side(left, left_key, 0).unionByName(side(right, right_key, 1))
    if least >= PIECES_FROM:
        met = _met_by_pieces(texts, least, alone=False)
    else:
        q = _size(least)
        border = _shortest(q, least)
        long = _meetings(texts.where(F.col("n") >= F.lit(border)), q, least)
        short = texts.where(F.col("n") <= F.lit(border * (2 - least) / least * (1 + _EASE)))
        met = long.unionByName(_meetings(short, 1, least)).distinct()
    found = _scored(met, texts.where("side = 0"), texts.where("side = 1"), least)
    return found.select(F.col("left").alias(left_key), F.col("right").alias(right_key), "ratio")


def similar_classes(df: DataFrame, least: float, *, key: str, text: str = "text") -> DataFrame:
    """(link, left, right, ratio) for all texts of one table with a ratio (of 1) of ``least`` or more, which is ``PIECES_FROM``
    at least. Equal texts are a class, named by its smallest key: ``similar`` links are those between the names of classes,
    the smaller first; ``copy`` links are those of a class's name with every other key of it. Together they say all of the
    pairs, in as many rows as there are links between different texts, and copies. Keys are unique; null and empty texts
    are in no link."""
    if not PIECES_FROM <= least <= 1:
        raise ValueError(f"least is {PIECES_FROM} at least and at most 1")
    given = df.where(F.col(text) != "").select(F.col(key).alias("key"), F.col(text).alias("text"))
    named = stored(given.groupBy("text").agg(F.min("key").alias("key"), F.count("*").alias("n")), "similar-classes")
    texts = named.select(F.lit(0).alias("side"), "key", "text")
    links = _scored(_met_by_pieces(texts, least, alone=True), texts, texts, least).select(F.lit("similar").alias("link"), "left", "right", "ratio")
    copied = named.where("n > 1").select(F.col("key").alias("left"), "text")
    copies = given.select(F.col("key").alias("right"), "text").join(copied, "text").where("left <> right")
    return links.unionByName(copies.select(F.lit("copy").alias("link"), "left", "right", F.lit(1.0).alias("ratio")))
