"""Sharding by sampled splitters: shards of near-equal bytes.

A record's key is the hash of its text and then its identifier, so equal texts lie together, but a large group of them
can be cut anywhere. A size-weighted sample of keys gives quantile boundaries of many small ranges; ranges that turn out
overfull are sampled again and subdivided. The exact bytes and rows of each range are counted, and shards are cut at equal
bytes from the ranges in order: a record belongs to the shard that holds the middle of its bytes. Slots count on from
range to range. So the records move once, dealt by range, and no task holds more than a range.

Sizes of ranges and the samples come to the driver; both are bounded by ``max_ranges``.

Everything is DataFrame code. Defined cases: a null text has no bytes (the size is 1) and the CRC of no bytes; a null
identifier sorts before the others; repeated rows are placed each for itself, but rows that share identifier and text stay
in one range; an empty table gives no rows; other columns
stay as they are.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import free_name, table, written

#: Aims: bytes in a range, sampled keys in a range, and fewest ranges in a shard.
RANGE_BYTES, SAMPLES, RANGES_A_SHARD = 32 << 20, 32, 8
_LOWEST = -(1 << 63)
#: Most times that overfull ranges are sampled again and subdivided.
MAX_CUTS = 8

Key = tuple[int, int]


def _longs(values: list[int]) -> Column:
    """A constant array of longs; as one string, so that thousands of values stay one literal in the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.lit(None).cast("array<bigint>")


def _below(bounds: list[Key], key: Column, doc: Column) -> Column:
    """How many of the bounds are at or below (key, doc)."""
    if not bounds:
        return F.lit(0)
    own = F.struct(key.alias("k"), doc.alias("d"))
    pairs = F.arrays_zip(_longs([k for k, _ in bounds]).alias("k"), _longs([d for _, d in bounds]).alias("d"))
    return F.size(F.filter(pairs, lambda b: F.struct(b["k"].alias("k"), b["d"].alias("d")) <= own))


def range_of(bounds: list[Key], key: Column, doc: Column) -> Column:
    """Number of the range of (key, doc) among sorted bounds: a search in every ``step``-th bound, then in one step."""
    if len(bounds) <= 64:
        return _below(bounds, key, doc)
    step = int(len(bounds) ** 0.5) + 1
    coarse = bounds[step - 1 :: step]
    block = _below(coarse, key, doc)
    own = F.struct(key.alias("k"), doc.alias("d"))
    pairs = F.slice(F.arrays_zip(_longs([k for k, _ in bounds]).alias("k"), _longs([d for _, d in bounds]).alias("d")), block * step + 1, F.lit(step))
    return block * step + F.size(F.filter(pairs, lambda b: F.struct(b["k"].alias("k"), b["d"].alias("d")) <= own))


def _sample(slim: DataFrame, per_byte: float, salt: int) -> list[tuple[Key, float]]:
    """Keys drawn with a chance in proportion to their size, with the bytes each stands for, in order."""
    unit = F.xxhash64(F.lit(salt), "key", "doc").bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / F.lit(float(1 << 52))
    chance = F.col("size") * F.lit(per_byte)
    drawn = slim.where(unit < chance).select("key", "doc", "size").collect()
    return sorted(((r["key"], r["doc"]), max(float(r["size"]), 1 / per_byte)) for r in drawn)


def _quantiles(sample: list[tuple[Key, float]], n: int) -> list[Key]:
    """Keys at the n - 1 inner quantiles of the sample's bytes."""
    ends = list(accumulate(w for _, w in sample))
    return sorted({sample[min(bisect_right(ends, ends[-1] * i / n), len(sample) - 1)][0] for i in range(1, n)}) if ends else []


def _range_sizes(slim: DataFrame, bounds: list[Key]) -> dict[int, tuple[int, int]]:
    sizes = slim.groupBy(range_of(bounds, F.col("key"), F.col("doc")).alias("r")).agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    return {row["r"]: (row["b"], row["n"]) for row in sizes.collect()}


def splitters(slim: DataFrame, total: int, ranges: int) -> tuple[list[Key], dict[int, tuple[int, int]]]:
    """Bounds of about ``ranges`` ranges of ``slim(key, doc, size)``, overfull ones subdivided, and each range's (bytes, rows)."""
    aim = total / ranges
    bounds = _quantiles(_sample(slim, SAMPLES * ranges / total, 0), ranges)
    sizes = _range_sizes(slim, bounds)
    for salt in range(1, MAX_CUTS + 1):
        over = [r for r, (b, n) in sizes.items() if b > 2 * aim and n > 1]
        if not over:
            break
        spot = range_of(bounds, F.col("key"), F.col("doc"))
        inside = slim.where(F.array_contains(_longs(over), spot.cast("long")))
        drawn = _sample(inside, SAMPLES / aim, salt)
        cuts = set(bounds)
        for r in over:
            own = [x for x in drawn if bisect_right(bounds, x[0]) == r]
            cuts.update(_quantiles(own, max(2, round(sizes[r][0] / aim))))
        if len(cuts) == len(bounds):  # what is left over shares one key, which nothing can cut
            break
        bounds = sorted(cuts)
        sizes = _range_sizes(slim, bounds)
    return bounds, sizes


def shard_by_bytes(docs: DataFrame, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text", max_ranges: int = 16384) -> DataFrame:
    """``docs`` with size (UTF-8 bytes and 1), shard (0 to ``shards`` - 1) and slot (gapless from 0 in a shard)."""
    size, shard, slot = (free_name(docs, n) for n in ("size", "shard", "slot"))
    key, doc, spot, upto, at = (free_name(docs, f"_{n}") for n in ("key", "doc", "range", "upto", "row"))
    placed = docs.withColumns({
        size: F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 1,
        key: F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
        doc: F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)),
    })
    slim = written(placed.select(F.col(key).alias("key"), F.col(doc).alias("doc"), F.col(size).alias("size")), "shard-keys")
    total = slim.agg(F.sum("size")).first()[0] or 0
    if not total:
        return docs.select("*", F.lit(0).cast("long").alias(size), F.lit(0).alias(shard), F.lit(0).cast("long").alias(slot)).limit(0)

    ranges = min(max_ranges, max(RANGES_A_SHARD * shards, -(-total // RANGE_BYTES)))
    bounds, sizes = splitters(slim, total, ranges)
    n = len(bounds) + 1
    bytes_before = [0, *accumulate(sizes.get(r, (0, 0))[0] for r in range(n))]
    rows_before = [0, *accumulate(sizes.get(r, (0, 0))[1] for r in range(n))]

    def shard_at(twice_middle: int) -> int:
        return min(shards - 1, twice_middle * shards // (2 * total))

    def of(begin: Column, running: Column, own: Column) -> Column:
        return F.least(F.lit(shards - 1), F.floor(((begin + running) * 2 - own) * F.lit(shards) / F.lit(2 * total))).cast("int")

    # Ranges with a cut inside, fewer than shards: their rows are counted by shard.
    cut = [r for r in range(n) if r in sizes and shard_at(2 * bytes_before[r] + 1) != shard_at(2 * bytes_before[r + 1] - 1)]
    first_row = [0] * shards
    rows_in: dict[int, dict[int, int]] = {r: {shard_at(2 * bytes_before[r] + 1): sizes[r][1]} for r in range(n) if r in sizes and r not in set(cut)}
    if cut:
        inside = slim.withColumn("r", range_of(bounds, F.col("key"), F.col("doc"))).where(F.array_contains(_longs(cut), F.col("r").cast("long")))
        order = Window.partitionBy("r").orderBy("key", "doc", "size")
        running = inside.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        counts = running.groupBy("r", of(F.element_at(_longs(bytes_before), F.col("r") + 1), F.col("upto"), F.col("size")).alias("s")).count()
        for row in counts.collect():
            rows_in.setdefault(row["r"], {})[row["s"]] = row["count"]
    rows_of = [sum(c.get(s, 0) for c in rows_in.values()) for s in range(shards)]
    first_row = [0, *accumulate(rows_of)][:shards]

    order = Window.partitionBy(spot).orderBy(key, doc, size)
    numbered = placed.withColumn(spot, range_of(bounds, F.col(key), F.col(doc))).withColumns({upto: F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)), at: F.row_number().over(order)})
    assigned = numbered.withColumn(shard, of(F.element_at(_longs(bytes_before), F.col(spot) + 1), F.col(upto), F.col(size)))
    row = F.element_at(_longs(rows_before), F.col(spot) + 1) + F.col(at) - 1
    return assigned.select(*[F.col(c) for c in docs.columns], size, shard, (row - F.element_at(_longs(first_row), F.col(shard) + 1)).alias(slot))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Store each shard in a folder of its own."""
    sharded.write.partitionBy("shard").parquet(path)


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return shard_by_bytes(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
