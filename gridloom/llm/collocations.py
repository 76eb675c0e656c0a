"""Phrases whose words belong together, by position bitmaps.

Every (lang, word) of a shard has a compressed bitmap of its positions: of the blocks of 16 positions only those that
hold the word, each with its 16 bits. Separators take a position of their own, so a bitmap shifted by one never runs
from one piece into the next. A phrase grows by shift and AND: the ends of the phrase, shifted by one, meet the words of
the same blocks; popcounts of what is left are the occurrences in the shard, and Spark adds them up over shards. A walk
goes down first: a batch of first words is extended to the end before the next batch starts, so a task holds one shard
and one batch.

A phrase that is frequent has frequent parts only. So the walk is run twice, with what is frequent in between:

1. shards of some ``SHARD_POSITIONS`` positions, of one lang each, are written with their words, counts and bitmaps;
2. pairs of frequent words are counted in every shard;
3. three and four words are counted along frequent pairs, in one walk.

Words and pairs are added up by windows over the shards' rows, so what is frequent comes back with the shards that hold
it, after one shuffle. Frequent words are numbered without gaps, so that two of them make one 64-bit number. A word or pair has one row for each shard at most, so the most common one has no more rows than
there are shards. Only numbers of words are broadcast, if they are counted to be few.

Defined cases: a null text is empty; a null lang counts as ``und``; repeated rows count each; a text of any length is
taken in chunks; texts without words and empty tables give no phrases; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import best_rows, if_small, lookup, slices, table, whole_text, written

#: Positions after which a shard is closed.
SHARD_POSITIONS = 2_000_000
#: Bitmap blocks of the phrases that are extended at once, bytes of text split at once.
BATCH_BLOCKS, CHUNK_BYTES = 100_000, 1 << 20
SEPARATOR = b"."
#: A-Z to lower case, the separators ``[.,;:!?\x0A-\x0D]`` to one of them, tab to space.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz......... ")
_SHARDS = "shard long, lang string, words array<string>, counts array<int>, blocks_of binary, blocks binary, bits binary"
_NONE = -1
#: Bits of a word's id where two share a number; ids are below 2^31, so all ones are no word.
_HALF, _LOW = 32, (1 << 32) - 1
#: Bits of a word's number in its shard, and of a shard's number in its task: together with the task's they make an id.
_WORD_BITS, _SHARD_BITS = 25, 16


class Words(dict):
    """Numbers of words in the order in which they come; 0 is the separator."""

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


def word_numbers(texts: list[str], numbers: Words) -> Iterator[np.ndarray]:
    """Numbers of the texts' words, position by position, with a separator after each piece."""
    blob = (SEPARATOR.join(t.encode() for t in texts) + SEPARATOR).translate(_FOLD).replace(SEPARATOR, b" . ")
    at = 0
    while at < len(blob):
        end = blob.find(b" ", at + CHUNK_BYTES)
        end = len(blob) if end < 0 else end
        words = blob[at:end].split()
        yield np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        at = end


def _packed(a: np.ndarray) -> bytes:
    """Compressed, first bytes of all numbers first: the high bytes are mostly zero."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"")


def _unpacked(b: bytes, dtype: type) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).reshape(-1)


def bitmaps(positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, block, bits) of the blocks that hold a word, by word and then block, without the separator's."""
    order = np.argsort(positions, kind="stable")[np.count_nonzero(positions == 0) :].astype(np.int32)
    word, block = positions[order], order >> 4
    starts = np.flatnonzero((np.diff(word, prepend=np.int32(-1)) != 0) | (np.diff(block, prepend=np.int32(-1)) != 0))
    bit = np.left_shift(np.uint16(1), (order & 15).astype(np.uint16))
    return word[starts], block[starts], np.bitwise_or.reduceat(bit, starts) if len(starts) else bit


class _Open:
    """A shard that is being filled."""

    def __init__(self) -> None:
        self.numbers, self.parts, self.size = Words({SEPARATOR: 0}), [], 0

    def add(self, texts: list[str]) -> None:
        for part in word_numbers(texts, self.numbers):
            self.parts.append(part)
            self.size += len(part)

    def row(self, shard: int, lang: str) -> dict:
        positions = np.concatenate(self.parts)
        word, block, bits = bitmaps(positions)
        n = len(self.numbers)
        if n > 1 << _WORD_BITS:
            raise ValueError(f"a shard has {n} different words")
        return {
            "shard": shard, "lang": lang, "words": [w.decode() for w in self.numbers if w != SEPARATOR], "counts": np.bincount(positions, minlength=n)[1:],
            "blocks_of": _packed(np.bincount(word, minlength=n)[1:].astype(np.int32)), "blocks": _packed(np.diff(block, prepend=np.int32(0))), "bits": _packed(bits),
        }


def shard_bitmaps(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", positions: int = SHARD_POSITIONS) -> DataFrame:
    """One row for each shard of a lang: its words, their counts and their bitmaps. Not one text is cut."""
    schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("blocks_of", pa.binary()), ("blocks", pa.binary()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, open_shards = TaskContext.get().partitionId(), 0, {}

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal made
            if made == 1 << _SHARD_BITS:
                raise ValueError(f"a task has over {made} shards; use smaller input splits")
            row = open_shards.pop(lang).row((task << _SHARD_BITS) + made, lang)
            made += 1
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in slices(batches):
            texts: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, some in texts.items():
                open_shards.setdefault(lang, _Open()).add(some)
            while sum(s.size for s in open_shards.values()) >= positions:
                yield closed(max(open_shards, key=lambda lang: open_shards[lang].size))
        for lang in list(open_shards):
            yield closed(lang)

    return docs.select(whole_text(text_col), F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))).mapInArrow(run, _SHARDS)


class Shard:
    """The bitmaps of a shard's frequent words, by word and by block. Words go by their place among the frequent ones."""

    def __init__(self, blocks_of: bytes, blocks: bytes, bits: bytes, at: np.ndarray, ids: np.ndarray):
        lengths, blocks, bits = _unpacked(blocks_of, np.int32), np.cumsum(_unpacked(blocks, np.int32), dtype=np.int32), _unpacked(bits, np.uint16)
        order = np.argsort(ids)
        self.ids, places = ids[order], np.full(len(lengths), _NONE, np.int32)
        places[at[order]] = np.arange(len(at), dtype=np.int32)
        word = np.repeat(places, lengths)
        order = np.argsort(word, kind="stable")[np.count_nonzero(word == _NONE) :]
        self.word, self.block, self.bits = word[order], blocks[order], bits[order]
        by_block = np.argsort(self.block, kind="stable")
        self.block_word, self.block_bits = self.word[by_block], self.bits[by_block]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.block, minlength=int(self.block.max(initial=0)) + 2))])

    def key(self, left: np.ndarray, word: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) * len(self.ids) + word

    def places(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids)

    def batches(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(word, block, bits) of some words each, all blocks of a word together: ``BATCH_BLOCKS`` and those of one word at most."""
        starts = np.flatnonzero(np.diff(self.word, prepend=np.int32(-1)))
        cuts = starts[np.flatnonzero(np.diff(starts // BATCH_BLOCKS, prepend=-1))]
        for at, end in zip(cuts, np.append(cuts[1:], len(self.word)), strict=False):
            yield self.word[at:end], self.block[at:end], self.bits[at:end]

    def extended(self, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, word, block, bits): the given bitmaps shifted by one, ANDed with the words' bitmaps, as far as bits are left."""
        over = np.flatnonzero(bits >> 15)
        row = np.concatenate([np.arange(len(block)), over])
        block, bits = np.concatenate([block, block[over] + 1]), np.concatenate([bits << 1, bits[over] >> 15])
        start = self.first[block]
        n = self.first[block + 1] - start
        with_word = np.repeat(np.arange(len(row)), n)
        at = np.arange(len(with_word)) + np.repeat(start - np.cumsum(n) + n, n)
        left = bits[with_word] & self.block_bits[at]
        keep = np.flatnonzero(left)
        with_word = with_word[keep]
        return row[with_word], self.block_word[at[keep]], block[with_word], left[keep]


def _counted(keys: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the bits set under each."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.add.reduceat(np.bitwise_count(bits[order]).astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    return keys[starts], counts


def _found(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """The place of each key in the sorted ``among``, or -1."""
    at = np.searchsorted(among, keys)
    return np.where(among[np.minimum(at, len(among) - 1)] == keys, at, _NONE) if len(among) else np.full(len(keys), _NONE)


def pairs_of(shard: Shard) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pair, count) batch by batch; a pair is its first word's id, then its second's."""
    size = len(shard.ids)
    for word, block, bits in shard.batches():
        row, second, _, left = shard.extended(block, bits)
        keys, n = _counted(shard.key(word[row], second), left)
        yield shard.ids[keys // size] << _HALF | shard.ids[keys % size], n


def longer_of(shard: Shard, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(pair, rest, count) along the frequent ``pairs``; the rest is the third word's id, then the fourth's or all ones."""
    size = len(shard.ids)
    known = np.sort(shard.key(shard.places(pairs >> _HALF), shard.places(pairs & _LOW)))
    pair = shard.ids[known // size] << _HALF | shard.ids[known % size]
    for word, block, bits in shard.batches():
        row, second, block, bits = shard.extended(block, bits)
        two = _found(shard.key(word[row], second), known)
        ok = np.flatnonzero(two >= 0)
        two, second, block, bits = two[ok], second[ok], block[ok], bits[ok]

        row, third, block, bits = shard.extended(block, bits)
        ok = np.flatnonzero(_found(shard.key(second[row], third), known) >= 0)
        keys, third, block, bits = shard.key(two[row[ok]], third[ok]), third[ok], block[ok], bits[ok]
        three, n = _counted(keys, bits)
        yield pair[three // size], shard.ids[three % size] << _HALF | _LOW, n
        node = np.searchsorted(three, keys)

        row, fourth, _, bits = shard.extended(block, bits)
        ok = np.flatnonzero(_found(shard.key(third[row], fourth), known) >= 0)
        keys, n = _counted(shard.key(node[row[ok]], fourth[ok]), bits[ok])
        of = three[keys // size]
        yield pair[of // size], shard.ids[of % size] << _HALF | shard.ids[keys % size], n


def _walked(shards: DataFrame, held: DataFrame, longer: bool) -> DataFrame:
    """The walk in every shard: (shard, pair, n) of the words it holds, which come as their places there and their ids, or
    (shard, pair, rest, n) along the pairs it holds."""
    names = ["shard", "pair", *(["rest"] if longer else []), "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                packed = [batch.column(c)[i].as_py() for c in ("blocks_of", "blocks", "bits")]
                words = batch.column("words")[i].values.to_numpy(zero_copy_only=False)
                shard = Shard(*packed, words >> _HALF, words & _LOW)
                for rows in longer_of(shard, batch.column("pairs")[i].values.to_numpy(zero_copy_only=False)) if longer else pairs_of(shard):
                    columns = [np.full(len(rows[0]), batch.column("shard")[i].as_py()), *rows]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    joined = shards.select("shard", "blocks_of", "blocks", "bits").join(held, "shard")
    return joined.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _frequent(counts: DataFrame, keys: list[str], least: int, own: Column, once: list[str], name: str) -> DataFrame:
    """Rows of keys found ``least`` times or more in all shards, with the sum ``f``, the smallest ``own`` number as ``id`` and
    whether the row is the one with that number, ``first``. Columns in ``once`` are kept in that row alone."""
    same = Window.partitionBy(*keys)
    summed = counts.withColumns({"f": F.sum("n").over(same), "id": F.min(own).over(same)}).withColumn("first", own == F.col("id"))
    kept = summed.where(F.col("f") >= least).drop("n")
    return written(kept.withColumns({c: F.when(F.col("first"), F.col(c)) for c in once}), name)


def _without_gaps(words: DataFrame) -> DataFrame:
    """``words`` with the column ``number``, from 0 on: places in the parts of the written table, after the parts before."""
    placed = written(words.withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33)), "phrase-words-placed")
    parts = sorted(placed.groupBy("part").count().collect())  # a row for each part of the table
    before = [sum(n for _, n in parts[:i]) for i in range(len(parts) + 1)]
    if before[-1] >= _LOW >> 1:
        raise ValueError(f"{before[-1]} frequent words")
    starts = words.sparkSession.createDataFrame([(p, at) for (p, _), at in zip(parts, before, strict=False)], "part long, start long")
    number = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(starts), "part").withColumn("number", number).drop("part", "place", "start")


def _by_shard(rows: DataFrame, entry: Column, name: str) -> DataFrame:
    """(shard, name): a shard's entries as one array, which the shard bounds."""
    return rows.groupBy("shard").agg(F.collect_list(entry).alias(name))


def frequent_phrases(docs: DataFrame, *, least: int = 30, text_col: str = "text", lang_col: str = "lang", positions: int = SHARD_POSITIONS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals): frequent words (id, lang, word, f); frequent phrases of two to four words
    (w1, w2, w3, w4, f), by the words' ids, -1 where there is none; all words of each lang (lang, n)."""
    shards = written(shard_bitmaps(docs, text_col=text_col, lang_col=lang_col, positions=positions), "phrase-shards")
    totals = shards.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda n, x: n + x)).alias("n"))
    entries = F.inline(F.arrays_zip(F.sequence(F.lit(0), F.size("words") - 1).alias("at"), F.col("words").alias("word"), F.col("counts").alias("n")))
    own_words = shards.where(F.size("words") > 0).select("shard", "lang", entries)
    held = _frequent(own_words, ["lang", "word"], least, F.expr(f"shiftleft(shard, {_WORD_BITS}) + at"), ["lang", "word", "f"], "phrase-words")
    words = written(_without_gaps(held.where("first").select("id", "lang", "word", "f")), "phrase-words-numbered")
    held = held.select("shard", "at", "id").join(if_small(words.select("id", "number")), "id")
    held = written(_by_shard(held, F.shiftleft(F.col("at").cast("long"), _HALF).bitwiseOR(F.col("number")), "words"), "phrase-words-held")

    pairs = _frequent(_walked(shards, held, longer=False), ["pair"], least, F.col("shard"), ["f"], "phrase-pairs")
    longer = _walked(shards, held.join(_by_shard(pairs, F.col("pair"), "pairs"), "shard"), longer=True)
    longer = longer.groupBy("pair", "rest").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    no_rest = F.lit(None).cast("long").alias("rest")
    high, low = lambda c: F.shiftright(c, _HALF), lambda c: F.col(c).bitwiseAND(F.lit(_LOW))
    none = F.lit(_NONE).cast("long")
    ids = [high("pair").alias("w1"), low("pair").alias("w2"), F.coalesce(high("rest"), none).alias("w3"), F.when(low("rest") == _LOW, none).otherwise(F.coalesce(low("rest"), none)).alias("w4")]
    phrases = pairs.where("first").select("pair", no_rest, "f").unionByName(longer).select(*ids, "f")
    return words.select(F.col("number").alias("id"), "lang", "word", "f"), written(phrases, "phrases"), totals


_KEY = ["k1", "k2", "k3"]


def _parts(phrases: DataFrame) -> DataFrame:
    """All proper contiguous parts of every phrase: (phrase, length, f, start, size, k1, k2, k3)."""
    word = lambda i: F.col(f"w{i}")
    none = F.lit(_NONE).cast("long")

    def part(start: int, size: int) -> Column:
        keys = [word(start + i + 1) if i < size else none for i in range(3)]
        return F.when((F.col("length") > size) & (F.col("length") >= start + size), F.struct(F.lit(start).alias("start"), F.lit(size).alias("size"), *[k.alias(n) for k, n in zip(keys, _KEY, strict=True)]))

    every = F.array_compact(F.array(*[part(start, size) for size in (1, 2, 3) for start in range(5 - size)]))
    return phrases.select("phrase", "length", "f", F.inline(every))


def scored_phrases(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases that no longer one stands for.

    A phrase goes if a longer one holds its words and has 80 % of its occurrences. The score is that of the lowest cut.
    """
    length = sum((F.when(F.col(f"w{i}") != _NONE, 1).otherwise(0) for i in (3, 4)), F.lit(2))
    phrases = written(phrases.withColumn("phrase", F.monotonically_increasing_id()).withColumn("length", length), "phrases-numbered")
    parts = written(_parts(phrases), "phrase-parts")
    none = F.lit(_NONE).cast("long")
    no_text = F.lit(None).cast("string")
    of_words = words.select(F.col("id").alias("k1"), none.alias("k2"), none.alias("k3"), F.col("f").alias("part_f"), "lang", "word")
    of_phrases = phrases.where("length < 4").select(F.col("w1").alias("k1"), F.col("w2").alias("k2"), F.col("w3").alias("k3"), F.col("f").alias("part_f"), no_text.alias("lang"), no_text.alias("word"))
    uses = parts.groupBy(*_KEY).agg(F.count("*").alias("uses"), F.max("f").alias("most"))
    known = written(uses.join(of_words.unionByName(of_phrases), _KEY), "phrase-parts-known")

    wide = lambda c: F.col(c).cast("decimal(38,0)")
    gone = known.where((F.col("k2") != _NONE) & (wide("most") * 100 >= wide("part_f") * 80)).select(*[F.col(k).alias(f"w{i}") for i, k in enumerate(_KEY, 1)], none.alias("w4"))
    kept = phrases.join(if_small(written(gone, "phrases-gone")), ["w1", "w2", "w3", "w4"], "left_anti").select("phrase")
    found = lookup(parts, known.drop("most"), _KEY, rows="uses", total=parts.count(), spread=["phrase", "start", "size"])

    at = lambda cond, c: F.max(F.when(cond, F.col(c)))
    start, size, length = F.col("start"), F.col("size"), F.col("length")
    sides = [at((start == 0) & (size == i), "part_f").alias(f"l{i}") for i in (1, 2, 3)] + [at((start == i) & (start + size == length), "part_f").alias(f"r{i}") for i in (1, 2, 3)]
    texts = [at((start == i) & (size == 1), "word").alias(f"t{i}") for i in range(4)]
    whole = found.groupBy("phrase").agg(F.max("f").alias("a"), F.max("lang").alias("lang"), *sides, *texts).join(kept, "phrase")

    def cut(i: int) -> Column:
        score = F.expr(f"(2000000BD * cast(a as decimal(25,0))) div (cast(l{i} as decimal(25,0)) + cast(r{i} as decimal(25,0)))")
        return F.when(F.col(f"r{i}").isNotNull(), F.struct(score.alias("score"), F.lit(i).alias("k"), F.col(f"l{i}").alias("l"), F.col(f"r{i}").alias("r")))

    lowest = F.array_min(F.array_compact(F.array(*[cut(i) for i in (1, 2, 3)])))
    return whole.select("lang", F.concat_ws(" ", "t0", "t1", "t2", "t3").alias("phrase"), "a", lowest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, *, least: int = 30, top: int = 2000, text_col: str = "text", lang_col: str = "lang", positions: int = SHARD_POSITIONS) -> DataFrame:
    """Each lang's ``top`` phrases: (lang, rank, phrase, a, l, r, n, score)."""
    words, phrases, totals = frequent_phrases(docs, least=least, text_col=text_col, lang_col=lang_col, positions=positions)
    scored = written(scored_phrases(words, phrases), "phrases-scored")
    entry = F.struct((-F.col("score")).alias("late"), (-F.col("a")).alias("few"), "phrase", "l", "r")
    best = best_rows(scored, ["lang"], entry, top).join(totals, "lang")
    ranked = best.select("lang", "n", F.posexplode("best").alias("at", "e"))
    return ranked.select("lang", (F.col("at") + 1).cast("long").alias("rank"), "e.phrase", (-F.col("e.few")).alias("a"), "e.l", "e.r", "n", (-F.col("e.late")).alias("score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9), 'abcdefghijklmnopqrstuvwxyz ') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split(piece, ' '), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, ws[i:i + k - 1] AS ph FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), (VALUES (1), (2), (3), (4)) AS ks(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, ph, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
tot AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, ph, f AS a FROM f WHERE k >= 2),
sub AS (SELECT lang, ph[i:j] AS ph, max(a) AS most FROM (SELECT c.*, unnest(range(1, k + 1)) AS i FROM c), (VALUES (1), (2), (3), (4)) AS js(j) WHERE j > i AND j <= k AND j - i + 1 < k GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN sub USING (lang, ph) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT),
cuts AS (SELECT lang, ph, a, unnest(range(1, k)) AS i, k FROM kept),
s AS (SELECT cuts.lang, cuts.ph, a, i, x.f AS l, y.f AS r, CAST((2000000 * a::HUGEINT) // (x.f + y.f) AS BIGINT) AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.ph = cuts.ph[1:i] JOIN f y ON y.lang = cuts.lang AND y.ph = cuts.ph[i + 1:cuts.k]),
b AS (SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, i) = 1),
o AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN tot USING (lang) WHERE rank <= 2000
"""
