"""How far the word use of sources is from each other, with terms split into heavy and light ones.

Each (lang, source) group gives every kept term of its lang a smoothed share in billionths, ``1 + floor(10^9 (count + 5)
/ (N + 5 V))``; the distance of two groups is the sum of the differences over all kept terms. A group that lacks a term
gives it the group's *base*, the share of count zero. Over all terms two groups' bases differ ``V`` times; what the
terms that occur add to that is summed tile by tile, a tile being some thousand terms of a lang:

* *heavy* terms, present in a good part of the groups, make a dense matrix of terms by groups, whose columns are
  subtracted from each other;
* *light* terms are postings (term, group, share). A posting of one group is set against the base of every other by
  sorted prefix sums; where two groups share a term, a pair correction puts that right.

Sums are of integers, so both partial sums add up exactly. Groups are dealt in blocks of ``BLOCK``, so a tile's matrices
have a bound of their own however many groups there are. Counts are added up in the tasks that read the texts, then by
Spark; terms that few documents have go before counts are spread over groups.

Defined cases: a null text, lang or source is empty; repeated rows count each; groups without terms, and langs without
kept terms, have rows (values 0 if no term is kept); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.collocations import CHUNK_BYTES, Words
from gridloom.llm.common import best_rows, if_small, lookup, slices, table, whole_text, written

#: Groups of a block, terms of a tile, the share of a tile's groups from which on a term is heavy.
BLOCK, TILE, HEAVY_SHARE = 256, 1024, 0.25
#: Counts a task holds before it hands them on.
HELD_COUNTS = 1_000_000
SCALE, SMOOTHING = 1_000_000_000, 5
#: Everything but letters and bytes of characters beyond ASCII to space, A-Z to lower case.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TALLIES = "lang string, term string, docs long, sources array<string>, counts array<long>"


def term_numbers(text: str, numbers: Words) -> np.ndarray:
    """Numbers of the text's terms, in order."""
    blob, at, parts = text.encode().translate(_TERM_BYTES), 0, []
    while at < len(blob):
        end = blob.find(b" ", at + CHUNK_BYTES)
        end = len(blob) if end < 0 else end
        terms = blob[at:end].split()
        parts.append(np.fromiter(map(numbers.__getitem__, terms), np.int64, len(terms)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of the values under each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], *[np.add.reduceat(v[order], starts) if len(starts) else v[:0] for v in values]


class _Tally:
    """Counts of a lang's terms by source, as they come in; a key is term * 2^31 + source."""

    def __init__(self) -> None:
        self.numbers, self.sources, self.parts, self.size = Words(), Words(), [], 0

    def add(self, texts: list[str], sources: list[str]) -> None:
        found = [term_numbers(t, self.numbers) for t in texts]
        of = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        if not len(of):
            _ = [self.sources[s] for s in sources]
            return
        source = np.array([self.sources[s] for s in sources])
        in_text, n = _summed((of << 31) | np.concatenate(found), np.ones(len(of), np.int64))
        keys = ((in_text & 0x7FFFFFFF) << 31) | source[in_text >> 31]
        self.parts.append(_summed(keys, n, np.ones(len(keys), np.int64)))
        self.size += len(self.parts[-1][0])
        if len(self.parts) > 64:
            self.merge()

    def merge(self) -> None:
        self.parts = [_summed(*[np.concatenate(c) for c in zip(*self.parts, strict=True)])] if self.parts else []
        self.size = sum(len(p[0]) for p in self.parts)

    def batch(self, lang: str) -> pa.RecordBatch:
        """A row for each term, and one without a term that lists the sources."""
        self.merge()
        keys, n, docs = self.parts[0] if self.parts else [np.zeros(0, np.int64)] * 3
        names = pa.array(list(self.sources), pa.string())
        term, starts = np.unique(keys >> 31, return_index=True)
        offsets = np.concatenate([starts, [len(keys), len(keys) + len(names)]]).astype(np.int32)
        source = pa.concat_arrays([names.take(pa.array(keys & 0x7FFFFFFF)), names])
        words = [w.decode() for w in self.numbers]
        columns = [
            pa.array([lang] * (len(term) + 1), pa.string()),
            pa.array([*[words[t] for t in term], None], pa.string()),
            pa.array(np.concatenate([np.add.reduceat(docs, starts) if len(term) else docs, [0]])),
            pa.ListArray.from_arrays(offsets, source),
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([n, np.zeros(len(names), np.int64)]))),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _TALLIES.split(", ")])


def term_tallies(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts by (lang, term) with those by source, of the texts that a task has read; a row without a term lists sources."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, _Tally] = {}
        for batch in slices(batches):
            rows: dict[str, tuple[list[str], list[str]]] = {}
            for text, lang, source in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                of = rows.setdefault(lang, ([], []))
                of[0].append(text)
                of[1].append(source)
            for lang, (texts, sources) in rows.items():
                tallies.setdefault(lang, _Tally()).add(texts, sources)
            if sum(t.size for t in tallies.values()) > HELD_COUNTS:
                for t in tallies.values():
                    t.merge()
                while sum(t.size for t in tallies.values()) > HELD_COUNTS // 2:
                    largest = max(tallies, key=lambda lang: tallies[lang].size)
                    yield tallies.pop(largest).batch(largest)
        for lang, tally in tallies.items():
            yield tally.batch(lang)

    return docs.select(whole_text(text_col), whole_text(lang_col), whole_text(source_col)).mapInArrow(run, _TALLIES)


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in billionths; the product passes 64 bits, so it is a decimal's."""
    wide = lambda c: c.cast("decimal(28,0)")
    above, below = wide(count + F.lit(SMOOTHING)) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + SMOOTHING * terms)
    return F.when(terms > 0, F.call_function("div", above, below) + 1).otherwise(F.lit(0)).cast("long")


def kept_terms(docs: DataFrame, *, least: int = 30, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(groups, postings): every (lang, source) with its number ``g`` in the lang, size, base and the lang's sums; each
    kept term (lang, id, term, total) with its postings, an array of (source, n)."""
    tallies = written(term_tallies(docs, text_col=text_col, lang_col=lang_col, source_col=source_col), "term-tallies")
    hashed = lambda df: df.withColumn("h", F.xxhash64("lang", "term"))
    found = hashed(tallies.where(F.col("term").isNotNull()))
    terms = found.groupBy("h", "lang", "term").agg(F.sum("docs").alias("docs"), F.count("*").alias("tallies")).where(F.col("docs") >= least)
    terms = written(terms.withColumn("id", F.monotonically_increasing_id()), "terms")
    held = lookup(found.select("h", "lang", "term", "sources", "counts"), terms.select("h", "lang", "term", "tallies", "id"), ["h", "lang", "term"], rows="tallies", total=found.count(), spread=["sources", "counts"])
    spread = held.select("id", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))))
    counts = spread.groupBy("id", "source").agg(F.sum("n").alias("n"))
    postings = counts.groupBy("id").agg(F.collect_list(F.struct("source", "n")).alias("postings"), F.sum("n").alias("total"))
    postings = written(postings.join(terms.select("id", "lang", "term"), "id"), "term-postings")

    seen = tallies.where(F.col("term").isNull()).select("lang", F.explode("sources").alias("source")).distinct()
    sizes = postings.select("lang", F.inline("postings")).groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = postings.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = seen.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", *[zero(c) for c in ("size", "terms", "lang_size")])
    groups = groups.withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    return written(groups.withColumn("base", share(F.lit(0).cast("long"), F.col("size"), F.col("terms"))), "term-groups"), postings


def tile_sums(ids: np.ndarray, g: np.ndarray, p: np.ndarray, starts: tuple[int, int], bases: tuple[np.ndarray, np.ndarray], heavy_share: float = HEAVY_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """(dense, light): what the tile's terms add, beyond the bases, to the distance of each group of the first block (rows)
    from each of the second (columns). Of one block with itself, what lies above the diagonal counts."""
    same = starts[0] == starts[1]
    rows, base = len(bases[0]), bases[0] if same else np.concatenate(bases)
    first = (g >= starts[0]) & (g < starts[0] + rows)
    column = np.where(first, g - starts[0], (0 if same else rows) + g - starts[1])
    others = slice(0, rows) if same else slice(rows, None)
    apart = np.abs(base[:rows, None] - base[None, others])

    _, term, length = np.unique(ids, return_inverse=True, return_counts=True)
    heavy_term = length >= heavy_share * len(base)
    heavy = heavy_term[term]
    matrix = np.tile(base, (int(heavy_term.sum()), 1))
    matrix[(np.cumsum(heavy_term) - 1)[term[heavy]], column[heavy]] = p[heavy]
    dense = np.stack([np.abs(matrix[:, c, None] - matrix[:, others]).sum(0) for c in range(rows)]) - len(matrix) * apart

    light = np.zeros((len(base), len(base)), np.int64)
    order = np.lexsort((column[~heavy], term[~heavy]))
    term, column, p = term[~heavy][order], column[~heavy][order], p[~heavy][order]
    for c in np.unique(column):  # a posting of group c, every other group at its base
        own = np.sort(p[column == c])
        sums = np.concatenate([[0], np.cumsum(own)])
        below = np.searchsorted(own, base)
        light[c] += base * (2 * below - len(own)) + sums[-1] - 2 * sums[below] - len(own) * np.abs(base[c] - base)
    light += light.T.copy()
    step = 1
    while len(term) > step and (pair := np.flatnonzero(term[step:] == term[:-step])).size:  # both groups have the term
        a, b = column[pair], column[pair + step]
        right = np.abs(p[pair] - p[pair + step]) - np.abs(p[pair] - base[b]) - np.abs(base[a] - p[pair + step]) + np.abs(base[a] - base[b])
        np.add.at(light, (a, b), right)
        step += 1
    return dense, light[:rows, others]


def group_distances(groups: DataFrame, postings: DataFrame, *, width: int = BLOCK, tile: int = TILE, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """(lang, g, other, value) of each two groups of a lang, ``g`` < ``other``, from blocks of ``width`` groups and tiles of
    some ``tile`` terms."""
    small = if_small(groups)
    entries = postings.select("lang", "id", F.inline("postings")).join(small, ["lang", "source"])
    block = F.floor(F.col("g") / width).cast("int")
    entries = entries.select("lang", "id", "g", share(F.col("n"), F.col("size"), F.col("terms")).alias("p"), block.alias("b"), F.pmod(F.xxhash64("id"), F.ceil(F.col("terms") / tile)).alias("tile"))
    blocks = written(groups.groupBy("lang", block.alias("b"), "terms").agg(F.array_sort(F.collect_list(F.struct("g", "base"))).alias("of")), "term-blocks")
    both = blocks.select("lang", "terms", F.col("b").alias("b1"), F.col("of.base").alias("base1")).join(blocks.select("lang", F.col("b").alias("b2"), F.col("of.base").alias("base2")), "lang").where("b1 <= b2")
    both = written(both, "term-block-pairs")
    with_block = entries.join(if_small(both.select("lang", "b1", "b2")), "lang").where("b = b1 or b = b2") if blocks.where("b > 0").take(1) else entries.withColumns({"b1": F.lit(0), "b2": F.lit(0)})
    tiles = with_block.groupBy("lang", "b1", "b2", "tile").agg(F.collect_list(F.struct("id", "g", "p")).alias("entries")).join(both, ["lang", "b1", "b2"])
    bases = both.select("lang", "b1", "b2", F.lit(None).cast("long").alias("tile"), F.array().cast("array<struct<id:bigint,g:int,p:bigint>>").alias("entries"), "terms", "base1", "base2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                value = lambda c, i=i, batch=batch: batch.column(c)[i].as_py()
                starts = value("b1") * width, value("b2") * width
                base = np.array(value("base1"), np.int64), np.array(value("base2"), np.int64)
                if value("tile") is None:  # all terms at their bases
                    light = value("terms") * np.abs(base[0][:, None] - base[1][None, :])
                    dense = np.zeros_like(light)
                else:
                    entries = batch.column("entries")[i].values
                    columns = [entries.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "g", "p")]
                    dense, light = tile_sums(*columns, starts, base, heavy_share)
                a, b = np.indices(dense.shape).reshape(2, -1)
                a, b = a + starts[0], b + starts[1]
                keep = a < b
                columns = [pa.array(a[keep], pa.int32()), pa.array(b[keep], pa.int32()), pa.array(dense.reshape(-1)[keep]), pa.array(light.reshape(-1)[keep])]
                yield pa.RecordBatch.from_arrays([pa.array([value("lang")] * int(keep.sum()), pa.string()), *columns], names=["lang", "g", "other", "dense", "light"])

    partial = tiles.select(*bases.columns).unionByName(bases).mapInArrow(run, "lang string, g int, other int, dense long, light long")
    return partial.groupBy("lang", "g", "other").agg((F.sum("dense") + F.sum("light")).alias("value"))


def over_used_terms(groups: DataFrame, postings: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): each group's terms with the largest share above that in the whole lang."""
    entries = postings.select("lang", "term", "total", F.inline("postings")).join(if_small(groups), ["lang", "source"])
    gap = share(F.col("n"), F.col("size"), F.col("terms")) - share(F.col("total"), F.col("lang_size"), F.col("terms"))
    found = written(entries.where("n > 0").select("lang", "source", "term", gap.alias("gap")).where("gap > 0"), "term-gaps")
    best = best_rows(found, ["lang", "source"], F.struct((-F.col("gap")).alias("late"), "term"), top)
    ranked = best.select("lang", "source", F.posexplode("best").alias("at", "e"))
    return ranked.select("lang", "source", F.col("e.term").alias("item"), (-F.col("e.late")).alias("value"), (F.col("at") + 1).alias("rank"))


def source_divergence(docs: DataFrame, *, least: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has a group's distance from every other source of its lang,
    part ``term`` its ``top`` over-used terms."""
    groups, postings = kept_terms(docs, least=least, text_col=text_col, lang_col=lang_col, source_col=source_col)
    found = written(group_distances(groups, postings), "term-distances")
    every = found.unionByName(found.select("lang", F.col("other").alias("g"), F.col("g").alias("other"), "value"))
    names = groups.select("lang", "g", "source")
    pairs = every.join(if_small(names), ["lang", "g"]).join(if_small(names.withColumnsRenamed({"g": "other", "source": "item"})), ["lang", "other"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    terms = over_used_terms(groups, postings, top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
o AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, source, sum(n)::HUGEINT AS size FROM c GROUP BY ALL),
cells AS (SELECT grp.lang, grp.source, kept.term, coalesce(c.n, 0) AS n,
                 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(size.size, 0) + 5 * v.v) AS p
          FROM grp JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN size USING (lang, source)),
whole AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)::HUGEINT) // (any_value(total) + 5 * any_value(v))::HUGEINT AS q
          FROM c JOIN (SELECT lang, sum(size)::HUGEINT AS total FROM size GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM cells x JOIN cells y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
          ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM cells JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT * FROM (SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
               FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)) WHERE part = 'pair' OR rank <= 50
"""
