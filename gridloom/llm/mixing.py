"""Mixing sources to target weights by Poisson replication.

A source's mean rate of repetition is ``target weight x target size / its size``. Each document draws its number of
copies by inverting the Poisson distribution of that mean at a uniform number hashed from the seed and its identifier, so
a run can be repeated and no state is shared. Copies are exploded and shuffled globally by another hash.

Means over ``PART`` are drawn as sums of Poisson numbers of equal smaller means, whose tables stay short. Sizes are
aggregated by source before anything is joined; the table of rates has one row per source.

Everything is DataFrame code. Defined cases: a null source is a source of its own; a null text has no size but is drawn
like the others; a source without size (or weight) gives no copies; repeated rows draw the same number; an empty table
gives no rows; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import free_name, table, written

#: Largest mean of one table of probabilities, and the last number of copies in it: beyond lie less than 2^-53.
PART, LAST = 16.0, 96
#: Largest table of rates that is broadcast, in rows; larger ones are joined as Spark sees fit.
MAX_BROADCAST_SOURCES = 10_000


def hashed_unit(*parts: Column) -> Column:
    """A uniform number in (0, 1) from the parts' MD5, 52 bits of it; the same in any engine."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ..., as far as it is below 1."""
    step = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("all"))
    done = F.aggregate(
        F.sequence(F.lit(1), F.lit(LAST)), step,
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"), (a["sum"] + a["p"] * mean / k).alias("sum"), F.concat(a["all"], F.array(a["sum"] + a["p"] * mean / k)).alias("all")),
    )["all"]
    return F.filter(done, lambda x: x < F.lit(1.0 - 2.0**-53))


def source_rates(docs: DataFrame, *, source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, temperature: float = 0.5, volume: float = 1.0) -> DataFrame:
    """(source, n_docs, bytes, rate): mean number of copies of a document of each source.

    ``weights`` gives each source's share of the result in bytes; without it the shares are proportional to the sizes to
    the power ``temperature``. The result is about ``volume`` times the size of ``docs``.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n_docs"), F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0)).alias("bytes"))
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    sizes = written(sizes.withColumn("weight", F.when(F.col("bytes") > 0, weight).otherwise(0.0)), "mix-sizes")
    total = sizes.agg(F.sum("bytes").cast("double"), F.sum("weight")).first()
    all_bytes, all_weight = (float(x or 0) for x in total)
    rate = F.col("weight") / F.lit(all_weight or 1.0) * F.lit(all_bytes * volume) / F.greatest(F.col("bytes"), F.lit(1)).cast("double")
    return sizes.select("source", "n_docs", "bytes", rate.alias("rate"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, temperature: float = 0.5, volume: float = 1.0, seed: int = 7) -> DataFrame:
    """Rows of ``docs``, each as often as drawn, in a global random order, with the columns copy (from 1), n_copies and
    mix_key, by whose order the whole result is a fixed random permutation."""
    rates = source_rates(docs, source_col=source_col, text_col=text_col, weights=weights, temperature=temperature, volume=volume)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PART)).cast("int"))
    tables = written(rates.where("rate > 0").select(F.col("source"), parts.alias("parts"), poisson_cdf(F.col("rate") / parts).alias("cdf")), "mix-rates")
    if tables.count() <= MAX_BROADCAST_SOURCES:
        tables = F.broadcast(tables)
    own, n_parts, cdf, u = (free_name(docs, f"_{n}") for n in ("source", "parts", "cdf", "u"))
    copy, n_copies, mix_key = (free_name(docs, n) for n in ("copy", "n_copies", "mix_key"))
    drawn = docs.join(tables.toDF(own, n_parts, cdf), F.col(source_col).eqNullSafe(F.col(own)))
    one = lambda i: F.size(F.filter(F.col(cdf), lambda x: x < hashed_unit(F.lit(seed), F.col(id_col), i)))
    number = F.when(F.col(n_parts) == 1, F.size(F.filter(F.col(cdf), lambda x: x < F.col(u)))).otherwise(F.aggregate(F.sequence(F.lit(1), F.col(n_parts)), F.lit(0), lambda n, i: n + one(i)))
    drawn = drawn.withColumn(u, hashed_unit(F.lit(seed), F.col(id_col), F.lit(1))).withColumn(n_copies, number)
    copies = drawn.where(F.col(n_copies) > 0).select(*[F.col(c) for c in docs.columns], n_copies, F.explode(F.sequence(F.lit(1), F.col(n_copies))).alias(copy))
    keyed = copies.withColumn(mix_key, F.md5(F.concat_ws(":", F.lit("order"), F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(copy)).cast("binary")))
    # A hash of a hash: partitions are even whatever the sources are, and each is in random order.
    return keyed.repartition(F.col(mix_key)).sortWithinPartitions(mix_key)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH s AS (SELECT source, CAST(sum(strlen(text)) AS DOUBLE) AS bytes FROM documents GROUP BY source HAVING sum(strlen(text)) > 0),
r AS (SELECT source, sqrt(bytes) / (SELECT sum(sqrt(bytes)) FROM s) * (SELECT sum(bytes) FROM s) / bytes AS rate FROM s),
p AS (SELECT source, greatest(1, CAST(ceil(rate / {PART}) AS INTEGER)) AS parts, rate / greatest(1, ceil(rate / {PART})) AS mean FROM r),
k AS (SELECT source, parts, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS mass FROM p, range({LAST + 1}) AS t(k)),
c AS (SELECT source, parts, k, sum(mass) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS cdf FROM k),
u AS (SELECT d.*, p.parts, i, (CAST('0x' || substr(md5('7:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || i), 1, 13) AS BIGINT) + 0.5) / CAST({1 << 52} AS DOUBLE) AS u
      FROM documents d JOIN p ON d.source IS NOT DISTINCT FROM p.source, LATERAL (SELECT unnest(range(1, p.parts + 1)) AS i)),
n AS (SELECT u.doc_id, u.i, count(c.k) AS n FROM u LEFT JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.cdf < u.u GROUP BY u.doc_id, u.i),
m AS (SELECT doc_id, CAST(sum(n) AS INTEGER) AS n_copies FROM n GROUP BY doc_id)
SELECT d.*, m.n_copies, CAST(copy AS INTEGER) AS copy, md5('order:7:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || copy) AS mix_key
FROM documents d JOIN m ON d.doc_id = m.doc_id, LATERAL (SELECT unnest(range(1, m.n_copies + 1)) AS copy)
"""
