"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other texts, labelled or not, are unlabelled. A linear model over word and
word-stem indicators is fitted in numpy to the class-prior-corrected risk ``prior R+(p) + max(0, R-(u) - prior R-(p))``
with logistic loss; where the corrected part turns negative its gradient is reversed (Kiryo et al., 2017). The prior is
the share of toxic rows among the labels that may be learnt from.

Which features count is decided on all texts that may be learnt from: those of the positives are counted over every one
of them, where the texts are. The fit itself sees a bounded sample: ``max_positive`` and ``max_unlabelled`` documents, drawn
by a hash of the identifier. The driver gets the counts of ``MAX_CANDIDATES`` features at most and, for each sampled
document, the numbers of the ``max_features`` features it has. Scoring is one narrow pass over whole texts.

Defined cases: a null or empty text has no words and is scored by the bias alone; labels of null, or for identifiers that
no document has, are ignored; repeated rows are each scored; without any positive every score is the prior (0 if there
are no labels); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import crc32_mod, map_batches, slices, table, whole_text, written

_WORD = re.compile(r"\w+")
#: Lengths of word beginnings that count as stems.
STEMS = (5, 6, 7, 8)
#: A feature is kept if it is so many standard errors more frequent in the positives.
DEVIATIONS = 5.0
#: Steps between looks at the weights, and the largest change of any of them that ends the fit.
LOOK, STILL = 50, 2e-3
#: Features of the positives, the most frequent ones, that are counted over all texts.
MAX_CANDIDATES = 50_000
#: Words whose features a worker remembers before it starts anew.
MEMO = 400_000


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """The word and its stems, which end with a star."""
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]


@dataclass
class Model:
    """Weights by feature; ``length`` belongs to the scaled logarithm of the number of distinct words."""

    bias: float = 0.0
    length: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def scaled_length(n_words: int) -> float:
        return math.log1p(n_words) / 5 - 1


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.memo: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: str) -> float:
        words = words_of(text)
        hits: set[str] = set()
        memo, weights = self.memo, self.model.weights
        for w in words:
            found = memo.get(w)
            if found is None:
                if len(memo) >= MEMO:
                    memo.clear()
                found = memo[w] = tuple(f for f in features_of(w) if f in weights)
            if found:
                hits.update(found)
        z = self.model.bias + self.model.length * Model.scaled_length(len(words)) + sum(weights[f] for f in sorted(hits))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def fit_nnpu(p: tuple[np.ndarray, np.ndarray, np.ndarray], u: tuple[np.ndarray, np.ndarray, np.ndarray], n_features: int, prior: float, *, steps: int = 3000, rate: float = 0.05) -> np.ndarray:
    """Weights, the length's weight and the bias. ``p`` and ``u`` are (row numbers, feature numbers, lengths by row).

    The penalty on the weights falls with the number of positives, as the evidence for them grows. The fit ends after
    ``steps``, or as soon as ``LOOK`` steps have moved no weight by more than ``STILL``.
    """
    w = np.zeros(n_features + 2)
    before = w.copy()
    l2 = min(1e-4, 0.04 / max(1, len(p[2])))
    first, second = np.zeros_like(w), np.zeros_like(w)
    sets = []
    for rows, cols, lengths in (p, u):
        sets.append((rows, cols, lengths, max(1, len(lengths))))

    def margin(s: tuple) -> np.ndarray:
        return np.bincount(s[0], w[s[1]], len(s[2])) + w[-2] * s[2] + w[-1]

    def gradient(s: tuple, each: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(s[1], each[s[0]], n_features), [each @ s[2], each.sum()]])

    for step in range(1, steps + 1):
        zp, zu = margin(sets[0]), margin(sets[1])
        up, uu = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        as_negative = gradient(sets[1], uu / sets[1][3]) - gradient(sets[0], prior * up / sets[0][3])
        if negative >= 0:
            g = gradient(sets[0], -prior * (1 - up) / sets[0][3]) + as_negative
        else:
            g = -as_negative
        g[:-1] += l2 * w[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        if step % LOOK == 0:
            if np.abs(w - before).max() < STILL:
                break
            before = w.copy()
    return w


def _positive_counts(positives: DataFrame) -> DataFrame:
    """(feature, n): sampled positives that have each feature, added up by task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                counts.update({f for w in words_of(text) for f in features_of(w)})
        names = list(counts)
        for at in range(0, len(names), 100_000):
            some = names[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([counts[x] for x in some], pa.int64())], names=["feature", "n"])

    return positives.select("text").mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _counts_everywhere(texts: DataFrame, features: list[str]) -> np.ndarray:
    """How many of all ``texts`` have each of the features; a task returns one number for each."""
    number = {f: i for i, f in enumerate(features)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(number), dtype=np.int64)
        memo: dict[str, tuple[int, ...]] = {}
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                hits: set[int] = set()
                for w in words_of(text):
                    if (found := memo.get(w)) is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        found = memo[w] = tuple(number[f] for f in features_of(w) if f in number)
                    hits.update(found)
                counts[list(hits)] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["feature", "n"])

    out = np.zeros(len(features), dtype=np.int64)
    for r in texts.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        out[r["feature"]] = r["n"]
    return out


def _vocabulary(positives: DataFrame, texts: DataFrame, n_pos: int, n_all: int, limit: int, support: float) -> list[str]:
    """Features of the positives that are rarer among all ``texts``; of those with one stem and the same counts, the longest."""
    common = _positive_counts(positives).where(F.col("n") >= max(2.0, support * n_pos)).orderBy(F.desc("n"), "feature").limit(MAX_CANDIDATES)
    rows = [(r["feature"], r["n"]) for r in common.collect()]
    if not rows:
        return []
    everywhere = _counts_everywhere(texts, [f for f, _ in rows])
    positive = np.array([n for _, n in rows])
    share = (positive + everywhere) / (n_pos + n_all)
    z = (positive / n_pos - everywhere / n_all) / np.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_all) + 1e-12)
    best = sorted((i for i in np.flatnonzero(z > DEVIATIONS).tolist()), key=lambda i: (-z[i], rows[i][0]))[:limit]
    kept: dict[tuple, str] = {}
    for i in sorted(best, key=lambda i: (rows[i][0].endswith("*"), -len(rows[i][0]), rows[i][0])):
        kept.setdefault((rows[i][0].rstrip("*")[: STEMS[0]], positive[i], everywhere[i]), rows[i][0])
    return sorted(kept.values())


def _rows_of_features(sample: DataFrame, vocabulary: list[str]) -> DataFrame:
    number = {f: i for i, f in enumerate(vocabulary)}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, lists = [], []
        for text in batch.column(2).to_pylist():
            words = words_of(text)
            lengths.append(len(words))
            lists.append(sorted({number[f] for w in words for f in features_of(w) if f in number}))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lengths, pa.int32()), pa.array(lists, pa.list_(pa.int32()))], names=["doc_id", "positive", "n_words", "features"])

    return map_batches(sample.select("doc_id", "positive", "text"), run, "doc_id long, positive int, n_words int, features array<int>")


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_positive: int = 4000, max_unlabelled: int = 12000, max_features: int = 4096, support: float = 0.02) -> Model:
    """A model from rows with ``may_learn`` (a condition on the identifier). Features in less than ``support`` of the sampled
    positives are left out."""
    spark = docs.sparkSession
    usable = labels.where(may_learn & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    n_labels, n_toxic = usable.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n_toxic:
        return Model(bias=-500.0)
    prior = float(n_toxic) / n_labels
    # Bounded by max_positive, so it may be broadcast.
    positives = usable.where("y = 1").orderBy(F.xxhash64(id_col), id_col).limit(max_positive).select(F.col(id_col).alias("p_id"))
    positives = spark.createDataFrame([(r[0],) for r in positives.collect()], "p_id long")
    free = docs.where(may_learn).select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    n = free.select("doc_id").count()
    part = F.pmod(F.xxhash64(F.lit("unlabelled"), "doc_id"), F.lit(1 << 40)) < F.lit(math.ceil((1 << 40) * min(1.0, max_unlabelled / max(1, n))))
    marked = free.join(F.broadcast(positives), F.col("doc_id") == F.col("p_id"), "left").where(F.col("p_id").isNotNull() | part)
    # A positive is drawn for the unlabelled part like any other text: that part stands for all texts.
    rows = marked.select("doc_id", "text", F.explode(F.filter(F.array(F.when(F.col("p_id").isNotNull(), 1), F.when(part, 0)), lambda x: x.isNotNull())).alias("positive"))
    sample = written(rows, "toxicity-sample")
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model(bias=math.log(prior / (1 - prior)) if prior < 1 else 500.0)
    vocabulary = _vocabulary(sample.where("positive = 1"), free, sizes[1], n, max_features, support)
    found = sorted(_rows_of_features(sample, vocabulary).collect(), key=lambda r: (r["positive"], r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"]))
    sets = []
    for kind in (1, 0):
        own = [r for r in found if r["positive"] == kind]
        lists = [r["features"] for r in own]
        rows_, cols = np.repeat(np.arange(len(own)), [len(x) for x in lists]), np.array([c for x in lists for c in x], dtype=np.int64)
        sets.append((rows_, cols, np.array([Model.scaled_length(r["n_words"]) for r in own])))
    w = fit_nnpu(sets[0], sets[1], len(vocabulary), prior)
    return Model(bias=float(w[-1]), length=float(w[-2]), weights=dict(zip(vocabulary, w[:-2].tolist(), strict=True)))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the chance that the text is toxic."""
    state: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.append(Scorer(model))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([state[0](t) for t in batch.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    return map_batches(docs.select(F.col(id_col).cast("long"), whole_text(text_col)), run, "doc_id long, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc32_mod(F.col("doc_id"), 3) == 1
    model = train(docs, labels, ~held_out)
    scored = score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
