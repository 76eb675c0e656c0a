"""Quality by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled text. A text is cut into pieces of
``PIECE`` bytes, all of it, and each piece is compressed under either dictionary; pieces are short, so that the
dictionary and not the piece's own past decides the size, however long the text is. The normalised difference of the sums
(bad - good) / (bad + good), and the ratio of the smaller sum to the text, give a score through a logistic function
calibrated on labelled rows.

Training sees a bounded sample: ``max_rows`` labelled texts of each class at most, by a hash of the identifier, of which
whole texts up to ``dictionary_bytes`` a class feed the dictionaries and the others the calibration. Scoring is one narrow
pass over whole texts.

Defined cases: a null or empty text scores the share of good rows among the labels that may be learnt from; labels of
null, or for identifiers that no document has, are ignored; repeated rows are each scored; without rows of both classes
every score is that share (1 without labels); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import crc32_mod, map_batches, table, whole_text

PIECE, DICTIONARY, LEVEL = 256, 32 << 10, 3


@dataclass
class Model:
    share: float = 1.0
    good: bytes = b""
    bad: bytes = b""
    #: Of the logistic function: bias, difference, ratio.
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)


class Scorer:
    def __init__(self, model: Model):
        import zstandard

        self.model = model
        self.compressors = []
        for raw in (model.good, model.bad) if model.good and model.bad else ():
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def measures(self, text: str) -> tuple[float, float] | None:
        """Normalised difference of the sizes, and ratio of the smaller to the text; None for an empty text."""
        data = text.encode()
        if not data or not self.compressors:
            return None
        good, bad = (sum(len(c.compress(data[at : at + PIECE])) for at in range(0, len(data), PIECE)) for c in self.compressors)
        return (bad - good) / (bad + good), min(good, bad) / len(data)

    def __call__(self, text: str) -> float:
        found = self.measures(text)
        if found is None:
            return self.model.share
        b, d, r = self.model.weights
        z = b + d * found[0] + r * min(1.0, found[1])
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def without_shared_lines(classes: list[list[str]], least: int = 20) -> list[list[str]]:
    """Texts of both classes without the lines of ``least`` characters or more that several of them have: boilerplate and
    copies say nothing of a class, but a dictionary that holds such a line would pull every text with it to its side."""
    seen = Counter(line for texts in classes for t in texts for line in {x.strip() for x in t.split("\n")} if len(line) >= least)
    return [["\n".join(x for x in t.split("\n") if seen[x.strip()] < 2) for t in texts] for texts in classes]


def build_dictionary(texts: list[str]) -> bytes:
    """A trained dictionary of ``DICTIONARY`` bytes from the pieces of whole texts. Up to ten times that is too little for
    the trainer to choose from: then the pieces are the dictionary themselves, all of them."""
    import zstandard

    data = [t.encode() for t in texts]
    pieces = [d[at : at + PIECE] for d in data for at in range(0, len(d), PIECE)]
    if sum(map(len, pieces)) <= 10 * DICTIONARY:
        return b"".join(pieces)
    return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 50, l2: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton's method; ``x`` has a column of ones first."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + l2 / len(y) * np.eye(len(w)) + 1e-9 * np.eye(len(w))
        move = np.linalg.solve(hessian, x.T @ (p - y) / len(y) + l2 / len(y) * w)
        w -= move
        if np.abs(move).max() < 1e-9:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 3000, dictionary_bytes: int = 3 << 20) -> Model:
    """A model from rows with ``may_learn`` (a condition on the identifier)."""
    spark = docs.sparkSession
    usable = labels.where(may_learn & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    counts = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 1.0
    if not counts.get(0) or not counts.get(1):
        return Model(share=share)
    # Bounded by 2 x max_rows identifiers, so they may be broadcast.
    chosen = [tuple(r) for y in (0, 1) for r in usable.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(max_rows).select(id_col, "y").collect()]
    own = spark.createDataFrame(chosen, "s_id long, y int")
    size = F.octet_length("text")
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).join(F.broadcast(own), F.col("doc_id") == F.col("s_id")).where(size > 0)
    # Sizes first: only as many whole texts come to the driver as the dictionaries take.
    sizes = sorted(((r["y"], r["h"], r["doc_id"], r["n"]) for r in found.select("y", F.xxhash64("doc_id").alias("h"), "doc_id", size.alias("n")).collect()))
    taken: set[int] = set()
    for y in (0, 1):
        mine = [s for s in sizes if s[0] == y]
        used = 0
        for i, (_, _, doc, n) in enumerate(mine):
            if used + n <= dictionary_bytes and i < 0.6 * len(mine):
                taken.add(doc)
                used += n
    in_dictionary = F.col("doc_id").isin(sorted(taken))
    texts = sorted((r["y"], r["doc_id"], r["text"]) for r in found.where(in_dictionary).select("y", "doc_id", "text").collect())
    good, bad = without_shared_lines([[t for y, _, t in texts if y == kind] for kind in (1, 0)])
    model = Model(share, build_dictionary(good), build_dictionary(bad))
    rest = found.where(~in_dictionary).select("y", "text")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = Scorer(model)
        got = [scorer.measures(t) or (0.0, 1.0) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got]), pa.array([min(1.0, g[1]) for g in got])], names=["y", "d", "r"])

    rows = sorted(tuple(r) for r in map_batches(rest, measure, "y int, d double, r double").collect())
    if {r[0] for r in rows} == {0, 1}:
        y = np.array([r[0] for r in rows], dtype=float)
        x = np.array([[1.0, r[1], r[2]] for r in rows])
        # Classes are sampled up to max_rows each; the bias is set back to their share among all labels.
        w = calibrate(x, y)
        w[0] += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
        model.weights = tuple(w.tolist())
    else:
        model.good = model.bad = b""
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the chance that the text is good."""
    state: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.append(Scorer(model))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([state[0](t) for t in batch.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    return map_batches(docs.select(F.col(id_col).cast("long"), whole_text(text_col)), run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, *, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below the threshold; a filter on each batch, with nothing joined."""
    at = docs.columns.index(text_col)
    state: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.append(Scorer(model))
        return batch.filter(pa.array([state[0](t or "") >= threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def held_out_fold(id_col: str = "doc_id") -> Column:
    return crc32_mod(F.col(id_col), 5) == 0


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, train(docs, labels, ~held_out_fold()))
    return scored.select("doc_id", held_out_fold().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
