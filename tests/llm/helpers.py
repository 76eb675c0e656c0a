from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Cases that every operator has to get through.
ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", None, 0),
    (3, "   \n\t ", None, "a", 6),
    (4, "word", "en", "a", 4),
    (5, "Same text in several rows, long enough to count as a line.", "en", "a", 1),
    (6, "Same text in several rows, long enough to count as a line.", "en", "b", 1),
    (7, "SAME text in several rows, long enough to count as a line.", "fr", "b", 1),
    (7, "SAME text in several rows, long enough to count as a line.", "fr", "b", 1),
    (8, "É accents É stay as they are é, a long enough line here", "fr", "b", 1),
    (9, "é accents É stay as they are é, a long enough line here", "fr", "b", 1),
    (10, "very long " * 30000, "en", "c", 1),
    (11, "x" * 200_000, "en", "c", 1),
    (None, "No identifier here, but a text that is long enough", "en", "a", 1),
    (12, "one two three four five six 漢字 😀 seven eight", "en", "a", 1),
]


def odd_docs(spark):
    return spark.createDataFrame(ODD, DOCS)


def clashing(df):
    """The table with more columns, named like those that operators add."""
    from pyspark.sql import functions as F

    for name in ("copy", "n_copies", "mix_key", "shard", "slot", "size", "n_lines", "n_dropped", "_doc", "_text_hash", "_mask", "_key", "_range", "fp", "score", "hash", "head"):
        df = df.withColumn(name, F.lit("x"))
    return df


def texts(n: int, seed: int = 0) -> list[str]:
    """Prose with copies, near copies, shared lines and odd characters."""
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "eta", "Theta", "iota", "kappa", "+1 (555) 010-9999", "a.b@c.example.org", "10.1.2.3", "4111 1111 1111 1111"]
    shared = [" ".join(r.choice(words) for _ in range(8)) for _ in range(6)]
    out: list[str] = []
    for _ in range(n):
        kind = r.random()
        if out and kind < 0.15:
            out.append(r.choice(out))
        elif out and kind < 0.3:
            w = r.choice(out).split(" ")
            w[r.randrange(len(w))] = r.choice(words)
            out.append(" ".join(w))
        elif out and kind < 0.35:
            out.append(r.choice(out).upper() if r.random() < 0.5 else "")
        else:
            lines = [" ".join(r.choice(words) for _ in range(r.randrange(1, 30))) for _ in range(r.randrange(1, 8))]
            lines.insert(r.randrange(len(lines) + 1), ("  " if r.random() < 0.5 else "") + r.choice(shared))
            out.append("\n".join(lines))
    return out


def docs_of(spark, some: list[str], partitions: int = 3):
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(some)]
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]
