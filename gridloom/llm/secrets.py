"""Secrets by a trigram inverted index.

From each rule's pattern a Boolean query of trigrams is derived: what every match must contain. Every Arrow batch of
texts is a segment of the index, with postings for the trigrams that some query names: sorted numbers of the texts that
contain it. Queries are answered by intersecting and uniting postings, and only the texts they leave are searched with
the pattern. Rules whose matches need not contain any one trigram search every text. A segment's postings are used in
the task that makes them, so nothing is shuffled, and a task's memory is one batch's.

Base rules (leftmost, non-overlapping by kind; matches that fail are dropped, and nothing is tried again inside):

* assign ``(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)``, letters of the cue in
  either case, group 2 of 6 characters or more
* access ``AKIA[A-Z0-9]+`` of 20 characters or more
* hex ``[0-9a-f]+`` of 24 characters or more

``ADDED`` holds further kinds: private key headers, and tokens with a known start. ``find_secrets`` takes any rules.

Defined cases: a null or empty text has no spans; repeated rows are each searched; long texts are searched whole; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import map_batches, table, whole_text

#: A clause holds trigrams that must all be there; a query is a list of parts, and of each part one clause must hold.
Clause = frozenset[str]
Query = list[frozenset[Clause]]
#: Most strings that a stretch of a pattern is spelled out to, and most characters of a class that is.
MOST_STRINGS, MOST_CHARACTERS = 64, 16
#: Bytes of a segment that are looked through at once.
WINDOW = 1 << 22
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint32)


@dataclass(frozen=True)
class Rule:
    """``group`` of a match of ``pattern`` must have ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        return [(m.start(), m.end(), self.kind) for m in re.finditer(self.pattern, text) if m.end(self.group) - m.start(self.group) >= self.least]


BASE = (
    Rule("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: What precedes them keeps the search linear: a start inside a run of the same characters is not tried.
ADDED = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]{2,12} )?PRIVATE KEY-----"),
    Rule("github", r"(?<![A-Za-z0-9_])gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("google", r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]{35}"),
    Rule("slack", r"(?<![A-Za-z0-9-])xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)


def _clauses(strings: Iterable[str]) -> frozenset[Clause] | None:
    """One clause for each string, its trigrams; none at all if a string has no trigram. Clauses that ask for more than
    another are left out. Trigrams are those of the lower-cased UTF-8 bytes."""
    found = set()
    for s in strings:
        b = s.encode().lower()
        grams = frozenset(b[i : i + 3].decode("latin-1") for i in range(len(b) - 2))
        if not grams:
            return None
        found.add(grams)
    return frozenset(c for c in found if not any(other < c for other in found))


class _Derivation:
    """Goes through a parsed pattern; ``ends`` are the strings that the stretch just read may be."""

    def __init__(self) -> None:
        self.parts: Query = []
        self.ends = {""}

    def closed(self) -> None:
        """The stretch can't be spelled out any further: what it must contain becomes a part."""
        clauses = _clauses(self.ends)
        if clauses:
            self.parts.append(clauses)
        self.ends = {""}

    def then(self, strings: set[str]) -> None:
        if len(self.ends) * len(strings) > MOST_STRINGS:
            self.closed()
        if len(strings) > MOST_STRINGS:
            return
        self.ends = {a + b for a, b in product(self.ends, strings)}

    def read(self, items: Sequence) -> None:
        for op, value in items:
            strings = _spelled_out([(op, value)])
            if strings is not None:
                self.then(strings)
                continue
            name = str(op)
            if name == "SUBPATTERN":
                self.read(value[3])
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
                self.read(value[2])  # one round must be there, at the end of what is known
                self.closed()
            elif name == "BRANCH":
                self.closed()
                self._one_of([derived(items) for items in value[1]])
            elif name == "ATOMIC_GROUP":
                self.read(value)
            elif name not in ("ASSERT", "ASSERT_NOT", "AT"):
                self.closed()

    def _one_of(self, queries: list[Query]) -> None:
        """Of a choice, each way gives its sharpest part, if every way has one."""
        if all(queries):
            clauses = {c for q in queries for c in max(q, key=lambda part: min(map(len, part)))}
            self.parts.append(frozenset(c for c in clauses if not any(other < c for other in clauses)))


def _spelled_out(items: Sequence) -> set[str] | None:
    """All strings that the parsed items match, if they are few and none depends on its surroundings."""
    found = {""}
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            now: set[str] | None = {chr(value)}
        elif name == "IN":
            now = set()
            for kind, v in value:
                span = range(v, v + 1) if str(kind) == "LITERAL" else range(v[0], v[1] + 1) if str(kind) == "RANGE" else None
                if span is None or len(span) > MOST_CHARACTERS:
                    return None
                now |= {chr(c) for c in span}
            if len(now) > MOST_CHARACTERS:
                return None
        elif name == "SUBPATTERN":
            now = _spelled_out(value[3])
        elif name == "BRANCH":
            ways = [_spelled_out(way) for way in value[1]]
            now = None if any(w is None for w in ways) else set().union(*ways)
        elif name == "MAX_REPEAT" and value[1] <= 4:
            once = _spelled_out(value[2])
            now = None if once is None or len(once) ** value[1] > MOST_STRINGS else {"".join(w) for n in range(value[0], value[1] + 1) for w in product(once, repeat=n)}
        else:
            return None
        if now is None or len(found) * len(now) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, now)}
    return found


def derived(items: Sequence) -> Query:
    d = _Derivation()
    d.read(items)
    d.closed()
    return d.parts


def trigram_query(pattern: str) -> Query:
    """What every match of the pattern must contain, in lower case. An empty query: nothing in particular."""
    return derived(re._parser.parse(pattern))


class Segment:
    """Postings of some trigrams over the texts of an Arrow column."""

    def __init__(self, texts: pa.Array, grams: list[str], number: np.ndarray):
        """``number`` has at each trigram's value its place in ``grams``, from 1."""
        column = texts.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        content = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.size, found = len(column), []
        for begin in range(int(at[0]), max(int(at[-1]) - 2, int(at[0])), WINDOW):
            b = _LOWER[content[begin : min(begin + WINDOW + 2, int(at[-1]))]]
            gram = number[b[:-2] << 16 | b[1:-1] << 8 | b[2:]]
            hit = np.flatnonzero(gram)
            place = hit + begin
            text = np.searchsorted(at, place, "right") - 1
            inside = place + 3 <= at[text + 1]  # not over the border of two texts
            found.append(np.unique(gram[hit][inside].astype(np.int64) * self.size + text[inside]))
        keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        bounds = np.searchsorted(keys // max(self.size, 1), np.arange(1, len(grams) + 2))
        self.postings = {g: keys[bounds[i] : bounds[i + 1]] % max(self.size, 1) for i, g in enumerate(grams)}

    def answer(self, query: Query) -> np.ndarray:
        """Numbers of the texts that have, of every part, one clause whole."""
        left = np.arange(self.size)
        for part in query:
            either = np.zeros(0, np.int64)
            for clause in part:
                both = left
                for gram in sorted(clause, key=lambda g: len(self.postings[g])):  # the rarest first
                    both = np.intersect1d(both, self.postings[gram], assume_unique=True)
                either = np.union1d(either, both)
            left = either
        return left


class Scanner:
    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(rule, trigram_query(rule.pattern)) for rule in rules]
        self.grams = sorted({g for _, query in self.rules for part in query for clause in part for g in clause})
        self.number = np.zeros(1 << 24, np.uint8 if len(self.grams) < 255 else np.uint16)
        for i, (a, b, c) in enumerate((g.encode("latin-1") for g in self.grams), 1):
            self.number[a << 16 | b << 8 | c] = i
        self.order = {rule.kind: i for i, rule in enumerate(rules)}

    def __call__(self, texts: pa.Array) -> list[list[tuple[int, int, str]]]:
        """Each text's spans, by start and then by kind in the rules' order."""
        segment, found, whole = Segment(texts, self.grams, self.number), [[] for _ in range(len(texts))], {}
        for rule, query in self.rules:
            for i in segment.answer(query).tolist() if query else range(len(texts)):
                text = whole[i] if i in whole else whole.setdefault(i, texts[i].as_py())
                found[i] += rule.spans(text)
        for spans in found:
            spans.sort(key=lambda s: (s[0], self.order[s[2]]))
        return found


def joined(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *ADDED), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): each text's spans, an array of (kind, start, end) in code points with exclusive ends, by start and
    then by kind in the rules' order. ``find_secrets`` goes through every text once."""
    rules, state = tuple(rules), []
    entry = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.append(Scanner(rules))
        found = [[{"kind": k, "start": a, "end": b} for a, b, k in spans] for spans in state[0](batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, entry)], names=["doc_id", "spans"])

    return map_batches(docs.select(F.col(id_col).cast("long"), whole_text(text_col)), run, "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint>>")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    kinds = [rule.kind for rule in BASE]
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda some: F.filter("spans", lambda s: s["kind"].isin(some))
    counts = [F.size(of([k])).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(text(of(kinds)).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
