"""Personal data by anchor expansion.

An Aho-Corasick automaton runs over every whole text and finds anchors: at-signs, plus signs, digits, URL schemes and
identifier cues. A parser of its own for each anchor expands left and right from there, in time linear in the span, and
validates what it found. No text is shuffled; the state of a task is one Arrow batch.

Kinds email, ip, card and phone follow fixed patterns (leftmost, non-overlapping by kind, failing matches dropped):

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, each part at most 255
* card ``[0-9]([\\x20-]?[0-9])+`` of 16 to 19 digits that pass Luhn's test
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]`` of 8 to 15 digits

Two more kinds come from the other anchors: ``url`` (scheme, then a host with a dot or a user part) and ``account`` (an
identifier cue, a separator and a value of at least 8 letters and digits with a digit in it; after ``iban`` the value
must pass the mod 97 test). They too are leftmost and don't overlap within their kind. Parsers remember how far they
have read, so the whole is linear in the text.

Defined cases: a null or empty text has no spans; repeated rows are each scanned; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import map_batches, table, whole_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("token", "api_key", "apikey", "secret", "password", "passwd", "account", "iban")

Span = tuple[int, int]

_DIGIT = frozenset("0123456789")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE_RUN = re.compile(r"[ ().0-9-]+")
_URL_TAIL = re.compile(r"[^\s<>\"'`{}|\\^\[\]]+")
_HOST_END = re.compile(r"[/?#]")
_SEPARATOR = re.compile(r"[\"']?\s{0,3}[:=#]\s{0,3}[\"']?(?=[A-Za-z0-9])")
_VALUE = re.compile(r"[A-Za-z0-9_+/=-]+")
_IBAN = re.compile(r"\W{1,4}([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,3})?)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    v = value.replace(" ", "").upper()
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def email_at(text: str, at: int, free: int) -> Span | None:
    """The address around the at-sign; ``free`` is the end of the address before it."""
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def ip_at(text: str, start: int) -> tuple[Span | None, int]:
    """Four dotted numbers from the first digit on: the span if the parts are small enough, and where to go on."""
    at, parts = start, []
    while len(parts) < 4 and (m := _DIGITS.match(text, at)):
        parts.append(m.group())
        end = at = m.end()
        if len(parts) < 4:
            if text[end : end + 1] != ".":
                break
            at = end + 1
    if len(parts) < 4:
        return None, end
    return ((start, end) if all(len(n := p.lstrip("0")) <= 3 and int(n or "0") <= 255 for p in parts) else None), end


def card_at(text: str, start: int) -> tuple[Span | None, int]:
    """The chain of digits with single spaces or hyphens between: the span if it is a card number, and its end."""
    m = _CHAIN.match(text, start)
    if not m:
        return None, start + 1
    digits = m.group().replace(" ", "").replace("-", "")
    return ((start, m.end()) if 16 <= len(digits) <= 19 and luhn(digits) else None), m.end()


def phone_at(text: str, plus: int) -> Span | None:
    if text[plus + 1 : plus + 2] not in _DIGIT:
        return None
    m = _PHONE_RUN.match(text, plus + 2)
    if not m:
        return None
    end = m.end()
    while text[end - 1] not in _DIGIT:  # back to the run's last digit; the digit after the sign stops it
        end -= 1
    if end < plus + 4:
        return None
    return (plus, end) if 8 <= sum(c in _DIGIT for c in text[plus:end]) <= 15 else None


def url_end(text: str, after: int) -> int:
    """Where the run behind a scheme ends, without closing punctuation. All schemes in one run share its end."""
    m = _URL_TAIL.match(text, after)
    end = m.end() if m else after
    while end > after and text[end - 1] in ".,;:!?)*":
        end -= 1
    return end


def url_host(text: str, after: int, end: int) -> bool:
    """Whether there is a user part, or a host with a dot. Reads no further than the next scheme's slashes."""
    m = _HOST_END.search(text, after, end)
    host = text[after : m.start() if m else end]
    return "." in host.rpartition("@")[2].strip(".") or "@" in host


def iban_at(text: str, after: int) -> Span | None:
    m = _IBAN.match(text, after)
    return m.span(1) if m and iban_ok(m.group(1)) else None


def value_at(text: str, after: int, barren: int) -> tuple[Span | None, int]:
    """A value behind a cue and a separator, and ``barren``: the end of the last run of value characters that holds no
    digit from where it was read, so that no value that starts in it is read again."""
    m = _SEPARATOR.match(text, after)
    if not m or m.end() < barren:
        return None, barren
    value = _VALUE.match(text, m.end())
    if not _DIGITS.search(text, *value.span()):
        return None, value.end()
    return (value.span() if value.end() - value.start() >= 8 else None), barren


class Finder:
    def __init__(self) -> None:
        import ahocorasick

        self.anchors = ahocorasick.Automaton()
        for c in "0123456789":
            self.anchors.add_word(c, ("digit", c))
        for kind, words in (("at", "@"), ("plus", "+"), ("scheme", SCHEMES), ("cue", CUES)):
            for w in words:
                for form in {w, w.upper(), w.capitalize()}:
                    self.anchors.add_word(form, (kind, w))
        self.anchors.make_automaton()

    def __call__(self, text: str) -> dict[str, list[Span]]:
        """Spans by kind, in order, as code points with exclusive ends."""
        spans: dict[str, list[Span]] = {k: [] for k in KINDS}
        email_free = ip_free = card_free = url_free = url_run = account_free = barren = 0
        for last, (kind, word) in self.anchors.iter(text):
            if kind == "digit":
                if last >= ip_free:
                    span, ip_free = ip_at(text, last)
                    if span:
                        spans["ip"].append(span)
                if last >= card_free:
                    span, card_free = card_at(text, last)
                    if span:
                        spans["card"].append(span)
            elif kind == "at":
                if span := email_at(text, last, email_free):
                    spans["email"].append(span)
                    email_free = span[1]
            elif kind == "plus":
                if span := phone_at(text, last):
                    spans["phone"].append(span)
            elif kind == "scheme":
                start, after = last - len(word) + 1, last + 1
                if start >= url_free:
                    url_run = url_end(text, after) if start >= url_run else url_run
                    if url_run > after and url_host(text, after, url_run):
                        spans["url"].append((start, url_run))
                        url_free = url_run
            elif last >= account_free:
                if word == "iban":
                    span = iban_at(text, last + 1)
                else:
                    span, barren = value_at(text, last + 1, barren)
                if span:
                    spans["account"].append(span)
                    account_free = span[1]
        return spans


def joined(spans: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_url long, n_account long, n_spans long"


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every text: counts by base kind, the SHA-256 of the base spans, all spans as ``kind:start:end``, and
    the counts of the other kinds and of all spans."""
    state: list[Finder] = []

    def batch_spans(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.append(Finder())
        found = [state[0](t) for t in batch.column(1).to_pylist()]
        columns = [batch.column(0)]
        columns += [pa.array([len(f[k]) for f in found], pa.int64()) for k in BASE_KINDS]
        columns.append(pa.array([hashlib.sha256(joined(f, BASE_KINDS).encode()).hexdigest() for f in found], pa.string()))
        columns.append(pa.array([joined(f, KINDS) for f in found], pa.string()))
        columns += [pa.array([len(f[k]) for f in found], pa.int64()) for k in KINDS[len(BASE_KINDS) :]]
        columns.append(pa.array([sum(map(len, f.values())) for f in found], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return map_batches(docs.select(F.col(id_col).cast("long"), whole_text(text_col)), batch_spans, SCHEMA)


def redactor(mask: Callable[[str], str] = lambda kind: f"<{kind}>") -> Callable[[str], str]:
    """A function that replaces all spans of a text, the earliest and then the longest first where spans overlap."""
    finder = Finder()

    def redact(text: str) -> str:
        out, at = [], 0
        for start, end, kind in sorted(((a, b, k) for k, xs in finder(text).items() for a, b in xs), key=lambda x: (x[0], -x[1])):
            if start >= at:
                out += [text[at:start], mask(kind)]
                at = end
        return "".join([*out, text[at:]])

    return redact


def redact_pii(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text column replaced by ``<kind>``; other columns as they are."""
    at = docs.columns.index(text_col)
    state: list[Callable[[str], str]] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.append(redactor())
        texts = pa.array([None if t is None else state[0](t) for t in batch.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], names=batch.schema.names)

    return map_batches(docs, run, docs.schema)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
