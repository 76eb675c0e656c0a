"""Text, identifier and hash expressions. NFKC is the one step Spark has no function for: it runs as an Arrow UDF."""

from __future__ import annotations

from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space at the ends of a text, in any script; the separators 1C to 1F count too.
_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    """Text by text, so a batch is never held as Python strings; ``pyarrow.compute.utf8_normalize`` is no way out, as it
    leaves letters and accents decomposed."""
    plain = (t.as_py() for t in texts)
    return pa.array((t if t is None else normalize("NFKC", t) for t in plain), pa.string(), size=len(texts))


def nfkc(c: Column) -> Column:
    """Compatibility normalisation. ASCII texts stay as they are, and don't leave the JVM."""
    return F.coalesce(_nfkc(F.when(c.rlike("[^\\x00-\\x7F]"), c)), c)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _ENDS, "")


def squeezed(c: Column) -> Column:
    """Without zero-width spaces and outer white space, blanks and tabs squeezed to one blank, null if empty."""
    return F.nullif(F.regexp_replace(strip(F.replace(c, F.lit("​"), F.lit(""))), "[ \\t]+", " "), F.lit(""))


def clean_text(c: Column) -> Column:
    return squeezed(nfkc(c.cast("string")))


def normalize_title(c: Column, cleaned: bool = False) -> Column:
    """Lower case without white space, book-title marks and quotes."""
    return F.lower(F.regexp_replace(c if cleaned else clean_text(c), "(?U)[《》〈〉\\s'\"“”‘’]", ""))


def _digest(parts: list[Column], separator: str) -> Column:
    return F.sha2(F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"), 256)


def stable_id(*parts: Column, prefix: str = "REC", length: int = 20, clean: bool = True) -> Column:
    """``prefix_`` and the first hex digits of the SHA-256 of the parts joined by ``|``; null counts as empty."""
    return F.concat(F.lit(f"{prefix}_"), F.upper(F.substring(_digest([clean_text(p) if clean else p for p in parts], "|"), 1, length)))


def content_hash(*parts: Column, clean: bool = True) -> Column:
    return _digest([clean_text(p) if clean else p for p in parts], "\n")


def task_id(*parts: Column) -> Column:
    return stable_id(*parts, prefix="REV", length=24, clean=False)


def chunks(c: Column, size: int = 12000, first: int | None = None) -> Column:
    """Array of consecutive pieces of ``size`` code points; an empty text gives one empty piece."""
    last = F.floor((F.greatest(F.char_length(c), F.lit(1)) - 1) / size).cast("int")
    every = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(c, i * size + 1, F.lit(size)))
    return every if first is None else F.slice(every, 1, first)


def excerpt(c: Column, position: Column, length: Column, before: int, after: int) -> Column:
    """Text around a match: ``position`` is its first code point (from 1), ``length`` its own."""
    start = F.greatest(F.lit(1), position - before)
    return F.substring(c, start, position + length + after - start)


def split_parts(c: Column) -> Column:
    """Parts between slashes, commas and semicolons, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, "[/、,，;；]"), lambda p: strip(p)), lambda p: p != "")


def first_line_title(c: Column) -> Column:
    """The first line if it can be a title: 8 to 100 code points that do not end a sentence."""
    line = F.element_at(F.split(strip(c), "\n"), 1)
    return F.when(F.char_length(line).between(8, 100) & ~line.rlike("[。；]$"), line)


def slug(c: Column) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(c, r"[^0-9A-Za-z一-鿿._-]+", "_"), "^_+|_+$", ""), 1, 100)


def without_suffix(c: Column, suffixes: list[str]) -> Column:
    """Without the first of the suffixes, in their order, that the text ends with."""
    out = F.when(F.lit(False), c)
    for s in suffixes:
        out = out.when(c.endswith(s), F.substring(c, F.lit(1), F.char_length(c) - len(s)))
    return out.otherwise(c)


def contains_any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def redact_query(url: Column) -> Column:
    """A URL without its query and fragment."""
    return F.regexp_replace(url, "[?#].*$", "")
