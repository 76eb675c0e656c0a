"""URLs: validity, host, canonical forms, harvesting, and what a domain says about a source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import INTERNAL_WORD, MEDIA_DOMAINS, MEDIA_URL_PARTS, OFFICIAL_DOMAINS, OFFICIAL_URL_PARTS, RUMOUR_WORD
from gridloom.functions.text import contains_any, squeezed

URL_PATTERN = r"(?i)https?://[^\s<>\"'，；]+"
#: scheme, host with port, path, query; the fragment is left out.
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _decoded(c: Column) -> Column:
    """``+`` and percent codes decoded; a percent sign that begins no code stands for itself."""
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(c: Column) -> Column:
    """As forms are encoded, but that ``*`` is encoded and ``~`` is not."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _sorted_query(query: Column, drop: tuple[str, ...], blanks: bool) -> Column:
    """The query decoded, without the keys that start with one of ``drop``, sorted by code point and encoded again."""

    def pair(part: Column) -> Column:
        value = F.when(F.contains(part, F.lit("=")), F.regexp_replace(part, "(?s)^[^=]*=", "")).otherwise("")
        return F.named_struct(F.lit("k"), _decoded(F.substring_index(part, "=", 1)), F.lit("v"), _decoded(value))

    dropped = lambda p: F.lower(p["k"]).rlike("^(?:" + "|".join(drop) + ")")
    pairs = F.transform(F.filter(F.split(query, "&", -1), lambda part: part != ""), pair)
    kept = F.array_sort(F.filter(pairs, lambda p: ~dropped(p) & (F.lit(blanks) | (p["v"] != ""))))
    return F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def _assembled(c: Column, host: Column, path: Column, query: Column) -> Column:
    return F.concat(F.lower(F.regexp_extract(c, _PARTS, 1)), F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def normalize_url(c: Column) -> Column:
    """Lower-case scheme and host, no trailing slash, no fragment, sorted query without utm keys and blank values.
    What is no http URL stays as it is."""
    text = squeezed(c)
    path = F.regexp_replace(F.regexp_extract(text, _PARTS, 3), "/+$", "")
    return F.when(text.rlike("(?i)^https?://"), _assembled(text, F.lower(F.regexp_extract(text, _PARTS, 2)), path, _sorted_query(F.regexp_extract(text, _PARTS, 4), ("utm_",), False))).otherwise(text)


def canonical_url(c: Column) -> Column:
    """Like ``normalize_url``, but without ``www.`` and more tracking keys, with at least ``/`` as path, and blank values
    kept. What has no scheme stays as it is."""
    text = F.btrim(c)
    host = F.regexp_replace(F.lower(F.regexp_extract(text, _PARTS, 2)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(text, _PARTS, 3), "/+$", "")
    return F.when(text.rlike(_PARTS), _assembled(text, host, F.when(path == "", "/").otherwise(path), _sorted_query(F.regexp_extract(text, _PARTS, 4), ("utm_", "spm", "from"), True))).otherwise(text)


def is_valid_url(c: Column) -> Column:
    """http or https with a host and no blank inside."""
    text = F.btrim(c)
    return F.coalesce(~F.contains(text, F.lit(" ")) & text.rlike("^(?i)https?://[^/?#]+"), F.lit(False))


def domain(c: Column) -> Column:
    """Host in lower case without user, port and ``www.``; empty if there is none."""
    host = F.lower(F.regexp_extract(c, _PARTS, 2))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":\d*$", ""), r"^www\.", "")


def authority(c: Column) -> Column:
    """Host with user and port, as it stands."""
    return F.regexp_extract(c, _PARTS, 2)


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments of an absolute path resolved; what ends in one ends in a slash."""
    segments = F.split(path, "/", -1)
    step = lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.concat(done, F.array(s)))
    kept = F.aggregate(F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0))), F.array().cast("array<string>"), step)
    closing = F.when(path.rlike(r"/\.{1,2}$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, closing), "/"))


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` as seen from the page at ``base``, as RFC 3986 resolves it, with runs of slashes in relative links as
    one; null without an absolute base."""
    link = F.btrim(href)
    scheme, host, path = (F.regexp_extract(base, _PARTS, i) for i in (1, 2, 3))
    origin = F.concat(scheme, F.lit("://"), host)
    link_path, tail = F.regexp_extract(link, r"^[^?#]*", 0), F.regexp_extract(link, r"[?#].*$", 0)
    without_fragment = F.regexp_replace(base, "#.*$", "")
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, "^.*/", 0))
    resolved = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link == "", base)
        .when(link.startswith("#"), F.concat(without_fragment, link))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .when(link.startswith("/"), F.concat(origin, _without_dots(link_path), tail))
        .otherwise(F.concat(origin, _without_dots(F.regexp_replace(F.concat(folder, link_path), "/{2,}", "/")), tail))
    )
    return F.when(base.rlike(_PARTS), resolved)


def harvest(c: Column) -> Column:
    """Array of all URLs in a text."""
    return F.regexp_extract_all(c, F.lit(URL_PATTERN), F.lit(0))


_FIELDS = ("source_name", "source_type", "source_role", "official_status", "agency_type", "priority")


def _source(*values: object) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in zip(_FIELDS, values, strict=True)])


def classify_domain(d: Column) -> Column:
    """struct of what a domain says about a source; known official domains, then .gov.cn, then media, then unknown."""
    out = F.when(F.lit(False), _source("", "", "", "", "", 0))
    for name, title, agency in OFFICIAL_DOMAINS:
        out = out.when(d == name, _source(title, "government", "canonical_candidate", "official", agency, 0))
    media = d.isin(*MEDIA_DOMAINS)
    for m in MEDIA_DOMAINS:
        media = media | d.endswith(f".{m}")
    return (
        out.when(d.endswith(".gov.cn"), _source(d, "government", "canonical_candidate", "official", "local_government", 0))
        .when(media, _source(d, "lead", "discovery_only", "secondary_only", "media_or_aggregator", 3))
        .otherwise(_source(d, "media_or_unknown", "supporting", "unknown", "unknown", 2))
    )


def source_status(url: Column, text: Column) -> Column:
    """struct(status, quality): rumours and internal notes first, then official and media URLs."""
    u = F.coalesce(url, F.lit(""))
    both = F.concat(u, F.lit(" "), F.coalesce(text, F.lit("")))
    pair = lambda s, q: F.struct(F.lit(s).alias("status"), F.lit(q).alias("quality"))
    return (
        F.when(F.contains(both, F.lit(INTERNAL_WORD)), pair("internal_unverified", 0))
        .when(F.contains(both, F.lit(RUMOUR_WORD)), pair("rumour", 0))
        .when(contains_any(u, OFFICIAL_URL_PARTS), pair("official", 5))
        .when(contains_any(u, MEDIA_URL_PARTS), pair("authoritative_media", 3))
        .when(u != "", pair("general_media", 2))
        .otherwise(pair("unknown", 0))
    )
