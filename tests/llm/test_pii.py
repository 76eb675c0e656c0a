from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from helpers import clashing, docs_of, odd_docs, rows, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm.pii import BASE_KINDS, CUES, Finder, find_pii, iban_ok, luhn, redact_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind: str, s: str) -> bool:
    digits = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def brute(text: str) -> dict:
    return {k: [m.span() for m in re.finditer(p, text) if valid(k, m.group())] for k, p in PATTERNS.items()}


FINDER = Finder()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="01259.@+- ()aZ_%é\n", max_size=80))
def test_base_spans_equal_the_patterns(text):
    found = FINDER(text)
    assert {k: found[k] for k in BASE_KINDS} == brute(text)


def test_long_dense_texts():
    r = random.Random(5)
    for alphabet in ("0123456789. -", "a1.@-", "+1 23()-.5a"):
        text = "".join(r.choice(alphabet) for _ in range(60_000))
        found = FINDER(text)
        assert {k: found[k] for k in BASE_KINDS} == brute(text)


def test_added_kinds():
    text = 'see https://user@host.example/x?y=1). and token = "2321bac4d15ec8f9" or IBAN: DE89 3704 0044 0532 0130 00, password: hello'
    found = FINDER(text)
    assert [text[a:b] for a, b in found["url"]] == ["https://user@host.example/x?y=1"]
    assert [text[a:b] for a, b in found["account"]] == ["2321bac4d15ec8f9", "DE89 3704 0044 0532 0130 00"]
    assert iban_ok("DE89370400440532013000") and not iban_ok("DE88370400440532013000")


def plain_added(text: str) -> dict:
    """URLs and values behind cues, each tried at every place in order, leftmost and without overlap."""
    url, account = [], []
    for m in re.finditer("https?://|HTTPS?://|Https?://|ftp://|FTP://|Ftp://", text):
        run = re.match(r"[^\s<>\"'`{}|\\^\[\]]*", text[m.end() :]).group().rstrip(".,;:!?)*")
        host = re.split("[/?#]", run)[0]
        if (not url or m.start() >= url[-1][1]) and ("@" in host or "." in host.rpartition("@")[2].strip(".")):
            url.append((m.start(), m.end() + len(run)))
    cues = [c for w in CUES if w != "iban" for c in (w, w.upper(), w.capitalize())]
    for m in sorted((m for c in cues for m in re.finditer(c, text)), key=lambda m: m.end()):
        v = re.compile(r"[\"']?\s{0,3}[:=#]\s{0,3}[\"']?([A-Za-z0-9][A-Za-z0-9_+/=-]{7,})").match(text, m.end())
        if v and (not account or m.end() > account[-1][1]) and re.search("[0-9]", v.group(1)):
            account.append(v.span(1))
    return {"url": url, "account": account}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["http://", "https://", "Ftp://", "a.b", "x@y", "/", " ", ".", "token", "Secret", "=", ": ", '"', "abcdefgh", "1", "12345678", "?", ")"]), max_size=14).map("".join))
def test_added_spans_equal_a_plain_search(text):
    found = FINDER(text)
    assert {k: found[k] for k in ("url", "account")} == plain_added(text)


@pytest.mark.parametrize("unit", ["http://a.b", "http://", "https://x@", "token=", "secret: ", "account#abcdefgh ", "iban DE89 ", "a@", "+1 ", "1.1.", "http://a.b/token=x1y2z3w4&"])
def test_a_megabyte_of_anchors_is_linear(unit):
    began = time.perf_counter()
    FINDER(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - began < 10


def test_table(spark):
    some = texts(80, 1)
    got = {r["doc_id"]: r for r in rows(find_pii(docs_of(spark, some)))}
    assert len(got) == len(some)
    for i, t in enumerate(some):
        spans = brute(t)
        assert [got[i][f"n_{k}"] for k in BASE_KINDS] == [len(spans[k]) for k in BASE_KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k in BASE_KINDS for a, b in spans[k])
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert got[i]["spans"].startswith(joined)
        assert got[i]["n_spans"] == len([s for s in got[i]["spans"].split(",") if s])


def test_odd_rows_and_empty(spark):
    assert find_pii(clashing(odd_docs(spark))).count() == odd_docs(spark).count()
    assert find_pii(odd_docs(spark).limit(0)).count() == 0


def test_redaction(spark):
    docs = docs_of(spark, ["mail a@b.org now", "call +1 (555) 010-9999.", "nothing"])
    assert {r["doc_id"]: r["text"] for r in rows(redact_pii(docs))} == {0: "mail <email> now", 1: "call <phone>.", 2: "nothing"}
