from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from helpers import clashing, docs_of, odd_docs, rows, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridloom.llm.packing import Encoder, pack_power_of_two, piece_lengths, write_buckets

ENCODER = Encoder()
REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PLAIN.encode_special_tokens = True


def ids_of(text: str | None) -> list[int]:
    return REFERENCE.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_tokenizer(text):
    assert [*ENCODER(text), 0] == ids_of(text)


@pytest.mark.parametrize("text", [" " * 60_000, "\n" * 50_000 + "x", "a" * 50_000, "<|endoftext|> x", "x<|endoftext|><|endoftext|", " <|endoftext|>  ", "é" * 5000])
def test_long_runs(text):
    assert [*ENCODER(text), 0] == ids_of(text)


def test_special_tokens_strings_as_text():
    encode = Encoder(special_as_text=True)
    for text in ("<|endoftext|> x", "a<|endoftext|>"):
        assert encode(text) == PLAIN.encode(text, add_special_tokens=False).ids != REFERENCE.encode(text, add_special_tokens=False).ids


def test_ids_of_all_documents_equal_the_tokenizer():
    """The fast encoder has the ids of the contract's call on every text of the table."""
    some = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    for at in range(0, len(some), 500):
        part = [t or "" for t in some[at : at + 500]]
        assert [ENCODER(t) for t in part] == [e.ids for e in REFERENCE.encode_batch(part, add_special_tokens=False)]


@given(st.integers(1, 10_000))
def test_lengths_are_powers_of_two(n):
    pieces = piece_lengths(n)
    assert sum(pieces) == n and all(p & (p - 1) == 0 and p <= 1024 for p in pieces)
    assert len({p for p in pieces if p < 1024}) == len([p for p in pieces if p < 1024])


def check(got: list[dict], docs: list[tuple]) -> None:
    assert len({r["sequence_id"] for r in got}) == len(got)
    assert all(r["offset"] == 0 and r["length"] == 1 << r["bucket"] for r in got)
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    for doc, text in docs:
        want = ids_of(text)
        own = sorted(by_doc[doc], key=lambda r: r["start"])
        starts = {r["start"] for r in own}
        assert starts and all(r["doc_tokens"] == len(want) for r in own)
        for r in own:
            piece = want[r["start"] : r["start"] + r["length"]]
            assert len(piece) == r["length"] and r["ids_crc32"] == zlib.crc32(np.asarray(piece, "<u4").tobytes())
            assert "ids" not in r or r["ids"] == piece
        copies = len([d for d, _ in docs if d == doc])
        assert sum(r["length"] for r in own) == len(want) * copies


def test_round_trip(spark):
    some = texts(60, 2) + ["word " * 5000]
    got = rows(pack_power_of_two(docs_of(spark, some)))
    check(got, list(enumerate(some)))
    whole = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        whole[r["doc_id"]] += r["ids"]
    assert all(REFERENCE.decode(whole[i][:-1]) == t for i, t in enumerate(some))


def test_odd_rows_and_empty(spark):
    got = rows(pack_power_of_two(clashing(odd_docs(spark)), with_ids=False))
    check(got, [(r["doc_id"], r["text"]) for r in rows(odd_docs(spark))])
    assert pack_power_of_two(odd_docs(spark).limit(0)).count() == 0


def test_buckets_on_disk(spark, tmp_path):
    write_buckets(pack_power_of_two(docs_of(spark, texts(20, 3))), f"file://{tmp_path}/p")
    back = spark.read.parquet(f"file://{tmp_path}/p")
    assert back.where("length <> shiftleft(1, bucket)").count() == 0
    with pytest.raises(ValueError):
        pack_power_of_two(docs_of(spark, ["x"]), limit=1000)
