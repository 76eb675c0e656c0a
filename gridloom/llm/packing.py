"""Packing by power-of-two decomposition.

A document's ``L`` ids (its tokens and the end id) are cut into ``L // 1024`` pieces of 1024 and one piece for each
binary digit of the rest, longest first. Every piece is a sequence by itself, so no sequence crosses documents, none
needs padding, and equal lengths share a bucket. It is one narrow pass: nothing is shuffled or gathered.

Defined cases: a null or empty text is the end id alone; the string of an added token in a text is that token, unless
``special_as_text`` is set; repeated rows and repeated ``doc_id`` are packed each for
itself; an empty table gives no rows; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import slices, table, whole_text

#: sequence_id is bucket << BUCKET_SHIFT | partition << PARTITION_SHIFT | running number: unique in a job, and the
#: bucket of equal lengths can be read from it.
BUCKET_SHIFT, PARTITION_SHIFT = 58, 36
#: The fast encoder's pattern backtracks over white space; texts with a run this long go to ``tokenizers`` itself.
LONG_SPACE = re.compile(r"\s{2000}")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int"


class Encoder:
    """Ids of ``byte_bpe_50k.json`` as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    The rank file holds the same vocabulary and its encoder is several times faster, with the same ids (see the tests);
    texts that hold the string of an added token go to ``tokenizers``, which reads it as that token. With
    ``special_as_text`` such strings are ordinary text.
    """

    def __init__(self, json_path: str | None = None, rank_path: str | None = None, special_as_text: bool = False):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))
        self.slow.encode_special_tokens = special_as_text
        added = [] if special_as_text else [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        with open(rank_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.added.search(text) or LONG_SPACE.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def piece_lengths(tokens: int, limit: int = 1024) -> list[int]:
    """``limit`` as often as it fits, then the binary digits of what is left, longest first."""
    whole, rest = divmod(tokens, limit)
    return [limit] * whole + [1 << b for b in range(limit.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_power_of_two(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, end_id: int = 0,
    json_path: str | None = None, rank_path: str | None = None, with_ids: bool = True, special_as_text: bool = False,
) -> DataFrame:
    """One row per piece (``PIECES``, and ``ids array<int>`` unless ``with_ids`` is false).

    ``limit`` is a power of two. ``write_buckets`` stores the pieces so that a bucket holds one length only.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(json_path, rank_path, special_as_text)
        part = TaskContext.get().partitionId()
        number = 0
        for batch in slices(batches):
            out: list[tuple] = []
            ids: list[np.ndarray] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                all_ids = np.asarray([*encode(text), end_id], dtype="<u4")
                at = 0
                for length in piece_lengths(len(all_ids), limit):
                    piece = all_ids[at : at + length]
                    bucket = length.bit_length() - 1
                    out.append((doc, at, length, zlib.crc32(piece.tobytes()), len(all_ids), bucket << BUCKET_SHIFT | part << PARTITION_SHIFT | number, 0, bucket))
                    if with_ids:
                        ids.append(piece)
                    at += length
                    number += 1
            columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 7 + [pa.int32()], strict=True)] if out else []
            if columns and with_ids:
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32))))
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col(id_col).cast("long"), whole_text(text_col)).mapInArrow(run, schema)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store pieces by bucket: each folder holds sequences of one length, ready to be stacked without padding."""
    pieces.write.partitionBy("bucket").parquet(path)


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_power_of_two(table(spark, sf_dir, "documents"), with_ids=False)
