"""Word shingles of a text, as hashes."""

from __future__ import annotations

import re

import numpy as np

SEED = 42
_WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")


def shingle_hashes(text: str, width: int = 4) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``width`` words, space-joined; A-Z count as lower case."""
    import xxhash

    words = _WORD.findall(text.encode().lower())
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    starts = np.concatenate([[0], ends[: len(words) - width] + 1]).tolist()
    stops = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype=np.uint64, count=len(starts))


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is 1 if it is 1 in over half of the shingles' hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):  # big-endian bytes: bit 0 below is the most significant
        ones += np.unpackbits(hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")
