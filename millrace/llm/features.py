"""Hashed character and word features of many texts at once, over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import joined_bytes, mix64

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTERS = np.zeros(256, bool)
LETTERS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True
MULTIPLIER = np.uint32(0x9E3779B1)


def _hashed(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes * MULTIPLIER) >> np.uint32(32 - bits)


def grams(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The bucket of the n bytes from each place on; n from 1 to 4. The last n - 1 places are cut off."""
    wide = data.astype(np.uint32)
    codes = wide[: len(wide) - n + 1].copy()
    for i in range(1, n):
        codes *= np.uint32(256)
        codes += wide[i : len(wide) - n + 1 + i]
    if 8 * n <= bits:
        return codes
    return _hashed(codes ^ (codes >> np.uint32(15)), bits)


def word_hashes(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes: where they begin and end, and a 64-bit hash of each."""
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    table = mix64(np.arange(1, 257, dtype=np.uint64))
    if not len(begins):
        return begins, ends, np.zeros(0, np.uint64)
    # Sums of mixed bytes by their place in the word, so that a word's hash is free of where it lies.
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], begins]), np.diff(np.concatenate([[0], begins, [len(data)]])))
    factors = mix64(np.arange(1, 1025, dtype=np.uint64)) | np.uint64(1)
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = sums[1:]
    np.take(table, data, out=terms, mode="clip")
    terms *= factors[place & 1023]
    far = np.flatnonzero(place > 1023)
    terms[far] *= mix64(place[far].astype(np.uint64))
    terms[~inside] = 0
    np.cumsum(sums, out=sums)
    return begins, ends, mix64(sums[ends] - sums[begins])


def framed(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    return joined_bytes(pc.utf8_lower(texts) if lower else texts)
