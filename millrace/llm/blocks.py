"""Blocks of documents: what many documents of a block share crosses the network once for each block.

An operator that looks something up for every word or pair of tokens of a text would shuffle more than the
texts themselves. Here a block of whole texts keeps the places (a code for each, numbered by how often it
occurs in the block) and only its distinct keys are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

# A block is closed when its texts have this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
# Answers for keys that a task holds before it hands them out, gathered by block.
HELD = 500_000


def document_blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array, list[str]]]:
    """(key, ids, texts) of runs of rows (doc_id, text) with about ``most`` bytes. NULL texts are empty.

    The key is made of the place and of the content, so that two readings of a table agree on a key only if
    they agree on the block.
    """
    part, count = TaskContext.get().partitionId(), 0
    ids: list[pa.Array] = []
    texts: list[str] = []
    size = 0

    def closed():
        digest = hashlib.blake2b(f"{part}:{count}".encode(), digest_size=8)
        for text in texts:
            digest.update(b"%d:" % len(text))
            digest.update(text.encode())
        return int.from_bytes(digest.digest(), "little", signed=True), pa.concat_arrays(ids), texts

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        done = 0
        ends = np.cumsum(lengths)
        while done < batch.num_rows:
            # Rows up to the one that fills the block; at least one.
            room = most - size + (ends[done - 1] if done else 0)
            stop = min(max(int(np.searchsorted(ends, room, "right")), done + 1), batch.num_rows)
            if size and lengths[done] > most:
                yield closed()
                ids, texts, size, count = [], [], 0, count + 1
            piece = batch.slice(done, stop - done)
            ids.append(piece.column("doc_id").cast(pa.int64()))
            texts.extend(t or "" for t in piece.column("text").to_pylist())
            size += int(lengths[done:stop].sum())
            done = stop
            if size >= most or len(texts) >= most // 64:
                yield closed()
                ids, texts, size, count = [], [], 0, count + 1
    if texts:
        yield closed()


def by_frequency(codes: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes numbered anew, the most frequent first (ties as before), and the old number of each new one."""
    order = np.argsort(-np.bincount(codes, minlength=distinct), kind="stable").astype(np.uint32)
    rank = np.empty(distinct, np.uint32)
    rank[order] = np.arange(distinct, dtype=np.uint32)
    return rank[codes], order


def squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed by byte planes (small ones leave the upper planes empty) if that is shorter."""
    numbers = numbers.astype("<u4", copy=False)
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T)
    packed = pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)
    return packed if len(packed) < 4 * len(numbers) else numbers.tobytes()


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    if len(data) == 4 * n:
        return np.frombuffer(data, "<u4")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, decompressed_size=4 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(n)


def ragged(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments ``codes`` of ``data`` one after another, and where each begins; one more place at the end."""
    n = lengths[codes]
    places = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    at = np.repeat(starts[codes] - places[:-1], n)
    at += np.arange(places[-1])
    return data[at], places


def coded(texts: list[str], split: Callable[[str], list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a block, most frequent first, number of words of each text, and the code of each word."""
    number, found, counts = {}, [], np.zeros(len(texts), np.int32)
    for i, text in enumerate(texts):
        words = split(text)
        counts[i] = len(words)
        found.append(np.array([number.setdefault(w, len(number)) for w in words], np.uint32))
    codes, order = by_frequency(np.concatenate(found), len(number))
    words = list(number)
    return [words[i] for i in order], counts, codes


def by_block(block: np.ndarray, number: np.ndarray, count: np.ndarray, flat: np.ndarray) -> pa.RecordBatch:
    """Answers gathered by block: a row has the numbers of some keys (as differences), how many values each has, the values."""
    order = np.lexsort((number, block))
    starts = np.cumsum(count, dtype=np.int64) - count
    values, places = ragged(flat, starts, count.astype(np.int64), order)
    block, number, count = block[order], number[order], count[order]
    edges = np.flatnonzero(np.diff(block, prepend=block[0] - 1, append=block[-1] + 1))
    rows: list[list] = [[], [], [], []]
    for a, b in zip(edges, edges[1:], strict=False):
        steps = np.diff(number[a:b], prepend=0).astype(np.uint32)
        every = np.concatenate([steps, count[a:b], values[places[a] : places[b]]])
        for column, value in zip(rows, (block[a], b - a, len(every), squeezed(every)), strict=True):
            column.append(value)
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["block", "n", "size", "numbers"]
    )


def dictionary(chunks: list[dict], distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of all keys of a block, and where each key's begin and how many they are, by number of the key."""
    starts, lengths = np.zeros(distinct, np.int64), np.full(distinct, -1, np.int64)
    flat, at = [], 0
    for chunk in chunks:
        n, every = chunk["n"], unsqueezed(chunk["numbers"], chunk["size"])
        number, count = np.cumsum(every[:n], dtype=np.int64), every[n : 2 * n].astype(np.int64)
        starts[number], lengths[number] = at + np.cumsum(count) - count, count
        flat.append(every[2 * n :])
        at += len(flat[-1])
    if (lengths < 0).any():
        raise RuntimeError("keys of a block are missing: its table was not read alike twice")
    return np.concatenate([np.zeros(0, np.uint32), *flat]), starts, lengths
