"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

Texts are cut into pre-tokens by the pattern of the rank file. A block of documents keeps the positions (a
code for each pre-token) and gives out its distinct words; all blocks' words meet in one shuffle by word, in
which each distinct word of the corpus is encoded once. Its ids go back to the blocks that hold it, and
every document is put together by position. A word that is in every document is one row for each block, so
no word is a hot key. Decoding joins the ids of each document with the token-byte table of the vocabulary.

The table is read twice, once for the positions and once for the words. A block's key is made of its place
and content: if the readings differ, the job stops instead of giving other results.

Defined results: a NULL or empty text has no ids. Repeated rows are rows each, also under one id; a row
without an id stays without one. An empty table gives no rows. Extra columns are ignored. A text or a word
is held whole by one task, however long; everything else by blocks of fixed size.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import HELD, by_block, coded, dictionary, document_blocks, ragged, squeezed, unsqueezed
from .common import pieces, prepare
from .packing import OTHER, PATTERN

LAYOUT = "block bigint, distinct_words int, doc_ids array<bigint>, counts array<int>, codes binary"
WORDS = "block bigint, no int, word string"
ENCODED = "block bigint, n int, size int, numbers binary"
DOCUMENTS = "doc_id bigint, n_tokens bigint, ids binary"
# Rows of a batch that leaves a task: words of a block are written in such slices.
SLICE = 50_000


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@cache
def token_bytes(path: str) -> dict[bytes, int]:
    """The vocabulary: bytes of each token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


# Characters of each class, where this library's tables and the pattern library's may be of different age.
STAND_INS = {r"\p{L}": "z", r"\p{N}": "0", r"\s": "\u2003"}
NONE_OF_THEM = "\ue000"


@cache
def _reclassed() -> dict[int, str]:
    """Characters that the library of the rank files puts into another class than ``regex``: what to read them as."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    changed: dict[int, str] = {}
    for kind, stand_in in STAND_INS.items():
        found = tiktoken.Encoding("class", pat_str=f"{kind}+", mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        theirs, ours = set(bytes(found).decode()), set(regex.findall(kind, every))
        changed |= {ord(c): changed.get(ord(c), NONE_OF_THEM) for c in ours - theirs}
        changed |= {ord(c): stand_in for c in theirs - ours}
    return changed


@cache
def _splitter(pattern: str):
    """Pre-tokens of a text. Texts of Latin letters are cut by the plain form of the family's pattern, which is quicker."""
    import public_tokenizers
    import regex

    whole = regex.compile(pattern).findall

    def any_text(text: str) -> list[str]:
        changed = _reclassed()
        read = text.translate(changed) if changed else text
        words = whole(read)
        if read == text:
            return words
        ends = np.cumsum([len(w) for w in words]).tolist()
        return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    if pattern != public_tokenizers.PATTERN:
        return any_text
    plain, other = re.compile(PATTERN).findall, re.compile(OTHER).search
    return lambda text: any_text(text) if other(text) else plain(text)


@cache
def _merger(path: str):
    """Ids of one pre-token."""
    import tiktoken

    merge = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=token_bytes(path), special_tokens={})
    return merge.encode_ordinary


def _layout(pattern: str):
    def layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, ids, texts in document_blocks(batches):
            words, counts, codes = coded(texts, _splitter(pattern))
            row = [[key], [len(words)], [ids.to_pylist()], [counts.tolist()], [squeezed(codes)]]
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(row, kinds, strict=True)],
                names=["block", "distinct_words", "doc_ids", "counts", "codes"],
            )

    return layout


def _words(pattern: str):
    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, texts in document_blocks(batches):
            words = coded(texts, _splitter(pattern))[0]
            for at in range(0, len(words), SLICE):
                some = words[at : at + SLICE]
                number = np.arange(at, at + len(some), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), key)), pa.array(number), pa.array(some, pa.string())],
                    names=["block", "no", "word"],
                )

    return words_of


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by word: equal words are neighbours, the first of them is encoded."""
        merge, last, ids = _merger(path), None, []
        blocks, numbers, counts, flat = [], [], array("I"), array("I")

        def out():
            sizes, values = (np.frombuffer(x, np.uint32) for x in (counts, flat))
            return by_block(np.concatenate(blocks), np.concatenate(numbers), sizes, values)

        for batch in batches:
            for word in batch.column("word").to_pylist():
                if word != last:
                    last, ids = word, merge(word)
                counts.append(len(ids))
                flat.extend(ids)
            blocks.append(np.asarray(batch.column("block")))
            numbers.append(np.asarray(batch.column("no")))
            if len(counts) >= HELD:
                yield out()
                blocks, numbers, counts, flat = [], [], array("I"), array("I")
        if counts:
            yield out()

    return encode


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block and the ids of its words, to the ids of its documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i] for name in batch.schema.names}
            counts = np.asarray(block["counts"].values)
            codes = unsqueezed(block["codes"].as_py(), int(counts.sum()))
            ids, places = ragged(*dictionary(block["chunks"].as_py() or [], block["distinct_words"].as_py()), codes)
            # From places of words to places of documents.
            edges = places[np.concatenate([[0], np.cumsum(counts)])]
            for at in range(0, len(counts), SLICE):
                some = edges[at : at + SLICE + 1]
                part = ids[some[0] : some[-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        block["doc_ids"].values[at : at + SLICE],
                        pa.array(np.diff(some)),
                        _as_binary(part.view(np.uint8), (some - some[0]) * 4),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of binaries, one after another, and where each begins."""
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def _as_binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers)


def encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids``: little-endian unsigned 32-bit ids of every text, without special tokens."""
    spark = docs.sparkSession
    prepare(spark)
    ranks, pattern = ranks or default_ranks(), pattern or default_pattern()
    texts = docs.select("doc_id", "text")
    words = texts.mapInArrow(_words(pattern), WORDS)
    gathered = words.repartition(F.col("word")).sortWithinPartitions("word")
    coded = gathered.mapInArrow(_encode(ranks), ENCODED)
    dictionaries = coded.groupBy("block").agg(
        F.collect_list(F.struct("n", "size", "numbers")).alias("chunks")
    )
    # One row on either side for each block.
    placed = texts.mapInArrow(_layout(pattern), LAYOUT).join(dictionaries, "block", "left")
    return placed.mapInArrow(_assemble, DOCUMENTS)


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """Adds ``decoded``, the bytes of all ids of a row. An id that the vocabulary lacks is an error."""
    path = ranks or default_ranks()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        size = max(table.values()) + 1
        lengths = np.full(size, -1, np.int64)
        for token, rank in table.items():
            lengths[rank] = len(token)
        by_rank = dict(zip(table.values(), table.keys(), strict=True))
        data = np.frombuffer(b"".join(by_rank.get(i, b"") for i in range(size)), np.uint8)
        starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])[:-1]
        for batch in batches:
            for some in pieces(iter([batch]), "ids"):
                flat, edges = plain_ids(some.column("ids"))
                if flat.size and (flat.max() >= size or (lengths[flat] < 0).any()):
                    raise ValueError("an id is not in the vocabulary")
                text, places = ragged(data, starts, np.maximum(lengths, 0), flat)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, _as_binary(text, places[edges])], names=[*some.schema.names, "decoded"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(joined, f"{fields}, decoded binary")


def plain_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column one after another, and where each row begins. NULL has none."""
    if column.null_count:
        column = pa.array([x or b"" for x in column.to_pylist()], pa.binary())
    data, starts = _binary(column)
    return data.view("<u4"), starts // 4


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
