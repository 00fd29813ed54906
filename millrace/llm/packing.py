"""Packing by concatenate and cut.

The documents are one long row of tokens, each document followed by an end id.
The first pass tokenises and keeps, beside the ids, a running position within its
partition. Prefix sums over the partitions' totals turn that into a global
position, and the second pass cuts at every multiple of the sequence length. A
sequence that lies over the edge of two partitions is met by pieces of both; only
the last sequence is short.

Token ids are those of the ``tokenizers`` file. A text of Latin letters is split by
the family's pattern and each distinct piece is encoded once per worker; others
go through the tokenizer as a whole.

Defined results: a NULL or empty text is its end id alone. Repeated rows are
packed each. An empty table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed, part_offsets, pieces, prepare

LENGTH = 2048
END_ID = 1
TOKENS = "doc_id bigint, part int, at bigint, n bigint, ids binary"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)
# How a byte-level tokenizer of this family splits a text before it merges bytes, for texts
# of these characters only; any other text goes through the tokenizer as a whole.
OTHER = r"[^\t\n\r -~À-ÖØ-öø-ÿ]"
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PATTERN = rf" ?[{LETTER}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s{LETTER}0-9]+|\s+(?!\S)|\s+"
CACHED = 200_000


def _byte_values() -> dict[str, int]:
    """The printable stand-ins of bytes in vocabularies of this family: printable Latin-1 is itself."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class PieceEncoder(dict):
    """Piece of text to its ids as bytes. Forgets everything when it is full."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        byte = _byte_values()
        ranks = {bytes(byte[c] for c in t): i for t, i in self.whole.get_vocab().items() if t not in self.special}
        # The same vocabulary merged by a faster library; it gets single pieces.
        self.merge = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.find, self.other = re.compile(PATTERN).findall, re.compile(OTHER).search
        self.width = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.merge(piece), self.width).tobytes()
        if len(piece) < 40:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.other(text) or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.width).tobytes()
        if len(self) > CACHED:
            self.clear()
        return b"".join(map(self.__getitem__, self.find(text)))


_encoders: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenised(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """First pass: ids of every document (the end id included) and the position within the partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer or default_tokenizer())
        end, each = np.array([end_id], encoder.width).tobytes(), np.dtype(encoder.width).itemsize
        part, at = TaskContext.get().partitionId(), 0
        for batch in pieces(batches):
            ids = [encoder.encode(t or "") + end for t in batch.column("text").to_pylist()]
            n = np.array([len(x) // each for x in ids], np.int64)
            before = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.full(len(n), part, np.int32)),
                    pa.array(before),
                    pa.array(n),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "part", "at", "n", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(encode, TOKENS)


def _cut(length: int, width: str, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "ids"):
            out: list[list] = [[] for _ in range(8)]
            for doc, at, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "position", "ids")), strict=True):
                row = np.frombuffer(ids, width)
                edges = [0, *range(length - at % length, len(row), length), len(row)]
                for a, b in zip(edges, edges[1:], strict=False):
                    piece = row[a:b].astype("<u4").tobytes()
                    one = (doc, a, b - a, zlib.crc32(piece), len(row), (at + a) // length, (at + a) % length)
                    for column, value in zip(out, (*one, piece if keep_ids else None), strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[f.split()[0] for f in PIECES.split(", ")]
            )

    return cut


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of documents and their place in sequences; ``ids`` are little-endian unsigned 32-bit ids."""
    prepare(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    rows = fixed(tokenised(docs, tokenizer, end_id), "pack-ids")
    before = part_offsets(rows.groupBy("part").agg(F.sum("n").alias("total")), "part", "total")
    placed = rows.join(F.broadcast(before), "part")  # one row for each partition of the first pass
    placed = placed.select("doc_id", (F.col("at") + F.col("__before")).alias("position"), "ids")
    width = "<u2" if _vocabulary(path) <= 1 << 16 else "<u4"
    return placed.mapInArrow(_cut(length, width, keep_ids), PIECES)


def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def sequences(packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """The sequences themselves, from pieces with their ids; a sequence has at most ``length`` pieces."""
    piece = F.struct("offset", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p"), F.sum("length").alias("length"))
    # Joining binaries: concat of two at a time, in order.
    joined = F.aggregate("p", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return grouped.select("sequence_id", "length", joined.alias("ids"))
