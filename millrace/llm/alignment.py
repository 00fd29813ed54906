"""Alignment of two tokenizers' tokens of the same texts, by byte ranges.

Both token rows of a document cover the bytes of a space and the text. ``pandas.merge_asof``, keyed by
document, finds for each token's start the token of the other side that covers it; both directions together
are all overlaps, and overlaps with equal ends close a group. A long document is cut where both sides begin
a token, so a call gets a bounded number of tokens.

How often a pair of ids is linked is counted over the whole corpus. Blocks of documents (see ``blocks``) keep
their links as numbers of the block's distinct pairs; only these pairs are counted, looked up and sent back.

Tokens are found by words: the first tokenizer's pre-tokens, the second one's runs of spaces with the
letters behind them, which no piece crosses. Each distinct word of a block is encoded once. Texts with
letters outside the Latin ones go through the first tokenizer as a whole; a model with pieces that go on
over a space, and anything but the plain space, gets whole texts too.

Defined results: texts that are NULL, empty, or do not come back byte by byte from both sides have no tokens:
zeros and an empty digest. Repeated rows are rows each and all count. A row without an id stays without one.
An empty table gives no rows. Extra columns are ignored. A text is held whole by one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import HELD, by_block, by_frequency, coded, dictionary, document_blocks, ragged, squeezed, unsqueezed
from .common import fixed, prepare
from .packing import OTHER, PATTERN, _byte_values

# Tokens of the first side that are aligned in one call.
CALL = 300_000
ALIGN_BLOCK = 8 << 20
SPACE = "▁"
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")
ALIGNED = (
    "block bigint, doc_ids array<bigint>, "
    + ", ".join(f"{c} array<bigint>" for c in COUNTS)
    + ", digests array<string>, groups array<string>, links binary, pairs array<bigint>, times array<bigint>"
)
CHUNKS = "block bigint, n int, size int, numbers binary"
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string, n_overlaps bigint, groups string"
)


class Side:
    """One tokenizer: how a text falls into words, the ids of a word, and the bytes of an id."""

    def __init__(self, split: Callable, encode: Callable, tokens: list[bytes]) -> None:
        self.split, self.encode = split, encode
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where each text's begin, and whether its tokens' bytes are a space and the text."""
        words, counts, codes = coded([" " + t for t in texts], self.split)
        found = self.encode(words)
        same = np.array([b"".join([self.tokens[i] for i in ids]) == w.encode() for w, ids in zip(words, found, strict=True)], bool)
        lengths = np.array([len(ids) for ids in found], np.int64)
        flat = np.fromiter((i for ids in found for i in ids), np.int64, int(lengths.sum()))
        ids, places = ragged(flat, np.cumsum(lengths) - lengths, lengths, codes)
        edges = np.concatenate([[0], np.cumsum(counts)])
        wrong = np.concatenate([[0], np.cumsum(~same[codes])])
        return ids, places[edges], wrong[edges[1:]] == wrong[edges[:-1]]


@cache
def byte_level(path: str) -> Side:
    """A byte-level tokenizer of the ``tokenizers`` library. Special tokens' strings are plain text."""
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    special = {t.content for t in whole.get_added_tokens_decoder().values()}
    byte = _byte_values()
    ranks = {bytes(byte[c] for c in t): i for t, i in whole.get_vocab().items() if t not in special}
    tokens = [b""] * whole.get_vocab_size()
    for token, i in ranks.items():
        tokens[i] = token
    merge = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    plain, other = re.compile(PATTERN).findall, re.compile(OTHER).search

    def encode(words: list[str]) -> list[list[int]]:
        return [whole.encode(w, add_special_tokens=False).ids if other(w) else merge(w) for w in words]

    return Side(lambda text: [text] if other(text) else plain(text), encode, tokens)


@cache
def pieces_with_spaces(path: str) -> Side:
    """A ``sentencepiece`` model that puts a space before the text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    tokens = [
        bytes([int(name[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else name.replace(SPACE, " ").encode()
        for i, name in enumerate(names)
    ]
    by_words = not any(SPACE in name.lstrip(SPACE) for name in names)
    word = re.compile(" *[^ ]+| +").findall
    space = model.piece_to_id(SPACE)

    def encode(words: list[str]) -> list[list[int]]:
        # The model puts the first space back, but not before nothing.
        found = model.encode([w[1:] for w in words], num_threads=1)
        return [ids if len(w) > 1 else [space] for w, ids in zip(words, found, strict=True)]

    return Side(word if by_words else lambda text: [text], encode, tokens)


def default_sides() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of overlapping tokens, as row numbers; both tables have ``doc`` and ``start``, in that order.

    Every token's start lies within one token of the other side.
    """
    over = pd.merge_asof(a, b.assign(other=np.arange(len(b))), on="start", by="doc")["other"].to_numpy(np.int64)
    under = pd.merge_asof(b, a.assign(other=np.arange(len(a))), on="start", by="doc")["other"].to_numpy(np.int64)
    pairs = np.union1d(np.arange(len(a)) * len(b) + over, under * len(b) + np.arange(len(b)))
    return pairs // len(b), pairs % len(b)


def _cuts(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Numbers of tokens to cut before, on either side: places where both sides begin a token."""
    cuts, at = [(0, 0)], CALL
    while at < len(a):
        some = a[at : at + 4096]
        found = np.searchsorted(b, some)
        both = np.flatnonzero(b[np.minimum(found, len(b) - 1)] == some)
        if len(both):
            cuts.append((at + int(both[0]), int(found[both[0]])))
            at += int(both[0]) + CALL
        else:
            at += len(some)
    return [*cuts, (len(a), len(b))]


class Aligner:
    """The two sides, and the text of each id with what may stand behind it."""

    def __init__(self, first: Side, second: Side) -> None:
        self.a, self.b = first, second
        self.names = [
            np.array([b"%d%s" % (i, end) for end in (b",", last) for i in range(len(side.tokens))], object)
            for side, last in ((first, b"|"), (second, b";"))
        ]

    def align(self, texts: list[str]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray]:
        """Counts and groups of each text, and all links as ``a id << 32 | b id`` in order of the texts."""
        sides = [side.ids(texts) for side in (self.a, self.b)]
        good = sides[0][2] & sides[1][2] & np.array([bool(t) for t in texts])
        counts = {c: np.zeros(len(texts), np.int64) for c in COUNTS}
        rows = []
        for name, side, (ids, edges, _) in zip(("n_a", "n_b"), (self.a, self.b), sides, strict=True):
            counts[name][:] = np.where(good, np.diff(edges), 0)
            doc = np.repeat(np.arange(len(texts)), np.diff(edges))
            kept = good[doc]
            ids, doc = ids[kept], doc[kept]
            ends = np.cumsum(side.lengths[ids])
            rows.append((ids, doc, ends - side.lengths[ids], ends))
        groups: list[list[bytes]] = [[] for _ in texts]
        links = []
        cuts = _cuts(rows[0][2], rows[1][2])
        for (a0, b0), (a1, b1) in zip(cuts, cuts[1:], strict=False):
            if a0 < a1:
                a, b = [tuple(x[i:j] for x in side) for side, i, j in ((rows[0], a0, a1), (rows[1], b0, b1))]
                links.append(self._call(a, b, counts, groups))
        said = [b"".join(parts)[:-1].decode() for parts in groups]
        return counts, said, np.concatenate([np.zeros(0, np.int64), *links])

    def _call(self, a: tuple, b: tuple, counts: dict, groups: list[list[bytes]]) -> np.ndarray:
        (a_ids, a_doc, a_start, a_end), (b_ids, b_doc, b_start, b_end) = a, b
        i, j = overlaps(pd.DataFrame({"start": a_start, "doc": a_doc}), pd.DataFrame({"start": b_start, "doc": b_doc}))
        n = len(counts["n_links"])
        counts["n_overlaps"] += np.bincount(a_doc[i], minlength=n)
        equal = a_end[i] == b_end[j]
        i, j = i[equal], j[equal]
        linked = np.bincount(a_doc[i], minlength=n)
        counts["n_links"] += linked
        counts["n_groups"] += np.bincount(a_doc[np.flatnonzero(np.isin(a_end, b_end, assume_unique=True))], minlength=n)
        # Each group's tokens of the first side, then those of the second.
        a_sizes, b_sizes = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        out = np.empty(len(a_ids) + len(b_ids), object)
        place = np.arange(len(a_ids)) + np.repeat(j + 1 - b_sizes, a_sizes)
        last = np.zeros(len(a_ids), np.int64)
        last[i] = len(self.a.tokens)
        out[place] = self.names[0][a_ids + last]
        place = np.arange(len(b_ids)) + np.repeat(i + 1, b_sizes)
        last = np.zeros(len(b_ids), np.int64)
        last[j] = len(self.b.tokens)
        out[place] = self.names[1][b_ids + last]
        docs, first_a = np.unique(a_doc, return_index=True)
        first_b = np.searchsorted(b_doc, docs)
        edges = [*(first_a + first_b).tolist(), len(out)]
        listed = out.tolist()
        for doc, begin, end in zip(docs.tolist(), edges, edges[1:], strict=False):
            groups[doc].append(b"".join(listed[begin:end]))
        return a_ids[i] << 32 | b_ids[j]


@cache
def _aligner(first: str, second: str) -> Aligner:
    return Aligner(byte_level(first), pieces_with_spaces(second))


def _align(first: str, second: str, keep_groups: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(first, second)
        for key, ids, texts in document_blocks(batches, ALIGN_BLOCK):
            counts, said, links = aligner.align(texts)
            pairs, codes, times = np.unique(links, return_inverse=True, return_counts=True)
            codes, order = by_frequency(codes, len(pairs))
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
            row = {
                "block": pa.array([key], pa.int64()),
                "doc_ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                **{c: pa.array([counts[c]], pa.list_(pa.int64())) for c in COUNTS},
                "digests": pa.array([digests], pa.list_(pa.string())),
                "groups": pa.array([said if keep_groups else None], pa.list_(pa.string())),
                "links": pa.array([squeezed(codes)], pa.binary()),
                "pairs": pa.array([pairs[order]], pa.list_(pa.int64())),
                "times": pa.array([times[order]], pa.list_(pa.int64())),
            }
            yield pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

    return align


def _hand_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of pairs to the blocks that hold the pairs: low and high half, the mark in the lowest bit of the latter."""
    held, n = [], 0

    def out():
        block, no, times, best = (np.concatenate(c) for c in zip(*held, strict=True))
        halves = np.stack([times & 0xFFFFFFFF, (times >> 32) << 1 | best], 1).astype(np.uint32)
        return by_block(block, no, np.full(len(block), 2, np.uint32), halves.reshape(-1))

    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "no", "times", "best")])
        n += batch.num_rows
        if n >= HELD:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block and the counts of its pairs, to rows of its documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i] for name in batch.schema.names}
            each = {c: np.asarray(block[c].values) for c in COUNTS}
            codes = unsqueezed(block["links"].as_py(), int(each["n_links"].sum()))
            flat, starts, _ = dictionary(block["chunks"].as_py() or [], block["distinct"].as_py())
            low, high = flat[starts].astype(np.int64), flat[starts + 1].astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(each["n_links"])])
            best, times = (np.concatenate([[0], np.cumsum(x[codes])]) for x in (high & 1, low | high >> 1 << 32))
            groups = block["groups"].values
            columns = {
                "doc_id": block["doc_ids"].values,
                **{c: pa.array(each[c]) for c in ("n_a", "n_b", "n_groups", "n_links")},
                "n_best": pa.array(best[edges[1:]] - best[edges[:-1]]),
                "count_sum": pa.array(times[edges[1:]] - times[edges[:-1]]),
                "groups_sha256": block["digests"].values,
                "n_overlaps": pa.array(each["n_overlaps"]),
                "groups": pa.nulls(len(edges) - 1, pa.string()) if groups is None else groups,
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _second_id(pair: Column) -> Column:
    return pair.bitwiseAND(F.lit((1 << 32) - 1))


def align(docs: DataFrame, first: str | None = None, second: str | None = None, keep_groups: bool = True) -> DataFrame:
    """``RESULT``: tokens, groups and links of every document, and how common its links are in the corpus.

    ``groups`` lists the ids of both sides group by group, ``a1,a2|b1;a3|b2,b3``.
    """
    prepare(docs.sparkSession)
    given = default_sides()
    step = _align(first or given[0], second or given[1], keep_groups)
    blocks = fixed(docs.select("doc_id", "text").mapInArrow(step, ALIGNED), "alignment")
    listed = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("no", "p"))
    counted = listed.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("times"))
    most = counted.groupBy(_second_id(F.col("pair")).alias("second")).agg(F.max("times").alias("most"))
    scored = counted.withColumn("second", _second_id(F.col("pair"))).join(most, "second")
    scored = scored.select("pair", "times", (F.col("times") == F.col("most")).cast("int").alias("best"))
    found = listed.select("block", "no", F.col("p.pairs").alias("pair")).join(scored, "pair")
    chunks = found.select("block", "no", "times", "best").mapInArrow(_hand_out, CHUNKS)
    returned = chunks.groupBy("block").agg(F.collect_list(F.struct("n", "size", "numbers")).alias("chunks"))
    kept = blocks.withColumn("distinct", F.size("pairs")).drop("pairs", "times")
    return kept.join(returned, "block", "left").mapInArrow(_finish, RESULT)
