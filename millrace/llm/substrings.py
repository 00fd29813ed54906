"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; where its leading bits are zero a chunk
ends, so a chunk depends on the 16 bytes before its end and on what is in it, and an
insertion shifts the cuts near it only. Chunks are compared by digest. The first
occurrence, by id and place, stays; in the others, runs of neighbouring repeated
chunks of ``LEAST`` bytes or more are cut out of the text.

Each run of rows sends a chunk that it meets often once, and knows by itself that
its other occurrences are not the first; so a chunk that all documents share is a
row for each run of rows, not for each document.

The whole text of every row is cut into chunks; a cut is never inside a character.
Defined results: NULL and empty texts stay as they are. Rows without an id stay as
they are and don't count as an occurrence. Rows alike in id and text are one document
and are cut alike. A repetition within a document is cut too. A document all of
which is repeated keeps an empty text. An empty table gives an empty result. Extra
columns are kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import fixed, mix64, pieces, plain_bytes, prepare
from .ngram_join import perhaps

SHORTEST, LONGEST = 16, 128  # bytes of a chunk
ZERO_BITS = 4  # leading bits of the 16-bit hash that are zero at a cut: every 16th place on average
LEAST = 100  # bytes that a run of repeated chunks must have
AT_ONCE = 4096  # chunks whose digests are made together, so some 512 KB of text at most
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
BYTE = mix64(np.arange(1001, 1257, dtype=np.uint64))
PLACE = mix64(np.arange(2001, 2001 + 2 * LONGEST, dtype=np.uint64)) | np.uint64(1)

SPANS = ArrayType(StructType().add("start", LongType()).add("length", LongType()))


def rolled(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 16 bytes up to each place: each byte's value shifted by how far back it is."""
    out = GEAR[data]
    for step in (1, 2, 4, 8):
        back = out[:-step] << np.uint16(step)
        out[step:] += back
    return out


def ends(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks end, text by text, and how many each text has."""
    free = np.ones(len(data) + 1, bool)  # places that are not inside a character
    free[:-1] = (data & 0xC0) != 0x80
    at = np.flatnonzero((rolled(data) >> np.uint16(16 - ZERO_BITS)) == 0) + 1 if len(data) else np.zeros(0, np.int64)
    at = at[free[at]]
    first = np.searchsorted(at, starts, "right")
    found: list[int] = []
    counts = np.zeros(len(starts) - 1, np.int64)
    for i, (start, end) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        before, last = len(found), start
        for cut in [*at[first[i] : first[i + 1]].tolist(), end]:
            if cut - last < SHORTEST and cut != end:
                continue
            while cut - last > LONGEST:
                last += LONGEST
                while not free[last]:
                    last -= 1
                found.append(last)
            if cut > last:
                found.append(cut)
                last = cut
        counts[i] = len(found) - before
    return np.array(found, np.int64), counts


def digests(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits that stand for the bytes of each chunk; chunks cover all of ``data``."""
    out = np.empty(len(begin), np.uint64)
    for first in range(0, len(begin), AT_ONCE):
        a, b = begin[first : first + AT_ONCE], end[first : first + AT_ONCE]
        part = data[a[0] : b[-1]]
        place = np.arange(a[0], b[-1]) - np.repeat(a, b - a)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.multiply(BYTE[part], PLACE[place], out=sums[1:])
        np.cumsum(sums, out=sums)
        out[first : first + AT_ONCE] = sums[b - a[0]] - sums[a - a[0]] + (b - a).astype(np.uint64)
    return mix64(out)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        data, starts = plain_bytes(batch.column("text"))
        end, counts = ends(data, starts)
        if not len(end):
            continue
        begin = np.concatenate([[0], end[:-1]])
        digest = digests(data, begin, end).view(np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        doc = batch.column("doc_id").to_numpy(zero_copy_only=False)[row]
        mark = batch.column("mark").to_numpy(zero_copy_only=False)[row]
        place = ((begin - starts[:-1][row]) << 8) | (end - begin)
        order = np.lexsort((place, mark, doc, digest))
        digest, doc, mark, place = digest[order], doc[order], mark[order], place[order]
        new = np.ones(len(order), bool)
        new[1:] = digest[1:] != digest[:-1]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        same = (doc == doc[head]) & (mark == mark[head]) & (place == place[head])
        keep = new | ~same  # rows alike in all are one
        yield pa.RecordBatch.from_arrays(
            [pa.array(digest[keep], mask=~new[keep]), pa.array(doc[keep]), pa.array(mark[keep]), pa.array(place[keep])],
            names=["digest", "doc_id", "mark", "place"],
        )


def mark_of(text: Column) -> Column:
    """64 bits of the text, which tell rows apart that share an id."""
    return F.xxhash64(text, F.octet_length(text))


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, spans``: the start and length in bytes of every repeated chunk that isn't the first."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    rows = rows.select("doc_id", mark_of(F.col("text")).alias("mark"), "text")
    # A NULL digest: known not to be the first.
    chunks = rows.mapInArrow(_chunks, "digest bigint, doc_id bigint, mark bigint, place bigint")
    own = F.struct("doc_id", "mark", "place")
    alone = F.when(F.col("digest").isNull(), F.xxhash64("doc_id", "mark", "place"))
    first = F.min(own).over(Window.partitionBy("digest", alone))
    later = chunks.withColumn("first", first).filter(F.col("digest").isNull() | (own != F.col("first")))
    span = F.struct(
        F.shiftright("place", 8).alias("start"),
        F.col("place").bitwiseAND(F.lit(255)).alias("length"),
    )
    # A set: rows alike in id and text say the same, however many there are.
    return later.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def _runs(least: int):
    """Documents with repeats to those with something to cut out."""

    def long_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, end = all_runs(batch.column("spans"), least)
            some, first = np.unique(row, return_index=True)
            span = pa.StructArray.from_arrays([pa.array(start), pa.array(end - start)], names=["start", "length"])
            spans = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), span)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(some)) for c in ("doc_id", "mark")), spans], names=["doc_id", "mark", "spans"]
            )

    return long_runs


def all_runs(lists: pa.ListArray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``runs`` of all rows of a batch at once: the row of each, its start and its end."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    spans = lists.flatten()
    row = np.repeat(np.arange(len(counts)), counts)
    # Each row has a stretch of its own, longer than any text, so that rows never touch.
    start = spans.field("start").to_numpy() + (row << 40)
    end = np.maximum.accumulate(start + spans.field("length").to_numpy())
    new = np.ones(len(row), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    long = end[last] - start[first] >= least
    row, base = row[first][long], row[first][long] << 40
    return row, start[first][long] - base, end[last][long] - base


def runs(spans: list[dict], least: int) -> list[tuple[int, int]]:
    """Neighbouring spans put together; those long enough, as start and end."""
    out: list[list[int]] = []
    for s in spans:
        start, end = s["start"], s["start"] + s["length"]
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out if b - a >= least]


def _cut(least: int, names: list[str]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "__text"):
            texts, removed = [], []
            for text, spans in zip(batch.column("__text").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                found = runs(spans or [], least)
                if not found:
                    texts.append(text)
                    removed.append([])
                    continue
                data, kept, at, chars, places = text.encode("utf-8", "surrogatepass"), [], 0, 0, []
                for a, b in found:
                    before, gone = data[at:a].decode("utf-8", "surrogatepass"), data[a:b].decode("utf-8", "surrogatepass")
                    places.append({"start": chars + len(before), "length": len(gone)})
                    chars += len(before) + len(gone)
                    kept.append(before)
                    at = b
                texts.append("".join(kept) + data[at:].decode("utf-8", "surrogatepass"))
                removed.append(places)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string()), pa.array(removed, kind)],
                names=[*names, "__text", "__removed"],
            )

    return cut


def deduplicated(docs: DataFrame, least: int = LEAST, spans_as: str | None = None) -> DataFrame:
    """All rows and columns, with what repeats cut out of ``text``.

    ``spans_as`` adds a column of that name: start and length, in code points of the
    original text, of everything that was cut out.
    """
    found = repeats(docs)
    found = fixed(found.mapInArrow(_runs(least), found.schema), "substring-runs")
    names = [f"__c{i}" for i, c in enumerate(docs.columns) if c != "text"]
    own = [F.col(c).alias(f"__c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    keys = [F.col("doc_id").cast("long").alias("__doc"), mark_of(F.col("text")).alias("__mark")]
    left = docs.select(*own, *keys, F.col("text").alias("__text"))
    # Only rows with something to cut meet their runs; a filter of fixed size lets the others pass by.
    known = perhaps(found.select("doc_id"))
    right = found.select(F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark"), F.col("spans").alias("__spans"))
    met = left.filter(known("__doc")).join(right, ["__doc", "__mark"], "left").select(*names, "__text", "__spans")
    schema = StructType([f for f in met.schema.fields if f.name != "__spans"])
    schema = schema.add("__removed", SPANS)
    passing = left.filter(~F.coalesce(known("__doc"), F.lit(False))).select(*names, "__text", F.array().cast(SPANS).alias("__removed"))
    out = met.mapInArrow(_cut(least, names), schema).unionByName(passing)
    back = [F.col("__text" if c == "text" else f"__c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return out.select(*back, *([F.col("__removed").alias(spans_as)] if spans_as else []))


def dedup_report(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """For every row its id, the text that is left, and what was cut out."""
    out = deduplicated(docs.select("doc_id", "text"), least, "removed")
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return out.select("doc_id", "text", gone.alias("removed_chars"), "removed")
