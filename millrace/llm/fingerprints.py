"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for a prime modulus and for 2^64, the sums of c[j] * B^j over
the code points before each place. The hash of any span is a difference of two
entries, brought to a common power, so equality of spans takes two look-ups, and
the longest common extension of two places is found by binary search.

A fingerprint is 24 hex digits for the hash of the whole text and ``BINS`` times
two for a sketch of its spans of ``SPAN`` code points: each span's hash falls into
a bin, and the bin keeps eight bits of its smallest. The likeness of two
fingerprints is the share of their filled bins that agree; those of equal texts
are equal, with likeness 1.

Defined results: a NULL text is empty; the likeness of two empty texts is 1, that
of an empty and another text 0. Texts shorter than a span are one span. Rows are
ordered by id, NULL first, ties by a hash of the text. A table of one row has itself as next.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fixed, mix64, pieces, prepare

PRIME = 2147483647
PRIME_BASE = 1_000_003
WORD_BASE = 0x9E3779B97F4A7C15
SPAN = 12
BINS = 64
BLOCK = 1 << 18
WORD = 1 << 64
ROW = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, unchanged bigint, part int, place int, text string"
)


def _powers(base: int, modulus: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    filled = 1
    while filled < n:  # by doubling
        step = np.uint64(pow(base, filled, modulus))
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * step  # wraps at 2^64, which is the other modulus
        if modulus == PRIME:
            out[filled : filled + more] %= np.uint64(PRIME)
        filled += more
    return out


_tables: dict[tuple, np.ndarray] = {}


def _table(base: int, modulus: int, n: int) -> np.ndarray:
    """At least ``n`` powers; a text longer than a block makes its own and doesn't keep them."""
    if n > BLOCK + SPAN + 1:
        return _powers(base, modulus, n)
    if (base, modulus) not in _tables:
        _tables[base, modulus] = _powers(base, modulus, BLOCK + SPAN + 1)
    return _tables[base, modulus]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


class PrefixHash:
    """Hashes of any span of a text, modulo the prime 2^31 - 1 and modulo 2^64."""

    def __init__(self, points: np.ndarray) -> None:
        n = self.n = len(points)
        terms = points * _table(PRIME_BASE, PRIME, n)[:n]
        terms = (terms & np.uint64(PRIME)) + (terms >> np.uint64(31))  # the same modulo the prime, below 2^32
        self.prime, self.word = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.prime[1:])  # left unreduced: below 2^63 for texts under 2^31 code points
        np.cumsum(points * _table(WORD_BASE, WORD, n)[:n], out=self.word[1:])

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The hash of [a, b), free of where the span lies."""
        return (
            (int(self.prime[b]) - int(self.prime[a])) * pow(PRIME_BASE, -a, PRIME) % PRIME,
            (int(self.word[b]) - int(self.word[a])) * pow(WORD_BASE, -a, WORD) % WORD,
        )

    def equal(self, a: int, other: PrefixHash, b: int, length: int) -> bool:
        """Whether the spans of ``length`` at a here and b there are equal: no inverse, one side is raised."""
        for p, q, base, m in ((self.prime, other.prime, PRIME_BASE, PRIME), (self.word, other.word, WORD_BASE, WORD)):
            one, two = int(p[a + length]) - int(p[a]), int(q[b + length]) - int(q[b])
            shift = pow(base, abs(b - a), m)
            if (one * shift - two if b >= a else one - two * shift) % m:
                return False
        return True

    def extension(self, a: int, other: PrefixHash, b: int) -> int:
        """How far the texts agree from a here and b there."""
        low, high = 0, min(self.n - a, other.n - b)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(a, other, b, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self, length: int) -> np.ndarray:
        """Mixed hashes of all spans of ``length``, alike wherever they lie."""
        n = self.n - length + 1
        return mix64((self.word[length:] - self.word[:n]) * _table(pow(WORD_BASE, -1, WORD), WORD, n)[:n])


def _smallest(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin; all ones where there is none. The bin is the leading bits."""
    ordered = np.sort(hashes)
    edges = (np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)).astype(np.uint64)
    at = np.searchsorted(ordered, edges)
    bounded = np.append(ordered, np.uint64(2**64 - 1))[at]
    ends = np.append(at[1:], len(ordered))
    return np.where(at < ends, bounded, np.uint64(2**64 - 1))


def _hex(whole: tuple[int, ...], smallest: np.ndarray) -> str:
    empty = smallest == np.uint64(2**64 - 1)
    bits = (smallest >> np.uint64(8)) % np.uint64(255) + np.uint64(1)
    return f"{whole[0]:08x}{whole[1]:016x}" + np.where(empty, 0, bits).astype(np.uint8).tobytes().hex()


def fingerprint_of(points: np.ndarray) -> tuple[str, PrefixHash | None]:
    """The fingerprint; for a text of one block also its prefix hashes. Longer ones go block by block."""
    if len(points) <= BLOCK:
        prefix = PrefixHash(points)
        if not len(points):
            return _hex((0, 0), np.full(BINS, 2**64 - 1, np.uint64)), prefix
        return _hex(prefix.span(0, prefix.n), _smallest(prefix.spans(min(SPAN, prefix.n)))), prefix
    whole, smallest = [0, 0], np.full(BINS, 2**64 - 1, np.uint64)
    for start in range(0, len(points), BLOCK):
        block = PrefixHash(points[start : start + BLOCK + SPAN - 1])
        own = min(BLOCK, len(points) - start)
        whole[0] = (whole[0] + int(block.prime[own]) * pow(PRIME_BASE, start, PRIME)) % PRIME
        whole[1] = (whole[1] + int(block.word[own]) * pow(WORD_BASE, start, WORD)) % WORD
        if block.n >= SPAN:
            smallest = np.minimum(smallest, _smallest(block.spans(SPAN)))
    return _hex(tuple(whole), smallest), None


def likeness(one: str, two: str) -> float:
    """The share of filled bins that agree."""
    a, b = (np.frombuffer(bytes.fromhex(x[24:]), np.uint8) for x in (one, two))
    filled = np.count_nonzero(a | b)
    if not filled:
        return 1.0
    return float(np.count_nonzero((a == b) & (a > 0)) / filled)


def common_start(one: np.ndarray, two: np.ndarray) -> int:
    """The longest common extension from the start of both, block by block."""
    at = 0
    while at < min(len(one), len(two)):
        a, b = one[at : at + BLOCK], two[at : at + BLOCK]
        found = PrefixHash(a).extension(0, PrefixHash(b), 0)
        at += found
        if found < min(len(a), len(b)):
            break
    return at


class _Document:
    def __init__(self, doc_id: int | None, text: str | None) -> None:
        self.doc_id, self.text = doc_id, text or ""
        self.points = code_points(self.text)
        self.fingerprint, self.prefix = fingerprint_of(self.points)

    def against(self, following: _Document, part: int) -> tuple:
        n = len(self.text)
        kept = n - n // 4
        edited = self.text[:kept] + following.text[: n // 4]
        points = np.concatenate([self.points[:kept], following.points[: n // 4]])
        mark, prefix = fingerprint_of(points)
        if self.prefix is not None and prefix is not None:
            same = self.prefix.extension(0, prefix, 0)
        else:
            same = common_start(self.points, points)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        near = likeness(self.fingerprint, mark), likeness(self.fingerprint, following.fingerprint)
        return (self.doc_id, n, digest, self.fingerprint, mark, *near, same, part, None, None)


KINDS = [
    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(),
    pa.int32(), pa.int32(), pa.string(),
]
NAMES = [f.split()[0] for f in ROW.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in KINDS]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, KINDS, strict=True)], names=NAMES)


def _range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All documents of a sorted range but the last; the first and the last one's texts for the edges."""
    last, part = None, TaskContext.get().partitionId()

    def edge(doc: _Document, place: int) -> tuple:
        return (doc.doc_id, *[None] * 7, part, place, doc.text)

    for batch in pieces(batches):
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            doc = _Document(doc_id, text)
            rows.append(edge(doc, 0) if last is None else last.against(doc, part))
            last = doc
        yield _batch(rows)
    if last is not None:
        yield _batch([edge(last, 1)])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        own, following = (batch.column(c).to_pylist() for c in ("text", "next_text"))
        ids = batch.column("doc_id").to_pylist()
        yield _batch([_Document(i, t).against(_Document(None, n), 0) for i, t, n in zip(ids, own, following, strict=True)])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how near it is to that and to the next document.

    The texts are dealt by ranges of the id once. A task compares neighbours within
    its range; the last of a range meets the first of the next in a second step
    over two rows for each range.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("draw"))
    # The keys are sampled on the driver, so the text itself is none of them.
    ranged = rows.repartitionByRange("doc_id", "draw").sortWithinPartitions("doc_id", "draw", "text")
    found = fixed(ranged.mapInArrow(_range, ROW), "fingerprints")
    place = found.filter("place is not null")
    ranges = place.filter("place = 0").select("part")
    order = Window.orderBy("part")
    first = F.min("part").over(Window.partitionBy())
    following = ranges.select("part", F.coalesce(F.lead("part").over(order), first).alias("next"))
    heads = place.filter("place = 0").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    # Texts of the edges are as long as documents are, so they meet in a shuffle; only part numbers may be broadcast.
    ends = place.filter("place = 1").select("part", "doc_id", "text").join(following, "part")
    ends = ends.hint("merge").join(heads.hint("merge"), "next")
    edges = ends.select("doc_id", "text", "next_text").mapInArrow(_edges, ROW)
    return found.filter("place is null").unionByName(edges).drop("part", "place", "text")
