"""Quality by supervised subword embeddings.

A document is the mean of the learned vectors of its words, its pairs of
neighbouring words and the character n-grams within and at the edges of its words, all hashed into one table of
``2^BITS`` rows; two outputs and softmax give the score. Vectors and outputs are
trained together by stochastic gradient descent in numpy, on a bounded sample of
the labelled rows: at most ``PER_LABEL`` of each label, with texts of at most
``MAX_CHARS`` characters, or windows of longer ones if a label has no others. Since the output is linear in the mean, scoring needs
one number for each row of the table.

Every whole text is scored; only the text is looked at. Defined results: a NULL or
empty text has no feature and scores the output's bias alone, as does a text of
white space. Without any usable label every score is 0.5. Repeated rows are scored
alike. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, mix64, labelled_sample, pieces, prepare, segment_sums
from .features import SPACE, framed, grams, word_hashes

BITS = 18
WIDTH = 12
PER_LABEL = 2500
MAX_CHARS = 12_000
EPOCHS = 4
RATE = 0.5
SEED = 11
SIZES = (3, 4)  # bytes of an n-gram


def buckets(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words and each n-gram size: the bucket of each, and where each text's begin."""
    data, starts = framed(texts)
    if not len(data):
        return []
    space, kinds = SPACE[data], []
    begins, _, hashes = word_hashes(data, ~space)
    kinds.append(((hashes >> np.uint64(64 - BITS)).astype(np.uint32), np.searchsorted(begins, starts)))
    # Pairs of neighbouring words, free of order: all pairs of a word with itself share one bucket.
    pairs = mix64(hashes[1:] ^ hashes[:-1])
    first = np.searchsorted(begins, starts)
    inside = np.ones(len(pairs), bool)
    inside[first[1:-1][(first[1:-1] > 0) & (first[1:-1] <= len(pairs))] - 1] = False  # not over the edge of two texts
    at = np.flatnonzero(inside)
    kinds.append(((pairs[at] >> np.uint64(64 - BITS)).astype(np.uint32), np.searchsorted(at, first)))
    for n in SIZES:
        rows = grams(data, n, BITS)
        inner = ~space[1 : len(rows) + 1]
        for i in range(2, n - 1):
            inner = inner & ~space[i : len(rows) + i]
        at = np.flatnonzero(inner)  # white space only at the ends: edges of words
        kinds.append((rows[at], np.searchsorted(at, starts)))
    return kinds


def train(texts: list[str], labels: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, float]:
    """The log odds that each bucket adds to the mean, and the bias."""
    rng = np.random.default_rng(seed)
    docs: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(texts), 256):
        kinds = buckets(pa.array(texts[start : start + 256], pa.large_string()))
        for i in range(len(texts[start : start + 256])):
            rows = np.concatenate([r[s[i] : s[i + 1]] for r, s in kinds]) if kinds else np.zeros(0, np.uint32)
            unique, counts = np.unique(rows, return_counts=True)
            docs.append((unique, (counts / max(1, counts.sum())).astype(np.float32)))
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    output, bias = np.zeros((2, WIDTH), np.float32), np.zeros(2, np.float32)
    share = labels.mean() if len(labels) else 0.5
    weight = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).clip(0, 5)
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rows, share_of = docs[i]
            rate = np.float32(RATE * (1 - done / steps) * weight[i])
            done += 1
            if not len(rows):
                continue
            mean = share_of @ table[rows]
            logits = output @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            pull = output.T @ p
            output -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
            table[rows] -= (rate * 20 * share_of)[:, None] * pull
    return table @ (output[1] - output[0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, parts: int = 4, rest: int = 2, per_label: int = PER_LABEL):
    """Learns from labelled rows outside the fold, from a bounded sample of them."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id"), parts, rest))
    # An id with contradictory labels teaches nothing.
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    known = known.filter("label = other").drop("other")
    rows = labelled_sample(docs.select("doc_id", "text"), MAX_CHARS, lambda _: per_label, SEED, labels=known)
    sample = rows.toArrow().to_pandas().sort_values(["doc_id", "text"])
    y = sample["label"].to_numpy(np.int64)
    if len(set(y)) < 2:
        return np.zeros(1 << BITS, np.float32), 0.0
    return train(sample["text"].tolist(), y)


def score(docs: DataFrame, model: tuple[np.ndarray, float], parts: int = 4, rest: int = 2, threshold: float = 0.7) -> DataFrame:
    prepare(docs.sparkSession)
    weights, bias = docs.sparkSession.sparkContext.broadcast(model[0].astype(np.float32)), model[1]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in pieces(batches):
            total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for rows, starts in buckets(batch.column("text")):
                total += segment_sums(table[rows], starts)
                n += np.diff(starts)
            p = 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -60, 60)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), parts, rest).alias("held_out"), "text"
    )
    return rows.mapInArrow(scored, "doc_id bigint, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
