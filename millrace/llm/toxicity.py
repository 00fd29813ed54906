"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Input of a step is a word: a learned vector of its hash, and the mean of the
learned vectors of its character trigrams. A gated recurrent unit runs over a
window of ``WINDOW`` words in each direction, attention pools the states, and a
logistic output scores the window. Windows start every ``STRIDE`` words, so they
overlap; a document scores as its highest window, and all windows of the whole
text are scored.

Training is in numpy (back-propagation through time, Adam) on a bounded sample of
the labelled rows: at most ``PER_LABEL`` of each label, with texts of at most
``MAX_CHARS`` characters, or windows of longer ones if a label has no others. Labels are for documents, so each epoch learns, for
every sampled document, from its window that scores highest so far (at first: by
log odds of words) and from another one of those without the label.

Words are runs of ASCII letters and digits and of non-ASCII characters but for
spaces and punctuation, lower-cased. A run of more than ``PIECE`` bytes, as scripts
without spaces have, is cut at character borders into words of at most ``PIECE``.
Defined results: a NULL or empty text, or one without words, is one empty window
and scores the output's bias. Without both labels every score is 0. Repeated rows
are scored alike. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, pieces, prepare
from .features import framed, grams, word_hashes

WINDOW, STRIDE = 40, 32
WORD_BITS, CHAR_BITS = 15, 13
WORD_WIDTH, CHAR_WIDTH, HIDDEN, ATTENTION = 8, 12, 8, 4
DROPPED = 0.5  # share of words whose own vector is hidden in a training step, so that spelling counts
PER_LABEL = 1500
MAX_CHARS = 12_000
EPOCHS = 8  # at least
STEPS = 500  # at least, so that a small sample is gone over more often
SEED = 17
INSIDE = np.zeros(256, bool)
INSIDE[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
PIECE = 48  # bytes of a word
# Spaces and punctuation outside ASCII.
BORDER = "[%s]+" % "".join(c for c in map(chr, range(128, 1 << 16)) if unicodedata.category(c)[0] in "ZP" or c in "\x85\u200b")


def parted(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space wherever a run of more than ``PIECE`` bytes is cut."""
    edges = np.diff(np.concatenate([[False], INSIDE[data], [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = np.flatnonzero(ends - begins > PIECE)
    if not len(long):
        return data, starts
    step = PIECE - 3  # a cut moves back by up to three bytes, to where a character begins
    count = -(-(ends - begins)[long] // step) - 1
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    cuts = np.repeat(begins[long], count) + (nth + 1) * step
    for _ in range(3):
        cuts -= (data[cuts] & 0xC0) == 0x80
    return np.insert(data, cuts, np.uint8(32)), starts + np.searchsorted(cuts, starts)


class Words:
    """The words of some texts: each one's number among the distinct ones, and where each text's begin."""

    def __init__(self, texts: pa.Array) -> None:
        data, starts = framed(pc.replace_substring_regex(texts, BORDER, " "), lower=True)
        data, starts = parted(data, starts)
        if not len(data):
            data = np.full(3, 32, np.uint8)
            starts = np.zeros(len(texts) + 1, np.int64)
        inside = INSIDE[data]
        begins, ends, hashes = word_hashes(data, inside)
        self.starts = np.searchsorted(begins, starts)
        distinct, first, self.number = np.unique(hashes, return_index=True, return_inverse=True)
        self.bucket = (distinct >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        # A word of n bytes has n trigrams, the first and last with the edge.
        trigrams = grams(np.where(inside, data, np.uint8(32)), 3, CHAR_BITS)
        lengths = (ends - begins)[first]
        self.chars = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(begins[first] - 1 - self.chars[:-1], lengths) + np.arange(self.chars[-1])
        self.trigram = trigrams[at].astype(np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """A row of word numbers for each window (-1: none), and the text of each."""
        n = np.diff(self.starts)
        count = np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE))
        text = np.repeat(np.arange(len(n)), count)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        place = nth[:, None] * STRIDE + np.arange(WINDOW)
        missing = place >= n[text][:, None]
        at = np.minimum(place + self.starts[:-1][text][:, None], max(len(self.number) - 1, 0))
        rows = self.number[at] if len(self.number) else np.zeros(at.shape, np.int64)
        return np.where(missing, -1, rows), text


def sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.exp(-x)
    out += 1
    return np.reciprocal(out, out=out)


class Network:
    def __init__(self, seed: int = SEED) -> None:
        rng = self.rng = np.random.default_rng(seed)
        h, x = HIDDEN, WORD_WIDTH + CHAR_WIDTH

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "word": normal(1 << WORD_BITS, WORD_WIDTH, scale=0.1),
            "char": normal(1 << CHAR_BITS, CHAR_WIDTH, scale=0.3),
            "attend": normal(2 * h, ATTENTION, scale=0.3),
            "attend_bias": np.zeros(ATTENTION, np.float32),
            "query": normal(ATTENTION, scale=0.3),
            "out": normal(2 * h, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        for way in ("f", "b"):
            self.p |= {
                f"in_{way}": normal(x, 3 * h, scale=0.3),
                f"in_bias_{way}": np.zeros(3 * h, np.float32),
                f"gates_{way}": normal(h, 2 * h, scale=0.3),
                f"new_{way}": normal(h, h, scale=0.3),
            }
        self.moments = None
        self.steps = 0

    def inputs(self, words: Words, which: np.ndarray | None = None) -> tuple:
        """Vectors of the distinct words (or those of ``which``): word part and mean of the character part."""
        if which is None:
            which, trigram, chars = np.arange(len(words.bucket)), words.trigram, words.chars
        else:
            lengths = np.diff(words.chars)[which]
            chars = np.concatenate([[0], np.cumsum(lengths)])
            at = np.repeat(words.chars[which] - chars[:-1], lengths) + np.arange(chars[-1])
            trigram = words.trigram[at]
        n = np.diff(chars)
        if len(n):
            mean = np.add.reduceat(self.p["char"][trigram], chars[:-1], axis=0) / n[:, None].astype(np.float32)
        else:
            mean = np.zeros((0, CHAR_WIDTH), np.float32)
        return np.concatenate([self.p["word"][words.bucket[which]], mean], 1), which, trigram, n

    def run(self, vectors: np.ndarray, rows: np.ndarray, keep: bool = False):
        """Logits of windows; ``rows`` point into ``vectors``, -1 is no word."""
        p, h = self.p, HIDDEN
        n = rows.shape[0]
        there = (rows >= 0).astype(np.float32)
        full = bool(there.all())
        at = rows.T
        states, caches = np.zeros((WINDOW, n, 2 * h), np.float32), {"f": [], "b": []}
        for way, order, place in (("f", range(WINDOW), slice(0, h)), ("b", range(WINDOW - 1, -1, -1), slice(h, 2 * h))):
            table = np.concatenate([vectors @ p[f"in_{way}"], np.zeros((1, 3 * h), np.float32)]) + p[f"in_bias_{way}"]
            gates, new = p[f"gates_{way}"], p[f"new_{way}"]
            state = np.zeros((n, h), np.float32)
            for t in order:
                x = table[at[t]]
                zr = sigmoid(x[:, : 2 * h] + state @ gates)
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h :] + (r * state) @ new)
                step = z * (c - state)
                if not full:
                    step *= there[:, t, None]
                if keep:
                    caches[way].append((t, state, z, r, c))
                state = state + step
                states[t, :, place] = state
        hidden = np.tanh(states @ p["attend"] + p["attend_bias"])
        energy = (hidden @ p["query"]).T
        if not full:
            energy = np.where(there > 0, energy, np.float32(-1e9))
        weight = np.exp(energy - energy.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        pooled = np.einsum("nt,tnh->nh", weight, states)
        logits = pooled @ p["out"] + p["bias"]
        return (logits, (there, states, caches, hidden, weight, pooled)) if keep else logits

    def learn(self, words: Words, rows: np.ndarray, labels: np.ndarray, rate: float) -> None:
        """One step of Adam on the mean log loss of some windows."""
        p, h = self.p, HIDDEN
        used = np.unique(rows[rows >= 0])
        vectors, which, trigram, lengths = self.inputs(words, used)
        known = (self.rng.random(len(used)) >= DROPPED).astype(np.float32)[:, None]
        vectors[:, :WORD_WIDTH] *= known
        local = np.where(rows >= 0, np.searchsorted(used, rows), -1)
        logits, (there, states, caches, hidden, weight, pooled) = self.run(vectors, local, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = ((sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        g["out"], g["bias"][0] = pooled.T @ d, d.sum()
        d_pooled = d[:, None] * p["out"]
        d_states = weight.T[:, :, None] * d_pooled
        d_weight = np.einsum("nh,tnh->nt", d_pooled, states)
        d_energy = (weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))).T
        g["query"] = np.einsum("tn,tna->a", d_energy, hidden)
        d_hidden = d_energy[:, :, None] * p["query"] * (1 - hidden**2)
        g["attend"] = np.einsum("tnh,tna->ha", states, d_hidden)
        g["attend_bias"] = d_hidden.sum((0, 1))
        d_states += d_hidden @ p["attend"].T
        d_vectors = np.zeros_like(vectors)
        for way, place in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            gates, new = p[f"gates_{way}"], p[f"new_{way}"]
            d_state = np.zeros((len(rows), h), np.float32)
            d_table = np.zeros((len(vectors) + 1, 3 * h), np.float32)
            for t, state, z, r, c in reversed(caches[way]):
                d_state += d_states[t, :, place]
                d_step = d_state * there[:, t, None]
                d_c = d_step * z * (1 - c**2)
                d_z = d_step * (c - state) * z * (1 - z)
                d_rs = d_c @ new.T
                d_r = d_rs * state * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], 1)
                g[f"gates_{way}"] += state.T @ d_zr
                g[f"new_{way}"] += (r * state).T @ d_c
                d_x = np.concatenate([d_zr, d_c], 1)
                np.add.at(d_table, local[:, t], d_x)
                d_state = d_state - d_step * z + d_rs * r + d_zr @ gates.T
            g[f"in_bias_{way}"] = d_table.sum(0)
            g[f"in_{way}"] = vectors.T @ d_table[:-1]
            d_vectors += d_table[:-1] @ p[f"in_{way}"].T
        np.add.at(g["word"], words.bucket[which], d_vectors[:, :WORD_WIDTH] * known)
        spread = np.repeat(d_vectors[:, WORD_WIDTH:] / lengths[:, None], lengths, axis=0)
        np.add.at(g["char"], trigram, spread.astype(np.float32))
        self._adam(g, rate)

    def _adam(self, g: dict, rate: float) -> None:
        if self.moments is None:
            self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps += 1
        for k, (m, v) in self.moments.items():
            m += 0.1 * (g[k] - m)
            v += 0.01 * (g[k] ** 2 - v)
            scale = rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
            self.p[k] -= (scale * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def windows(self, words: Words, rows: np.ndarray, batch: int = 2048) -> np.ndarray:
        vectors = self.inputs(words)[0]
        return np.concatenate([self.run(vectors, rows[i : i + batch]) for i in range(0, len(rows), batch)] or [np.zeros(0)])


def highest(values: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest value of each text, and its window. Windows of a text lie together; each has one at least."""
    first = np.searchsorted(text, np.arange(n))
    best = np.maximum.reduceat(values, first) if n else np.zeros(0)
    order = np.lexsort((-values, text))
    return best, order[first] if n else np.zeros(0, np.int64)


def train(texts: list[str], labels: np.ndarray, seed: int = SEED, epochs: int | None = None) -> Network:
    rng = np.random.default_rng(seed)
    words, network, n = Words(pa.array(texts, pa.large_string())), Network(seed), len(texts)
    rows, text = words.windows()
    doc = np.repeat(np.arange(n), np.diff(words.starts))
    seen = np.unique(doc.astype(np.int64) * len(words.bucket) + words.number)
    with_word = [
        np.bincount(seen[labels[seen // len(words.bucket)] == y] % len(words.bucket), minlength=len(words.bucket))
        for y in (0, 1)
    ]
    odds = np.log((with_word[1] + 0.5) / (sum(labels == 1) + 1)) - np.log((with_word[0] + 0.5) / (sum(labels == 0) + 1))
    odds = np.append(np.maximum(odds, 0), 0)
    values = odds[rows].max(1) + 0.01 * odds[rows].sum(1)
    first = np.searchsorted(text, np.arange(n))
    count = np.diff(np.append(first, len(text)))
    if epochs is None:
        epochs = max(EPOCHS, -(-STEPS // -(-(n + int((labels == 0).sum())) // 64)))
    for epoch in range(epochs):
        _, best = highest(values, text, n)
        other = first + (rng.random(n) * count).astype(np.int64)
        chosen = np.concatenate([best, other[labels == 0]])
        y = labels[text[chosen]].astype(np.float32)
        order = rng.permutation(len(chosen))
        for i in range(0, len(order), 64):
            at = order[i : i + 64]
            network.learn(words, rows[chosen[at]], y[at], 0.01 * (1 - 0.8 * epoch / epochs))
        if epoch >= 2:
            values = network.windows(words, rows)
    network.moments = None
    return network


def fit(docs: DataFrame, labels: DataFrame, parts: int = 3, rest: int = 1, per_label: int = PER_LABEL) -> Network | None:
    """Learns from labelled rows outside the fold; None without both labels."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id"), parts, rest))
    # An id with contradictory labels teaches nothing.
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    known = known.filter("label = other").drop("other")
    rows = labelled_sample(docs.select("doc_id", "text"), MAX_CHARS, lambda _: per_label, SEED, labels=known)
    sample = rows.toArrow().to_pandas().sort_values(["doc_id", "text"])
    y = sample["label"].to_numpy(np.int64)
    return train(sample["text"].tolist(), y) if len(set(y)) == 2 else None


def score(docs: DataFrame, network: Network | None, parts: int = 3, rest: int = 1, threshold: float = 0.7) -> DataFrame:
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in pieces(batches, most=1_500_000):
            if own is None:
                p = np.zeros(batch.num_rows)
                count = np.zeros(batch.num_rows, np.int64)
            else:
                words = Words(batch.column("text"))
                rows, text = words.windows()
                p = sigmoid(highest(own.windows(words, rows), text, batch.num_rows)[0].astype(np.float64))
                count = np.bincount(text, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                    pa.array((p >= threshold).astype(np.int32)), pa.array(count),
                ],
                names=["doc_id", "held_out", "score", "predicted", "windows"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), parts, rest).alias("held_out"), "text"
    )
    return rows.mapInArrow(scored, "doc_id bigint, held_out boolean, score double, predicted int, windows bigint")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
