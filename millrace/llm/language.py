"""Language identification by hierarchical discrimination.

The language family is predicted first, by one linear machine per family; then
one-versus-one linear support vector machines vote among the languages of that
family. All machines share one hashed vector of character n-grams of the letters
in the text, lower-cased, whose length is 1, and are trained by averaged
stochastic gradient steps on the hinge loss in numpy, on a bounded sample of every language
that occurs: at most ``PER_LANGUAGE`` rows of each, of at most ``MAX_CHARS``
characters (windows of longer texts where a language has no others). Beyond
``LANGUAGES`` languages, they share ``LANGUAGES * PER_LANGUAGE`` rows evenly, with
``LEAST_ROWS`` for each at least. The model grows with the number of languages.

Every whole text is read. Defined results: a NULL text or one without a letter is
``und`` with score 0. A single learned language is always predicted; without any,
everything is ``und``. A language of unlisted family is a family of its own.
Repeated rows get the same answer. An empty table gives an empty result. Extra
columns are ignored by ``predict`` and kept by ``accepted``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, pieces, prepare, segment_sums
from .features import LETTERS, framed, grams

BITS = 16
SIZES = (2, 3, 4)
PER_LANGUAGE = 1500
LANGUAGES = 64  # with more of them, each has fewer rows
LEAST_ROWS = 20
MAX_CHARS = 6_000
EPOCHS = 6
SEED = 13
REJECT = 0.5
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fo", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne"),
    "semitic": ("ar", "he", "mt", "am"),
}
_letter = re.compile(r"[^\W\d_]").search


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


def buckets(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size the buckets (sizes lie behind one another) and where each text's begin."""
    data, starts = framed(texts, lower=True)
    if not len(data):
        return []
    letter = LETTERS[data]
    data = np.where(letter, data, np.uint8(32))
    kinds = []
    for i, n in enumerate(SIZES):
        rows = grams(data, n, BITS)
        inner = letter[: len(rows)] | letter[1 : len(rows) + 1] if n == 2 else letter[1 : len(rows) + 1]
        for j in range(2, n - 1):
            inner = inner & letter[j : len(rows) + j]
        at = np.flatnonzero(inner)
        kinds.append((rows[at] + np.uint32(i << BITS), np.searchsorted(at, starts)))
    return kinds


def vectors(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse vectors of length 1."""
    out = []
    for start in range(0, len(texts), 256):
        part = texts[start : start + 256]
        kinds = buckets(pa.array(part, pa.large_string()))
        for i in range(len(part)):
            rows = np.concatenate([r[s[i] : s[i + 1]] for r, s in kinds])
            unique, counts = np.unique(rows, return_counts=True)
            value = np.sqrt(counts).astype(np.float32)
            out.append((unique, value / max(float(np.sqrt((value**2).sum())), 1e-9)))
    return out


def machine(docs: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, seed: int) -> np.ndarray:
    """A linear support vector machine: hinge loss, decaying steps, the mean of the weights of all steps."""
    rng = np.random.default_rng(seed)
    size = len(SIZES) << BITS
    weights, lagged, step = np.zeros(size + 1), np.zeros(size + 1), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rows, values = docs[i]
            step += 1
            if signs[i] * (values @ weights[rows] + weights[-1]) < 1:
                rate = signs[i] * 2.0 / np.sqrt(1 + step / 100)
                weights[rows] += rate * values
                weights[-1] += rate * 0.1
                lagged[rows] += step * rate * values
                lagged[-1] += step * rate * 0.1
    return (weights - lagged / max(step, 1)).astype(np.float32)


class Model:
    """``families``: each one's languages; one column of ``weights`` for each machine."""

    def __init__(self, texts: list[str], languages: list[str], seed: int = SEED) -> None:
        self.families: dict[str, list[str]] = {}
        for language in sorted(set(languages)):
            self.families.setdefault(family_of(language), []).append(language)
        self.machines: list[tuple] = []
        docs, columns, known = vectors(texts), [], np.array(languages, object)
        if len(self.families) > 1:
            for f, members in self.families.items():
                self.machines.append(("family", f))
                columns.append(machine(docs, np.where(np.isin(known, members), 1, -1), seed))
        for members in self.families.values():
            for one, two in combinations(members, 2):
                at = np.flatnonzero((known == one) | (known == two))
                self.machines.append((one, two))
                columns.append(machine([docs[i] for i in at], np.where(known[at] == one, 1, -1), seed))
        size = (len(SIZES) << BITS) + 1
        self.weights = np.stack(columns, 1) if columns else np.zeros((size, 0), np.float32)

    def counted(self, texts: pa.Array) -> tuple[list[tuple], np.ndarray]:
        """For each n-gram size the distinct buckets, their values and where each text's begin; the vectors' lengths."""
        kinds, length = [], np.zeros(len(texts))
        text_of = np.arange(len(texts), dtype=np.uint64)
        for rows, starts in buckets(texts):
            keys = (np.repeat(text_of, np.diff(starts)) << np.uint64(20)) | rows.astype(np.uint64)
            keys.sort()
            new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            counts = np.diff(np.append(new, len(keys)))
            unique = keys[new]
            row = (unique & np.uint64((1 << 20) - 1)).astype(np.int32)
            begin = np.searchsorted(unique >> np.uint64(20), np.arange(len(texts) + 1, dtype=np.uint64))
            kinds.append((row, np.sqrt(counts), begin))
            length += segment_sums(counts.astype(np.float64), begin)
        return kinds, np.maximum(np.sqrt(length), 1e-9)

    def margins(self, kinds: list[tuple], length: np.ndarray, rows: np.ndarray, machines: list[int]) -> np.ndarray:
        """The margins of these machines for these rows. Scoring takes counts as they are, divided by their length."""
        total = np.zeros((len(rows), len(machines)))
        for row, value, begin in kinds:
            if len(rows) < len(length):
                n = begin[rows + 1] - begin[rows]
                ahead = np.concatenate([[0], np.cumsum(n)])
                at = np.repeat(begin[rows] - ahead[:-1], n) + np.arange(ahead[-1])
                row, value, begin = row[at], value[at], ahead
            for j, machine in enumerate(machines):
                total[:, j] += segment_sums(self.weights[row, machine] * value, begin)
        return total / length[rows, None] + self.weights[-1, machines]

    def answers(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The family by its machines for all texts, then the machines of each family for its own texts only."""
        (kinds, length), at = self.counted(texts), {m: i for i, m in enumerate(self.machines)}
        n, names = len(texts), list(self.families)
        answer, sure = np.full(n, "und", object), np.zeros(n)
        if not names:
            return list(answer), sure
        if len(names) > 1:
            margins = self.margins(kinds, length, np.arange(n), [at["family", f] for f in names])
            family, sure_family = np.argmax(margins, 1), _share(margins)
        else:
            family, sure_family = np.zeros(n, np.int64), np.ones(n)
        for k, f in enumerate(names):
            rows, members = np.flatnonzero(family == k), self.families[f]
            votes = np.zeros((len(rows), len(members)))
            pairs = list(combinations(range(len(members)), 2))
            margins = self.margins(kinds, length, rows, [at[members[i], members[j]] for i, j in pairs])
            for (i, j), margin in zip(pairs, margins.T, strict=True):
                p = 1 / (1 + np.exp(-np.clip(4 * margin, -50, 50)))
                # A vote counts whole; how sure it was decides among equal votes.
                votes[:, i] += (margin >= 0) + p
                votes[:, j] += (margin < 0) + 1 - p
            best = np.argmax(votes, 1) if len(members) > 1 else np.zeros(len(rows), np.int64)
            for r, b, v in zip(rows, best, votes, strict=True):
                answer[r] = members[b]
                sure[r] = sure_family[r] * (v[b] / (2 * (len(members) - 1)) if len(members) > 1 else 1.0)
        return list(answer), np.clip(sure, 0, 1)


def _share(margins: np.ndarray) -> np.ndarray:
    e = np.exp(4 * (margins - margins.max(1, keepdims=True)))
    return e.max(1) / e.sum(1)


def fit(docs: DataFrame, parts: int = 4, rest: int = 2, per_language: int = PER_LANGUAGE) -> Model:
    known = docs.select("doc_id", "text", F.col("lang").alias("label"))
    known = known.filter(~held_out(F.col("doc_id"), parts, rest))
    total = LANGUAGES * per_language

    def share(languages: int) -> int:
        return max(LEAST_ROWS, min(per_language, total // languages))

    rows = labelled_sample(known, MAX_CHARS, share, SEED, F.col("text").rlike(r"\p{L}"))
    sample = rows.withColumnRenamed("label", "lang").toArrow().to_pandas().sort_values(["doc_id", "lang", "text"])
    has_letter = sample["text"].map(lambda t: bool(_letter(t))).astype(bool)
    sample = sample[has_letter]
    return Model(sample["text"].tolist(), sample["lang"].tolist())


def _answered(model, columns: list[str], schema: str):
    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in pieces(batches, most=500_000):
            texts = batch.column("text")
            said, score = own.answers(texts)
            silent = [not (t and _letter(t)) for t in texts.to_pylist()]
            said = ["und" if s else x for s, x in zip(silent, said, strict=True)]
            score = np.where(silent, 0.0, score)
            extra = [pa.array(said, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *extra], names=[*columns, *schema.split()])

    return answered


def predict(docs: DataFrame, model: Model, parts: int = 4, rest: int = 2) -> DataFrame:
    """``lang_pred`` and how sure it is, for each row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), parts, rest).alias("held_out"), "text"
    )
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double"
    run = _answered(shared, ["doc_id", "held_out"], "lang_pred score")
    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def accepted(docs: DataFrame, least: float = REJECT) -> DataFrame:
    """The documents whose language is known well enough; all their columns, nothing added."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    kept = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)], F.col("text").alias("text"))
    names = [f"__c{i}" for i in range(len(docs.columns))]
    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType([*kept.schema.fields[:-1]]).add("__lang", StringType()).add("__sure", DoubleType())
    found = kept.mapInArrow(_answered(shared, names, "__lang __sure"), schema)
    found = found.filter((F.col("__lang") != "und") & (F.col("__sure") >= least))
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
