"""N-gram Jaccard join with vertical partitioning, and the groups that its links make.

A document's set is its distinct word shingles. One order of all shingles is fixed
for everybody: by their hash, but those found frequent come last, the most
frequent at the very end. Two sets that are alike enough share ``SHARED`` shingles
among the first few of each in that order, whatever the order is, so these are the
keys under which pairs are sought; frequent passages don't become keys unless a
document is little else. Which shingles count as frequent therefore decides
about the work only, never about the links.

Pairs are verified exactly: the order of hashes is cut into ``FRAGMENTS`` ranges,
sets are stored by fragment, the overlap of a pair is counted in each fragment
by itself, and the partial counts are summed per pair.

Equal sets are one class from the start. Under a key with many classes not all
pairs are made: in each of ``ROUNDS`` rounds a pivot is compared with the rest, and
classes that have come to one component need no comparing among themselves. Pairs
from different components that are still open are all compared in the end, so
no link that joins components is lost.

Words are lower-cased in A-Z only. Defined results: a NULL or empty text, or one of
white space, has an empty set and is linked with nothing. A text of fewer words
than a shingle has one shingle, all of it. Rows without an id get their set's size
but no component and link nothing. Rows that share an id are linked by their own sets. An
empty table gives an empty result. Extra columns are ignored by ``groups`` and kept
by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import fixed, joined_bytes, mix64, pieces, prepare
from .components import components
from .features import SPACE, word_hashes

FRAGMENTS = 8
FILTER_BITS = 1 << 25  # 4 MB, whatever the input
FREQUENT = 1_000_000  # how many of the most frequent shingles are put last
LOCALLY = 2  # in so many sets of one run of rows, 2 at least, a shingle is worth counting
RUN = 3_000_000  # shingles of a run
ROUNDS = 2
SHARED = 3  # keys that a pair must have in common, or all its overlap if that is less
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Sets:
    """The shingle sets of some texts: hashes in order, text by text, and where each set begins."""

    def __init__(self, texts: pa.Array, words: int) -> None:
        data, starts = joined_bytes(texts)
        data = LOWER[data]
        begins, _, hashes = word_hashes(data, ~SPACE[data])
        first = np.searchsorted(begins, starts)
        n = np.diff(first)
        factors = mix64(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
        rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
        for i, f in enumerate(factors):
            rolled += hashes[i : i + len(rolled)] * f
        rolled = mix64(rolled)
        count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
        self.starts = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(first[:-1] - self.starts[:-1], count) + np.arange(self.starts[-1])
        short = np.flatnonzero((n > 0) & (n < words))
        values = rolled[np.minimum(at, max(len(rolled) - 1, 0))] if len(rolled) else np.zeros(len(at), np.uint64)
        for i in short:  # all words as one, told apart from longer ones by how many they are
            own = hashes[first[i] : first[i + 1]]
            values[self.starts[i]] = mix64((own * factors[: len(own)]).sum(keepdims=True) + np.uint64(len(own)))[0]
        for a, b in zip(self.starts[:-1], self.starts[1:], strict=True):
            values[a:b].sort()
        doc = np.repeat(np.arange(len(n)), count)
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
        self.values, self.doc = values[new], doc[new]
        self.starts = np.searchsorted(self.doc, np.arange(len(n) + 1))
        self.n = np.diff(self.starts)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two numbers that stand for each whole set."""
        out = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(self.values ^ np.uint64(salt)), dtype=np.uint64)])
            total = sums[self.starts[1:]] - sums[self.starts[:-1]]
            out.append(mix64(total + self.n.astype(np.uint64)).view(np.int64))
        return out[0], out[1]


def _described(words: int):
    """Size and digests of every set, and the shingles that many sets of a run share (NULL id and size)."""

    def told(rows: tuple, shingle: bool) -> pa.RecordBatch:
        names = ["doc_id", "n", "node", "check", "shingle"]
        return pa.RecordBatch.from_arrays([*rows, pa.array(np.full(len(rows[0]), shingle))], names=names)

    def frequent(waiting: list[np.ndarray]) -> pa.RecordBatch:
        shingle = np.concatenate([*waiting, np.zeros(0, np.uint64)])
        waiting.clear()
        shingle.sort()
        again = np.zeros(len(shingle) + 1, bool)  # like the one before
        again[1:-1] = shingle[1:] == shingle[:-1]
        first = np.flatnonzero(~again[:-1] & again[1:])
        times = np.flatnonzero(again[:-1] & ~again[1:]) - first + 1
        common = times >= LOCALLY
        none = pa.nulls(int(common.sum()), pa.int64())
        return told((none, none, pa.array(shingle[first[common]].view(np.int64)), pa.array(times[common])), True)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, seen = [], 0, set()
        for batch in pieces(batches):
            sets = Sets(batch.column("text"), words)
            node, check = sets.digests()
            fresh = np.zeros(len(node), bool)
            for i, x in enumerate(node.tolist()):
                fresh[i] = x not in seen
                seen.add(x)
            waiting.append(sets.values[fresh[sets.doc]])
            size += len(waiting[-1])
            if size > RUN:
                yield frequent(waiting)
                waiting, size, seen = [], 0, set()
            doc_id = batch.column("doc_id").cast(pa.int64())
            yield told((doc_id, pa.array(sets.n.astype(np.int64)), pa.array(node, mask=sets.n == 0), pa.array(check)), False)
        yield frequent(waiting)

    return described


def _keys(words: int, percent: int, shared):
    """The first shingles of every set in the common order, as many as a partner must share one of."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = shared.value
        seen: set[int] = set()
        for batch in pieces(batches):
            sets = Sets(batch.column("text"), words)
            node, _ = sets.digests()
            fresh = np.zeros(len(node), bool)
            for i, x in enumerate(node.tolist()):
                if sets.n[i] and x not in seen:
                    fresh[i] = True
                    seen.add(x)
            if len(seen) > 500_000:
                seen.clear()
            n = sets.n.astype(np.int64)
            needed = n - -(-n * percent // 100) + SHARED
            at = np.searchsorted(frequent, sets.values)
            at[at == len(frequent)] = 0
            late = frequent[at] == sets.values if len(frequent) else np.zeros(len(at), bool)
            early = np.cumsum(~late)
            base = np.concatenate([[0], early])[sets.starts]
            nth = early - 1 - base[:-1][sets.doc]
            which = np.flatnonzero(late)
            if len(which):
                order = which[np.lexsort((rank[at[which]], sets.doc[which]))]
                doc = sets.doc[order]
                nth[order] = np.diff(base)[doc] + np.arange(len(order)) - np.searchsorted(doc, doc)
            chosen = (nth < needed[sets.doc]) & fresh[sets.doc]
            doc = sets.doc[chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets.values[chosen].view(np.int64)), pa.array(node[doc]), pa.array(n[doc].astype(np.int32)),
                 pa.array(nth[chosen].astype(np.int32))],
                names=["key", "node", "n", "place"],
            )

    return keys


def _bits(ids: np.ndarray) -> list[np.ndarray]:
    """The places of ids in the filter."""
    mixed = mix64(ids.astype(np.int64).view(np.uint64))
    return [(mixed >> np.uint64(shift)) % np.uint64(FILTER_BITS) for shift in (0, 32)]


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = np.unique(np.concatenate(_bits(batch.column("doc_id").to_numpy())))
        bit = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bit)], names=["at", "bit"])


def id_filter(ids: DataFrame) -> np.ndarray:
    """A filter of fixed size for any number of ids: it lets all of them pass, and the fewer they are the fewer others."""
    marks = ids.mapInArrow(_marks, "at bigint, bit bigint").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    words[marks.column("at").to_numpy()] = marks.column("bit").to_numpy().view(np.uint64)
    return words


def perhaps(ids: DataFrame):
    """Whether an id may be one of ``ids`` (``doc_id``), as a function of a column: always true for these, false for NULL."""
    shared = ids.sparkSession.sparkContext.broadcast(id_filter(ids))

    @F.arrow_udf("boolean")
    def among(column: pa.Array) -> pa.Array:
        passed = column.is_valid().to_numpy(zero_copy_only=False)
        for at in _bits(column.fill_null(0).to_numpy(zero_copy_only=False)):
            passed = passed & ((shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0)
        return pa.array(passed)

    return among


def _fragments(words: int, shared):
    """The sets of the documents that the filter lets pass, by fragment."""

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([min((i << 64) // FRAGMENTS, 2**64 - 1) for i in range(FRAGMENTS + 1)], np.uint64)
        for batch in batches:
            passed = np.ones(batch.num_rows, bool)
            for at in _bits(batch.column("doc_id").to_numpy()):
                passed &= (shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
            for part in pieces([batch.filter(pa.array(passed))]):
                sets = Sets(part.column("text"), words)
                node, _ = sets.digests()
                out: list[list] = [[], [], []]
                for i in np.flatnonzero(sets.n > 0):
                    own = sets.values[sets.starts[i] : sets.starts[i + 1]]
                    cut = np.searchsorted(own, edges)
                    cut[-1] = len(own)
                    for f in range(FRAGMENTS):
                        if cut[f] < cut[f + 1]:
                            for column, value in zip(out, (node[i], f, own[cut[f] : cut[f + 1]].tobytes()), strict=True):
                                column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["node", "fragment", "shingles"]
                )

    return fragments


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = []
        for one, two in zip(batch.column("shingles").to_pylist(), batch.column("others").to_pylist(), strict=True):
            both = np.concatenate([np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)])
            both.sort()
            counts.append(np.count_nonzero(both[1:] == both[:-1]))
        names = ["a", "b", "na", "nb", "fragment"]
        rest = [batch.column(c) for c in names]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(counts, pa.int64())], names=[*names, "part"])


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``overlap`` of each pair: counted in every fragment by itself, then summed."""
    one = sets.withColumnsRenamed({"node": "a"})
    two = sets.withColumnsRenamed({"node": "b", "shingles": "others"})
    placed = pairs.join(one, "a").join(two, ["b", "fragment"]).select("a", "b", "na", "nb", "fragment", "shingles", "others")
    parts = placed.mapInArrow(_overlaps, "a bigint, b bigint, na int, nb int, fragment int, part bigint")
    # Rows that repeat an id bring a fragment twice, with the same count.
    parts = parts.groupBy("a", "b", "na", "nb", "fragment").agg(F.max("part").alias("part"))
    return parts.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("overlap"))


def _within_reach(percent: int):
    """Whether a pair can be linked if this is one of its first ``SHARED`` common keys: of what comes before
    the key in either set, no more than the earlier keys are in the other, so the overlap is at most these
    and what is left of the shorter rest."""
    left = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("there")) + SHARED - 1
    return left * (100 + percent) >= (F.col("n") + F.col("m")) * percent


class Join:
    """Everything one join needs, from the documents to the components of their classes."""

    def __init__(self, docs: DataFrame, words: int, percent: int) -> None:
        prepare(docs.sparkSession)
        self.words, self.percent, spark = words, percent, docs.sparkSession
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        schema = "doc_id bigint, n bigint, node bigint, check bigint, shingle boolean"
        told = fixed(rows.mapInArrow(_described(words), schema), "ngram-sets")
        self.sizes = told.filter("not shingle").drop("shingle")
        counted = told.filter("shingle").groupBy("node").agg(F.sum("check").alias("times"))
        top = counted.orderBy(F.desc("times"), "node").limit(FREQUENT).toArrow()  # bounded by FREQUENT
        frequent = top.column("node").to_numpy().view(np.uint64)
        order = np.argsort(frequent)
        rank = np.arange(len(order), dtype=np.int32)[::-1][order]  # the most frequent comes last
        shared = spark.sparkContext.broadcast((frequent[order], rank))
        keyed = rows.filter("doc_id is not null").mapInArrow(
            _keys(words, percent, shared), "key bigint, node bigint, n int, place int"
        )
        same = Window.partitionBy("key")
        ends = keyed.withColumns({"low": F.min("node").over(same), "high": F.max("node").over(same)})
        self.open = fixed(ends.filter("low <> high").select("key", "node", "n", "place").distinct(), "ngram-keys")
        self.rows = rows.filter("doc_id is not null")
        self.first = fixed(
            self.sizes.filter("doc_id is not null and n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "ngram-first"
        )

    def sets(self, pairs: DataFrame) -> DataFrame:
        """The sets of the classes in ``pairs``, read from one document of each; others may be among them."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        shared = pairs.sparkSession.sparkContext.broadcast(id_filter(self.first.join(nodes, "node").select("doc_id")))
        found = self.rows.mapInArrow(_fragments(self.words, shared), "node bigint, fragment int, shingles binary")
        return fixed(found, "ngram-fragments")

    def labels(self) -> DataFrame:
        """The component of every class that has a link, by verified links."""
        links = verified = None
        labels = None
        for turn in range(ROUNDS + 1):
            labelled = self.open
            if labels is None:
                labelled = labelled.withColumn("label", F.col("node"))
            else:
                labelled = labelled.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            same = Window.partitionBy("key")
            labelled = labelled.withColumns({"low": F.min("label").over(same), "high": F.max("label").over(same)})
            labelled = labelled.filter("low <> high").drop("low", "high")
            pairs = self._star(labelled, turn) if turn < ROUNDS else self._all(labelled)
            least = F.ceil((F.col("na") + F.col("nb")) * self.percent / (100 + self.percent))
            pairs = pairs.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("keys"))
            pairs = pairs.filter(F.col("keys") >= F.least(F.lit(SHARED), least)).drop("keys")
            if verified is not None:
                pairs = pairs.join(verified.select("a", "b"), ["a", "b"], "left_anti")
            pairs = fixed(pairs, "ngram-pairs")
            if pairs.isEmpty() and labels is not None:
                continue
            counted = fixed(overlaps(pairs, self.sets(pairs)), "ngram-overlaps")
            held = F.col("overlap") * 100 >= (F.col("na") + F.col("nb") - F.col("overlap")) * self.percent
            found = counted.filter(held).select("a", "b")
            verified = counted if verified is None else verified.union(counted)
            links = found if links is None else links.union(found)
            labels = components(links, "ngram-components")
            if turn < ROUNDS:  # keys all of whose classes had come together before are closed
                self.open = fixed(labelled.select("key", "node", "n", "place"), "ngram-open")
                if self.open.isEmpty():
                    break
        return labels

    def _pair(self, df: DataFrame) -> DataFrame:
        """The pairs within reach, the smaller node first."""
        swap = F.col("node") < F.col("other")
        return df.filter(_within_reach(self.percent)).select(
            F.when(swap, F.col("node")).otherwise(F.col("other")).alias("a"),
            F.when(swap, F.col("other")).otherwise(F.col("node")).alias("b"),
            F.when(swap, F.col("n")).otherwise(F.col("m")).alias("na"),
            F.when(swap, F.col("m")).otherwise(F.col("n")).alias("nb"),
        )

    def _star(self, labelled: DataFrame, turn: int) -> DataFrame:
        """Every class under a key with the key's pivot: first the one with the fewest shingles before the
        key, as what is alike to many has few of its own; then any."""
        first = F.col("place") if turn % 2 == 0 else F.lit(0)
        order = F.struct(first.alias("first"), F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "n", "place", "label")
        placed = labelled.withColumn("pivot", F.min(order).over(Window.partitionBy("key"))).filter("label <> pivot.label")
        pivot = [F.col(f"pivot.{own}").alias(name) for own, name in (("node", "other"), ("n", "m"), ("place", "there"))]
        return self._pair(placed.select("node", "n", "place", *pivot))

    def _all(self, labelled: DataFrame) -> DataFrame:
        """All pairs under a key that lie in different components."""
        names = {"node": "other", "n": "m", "place": "there", "label": "side"}
        met = labelled.join(labelled.withColumnsRenamed(names), "key").filter("label <> side and node < other")
        return self._pair(met.filter(_within_reach(self.percent)))


def _placed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, n, node, label, component`` of every row: its set's size, class, the component of that and
    the smallest id in it. A class without links is its own component; an empty set has neither."""
    join = Join(docs, words, percent)
    labels = join.labels()
    named = labels.join(join.first, "node")
    least = named.groupBy("label").agg(F.min("doc_id").alias("least"))
    of_node = join.first.withColumnRenamed("doc_id", "own").join(labels.join(least, "label"), "node", "left")
    of_node = of_node.select("node", F.coalesce("label", "node").alias("label"), F.coalesce("least", "own").alias("component"))
    return join.sizes.join(of_node, "node", "left").select("doc_id", "n", "node", "label", "component")


def groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the smallest id reachable by links of
    ``percent`` or more per cent Jaccard similarity."""
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return _placed(docs, words, percent).select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _nodes(words: int, names: list[str]):
    """Rows as they are, with the class of their set; NULL for an empty one."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "__text"):
            sets = Sets(batch.column("__text"), words)
            node = pa.array(sets.digests()[0], mask=sets.n == 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, node], names=[*names, "__node"])

    return nodes


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Of each group one row, with all its columns: the one with the smallest id, then the smallest class.

    Rows without an id stay. Rows that share an id are told apart by their sets: those with the same set, or
    without words and with the same text, are one; the others are documents of their own.
    """
    placed = fixed(_placed(docs, words, percent), "ngram-groups").filter("doc_id is not null")
    per_id = placed.groupBy("doc_id").agg(F.min("component").alias("component"), F.count("*").alias("rows"))
    marked = fixed(per_id.filter("rows > 1 or component <> doc_id").select("doc_id", (F.col("rows") > 1).alias("again")), "ngram-marked")
    names = ["__text" if c == "text" else f"__c{i}" for i, c in enumerate(docs.columns)]
    own = [F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)]
    # Only rows that may go or that share an id meet their mark in a shuffle; a filter of fixed size lets the others pass by.
    known = perhaps(marked.select("doc_id"))
    every = docs.select(*own, F.col("doc_id").cast("long").alias("__doc"))
    passing = every.filter(~F.coalesce(known("__doc"), F.lit(False))).select(*names)
    marks = marked.select(F.col("doc_id").alias("__id"), F.col("again").alias("__again"))
    met = every.filter(known("__doc")).join(marks, F.col("__doc") == F.col("__id"), "left")
    single = passing.unionByName(met.filter("__id is null").select(*names))
    if marked.filter("again").isEmpty():
        return single.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
    rows = met.filter("__again").select(*names)
    rows = rows.mapInArrow(_nodes(words, names), StructType(list(rows.schema.fields)).add("__node", LongType()))
    doc = f"__c{docs.columns.index('doc_id')}"
    # The first row of each component, by id and class; counted up before it is shuffled.
    keepers = placed.filter("node is not null").groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("k")).select("k.*")
    staying = rows.join(keepers.withColumnsRenamed({"doc_id": doc, "node": "__node"}), [doc, "__node"], "left_semi")
    staying = staying.select(*names, "__node").unionByName(rows.filter("__node is null").select(*names, "__node"))
    # Of rows alike one, whichever of them has the smallest text, then the smallest hash of all columns.
    alike = F.when(F.col("__node").isNull(), F.coalesce("__text", F.lit("")))
    order = F.struct("__text", F.xxhash64(*names))
    chosen = staying.groupBy(doc, "__node", alike.alias("__alike")).agg(F.min_by(F.struct(*[F.col(n).alias(f"r{i}") for i, n in enumerate(names)]), order).alias("row"))
    back = [F.col(f"row.r{i}").alias(n) for i, n in enumerate(names)]
    left = single.unionByName(chosen.select(*back))
    return left.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
