"""Approximate nearest neighbours by adaptive dimension scan.

Vectors get one more component, so that the largest inner product is the smallest
distance, and a random rotation, so that any few components stand for all. They
are kept in lists around centres, and a query scans the lists nearest to it. Within
a list the components are read in blocks of columns: after each, the distance so
far, scaled up, is held against the best found by a test whose error shrinks with
the number of components read, and candidates that fail are abandoned. What is
left is scored exactly on the original vectors.

A query first scans the share ``NEAR`` of lists nearest to it; the k-th best score
found there is its limit in all others, so that most of their candidates go after
one block of columns, and about as many stay for a query whatever the table's size.

The centres are fitted on at most about ``SAMPLE`` vectors; every vector is
indexed. Lists and their queries are cut into blocks by size, so a large list is
many tasks. A query goes on to further lists until these hold ten times the
wanted number.

Defined results: vectors that are NULL, empty, all zero, of another length than
most, or hold NULL or non-finite components take no part, nor do rows without an
id. Ties go to the smaller id. An empty table gives an empty result. Extra columns
are ignored. A repeated id is a candidate each time, but never for itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chance, fixed, prepare

SAMPLE = 16_000
LISTS = 1024
PROBE = 0.6  # share of the lists that a query scans
NEAR = 0.05  # share of the lists scanned first
ERROR = 2.1  # how many standard errors a candidate may lie behind
COLUMNS = 16
BLOCK = 4096
SEED = 23
EVERY = 20
K = 20


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the vectors that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    v = v.filter(finite & F.exists("embedding", lambda x: x != 0))
    size = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.filter(F.size("embedding") == (size["n"] if size else -1))


class Index:
    def __init__(self, sample: np.ndarray, n: int, radius: float, seed: int = SEED, scale: float = 1.0) -> None:
        """``scale`` is a power of two that vectors are multiplied with; ``radius`` is that of the scaled ones."""
        rng = np.random.default_rng(seed)
        self.radius, self.scale, d = radius, scale, sample.shape[1] + 1
        self.rotation = np.linalg.qr(rng.normal(size=(d, d)))[0]
        points = self.rotated(sample)
        lists = max(1, min(LISTS, round(n**0.5), len(points)))
        self.centres = points[rng.choice(len(points), lists, replace=False)]
        for _ in range(8):
            at = self.nearest(points, 1)[:, 0]
            sums, count = np.zeros_like(self.centres), np.bincount(at, minlength=lists)
            np.add.at(sums, at, points)
            self.centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], self.centres)

    def rotated(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        vectors = vectors * self.scale
        rest = np.maximum(self.radius**2 - (vectors**2).sum(1), 0) ** 0.5
        return np.concatenate([vectors, (np.zeros_like(rest) if query else rest)[:, None]], 1) @ self.rotation

    def nearest(self, points: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros((len(points), k), np.int64)
        for i in range(0, len(points), 2048):
            part = points[i : i + 2048]
            distance = (self.centres**2).sum(1) - 2 * part @ self.centres.T
            out[i : i + 2048] = np.argsort(distance, 1, kind="stable")[:, :k]
        return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def slack(seen: int, of: int) -> float:
    """How far a scaled-up partial distance may exceed the limit; drawn without putting back, so 1 at the end."""
    return (1 + ERROR * ((1 - seen / of) / seen) ** 0.5) ** 2 * (1 + 1e-9)


def scan(
    index: Index, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, worst: np.ndarray, k: int
):
    """The best candidates of one block of a list for some queries: query, id, score.

    ``worst`` is the score that each query's candidates must reach, minus infinity where none is known.
    """
    x, q = index.rotated(vectors), index.rotated(queries, query=True)
    d = x.shape[1]
    whole = index.radius**2 + ((queries * index.scale) ** 2).sum(1)
    # A limit that is not a number says nothing, nor does one of products that may have become zero.
    told = np.isfinite(worst) & (index.scale <= 1)
    known = np.where(told, whole - 2 * (np.where(told, worst, 0) * index.scale * index.scale) + 1e-12 * whole, np.inf)
    found: list[tuple] = []
    for start in range(0, len(q), 128):
        part, own = q[start : start + 128], query_ids[start : start + 128]
        seen = min(COLUMNS, d)
        a, b = part[:, :seen], x[:, :seen]
        so_far = (a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * a @ b.T
        so_far[own[:, None] == ids] = np.inf
        limit = known[start : start + 128]
        few = min(k, len(ids))
        if few == k and np.isinf(limit).any():
            # The worst of k full distances bounds the k-th best; with fewer candidates there is no bound.
            first = np.argpartition(so_far, few - 1, 1)[:, :few]
            exact = ((part[:, None, :] - x[first]) ** 2).sum(2)
            exact[np.isinf(np.take_along_axis(so_far, first, 1))] = np.inf
            limit = np.minimum(limit, exact.max(1))
        limit = limit * (1 + 1e-9) + 1e-9
        row, col = np.nonzero(so_far * (d / seen) <= (limit * slack(seen, d))[:, None])
        ahead = so_far[row, col]
        row, col, ahead = row[np.isfinite(ahead)], col[np.isfinite(ahead)], ahead[np.isfinite(ahead)]
        while seen < d:
            more = min(seen + COLUMNS, d)
            ahead = ahead + ((part[row, seen:more] - x[col, seen:more]) ** 2).sum(1)
            seen = more
            stay = ahead * (d / seen) <= limit[row] * slack(seen, d) + 1e-9
            row, col, ahead = row[stay], col[stay], ahead[stay]
        with np.errstate(over="ignore", invalid="ignore"):
            score = (queries[start + row] * vectors[col]).sum(1)
        order = np.lexsort((ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        keep = nth < k
        found.append((own[row[keep]], ids[col[keep]], score[keep]))
    return [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]


def search(vectors: DataFrame, every: int = EVERY, k: int = K, probe: float = PROBE) -> DataFrame:
    """Each query's ``k`` nearest found: ``query_id, rank, vec_id, score``."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = fixed(usable(vectors), "vectors")
    largest = rows.agg(F.max(F.array_max(F.transform("embedding", F.abs)))).first()[0]
    if largest is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # Squares of very large or small components leave the range of doubles.
    scale = 1.0 if 1e-100 < largest < 1e100 else 2.0 ** float(np.clip(-np.frexp(largest)[1], -1000, 1000))
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * scale * x * scale))
    facts = rows.agg(F.count("*").alias("n"), F.max(length).alias("radius")).first()
    chosen = rows.filter(chance(F.col("vec_id"), SEED) < SAMPLE / facts["n"]).orderBy("vec_id").limit(2 * SAMPLE)
    sample = _matrix(chosen.select("embedding").toArrow().column("embedding"))
    if not len(sample):
        sample = _matrix(rows.orderBy("vec_id").limit(1).select("embedding").toArrow().column("embedding"))
    index = Index(sample, facts["n"], facts["radius"], scale=scale)
    shared = spark.sparkContext.broadcast(index)  # LISTS centres at most
    lists = len(index.centres)

    def assign(batches):
        for batch in batches:
            at = shared.value.nearest(shared.value.rotated(_matrix(batch.column("embedding"))), 1) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[:, 0].astype(np.int32)), *batch.columns], names=["list", "vec_id", "embedding"]
            )

    listed = fixed(rows.mapInArrow(assign, "list int, vec_id bigint, embedding array<double>"), "vector-lists")
    sizes = np.zeros(lists, np.int64)
    for r in listed.groupBy("list").count().collect():  # one row for each list
        sizes[r[0]] = r[1]

    def to_lists(first: bool):
        def placed(batches):
            for batch in batches:
                points = _matrix(batch.column("embedding"))
                if not len(points):
                    continue
                order = shared.value.nearest(shared.value.rotated(points, query=True), lists)
                nth = np.arange(lists)
                near = (nth < np.ceil(NEAR * lists)) | (np.cumsum(sizes[order], 1) - sizes[order] < 10 * k)
                row, nth = np.nonzero(near if first else (nth < np.ceil(probe * lists)) & ~near)
                rest = [batch.column(c).take(pa.array(row)) for c in ("vec_id", "embedding", "worst")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(order[row, nth].astype(np.int32)), *rest], names=["list", "vec_id", "embedding", "worst"]
                )

        return placed

    key = ["list", "vblock", "qblock"]

    def blocked(side: DataFrame, blocks: DataFrame, own: str, other: str) -> DataFrame:
        placed = side.join(F.broadcast(blocks), "list")  # one row for each list
        placed = placed.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col(f"{own}s")).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("vblocks", "qblocks")

    def scanned(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            empty = [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())]
            return pa.Table.from_arrays(empty, names=kinds)
        ids, query_ids, worst = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy(), right.column("worst").to_numpy()
        out = scan(shared.value, ids, _matrix(left.column("embedding")), query_ids, _matrix(right.column("embedding")), worst, k)
        return pa.Table.from_arrays([pa.array(c) for c in out], names=kinds)

    def passed(queries: DataFrame, first: bool) -> DataFrame:
        """What the queries find in their nearest lists, or in the further ones."""
        schema = "list int, vec_id bigint, embedding array<double>, worst double"
        asked = fixed(queries.mapInArrow(to_lists(first), schema), "vector-queries")
        counts = [(r[0], r[1]) for r in asked.groupBy("list").count().collect()]  # one row for each list
        blocks = spark.createDataFrame(
            [(i, -(-int(sizes[i]) // BLOCK), -(-n // BLOCK)) for i, n in counts if sizes[i]],
            "list int, vblocks int, qblocks int",
        )
        stored = blocked(listed, blocks, "vblock", "qblock").groupBy(*key)
        posed = blocked(asked, blocks, "qblock", "vblock").groupBy(*key)
        return stored.cogroup(posed).applyInArrow(scanned, "query_id bigint, vec_id bigint, score double")

    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    near = fixed(passed(queries.withColumn("worst", F.lit(float("-inf"))), True), "vector-near")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)

    limits = ranked(near).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("worst"))
    bounded = queries.join(limits, "vec_id", "left").withColumn("worst", F.coalesce("worst", F.lit(float("-inf"))))
    found = near.union(passed(bounded, False))
    return ranked(found).select("query_id", "rank", "vec_id", "score")
