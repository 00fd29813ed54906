"""Adaptive dimension scan against brute force, and rows that take no part."""

import numpy as np
import pytest

from millrace.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, score double, list string"


def brute(ids, vectors, every=20, k=20):
    """The ``k`` best of each query, ties to the smaller id."""
    out = {}
    for i, q in zip(ids, vectors, strict=True):
        if i % every == 0:
            scores = vectors @ q
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v], None, None) for i, v in zip(ids, vectors, strict=True)], SCHEMA)


@pytest.mark.parametrize("copies", [0, 300])
def test_recall_and_scores(spark, copies):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    vectors = (centres[rng.integers(0, 12, 900)] + rng.normal(scale=0.7, size=(900, 24))).astype(np.float32)
    vectors[100 : 100 + copies] = vectors[100]  # a large group of copies: ties go to the smaller id
    ids, vectors = np.arange(900), vectors.astype(np.float64)
    got, want = found(neighbours.search(table(spark, ids, vectors))), brute(ids, vectors)
    assert got.keys() == want.keys() and all(len(rows) == 20 for rows in got.values())
    hits = 0
    for query, rows in got.items():
        assert all(vec_id != query for vec_id, _ in rows)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        for vec_id, score in rows:
            assert score == pytest.approx(vectors[vec_id] @ vectors[query], rel=1e-12, abs=1e-12)
        # A tie at the end may be broken by rounding, so scores count and not ids.
        hits += sum(score >= want[query][-1][1] - 1e-9 for _, score in rows)
    assert hits / sum(len(rows) for rows in want.values()) >= 0.9


def test_fewer_candidates_than_wanted_are_all_returned(spark):
    ids, vectors = np.array([0, 1, 2, 20]), np.array([[1.0, 0], [0, 1], [-2, 0.5], [1, 1]])
    assert found(neighbours.search(table(spark, ids, vectors))) == brute(ids, vectors)


def test_unusable_rows_take_no_part(spark):
    rows = [
        (0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [-1.0, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
        (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (20, [0.0, 0.0]),
        (1, [2.0, 1.0]),
    ]
    got = found(neighbours.search(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)))
    assert got == {0: [(1, 4.0), (1, 4.0), (2, 0.0)]}


def test_empty(spark):
    assert neighbours.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert neighbours.search(spark.createDataFrame([(1, [1.0, 2.0], None, None)], SCHEMA)).count() == 0
