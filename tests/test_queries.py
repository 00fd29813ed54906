"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from millrace.plans.catalog import QUERIES
from millrace.plans.oracle import SQL

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SMALL) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["table", "op", "topic", "n"] and df.count() > 0


def test_positions_of_large_keys(spark, tmp_path):
    """Products that fill a bigint, 64 bits, and more: none fails, and all 64 bits are in the text."""
    factor = 1311768467294
    full, wide = (1 << 63) // factor, (1 << 64) // factor
    keys = [None, 0, 1, full, full + 1, 7_500_001, wide, wide + 1, 36_000_003, (1 << 63) - 1, -1, -full - 2]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")

    def text(key):
        if key is None or key % 10 == 0:
            return ""
        bits = key * factor % (1 << 64)
        return f"{bits >> 32}/{bits & 0xFFFFFFFF}"

    got = {r.o_orderkey: r.position for r in QUERIES["position_text"](spark, str(tmp_path)).collect()}
    assert got == {k: text(k) for k in keys}
