"""Typed views over changing layouts, scope in the scan, and lookups too large to broadcast."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions import pgtext as P
from millrace.operators import lookup, outcome
from millrace.operators import transforms as T
from millrace.operators.decode import ChangeLog, decode, errors_of, table_view
from millrace.plans import derived_log as logs
from millrace.plans.catalog import QUERIES
from millrace.sources import landing
from tests.helpers import ORDERS, USERS, by_seq, change, raw, relation

SMALL = "/root/testdata/sf0.001"


def layouts():
    return [
        relation(0, (7, "public", "m", [("id", P.INT4), ("name", P.TEXT)])),
        change(1, "I", 7, new=["1", "a"]),
        relation(2, (7, "public", "m", [("name", P.TEXT), ("score", P.FLOAT8), ("id", P.INT8)])),  # moved, added, wider
        change(3, "U", 7, old=["b", "1.5", "99999999999"], new=["b", "x", "99999999999"]),
        change(4, "I", 7, new=["b", "2.5", "99999999999"]),
        relation(5, (7, "public", "m", [("score", P.NUMERIC), ("id", P.TEXT)])),  # gone, other types
        change(6, "I", 7, new=["3.25", "12"]),
        change(7, "I", 7, new=["3.25", "twelve"]),
        relation(8, (7, "app", "m", [("id", P.INT4)])),  # another table under the number
        change(9, "I", 7, new=["5"]),
        relation(10, (8, "public", "m", [("id", P.BOOL), ("id", P.INT4)])),
        change(11, "I", 8, new=["t", "5"]),
        change(12, "I", 7, new=None),
        relation(13, (9, "public", "m", [("id", P.INT4), ("score", P.FLOAT8)])),
        change(14, "D", 9, old=["1", None, "more"]),
        change(15, "D", 9, old=["no", "no", "more"]),
        change(16, "X", 9, new=["1"]),
    ]


VIEW = [("id", P.INT8), ("name", P.TEXT), ("score", P.FLOAT8)]


def test_columns_by_the_layout_in_force(spark):
    log = ChangeLog.of(raw(spark, layouts()))
    view = table_view(log, "m", VIEW, keep_errors=True)
    assert dict(view.select("after.*").dtypes) == {"id": "bigint", "name": "string", "score": "double"}
    got = {r.seq: r for r in view.collect()}
    assert sorted(got) == [1, 3, 4, 6, 7, 11, 14, 15, 16]
    assert tuple(got[1].after) == (1, "a", None)
    assert tuple(got[4].after) == (99999999999, "b", 2.5)
    assert tuple(got[6].after) == (12, None, 3.25)
    errors = {seq: r.error for seq, r in got.items() if r.failed}
    assert errors == {
        3: 'failed to parse new tuple: failed to convert column score: invalid float8 value "x"',
        7: 'failed to parse tuple: failed to convert column id: invalid int8 value "twelve"',
        11: "failed to parse tuple: repeated column name in relation m",
        14: "failed to parse tuple: column index 2 out of range for relation m",
        15: 'failed to parse tuple: failed to convert column id: invalid int4 value "no"',
        16: "unknown message type: X",
    }
    assert all(r.before is None and r.after is None for r in got.values() if r.failed)
    assert {r.seq for r in table_view(log, "m", VIEW).collect()} == {1, 4, 6}
    assert table_view(log, "nowhere", VIEW).collect() == []


def test_values_fit_the_type_in_force_and_the_type_shown(spark):
    rows = [
        relation(0, (7, "", "m", [("id", P.INT4), ("day", P.DATE)])),
        change(1, "I", 7, new=["99999999999", "2026-01-01"]),  # too wide for the type in force
        change(2, "I", 7, new=["5", "yesterday"]),
        change(3, "I", 7, new=["5", "2026-01-02"]),
    ]
    view = table_view(ChangeLog.of(raw(spark, rows)), "m", [("id", P.INT8), ("day", P.TEXT)], keep_errors=True)
    got = {r.seq: (r.error, r.after) for r in view.collect()}
    assert got[1][0].endswith('column id: invalid int4 value "99999999999"')
    assert got[2][0].endswith('column day: invalid date value "yesterday"')
    assert got[3][0] is None and tuple(got[3][1]) == (5, "2026-01-02")


def test_decimal_columns(spark):
    rows = [relation(0, (7, "", "m", [("x", P.NUMERIC)]))]
    rows += [change(i + 1, "I", 7, new=[x]) for i, x in enumerate(["1.10", "123456.7", None, "NaN", "-0.005"])]
    view = table_view(ChangeLog.of(raw(spark, rows)), "m", [("x", P.NUMERIC, "decimal(6,2)")], keep_errors=True)
    assert dict(view.select("after.*").dtypes) == {"x": "decimal(6,2)"}
    got = {r.seq: None if r.after is None else r.after.x and str(r.after.x) for r in view.collect()}
    assert got == {1: "1.10", 2: None, 3: None, 4: None, 5: "-0.01"}
    assert {r.seq for r in view.filter("failed").collect()} == {2, 4}
    with pytest.raises(ValueError, match="only numeric columns"):
        table_view(ChangeLog.of(raw(spark, rows)), "m", [("x", P.TEXT, "decimal(6,2)")])


def test_events_agree_with_the_view(spark):
    """The same rows fail, with the same words, where the view shows every column as its layout has it."""
    log = ChangeLog.of(raw(spark, [r for r in layouts() if r[0] in (2, 3, 4, 13, 14, 15)]))
    columns = [("name", P.TEXT), ("score", P.FLOAT8), ("id", P.INT8)]
    view = {r.seq: r.error for r in table_view(log, "m", columns, keep_errors=True).filter("seq < 10").collect()}
    events = {r.seq: r.error for r in decode(log, None).filter("seq < 10").collect()}
    assert view == events


def test_a_repeated_column_name_is_a_decode_error(spark):
    log = ChangeLog.of(raw(spark, layouts()))
    errors = {r.seq: r.error for r in errors_of(decode(log, None)).collect()}
    assert errors[11] == "failed to parse tuple: repeated column name in relation m"
    assert by_seq(decode(log, None))[4]["after"] == {"id": 99999999999, "name": "b", "score": 2.5}


def explained(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scope_reaches_the_scan(spark, tmp_path):
    rows = [relation(0, USERS), relation(1, ORDERS), change(2, "I", 100, new=["1", "a"])]
    rows += [change(3, "I", 200, new=["1", "2", "9.5"]), change(4, "I", 300, new=["1"])]
    raw(spark, rows).write.parquet(str(tmp_path / "log"))
    log = ChangeLog.of(landing.read_log(spark, str(tmp_path / "log")))
    scoped = decode(log, None, tables=["users"])
    assert "Not(EqualTo(relation_id,200))" in explained(scoped) or "Not(In(relation_id" in explained(scoped)
    assert set(by_seq(scoped)) == {2, 4}  # unknown layouts stay visible
    # An id that was ever one of the tables is read.
    rows += [relation(5, (200, "public", "users", [("id", 23)])), change(6, "I", 200, new=["7"])]
    both = ChangeLog.of(raw(spark, rows))
    assert both.in_scope(["users"]) is both and set(by_seq(decode(both, None, tables=["users"]))) == {2, 4, 6}


def test_no_nested_loop_in_the_registered_plans(spark):
    for name in ("decode_images", "decode_typed", "key_order", "outbox_shape", "outcome_split", "typed_view_layouts"):
        plan = explained(QUERIES[name](spark, SMALL))
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name


# -- large lookups -----------------------------------------------------------------


def test_a_table_is_small_by_rows_and_by_bytes(spark):
    table = spark.range(100).withColumn("x", F.repeat(F.lit("y"), 1000))
    assert lookup.within(table, 100) and not lookup.within(table, 99)
    assert lookup.within(table, 100, 200_000) and not lookup.within(table, 100, 50_000)
    assert lookup.within(table.limit(0), 0, 0)


def test_a_bursty_key_is_spread(spark, monkeypatch):
    monkeypatch.setattr(lookup, "MAX_HOT_KEYS", 8)
    # One key has most rows, all in one burst of the sequence, some without any place in it.
    rows = [(1, s) for s in range(5000, 5800)] + [(k, k) for k in range(2, 200)] + [(None, s) for s in range(100)] + [(1, None)] * 3
    log = spark.createDataFrame(rows, "k int, seq bigint")
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 200, 2)] + [(1, "v1")], "k int, v string")
    joined = lookup._salted_join(log, table, "k", "seq")
    got = Counter((r.k, r.seq, r.v) for r in joined.collect())
    want = Counter((k, s, f"v{k}" if k is not None and (k % 2 == 0 or k == 1) else None) for k, s in rows)
    assert got == want
    hot = lookup.hot_keys(log, "k", "seq").collect()
    assert [r.k for r in hot] == [1] and hot[0]._parts >= 6


def test_enriching_from_a_large_table_runs_functions_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def note(event):
        with open(f"{calls}/{event['after']['id']}", "a") as out:
            out.write("x")
        return event

    rows = [relation(0, USERS)] + [change(i, "I", 100, new=[str(i % 40), "n"]) for i in range(1, 81)]
    dim = spark.createDataFrame([(i, f"c{i}") for i in range(0, 40, 2)], "id int, city string")
    for limit, folder in ((1000, "small"), (3, "large")):
        links = [T.UserFunction("note", note), T.enrich(dim, ("id", "id"), {"city": "city"}, broadcast_rows=limit)]
        staged = T.chain(outcome.begin(decode(ChangeLog.of(raw(spark, rows)), None)), links)
        staged.write.parquet(f"{tmp_path}/{folder}")
        got = {r.seq: r for r in spark.read.parquet(f"{tmp_path}/{folder}").select("seq", F.to_json("after").alias("a")).collect()}
        assert len(got) == 80
        assert all((f'"city":"c{s % 40}"' in r.a) == (s % 40 % 2 == 0) for s, r in got.items())
        assert {p.read_text() for p in calls.iterdir()} == {"xx"} and len(list(calls.iterdir())) == 40
        for p in calls.iterdir():
            p.write_text("")


def test_derived_logs_hold_several_ids_and_versions(spark):
    for log in (logs.orders_log(spark, SMALL), logs.outbox_log(spark, SMALL)):
        assert log.changes.select("relation_id").distinct().count() > 1
