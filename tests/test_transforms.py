import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import outcome
from millrace.operators import transforms as T
from millrace.operators.userfn import MAX_RESULT, call_with_retry

SCHEMA = "seq bigint, lsn bigint, source string, table string, op string, ts timestamp, before string, after string, not_finite boolean"


def staged(spark, rows):
    """(table, op, after dict) triples as staged events."""
    data = [
        (i, i, "postgres", table, op, None, None, json.dumps(after), bool(rest and rest[0]))
        for i, (table, op, after, *rest) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, SCHEMA)
    return outcome.begin(df.withColumns({c: F.try_parse_json(c) for c in ("before", "after")}))


def result(df):
    rows = df.withColumn("after", F.to_json("after")).orderBy("seq").collect()
    return [(r.status, r.table, r.op, json.loads(r.after), r.error) for r in rows]


def test_empty_chain_is_identity(spark):
    df = staged(spark, [("users", "create", {"id": 1})])
    assert T.chain(df, []) is df


def test_allow_list_counts(spark):
    names = ["users", "orders", "audit_logs", "sessions", "payments"]
    rows = [(names[i % 5], "create", {"id": i}) for i in range(100)]
    kept = T.chain(staged(spark, rows), [T.allow("users", "orders")]).filter(outcome.is_live())
    assert kept.count() == 40
    mixed = "users audit_logs orders sessions users payments orders".split()
    events = staged(spark, [(n, op, {}) for n, op in zip(mixed, ["create", "update", "delete"] * 3)])
    assert T.chain(events, [T.allow("users", "orders")]).filter(outcome.is_live()).count() == 4
    assert T.allow_tables(events, ["users", "orders"]).count() == 4


def test_order_drop_and_error(spark):
    rename = T.rewrite({"table": F.concat("table", F.lit("_modified"))})
    update = T.rewrite({"op": F.lit("update")})
    df = staged(spark, [("users", "create", {"id": 1})])
    assert result(T.chain(df, [rename, update]))[0][:3] == (None, "users_modified", "update")
    dropped = result(T.chain(df, [rename, T.keep(F.lit(False)), update]))[0]
    assert dropped[:3] == ("filtered", "users_modified", "create")
    failed = result(T.chain(df, [rename, T.reject(F.lit(True), "boom"), update]))[0]
    assert failed[0] == "transform_error" and failed[2] == "create"
    assert failed[4] == "transform 1 failed\nboom"
    alone = result(T.chain(df, [T.reject(F.lit(True), "boom")], numbered=False))[0]
    assert alone[4] == "boom"
    with pytest.raises(ValueError):
        T.rewrite({"lsn": F.lit(1)})


def test_not_finite_fails_any_chain(spark):
    df = staged(spark, [("users", "create", {"id": 1}, True), ("users", "create", {"id": 2})])
    got = result(T.chain(df, [T.allow("orders")]))
    assert got[0][0] == "transform_error" and "failed to marshal event" in got[0][4]
    assert got[1][0] == "filtered"


def test_enrich_small_and_large(spark):
    df = staged(spark, [("t", "create", {"k": i % 3, "v": i}) for i in range(20)] + [("t", "create", {"v": 1})])
    dim = spark.createDataFrame([(0, "zero"), (1, "one")], "id int, label string")
    for limit in (100, 1):
        link = T.enrich(dim, ("k", "id"), {"name": "label"}, broadcast_rows=limit)
        got = result(T.chain(df, [link]))
        assert [g[3].get("name", "absent") for g in got] == [["zero", "one", None][i % 3] for i in range(20)] + [None]
    twice = spark.createDataFrame([(0, "a"), (0, "b")], "id int, label string")
    with pytest.raises(Exception, match="repeated key"):
        result(T.chain(df, [T.enrich(twice, ("k", "id"), {"name": "label"})]))


def test_functions(spark):
    def fn(event):
        if event["table"] == "drop":
            return None
        if event["table"] == "fail":
            raise ValueError("refused")
        if event["table"] == "odd":
            return {"table": 5}
        if event["table"] == "infinite":
            event["after"]["x"] = float("inf")
        event["after"]["seen"] = True
        return event

    def big(event):
        event["after"]["big"] = "x" * (MAX_RESULT if event["table"] == "big" else 1)
        return event

    names = ["ok", "drop", "fail", "odd", "infinite", "big"]
    df = staged(spark, [(n, "create", {"id": 2**60 + 1, "deep": {"a": [1, None, "☃"]}}) for n in names])
    links = [T.UserFunction("fn", fn)]
    got = dict(zip(names, result(T.chain(df, links, max_attempts=2, backoff_ms=0))))
    assert got["ok"][3] == {"id": 2**60 + 1, "deep": {"a": [1, None, "☃"]}, "seen": True}
    assert got["drop"][0] == "filtered"
    assert got["fail"][0] == "transform_error" and got["fail"][4] == "transform 0 failed\nrefused"
    assert got["odd"][0] == "transform_error" and "table is not a string" in got["odd"][4]
    assert got["infinite"][0] == "transform_error"
    two = T.chain(df.filter("table in ('ok', 'big')"), [T.UserFunction("fn", fn), T.UserFunction("big", big)], 1, 0)
    two = two.select("status", "error", "attempts").collect()
    assert two[0].status is None
    assert two[1].status == "transform_error" and "transform 1 failed\nresult data too large" in two[1].error


def test_adjacent_functions_run_in_one_pass(spark):
    df = staged(spark, [("t", "create", {"id": 1})])
    one = T.UserFunction("one", lambda e: {**e, "op": "a"})
    two = T.UserFunction("two", lambda e: {**e, "op": e["op"] + "b"})
    out = T.chain(df, [one, two])
    assert result(out)[0][2] == "ab"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_retry_stops_at_the_first_success():
    calls = []

    def flaky(event):
        calls.append(1)
        if len(calls) < 2:
            raise RuntimeError("not yet")
        return event

    status, error, attempts, out, _ = call_with_retry('{"table":"t"}', [("", flaky)], 3, 0)
    assert (status, error, attempts, out) == (None, None, 2, '{"table":"t"}')

    def never(event):
        calls.append(1)
        raise RuntimeError("no")

    calls.clear()
    status, error, attempts, out, _ = call_with_retry("{}", [("", never)], 3, 0)
    assert (status, error, attempts, out, len(calls)) == ("transform_error", "no", 3, None, 3)
