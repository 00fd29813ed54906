import random

from pyspark.sql import functions as F

from millrace.operators import commits, lookup, relations
from millrace.operators.decode import ChangeLog, decode, decode_changes, errors_of, events_of, table_view
from millrace.sources import landing
from tests.helpers import ORDERS, USERS, at, begin, by_seq, change, commit, raw, relation


def decoded(spark, rows, **kwargs):
    return decode(ChangeLog.of(raw(spark, rows)), **kwargs)


def test_operations_and_images(spark):
    rows = [
        begin(0, 1),
        relation(1, USERS),
        change(2, "I", 100, new=["1", "alice"]),
        change(3, "U", 100, old=["1", "old-name"], new=["1", "new-name"]),
        change(4, "U", 100, new=["2", None]),
        change(5, "D", 100, old=["999", None]),
        (6, 1006, 1, "T", None, None, None, None, None, None, None),
        commit(7, 1, 9),
    ]
    got = by_seq(decoded(spark, rows))
    assert sorted(got) == [2, 3, 4, 5]
    assert (got[2]["op"], got[2]["before"], got[2]["after"]) == ("create", None, {"id": 1, "name": "alice"})
    assert got[2]["table"] == "users" and got[2]["source"] == "postgres" and got[2]["lsn"] == 1002
    assert got[3]["op"] == "update"
    assert got[3]["before"] == {"id": 1, "name": "old-name"} and got[3]["after"] == {"id": 1, "name": "new-name"}
    assert got[4]["before"] is None and got[4]["after"] == {"id": 2, "name": None}
    assert (got[5]["op"], got[5]["before"], got[5]["after"]) == ("delete", {"id": 999, "name": None}, None)


def test_errors(spark):
    rows = [
        relation(1, USERS),
        change(2, "I", 99999, new=["1"]),
        change(3, "I", 100, new=["1", "a", "extra"]),
        change(4, "U", 100, old=["x", "a"], new=["y", "b"]),
        change(5, "U", 100, old=["1", "a"], new=["y", "b"]),
        change(6, "D", 100, old=["99999999999"]),
        change(7, "X", 100, new=["1"]),
        change(8, "I", 100),
        change(9, "I", 100, new=["3"]),
        change(10, "I", 100, new=[]),
        (11, 1, 1, None, None, None, None, None, None, None, None),
    ]
    log = decoded(spark, rows, ts_mode=None)
    errors = {r.seq: r.error for r in errors_of(log).collect()}
    assert errors == {
        2: "unknown relation ID: 99999",
        3: "failed to parse tuple: column index 2 out of range for relation users",
        4: 'failed to parse old tuple: failed to convert column id: invalid int4 value "x"',
        5: 'failed to parse new tuple: failed to convert column id: invalid int4 value "y"',
        6: 'failed to parse tuple: failed to convert column id: invalid int4 value "99999999999"',
        7: "unknown message type: X",
        8: "failed to parse tuple: missing",
    }
    good = by_seq(events_of(log))
    assert good[9]["after"] == {"id": 3} and good[10]["after"] is None


def test_table_names(spark):
    rows = [("public", "users", "users"), ("", "orders", "orders"), ("app", "products", "app.products"), (None, "t", "t")]
    df = spark.createDataFrame(rows, "ns string, rel string, want string")
    assert df.filter(relations.table_name(F.col("ns"), F.col("rel")) != F.col("want")).count() == 0


def test_layout_changes_mid_log(spark):
    wider = (100, "public", "people", [("id", 20), ("name", 25), ("age", 21)])
    rows = [
        change(1, "I", 100, new=["1", "too early"]),
        relation(2, USERS),
        change(3, "I", 100, new=["1", "a"]),
        relation(4, USERS),  # announced again, unchanged
        change(5, "I", 100, new=["2", "b"]),
        relation(6, wider),
        change(7, "I", 100, new=["3", "c", "40"]),
    ]
    log = ChangeLog.of(raw(spark, rows))
    assert relations.relation_spans(log.relations).count() == 2
    got = by_seq(decode(log, ts_mode=None))
    assert got[1]["error"] == "unknown relation ID: 100"
    assert got[3]["table"] == got[5]["table"] == "users"
    assert got[7]["table"] == "people" and got[7]["after"] == {"id": 3, "name": "c", "age": 40}


def random_log(seed, n=600, ids=(1, 2, 3)):
    """A log where id 1 holds most rows and layouts change often."""
    rnd = random.Random(seed)
    rows, known, want = [], {}, {}
    for seq in range(n):
        rid = 1 if rnd.random() < 0.7 else rnd.choice(ids)
        if rnd.random() < 0.1:
            known[rid] = f"t{rid}_{seq}"
            rows.append(relation(seq, (rid, "public", known[rid], [("id", 23)])))
        else:
            rows.append(change(seq, "I", rid, new=["1"], xid=seq // 7))
            want[seq] = known.get(rid)
    return rows, want


def test_layout_lookup_beyond_the_broadcast_limit(spark):
    for seed in range(3):
        rows, want = random_log(seed)
        log = ChangeLog.of(raw(spark, rows))
        spans = relations.relation_spans(log.relations)
        for small in (True, False):
            got = relations.attach_relations(log.changes, spans, small)
            assert {r.seq: r.table for r in got.select("seq", "table").collect()} == want


def test_keyed_lookup_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(lookup, "MAX_HOT_KEYS", 5)
    rows = [(i, 0 if i % 3 else i % 50, i) for i in range(1000)] + [(i, None, i) for i in range(1000, 1100)]
    log = spark.createDataFrame(rows, "i int, k int, seq bigint")
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 50, 2)], "k int, v string")
    want = {i: (f"v{k}" if k is not None and k % 2 == 0 else None) for i, k, _ in rows}
    for limit in (1000, 3):
        got = lookup.left_lookup(log, table, "k", broadcast_rows=limit)
        assert {r.i: r.v for r in got.collect()} == want


def test_commit_times(spark):
    rows, want_own, want_seen, last = [relation(0, USERS)], {}, {}, None
    seq = 1
    for xid in range(40):
        for _ in range(xid % 3 + 1):
            rows.append(change(seq, "I", 100, new=["1", "a"], xid=xid))
            want_own[seq], want_seen[seq] = at(xid), last
            seq += 1
        rows.append(commit(seq, xid, xid))
        last = at(xid)
        seq += 1
    rows.append(change(seq, "I", 100, new=["1", "a"], xid=99))
    want_own[seq], want_seen[seq] = None, last
    log = ChangeLog.of(raw(spark, rows))

    def times(df):
        micros = df.select("seq", F.unix_micros("ts").alias("us")).collect()
        return {r.seq: r.us for r in micros}

    def us(times):
        return {k: None if v is None else int(v.timestamp()) * 1_000_000 for k, v in times.items()}

    for limit in (10_000, 5):
        own = commits.stamp_commit_time(log.changes, log.commits, "transaction", limit)
        assert times(own) == us(want_own)
        seen = commits.stamp_commit_time(log.changes, log.commits, "last_seen_commit", limit)
        assert times(seen) == us(want_seen)
    pieces = commits.previous_commit(log.commits, piece=8)
    whole = commits.previous_commit(log.commits)
    assert sorted(pieces.collect()) == sorted(whole.collect())


def test_commit_times_of_redelivered_and_reused_numbers(spark):
    rows, want = [relation(0, USERS)], {}
    for turn, (xid, second) in enumerate([(1, 10), (2, 20), (1, 10), (3, 30), (2, 40)]):
        for i in range(2):
            rows.append(change(turn * 10 + 1 + i, "I", 100, new=["1", "a"], xid=xid))
            want[turn * 10 + 1 + i] = second
        rows.append(commit(turn * 10 + 9, xid, second))
    log = ChangeLog.of(raw(spark, rows))
    for limit in (10_000, 2):
        own = commits.stamp_commit_time(log.changes, log.commits, "transaction", limit)
        got = [(r.seq, r.s) for r in own.select("seq", F.second("ts").alias("s")).collect()]
        assert sorted(got) == sorted((k, v if v < 60 else v - 60) for k, v in want.items())
        seen = commits.stamp_commit_time(log.changes, log.commits, "last_seen_commit", limit)
        assert seen.count() == len(want)


def test_carried_commit_time(spark):
    rows = [relation(0, USERS), change(1, "I", 100, new=["1", "a"], xid=5), commit(2, 5, 30)]
    rows.append(change(3, "I", 100, new=["1", "a"], xid=6))
    got = by_seq(decoded(spark, rows, ts_mode="last_seen_commit", last_before=at(7)))
    assert got[1]["ts"].second == 7 and got[3]["ts"].second == 30


def test_scope_and_start(spark):
    rows = [relation(0, USERS), relation(1, ORDERS)]
    rows += [change(2, "I", 100, new=["1", "a"]), change(3, "I", 200, new=["1", "2", "9.5"])]
    log = ChangeLog.of(raw(spark, rows))
    assert set(by_seq(decode(log, None, tables=["orders"]))) == {3}
    assert set(by_seq(decode(log, None, tables=[]))) == {2, 3}
    assert set(by_seq(decode(log.starting_at(1003), None))) == {3}
    assert set(by_seq(decode(log.starting_at(0), None))) == {2, 3}
    kept = landing.from_position(raw(spark, rows), 1003)
    assert {r.seq for r in kept.collect()} == {0, 1, 3}


def test_table_view(spark):
    layout = (7, "public", "m", [("id", 23), ("rate", 701), ("day", 1082), ("doc", 114)])
    rows = [
        relation(0, layout),
        change(1, "U", 7, old=["1", "0.5", "2026-03-05", "{}"], new=["1", "1.5", None, '{"a":1}']),
        change(2, "I", 7, new=["bad", "1.5", None, None]),
        change(3, "I", 7, new=["4"]),
        change(4, "I", 7, new=["4", "1", None, None, "extra"]),
    ]
    log = ChangeLog.of(raw(spark, rows))
    view = table_view(log, "m", layout[3])
    assert dict(view.select("after.*").dtypes) == {"id": "bigint", "rate": "double", "day": "date", "doc": "variant"}
    got = {r.seq: r for r in view.select("seq", "before.rate", "after.id").collect()}
    assert set(got) == {1, 3} and got[1].rate == 0.5 and got[1].id == 1 and got[3].id == 4
    flags = {r.seq: r.failed for r in table_view(log, "m", layout[3], keep_errors=True).collect()}
    assert flags == {1: False, 2: True, 3: False, 4: True}


def test_json_landing(spark, tmp_path):
    lines = [
        '{"seq":1,"lsn":"4242","xid":1,"kind":"I","relation_id":100,"new":["1","a"]}',
        "not json at all",
        '{"seq":2,"lsn":"oops","xid":1,"kind":"I","relation_id":100,"new":["2","b"]}',
        '{"seq":3,"xid":1,"kind":"I","relation_id":100,"new":["3","c"]}',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    got = {r.seq: r.lsn for r in landing.read_log(spark, str(tmp_path), "json").collect()}
    assert got == {1: 4242, 2: None, 3: None}


def explained(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_layout_lookup_does_not_shuffle_the_log(spark, tmp_path):
    rows, _ = random_log(1)
    raw(spark, rows).write.parquet(str(tmp_path / "log"))
    log = ChangeLog.of(landing.read_log(spark, str(tmp_path / "log")))
    plan = explained(decode_changes(log.with_relations()))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    probe = plan.split("BroadcastExchange")[0]
    assert "Exchange" not in probe
    assert plan.count("zip_with") == 2  # each tuple is converted once
