"""Going on where a run stopped, changes delivered again, and rows that can't be used."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import delivery
from millrace.operators.decode import ChangeLog
from millrace.operators.offsets import Offset, Run, RunLedger, rows_of
from millrace.sources import landing
from millrace.spec import PipelineSpec, SinkSpec, SourceSpec
from millrace.streaming.runner import build
from tests.helpers import ORDERS, USERS, begin, change, commit, count_by, raw, relation
from tests.test_runs import account, spec_for, stream_log_rows, values, with_flaky


def resumed(spark, path, **source):
    spec = spec_for(path, source=SourceSpec(path=f"{path}/log", resume=True, **source))
    return build(spark, spec)


def land(spark, rows, path):
    raw(spark, rows).coalesce(1).write.mode("append").parquet(f"{path}/log")


@pytest.mark.parametrize("ts_mode", ["transaction", "last_seen_commit"])
def test_parts_of_a_log_equal_one_run(spark, tmp_path, ts_mode):
    rows = stream_log_rows()
    whole = build(spark, spec_for(tmp_path / "one", source=SourceSpec(ts_mode=ts_mode)))
    want = account(whole.run_batch(raw(spark, rows)))
    first, last = resumed(spark, tmp_path / "two", ts_mode=ts_mode), 0
    for cut in (17, 44, len(rows)):  # inside transactions
        land(spark, rows[last:cut], tmp_path / "two")
        last = cut
        first = resumed(spark, tmp_path / "two", ts_mode=ts_mode)  # nothing is kept in memory
        first.run_batch()
    assert account(first.ledger.read_all()) == want
    assert first.offsets.load() == whole.offsets.load()
    assert sorted(first.ledger.numbers()) == [0, 1, 2]
    assert first.run_next() is None  # nothing new
    assert account(first.run_batch()) == account(first.ledger.read(2))


def test_only_the_new_range_is_read(spark, tmp_path):
    land(spark, stream_log_rows(), tmp_path)
    log = landing.read_log(spark, f"{tmp_path}/log")
    plan = rows_of(log, Run(1, 10, 20))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(seq,10)" in plan and "LessThanOrEqual(seq,20)" in plan


def test_a_broken_batch_is_done_again_with_the_same_rows(spark, tmp_path):
    rows = stream_log_rows()
    registry, made = with_flaky(tmp_path, 99)
    spec = spec_for(
        tmp_path, sink="flaky", on_sink_failure="fail", source=SourceSpec(path=f"{tmp_path}/log", resume=True)
    )
    land(spark, rows[:30], tmp_path)
    with pytest.raises(RuntimeError, match="broker away"):
        build(spark, spec, registry=registry).run_batch()
    land(spark, rows[30:], tmp_path)
    pipeline = resumed(spark, tmp_path)
    assert pipeline.runs.unfinished() == Run(0, None, 29)
    pipeline.run_batch()
    assert max(r[0] for r in account(pipeline.ledger.read(0))) < 30
    pipeline.run_batch()
    whole = build(spark, spec_for(tmp_path / "one"))
    assert account(pipeline.ledger.read_all()) == account(whole.run_batch(raw(spark, rows)))
    assert spark.read.parquet(f"{tmp_path}/out").count() == pipeline.ledger.read_all().filter("status = 'success'").count()


def test_an_open_tail_waits_or_ends_with_the_log(spark, tmp_path):
    rows = [relation(0, USERS), change(1, "I", 100, new=["1", "a"]), commit(2, 1, 5), change(3, "I", 100, new=["2", "b"], xid=2)]
    pipeline = resumed(spark, tmp_path)
    assert [r[0] for r in account(pipeline.run_next(raw(spark, rows)))] == [1]
    rows += [relation(4, (100, "public", "people", [("id", 20), ("name", 25)]))]
    assert account(pipeline.run_next(raw(spark, rows))) == []
    # The held row belongs to the layout that was in force when it arrived.
    rows += [change(5, "I", 100, new=["3", "c"], xid=2)]
    got = account(pipeline.run_next(raw(spark, rows), final=True))
    assert [r[:2] for r in got] == [(3, "users"), (5, "people")] and {r[4] for r in got} == {None}


def test_positions_of_other_runs_and_given_positions(spark, tmp_path):
    rows = stream_log_rows()
    pipeline = resumed(spark, tmp_path)
    pipeline.offsets.mark(Offset(1000 + 40))
    pipeline.offsets.flush(0)
    assert min(r[0] for r in account(pipeline.run_next(raw(spark, rows)))) == 41
    given = resumed(spark, tmp_path / "given", start_lsn=1000 + 60)
    assert min(r[0] for r in account(given.run_next(raw(spark, rows)))) == 60
    assert build(spark, PipelineSpec(sink=SinkSpec(type="stdout"), work_dir=f"{tmp_path}/none")).run_next(raw(spark, [])) is None


def test_the_run_ledger_keeps_its_newest_entries(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "runs"))
    assert ledger.newest() is None and ledger.unfinished() is None
    log = spark.range(100).withColumnRenamed("id", "seq")
    for n in range(13):
        run = ledger.plan(log.filter(F.col("seq") < (n + 1) * 5))
        assert (run.batch_id, run.last) == (n, n * 5 + 4)
        assert ledger.plan(log) == run  # unfinished: the same rows again
        ledger.finish(run)
    assert sorted(ledger.done.numbers()) == list(range(3, 13)) and ledger.newest() == Run(12, 59, 64)


# -- delivered again ---------------------------------------------------------------


def twice_delivered():
    """Transaction 1 is cut off, then sent whole, then sent again; several rows share a position.

    Rows, the changes that are first deliveries, and all changes, by sequence number.
    """
    rows, sent = [relation(0, USERS), relation(1, ORDERS)], {}

    def send(xid, lsns, end=True):
        rows.append(begin(len(rows), xid))
        for lsn in lsns:
            seq, _, *rest = change(len(rows), "I", 100, new=["1", "same"], xid=xid)
            rows.append((seq, lsn, *rest))
            sent.setdefault((xid, lsn), []).append(seq)
        if end:
            rows.append(commit(len(rows), xid, xid))

    send(1, [10, 10, 11], end=False)
    send(1, [10, 10, 11, 12])
    send(2, [20, 20, None])
    send(1, [10, 10, 11, 12])
    send(2, [20, 20, None])
    send(1, [50])  # the number is used again
    # Twice in one statement, once, or never recognised.
    counts = {(1, 10): 2, (2, 20): 2, (2, None): 2}
    firsts = [seq for key, found in sent.items() for seq in found[: counts.get(key, 1)]]
    return rows, sorted(firsts), sorted(seq for found in sent.values() for seq in found)


def test_first_deliveries(spark):
    rows, want, _ = twice_delivered()
    log = ChangeLog.of(raw(spark, rows))
    got = delivery.first_deliveries(log.changes, log.begins)
    assert sorted(r.seq for r in got.collect()) == want and got.columns[0] == "seq"


def test_events_once_in_batch_and_in_parts(spark, tmp_path):
    rows, want, every = twice_delivered()
    source = {"deliveries": "first", "ts_mode": "last_seen_commit"}
    batch = build(spark, spec_for(tmp_path / "b", source=SourceSpec(**source)))
    ledger = batch.run_batch(raw(spark, rows))
    assert sorted(r.seq for r in ledger.filter("status = 'success'").collect()) == want
    assert sorted(r.seq for r in ledger.collect()) == every
    assert len(values(spark, tmp_path / "b" / "out")) == len(want)
    parts = build(spark, spec_for(tmp_path / "p", source=SourceSpec(**source)))
    # Cut between deliveries, as a begin message has to be in a batch with its changes.
    cuts = [0, 6, 12, 17, 23, len(rows)]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(2):  # done again, it says the same
            parts.stream_batch(raw(spark, rows[a:b]), n)
    done = parts.ledger.read_all()
    assert sorted(r.seq for r in done.collect()) == every
    assert sorted(r.seq for r in done.filter("status = 'success'").collect()) == want
    assert len(values(spark, tmp_path / "p" / "out")) == len(want)


def test_identities_expire(spark, tmp_path):
    source = SourceSpec(deliveries="first", remember=2)
    pipeline = build(spark, spec_for(tmp_path, source=source))
    same = lambda seq: [begin(seq, 1), (seq + 1, 77, *change(seq + 1, "I", 100, new=["1", "a"])[2:]), commit(seq + 2, 1, 5)]
    other = lambda seq: [begin(seq, 9), change(seq + 1, "I", 100, new=["1", "a"], xid=9), commit(seq + 2, 9, 6)]
    parts = [[relation(0, USERS), *same(1)], same(11), other(21), other(31), other(41), same(51)]
    for n, rows in enumerate(parts):
        pipeline.stream_batch(raw(spark, rows), n)
    states = {r.batch: r.status for r in pipeline.ledger.read_all().select("batch", "status").collect()}
    assert states == {0: "success", 1: "repeated", 2: "success", 3: "success", 4: "success", 5: "success"}
    assert min(pipeline.state.seen.numbers()) == 2
    with pytest.raises(ValueError, match="unsupported source deliveries"):
        PipelineSpec(source=SourceSpec(deliveries="twice"), sink=SinkSpec(type="stdout")).validate()


# -- unusable rows -----------------------------------------------------------------


def test_unusable_rows_are_kept_and_counted(spark, tmp_path):
    lines = [
        '{"seq":0,"kind":"R","relation_id":100,"ns":"public","rel":"users","cols":[{"name":"id","oid":23},{"name":"name","oid":25}]}',
        '{"seq":1,"lsn":"4242","xid":1,"kind":"I","relation_id":100,"new":["1","a"]}',
        "not json at all",
        "",
        '{"seq":2,"lsn":"oops","xid":1,"kind":"I","relation_id":100,"new":["2","b"]}',
        '{"lsn":"5","xid":1,"kind":"I","relation_id":100,"new":["3","c"]}',
        '{"seq":"four","xid":1,"kind":"I"}',
        '{"seq":5,"xid":1}',
        '{"seq":6,"xid":1,"kind":"C","commit_ts":"2026-03-05T12:00:09Z"}',
    ]
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text("\n".join(lines))
    source = SourceSpec(path=f"{tmp_path}/log", format="json", resume=True)
    pipeline = build(spark, spec_for(tmp_path, source=source))
    ledger = pipeline.run_batch()
    assert count_by(ledger, "status") == {"success": 2, "unreadable": 4}
    assert count_by(ledger.filter("status = 'unreadable'"), "error") == {"malformed": 2, "no seq": 1, "no kind": 1}
    found = {r.reason: r.text for r in pipeline.rejects.read(0).collect() if r.reason != "malformed"}
    assert json.loads(found["unreadable lsn"])["lsn"] == "oops" and "seq" not in json.loads(found["no seq"])
    streamed = build(spark, spec_for(tmp_path / "s"))
    streamed.run_stream(landing.stream_log(spark, f"{tmp_path}/log", "json")).awaitTermination(120)
    assert count_by(streamed.ledger.read_all(), "status") == {"success": 2, "unreadable": 4}


def test_rows_without_a_place_in_a_given_table(spark, tmp_path):
    rows = [relation(0, USERS), change(1, "I", 100, new=["1", "a"]), (None, *change(2, "I", 100, new=["2", "b"])[1:]), commit(3, 1, 5)]
    for n, run in enumerate(("run_batch", "run_next")):
        pipeline = build(spark, spec_for(tmp_path / str(n)))
        ledger = getattr(pipeline, run)(raw(spark, rows))
        assert count_by(ledger, "status", "error") == {("success", None): 1, ("unreadable", "no seq"): 1}


def test_changes_without_a_position_are_not_cut_off(spark):
    rows = [relation(0, USERS), (1, None, *change(1, "I", 100, new=["1", "a"])[2:]), change(2, "I", 100, new=["1", "a"])]
    assert {r.seq for r in landing.from_position(raw(spark, rows), 5000).collect()} == {0, 1}
    assert {r.seq for r in ChangeLog.of(raw(spark, rows)).starting_at(5000).changes.collect()} == {1}


# -- the size of a micro-batch -----------------------------------------------------


def wide_log(spark, n):
    """One transaction of ``n`` inserts, each of them with a text that does not compress."""
    number, negative = F.col("id").cast("string"), (-F.col("id")).cast("string")
    values = F.array(number, F.concat(F.sha2(number, 512), F.sha2(negative, 512)))
    rows = spark.range(1, n + 1, numPartitions=4).select(
        F.col("id").alias("seq"),
        (F.col("id") + 1000).alias("lsn"),
        F.lit(1).alias("xid"),
        F.lit("I").alias("kind"),
        F.lit(100).alias("relation_id"),
        values.alias("new"),
    )
    ends = raw(spark, [relation(0, USERS), commit(n + 1, 1, 5)])
    return ends.unionByName(rows, allowMissingColumns=True).select(*ends.columns)


def rows_by_partition(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_a_landed_file_is_read_by_several_tasks(spark, tmp_path):
    landing.land_in_order(wide_log(spark, 60_000), f"{tmp_path}/log")
    files = list((tmp_path / "log").glob("*.parquet"))
    counts = rows_by_partition(landing.read_landed(spark, f"{tmp_path}/log"))
    assert len(files) == 1 and len(counts) > 1 and sum(counts) == 60_002


def test_a_micro_batch_of_one_partition_goes_to_all_cores(spark, tmp_path, monkeypatch):
    wide_log(spark, 20_000).coalesce(1).write.parquet(f"{tmp_path}/log")
    pipeline, seen = build(spark, spec_for(tmp_path, source=SourceSpec(path=f"{tmp_path}/log"))), []
    taken = pipeline._stream_batch
    monkeypatch.setattr(pipeline, "_stream_batch", lambda batch, n: (seen.append(rows_by_partition(batch)), taken(batch, n)))
    pipeline.run_stream().awaitTermination()
    (counts,) = seen
    assert sum(counts) == 20_002 and max(counts) * spark.sparkContext.defaultParallelism <= 2 * sum(counts)
    assert count_by(pipeline.ledger.read_all(), "status") == {"success": 20_000}


def test_small_or_even_batches_stay_as_they_are(spark):
    for n, parts in ((0, 1), (10, 1), (20_000, 4)):
        batch = spark.range(0, n, numPartitions=parts).withColumnRenamed("id", "seq")
        assert landing.spread_out(batch) is batch


def test_batches_elsewhere_in_the_log_are_not_compared(spark, tmp_path):
    rows, want, every = twice_delivered()
    log = ChangeLog.of(raw(spark, rows))
    found = delivery.identified(log.changes, log.begins)
    path = f"{tmp_path}/seen"
    far = found.withColumns({"lsn": F.col("lsn") + 1000, "seq": F.col("seq") + 1000})
    far.write.parquet(path)
    found.filter("lsn = 10").write.mode("append").parquet(path)
    seen = spark.read.parquet(path)
    near = delivery.near(seen, found)
    assert {r.lsn for r in near.collect()} == {10}
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lsn,10)" in plan and "LessThanOrEqual(lsn,50)" in plan
    assert delivery.near(None, found) is None and delivery.near(seen, found.limit(0)) is None
    expected = {r.seq for r in delivery.repeated(found, seen).collect()}
    assert {r.seq for r in delivery.repeated(found, near).collect()} == expected
    assert {r.seq for r in found.filter("lsn = 10").collect()} <= expected


def test_repeated_changes_are_fixed_once_a_batch(spark, tmp_path):
    rows, want, every = twice_delivered()
    spec = spec_for(tmp_path, source=SourceSpec(deliveries="first", ts_mode="last_seen_commit"))
    pipeline = build(spark, spec)
    pipeline.run_batch(raw(spark, rows))
    assert sorted(r.seq for r in pipeline.state.repeats.read(0).collect()) == sorted(set(every) - set(want))
    # Redelivered to the next batch: all of them are repeated, and only its own list is kept.
    pipeline.process(ChangeLog.of(raw(spark, [(r[0] + 1000, *r[1:]) for r in rows])), 1)
    again = {r.seq - 1000 for r in pipeline.state.repeats.read(1).collect()}
    assert again | {r.seq - 1000 for r in pipeline.ledger.read(1).filter("status != 'repeated'").collect()} == set(every)
    assert pipeline.state.repeats.numbers() == [1]
