"""Whole runs: outcomes, dead letters, retries, offsets, streams."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.operators import metrics, outcome
from millrace.operators import transforms as T
from millrace.operators.offsets import Offset, OffsetLedger
from millrace.sinks.console import ConsoleSink
from millrace.sinks.files import JsonLinesSink, TopicLogSink, retained
from millrace.sinks.registry import SinkRegistry
from millrace.spec import DlqSpec, MappingSpec, PipelineSpec, RetrySpec, SinkSpec, SourceSpec, TransformSpec
from millrace.streaming.runner import build
from tests.helpers import ORDERS, USERS, at, begin, change, commit, count_by, raw, relation

METRICS = (300, "public", "metrics", [("id", 23), ("x", 701)])


def simple_log():
    return [
        relation(0, USERS),
        relation(1, ORDERS),
        change(2, "I", 100, new=["1", "alice"], xid=1),
        change(3, "I", 200, new=["1", "1", "9.99"], xid=1),
        change(4, "I", 999, new=["1"], xid=1),
        commit(5, 1, 10),
        change(6, "U", 100, new=["1", "bob"], xid=2),
        commit(7, 2, 20),
    ]


class FlakySink(TopicLogSink):
    """Fails the first ``failures`` writes."""

    def __init__(self, path, failures):
        super().__init__(path)
        self.failures, self.writes = failures, 0

    def write(self, rows, batch_id):
        self.writes += 1
        if self.writes <= self.failures:
            raise ConnectionError("broker away")
        super().write(rows, batch_id)


def spec_for(tmp_path, *links, sink="topic_log", **parts):
    transform = TransformSpec(enabled=bool(links), modules=tuple(links))
    return PipelineSpec(
        transform=transform,
        sink=SinkSpec(type=sink, path=f"{tmp_path}/out"),
        work_dir=f"{tmp_path}/work",
        **{"retry": RetrySpec(3, 1), **parts},
    )


def dlq_at(tmp_path):
    return DlqSpec(True, SinkSpec(type="topic_log", path=f"{tmp_path}/dlq"))


def with_flaky(tmp_path, failures):
    registry, made = SinkRegistry(), []

    def make(spec, topics):
        made.append(FlakySink(spec.path, failures))
        return made[-1]

    registry.register("flaky", make)
    return registry, made


def values(spark, path):
    return [json.loads(bytes(r.value)) for r in spark.read.parquet(str(path)).collect()]


def test_success_and_decode_errors(spark, tmp_path):
    reports = []
    pipeline = build(spark, spec_for(tmp_path), on_batch=reports.append)
    ledger = pipeline.run_batch(raw(spark, simple_log()))
    assert count_by(ledger, "table", "op", "status") == {
        ("users", "create", "success"): 1,
        ("orders", "create", "success"): 1,
        ("users", "update", "success"): 1,
        (None, "create", "decode_error"): 1,
    }
    out = values(spark, tmp_path / "out")
    assert {e["ts"] for e in out} == {"2026-03-05T12:00:10Z", "2026-03-05T12:00:20Z"}
    assert pipeline.offsets.load() == Offset(1006, at(20))
    assert reports[0].counts["events"] == 4 and reports[0].counts["success"] == 3


def test_transform_failure_goes_to_dead_letters(spark, tmp_path):
    def fn(event):
        if event["table"] == "orders":
            raise ValueError("transform failed")
        return event

    spec = spec_for(tmp_path, T.UserFunction("fn", fn), dlq=dlq_at(tmp_path), mapping=MappingSpec({"dlq": "graveyard"}))
    ledger = build(spark, spec).run_batch(raw(spark, simple_log()))
    assert count_by(ledger, "status") == {"success": 2, "transform_error": 1, "decode_error": 1}
    assert ledger.filter("status = 'transform_error'").first().attempts == 3
    (letter,) = values(spark, tmp_path / "dlq")
    assert (letter["source"], letter["table"], letter["op"]) == ("postgres", "dlq", "dlq")
    body = letter["after"]
    assert body["error"] == "transform 0 failed\ntransform failed"
    assert (body["stage"], body["attempts"]) == ("transform", 3)
    assert body["event"]["table"] == "orders" and body["event"]["after"]["amount"] == "9.99"
    assert body["failed_at"] == letter["ts"] and "before" not in body["event"]
    assert spark.read.parquet(f"{tmp_path}/dlq").first().topic == "graveyard"
    assert {(r.component, r.error_type, r.n) for r in metrics.pipeline_errors(ledger).collect()} == {
        ("transform", "retry_exhausted", 1), ("transform", "dlq", 1),
    }


def test_failures_without_dead_letters_are_lost(spark, tmp_path):
    spec = spec_for(tmp_path, T.reject(F.col("table") == "orders", "no"))
    ledger = build(spark, spec).run_batch(raw(spark, simple_log()))
    assert count_by(ledger, "status") == {"success": 2, "lost": 1, "decode_error": 1}


def test_sink_recovers_on_the_second_try(spark, tmp_path):
    registry, made = with_flaky(tmp_path, 1)
    spec = spec_for(tmp_path, sink="flaky", dlq=dlq_at(tmp_path))
    ledger = build(spark, spec, registry=registry).run_batch(raw(spark, simple_log()))
    assert made[0].writes == 2 and spark.read.parquet(f"{tmp_path}/out").count() == 3
    assert count_by(ledger.filter("status = 'success'"), "attempts") == {2: 3}


def test_sink_outage(spark, tmp_path):
    registry, made = with_flaky(tmp_path, 99)
    spec = spec_for(
        tmp_path, T.rewrite({"table": F.lit("changed")}), sink="flaky", dlq=dlq_at(tmp_path), retry=RetrySpec(2, 1)
    )
    ledger = build(spark, spec, registry=registry).run_batch(raw(spark, simple_log()))
    assert made[0].writes == 2
    assert count_by(ledger, "status") == {"sink_error": 3, "decode_error": 1}
    letters = values(spark, tmp_path / "dlq")
    assert {x["after"]["event"]["table"] for x in letters} == {"users", "orders"}  # as before transforms
    assert all("after" in x["after"]["event"] and x["after"]["error"] == "broker away" for x in letters)
    failing = spec_for(tmp_path, sink="flaky", on_sink_failure="fail")
    with pytest.raises(RuntimeError, match="broker away"):
        build(spark, failing, registry=registry).run_batch(raw(spark, simple_log()))


def test_dead_letter_sink_failing_loses_events(spark, tmp_path):
    registry, _ = with_flaky(tmp_path, 99)
    spec = spec_for(
        tmp_path, T.reject(F.col("table") == "orders", "no"),
        dlq=DlqSpec(True, SinkSpec(type="flaky", path=f"{tmp_path}/dlq")),
    )
    ledger = build(spark, spec, registry=registry).run_batch(raw(spark, simple_log()))
    assert count_by(ledger, "status") == {"success": 2, "lost": 1, "decode_error": 1}


def test_unwritable_rows_fail_alone(spark, tmp_path):
    rows = [relation(0, METRICS), relation(1, USERS)]
    rows += [change(2, "I", 300, new=["1", "NaN"]), change(3, "I", 300, new=["2", "1.5"])]
    rows += [change(4, "I", 100, new=["1", "a"]), commit(5, 1, 1)]
    spec = spec_for(tmp_path, dlq=dlq_at(tmp_path), mapping=MappingSpec({"users": ""}))
    ledger = build(spark, spec).run_batch(raw(spark, rows))
    got = {r.seq: (r.status, r.stage, r.error) for r in ledger.collect()}
    assert got[2] == ("sink_error", "sink", f"marshal event: {outcome.NOT_FINITE}")
    assert got[3][0] == "success"
    assert got[4] == ("sink_error", "sink", "produce: empty topic")
    letters = {x["after"]["event"]["table"]: x for x in values(spark, tmp_path / "dlq")}
    assert letters["metrics"]["after"]["event"]["after"]["x"] == "NaN"


def test_transform_by_import_path(spark, tmp_path):
    spec = PipelineSpec(
        transform=TransformSpec(enabled=True, path="tests.test_runs:allow_users"),
        sink=SinkSpec(type="topic_log", path=f"{tmp_path}/out"),
        work_dir=f"{tmp_path}/work",
    )
    ledger = build(spark, spec).run_batch(raw(spark, simple_log()))
    assert count_by(ledger, "status") == {"success": 2, "filtered": 1, "decode_error": 1}


allow_users = T.allow("users")


def test_registry(spark):
    registry = SinkRegistry()
    with pytest.raises(ValueError, match="unsupported sink type: nope"):
        registry.create(SinkSpec(type="nope"))
    registry.register("mine", lambda spec, topics: ConsoleSink())
    assert isinstance(registry.create(SinkSpec(type="mine")), ConsoleSink)
    assert isinstance(registry.create(SinkSpec(type="file", path="/x")), JsonLinesSink)
    PipelineSpec(sink=SinkSpec(type="mine")).validate(registry.names())


def test_console(spark, tmp_path):
    spec = spec_for(tmp_path, sink="stdout")
    ledger = build(spark, spec).run_batch(raw(spark, simple_log()))
    assert count_by(ledger, "status") == {"success": 3, "decode_error": 1}


def line_rows(spark, n):
    return spark.createDataFrame([(i, f'{{"id":{i}}}') for i in range(n)], "seq bigint, line string")


def test_rotation_and_retention(spark, tmp_path):
    sink = JsonLinesSink(str(tmp_path / "log"), max_size=50)
    sink.write(line_rows(spark, 200).coalesce(1), 0)
    segments = sink.segments(spark).collect()
    assert sum(s.n for s in segments) == 200 and max(s.bytes for s in segments) <= 50
    assert spark.read.text(f"{sink.path}/lines").count() == 200
    sink.write(line_rows(spark, 200).coalesce(1), 0)  # again: replaced
    assert spark.read.text(f"{sink.path}/lines").count() == 200

    small = JsonLinesSink(str(tmp_path / "kept"), max_size=50, max_files=3)
    small.write(line_rows(spark, 100).coalesce(1), 0)
    small.write(line_rows(spark, 100).coalesce(1), 1)
    left = spark.read.text(f"{small.path}/lines")
    assert left.select("batch", "writer", "segment").distinct().count() in (4, 5)
    assert count_by(left, "batch").keys() == {1}
    assert retained(small.segments(spark), 0, 50).count() == small.segments(spark).count()


@pytest.mark.parametrize("tasks", [1, 4, 32])
def test_retention_keeps_what_fits_whatever_the_tasks(spark, tmp_path, tasks):
    rows = line_rows(spark, 500).repartition(tasks)
    sink = JsonLinesSink(str(tmp_path / "kept"), max_size=10_000, max_files=1)
    sink.write(rows, 0)  # all of it is below the limit
    assert spark.read.text(f"{sink.path}/lines").count() == 500
    sink.write(rows, 1)
    sink.write(rows, 2)
    left = spark.read.text(f"{sink.path}/lines")
    assert count_by(left, "batch")[2] == 500
    assert left.agg(F.sum(F.length("value") + 1)).first()[0] >= 10_000


def test_a_line_over_the_limit_has_its_own_segment(spark, tmp_path):
    rows = spark.createDataFrame([(0, "a"), (1, "x" * 100), (2, "b")], "seq bigint, line string")
    sink = JsonLinesSink(str(tmp_path / "log"), max_size=50)
    sink.write(rows.coalesce(1), 0)
    assert sorted(s.bytes for s in sink.segments(spark).collect()) == [2, 2, 101]


def test_offsets(spark, tmp_path):
    ledger = OffsetLedger(spark, str(tmp_path / "offsets"))
    assert ledger.load() == Offset() and ledger.load().is_zero
    ledger.flush(0)
    assert ledger.load() == Offset()
    when = datetime(2026, 3, 11, 6, 0, tzinfo=timezone.utc)
    for lsn in (100, 200, 12345):
        ledger.mark(Offset(lsn, when))
    assert ledger.load() == Offset()
    ledger.flush(0)
    assert OffsetLedger(spark, ledger.path).load() == Offset(12345, when)
    ledger.mark(Offset(7))
    ledger.flush(1)
    assert ledger.load() == Offset(7, None)
    (tmp_path / "offsets" / "batch=2").mkdir()
    (tmp_path / "offsets" / "batch=2" / "x.json").write_text("{corrupt")
    with pytest.raises(ValueError, match="parse offset"):
        ledger.load()


def test_scope_drift(spark):
    def tables(*names):
        return spark.createDataFrame([(n,) for n in names], "table string")

    def drift(a, b):
        return {tuple(r) for r in metrics.scope_drift(tables(*a), tables(*b)).collect()}

    assert drift(["a", "b"], ["b", "a", "a"]) == set()
    assert drift(["a"], ["a", "b"]) == {("b", "captured_only")}
    assert drift(["a", "c"], ["a", "b"]) == {("c", "configured_only"), ("b", "captured_only")}
    assert metrics.scope_drift(spark.createDataFrame([], "table string"), tables("a")).count() == 1


def test_snapshots(spark):
    from millrace.sources.snapshots import as_events, snapshot_diff

    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 1.0)], "id int, v string, w double")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", None)], "id int, v string, w double")
    diff = snapshot_diff(old, new, ["id"], "t")
    assert {(r.id, r.op) for r in diff.collect()} == {(2, "update"), (3, "delete"), (4, "create")}
    events = as_events(diff, ["id"], 7, at(1)).withColumn("after", F.to_json("after"))
    assert {r.after for r in events.collect()} == {None, '{"id":2,"v":"b","w":2.0}', '{"id":4,"v":"d","w":null}'}
    with pytest.raises(Exception, match="before snapshot: repeated key"):
        snapshot_diff(old.unionAll(old), new, ["id"], "t").collect()
    plan = snapshot_diff(old, new, ["id"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


# -- streams -----------------------------------------------------------------------


def stream_log_rows():
    wider = (100, "public", "people", [("id", 20), ("name", 25), ("age", 21)])
    rows = [relation(0, USERS), relation(1, ORDERS)]
    seq = 2
    for xid in range(12):
        rows.append(begin(seq, xid))
        seq += 1
        if xid == 6:
            rows.append(relation(seq, wider))
            seq += 1
        for i in range(4 if xid != 8 else 30):
            layout = 100 if i % 2 else 200
            new = ["1", "2", "3.5"] if layout == 200 else ["1", "n"]
            rows.append(change(seq, "I", layout, new=new, xid=xid))
            seq += 1
        rows.append(commit(seq, xid, xid))
        seq += 1
    return rows


def land(spark, rows, path, cuts):
    """Files in arrival order; cuts fall inside transactions."""
    import os
    import time

    for i, (start, end) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        part = rows[start:end]
        raw(spark, part).coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if name.endswith(".parquet") and not os.path.getmtime(full) < 1_700_000_000:
                os.utime(full, (1_600_000_000 + i, 1_600_000_000 + i))
    return time.time()


def account(ledger):
    rows = ledger.select("seq", "table", "op", "status", F.unix_micros("ts").alias("us")).collect()
    return sorted((r.seq, r.table, r.op, r.status, r.us) for r in rows)


@pytest.mark.parametrize("ts_mode", ["transaction", "last_seen_commit"])
def test_stream_equals_batch(spark, tmp_path, ts_mode):
    from millrace.sources.landing import stream_log

    rows = stream_log_rows()
    source = SourceSpec(ts_mode=ts_mode)
    batch = build(spark, spec_for(tmp_path / "b", T.allow("users", "people"), source=source))
    want = account(batch.run_batch(raw(spark, rows)))
    log = str(tmp_path / "log")
    land(spark, rows, log, [5, 17, 44, 50, 58, 80])
    stream = build(spark, spec_for(tmp_path / "s", T.allow("users", "people"), source=source))

    def run():
        stream.run_stream(stream_log(spark, log, max_files=1)).awaitTermination(120)

    run()
    got = account(stream.ledger.read_all())
    assert got == want
    assert sum(1 for r in got if r[1] == "people") > 0
    out = spark.read.parquet(str(tmp_path / "s" / "out")).count()
    assert out == spark.read.parquet(str(tmp_path / "b" / "out")).count()
    run()  # same checkpoint: nothing new
    assert account(stream.ledger.read_all()) == want
    assert stream.offsets.load() == batch.offsets.load()


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    rows = stream_log_rows()
    pipeline = build(spark, spec_for(tmp_path))
    first, second = raw(spark, rows[:30]), raw(spark, rows[30:])
    pipeline.stream_batch(first, 0)
    pipeline.stream_batch(second, 1)
    once = account(pipeline.ledger.read_all())
    pipeline.stream_batch(second, 1)
    assert account(pipeline.ledger.read_all()) == once
    assert spark.read.parquet(str(tmp_path / "out")).count() == len([r for r in once if r[3] == "success"])


def test_held_rows_are_kept_until_their_commit_and_then_dropped(spark, tmp_path):
    rows = [relation(0, USERS)] + [change(i, "I", 100, new=["1", "n"], xid=1) for i in range(1, 9)]
    pipeline = build(spark, spec_for(tmp_path))
    for n in range(4):
        pipeline.stream_batch(raw(spark, rows[n * 2 : n * 2 + 2]), n)
        assert pipeline.ledger.read(n).count() == 0
    pipeline.stream_batch(raw(spark, rows[8:] + [commit(9, 1, 33)]), 4)
    done = pipeline.ledger.read(4).collect()
    assert [r.seq for r in sorted(done)] == list(range(1, 9)) and {r.ts.second for r in done} == {33}
    for n in (5, 6):
        more = [change(10 * n, "I", 100, new=["1", "n"], xid=n), commit(10 * n + 1, n, 40)]
        pipeline.stream_batch(raw(spark, more), n)
    assert not any(pipeline.state.held.has(n) for n in range(4))
    assert account(pipeline.ledger.read(6)) == [(60, "users", "create", "success", int(at(40).timestamp()) * 10**6)]


def test_live_progress(spark, tmp_path):
    from millrace.sources.landing import stream_log
    from millrace.streaming.progress import ProgressLog

    log, progress, reports = str(tmp_path / "log"), ProgressLog(), []
    raw(spark, simple_log()).coalesce(1).write.parquet(log)
    spark.streams.addListener(progress)
    try:
        pipeline = build(spark, spec_for(tmp_path), on_batch=reports.append)
        pipeline.run_stream(stream_log(spark, log)).awaitTermination(120)
        for _ in range(50):
            if progress.batches:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(progress)
    assert progress.batches[0][1] >= 8 and not progress.failures
    assert reports[0].counts["success"] == 3


def test_messages_as_a_log(spark):
    from millrace.sources.landing import log_from_messages

    values = ['{"seq":1,"lsn":"7","xid":1,"kind":"I","relation_id":100,"new":["1","a"]}', "junk", '{"seq":2}']
    messages = spark.createDataFrame([(v.encode(),) for v in values], "value binary")
    (row,) = log_from_messages(messages).collect()
    assert (row.seq, row.lsn, row.kind, row.new) == (1, 7, "I", ["1", "a"])
