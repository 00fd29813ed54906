"""The registered queries: each runs one or more operators over whole tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import envelope as env
from millrace.operators import metrics, outcome, routing
from millrace.operators import transforms as T
from millrace.operators.decode import (
    ChangeLog,
    decode,
    errors_of,
    events_of,
    table_view,
)
from millrace.operators.unchanged import fill_unchanged
from millrace.plans import derived_log as logs
from millrace.session import configure, shared_folder
from millrace.sinks.files import JsonLinesSink, TopicLogSink, with_segments
from millrace.sinks.registry import SinkRegistry
from millrace.sources import landing
from millrace.sources.landing import land_in_order, stream_log
from millrace.sources.snapshots import snapshot_diff
from millrace.spec import DlqSpec, PipelineSpec, RetrySpec, SinkSpec, SourceSpec, TransformSpec
from millrace.streaming.runner import build

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOPICS = {"users": "prod.users.events", "orders": "prod.orders.events"}
SEGMENT_BYTES = 100_000


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    root = shared_folder(spark)
    if "://" in root and not root.startswith("file:"):
        stamp = spark.sql("SELECT uuid()").first()[0]
        return f"{root}/{name}-{stamp}"
    return tempfile.mkdtemp(prefix=f"{name}-", dir=root.removeprefix("file://").removeprefix("file:"))


def _images(df: DataFrame, *keep: str) -> DataFrame:
    """Images as JSON text; VARIANT itself cannot be compared."""
    return df.select(
        *keep,
        F.to_json("before").alias("before_json"),
        F.to_json("after").alias("after_json"),
    )


# -- decode ------------------------------------------------------------------------


@query
def routed_changes(spark, sf_dir):
    """How many creates, updates and deletes of the allowed tables go to each topic."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    kept = T.allow_tables(events, ["users", "orders", "sales.orders", "sessions"])
    topic = routing.topic_of(F.col("table"), TOPICS).alias("topic")
    return kept.groupBy("table", "op", topic).agg(F.count(F.lit(1)).alias("n"))


@query
def decode_events(spark, sf_dir):
    """Layout lookup, naming, operation and images of every change that decodes."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    return _images(events, "seq", "lsn", "source", "table", "op")


@query
def decode_images(spark, sf_dir):
    """Images of a table with a column of almost every type, as they go on the wire."""
    events = events_of(decode(logs.orders_log(spark, sf_dir), ts_mode=None))
    return _images(events, "seq", "table", "op", "not_finite")


@query
def decode_typed(spark, sf_dir):
    """The same table as typed columns."""
    view = table_view(
        logs.orders_log(spark, sf_dir), "order_facts", logs.ORDER_COLUMNS, keep_errors=True
    )
    row = view.withColumn("r", F.coalesce("after", "before"))
    good = row.filter(~F.col("failed"))
    return good.select(
        "seq",
        "op",
        "r.order_key",
        "r.cust_key",
        "r.status",
        "r.total",
        F.isnan("r.rate").alias("rate_is_nan"),
        F.when(~F.isnan("r.rate"), F.col("r.rate")).alias("rate"),
        F.col("r.order_date").cast("string").alias("order_date"),
        F.unix_micros(F.col("r.created").cast("timestamp")).alias("created_us"),
        F.unix_micros("r.seen").alias("seen_us"),
        "r.at",
        "r.urgent",
        "r.priority",
        F.to_json("r.meta").alias("meta_json"),
        "r.tags",
        F.octet_length("r.blob").alias("blob_bytes"),
        "r.uid",
    )


@query
def typed_view_layouts(spark, sf_dir):
    """A table as typed columns while its layout changes: by the layout in force, with what does not fit."""
    view = table_view(logs.drifting_log(spark, sf_dir), "drifting", logs.DRIFT_VIEW, keep_errors=True)
    row = view.withColumn("r", F.coalesce("after", "before"))
    total = F.col("r.total").cast("string").alias("total")
    return row.select("seq", "op", "r.order_key", "r.cust_key", "r.status", total, "failed", "error")


@query
def decode_errors(spark, sf_dir):
    """Changes whose layout is unknown."""
    decoded = decode(logs.events_log(spark, sf_dir), ts_mode=None)
    return errors_of(decoded).select("seq", "lsn", "op", "error")


@query
def tuple_errors(spark, sf_dir):
    """Changes whose tuple does not fit its layout, with the first reason."""
    decoded = decode(logs.orders_log(spark, sf_dir), ts_mode=None)
    return errors_of(decoded).select("seq", "table", "op", "error")


def _stamped(spark, sf_dir, mode):
    decoded = decode(logs.events_log(spark, sf_dir), ts_mode=mode)
    return decoded.select("seq", "xid", F.unix_micros("ts").alias("ts_us"))


@query
def commit_time_transaction(spark, sf_dir):
    """Each change stamped with its own transaction's commit time."""
    return _stamped(spark, sf_dir, "transaction")


@query
def commit_time_last_seen(spark, sf_dir):
    """Each change stamped with the last commit that arrived before it."""
    return _stamped(spark, sf_dir, "last_seen_commit")


@query
def message_kinds(spark, sf_dir):
    """Messages by kind, and whether the kind gives an event."""
    raw = logs.raw_log(logs.events_log(spark, sf_dir))
    gives = F.col("kind").isin(*S.CHANGE_KINDS).alias("is_change")
    return raw.groupBy("kind", gives).agg(F.count(F.lit(1)).alias("n"))


@query
def scope_filter(spark, sf_dir):
    """Only the captured tables."""
    log = logs.events_log(spark, sf_dir)
    return events_of(decode(log, ts_mode=None, tables=["users", "sales.orders"])).select("seq", "table", "op")


@query
def start_position(spark, sf_dir):
    """Changes from a position on."""
    log = logs.events_log(spark, sf_dir).starting_at(16777216 + 64 * 500)
    return events_of(decode(log, ts_mode=None)).select("seq", "lsn", "table", "op")


# -- snapshots ---------------------------------------------------------------------


@query
def snapshot_diff_orders(spark, sf_dir):
    """Changes between two states of ``orders``."""
    orders = logs.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    old = orders.filter(key % 10 != 0)
    new = orders.filter(key % 10 != 1).withColumn(
        "o_orderstatus", F.when(key % 7 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    )
    diff = snapshot_diff(old, new, ["o_orderkey"], "orders")
    return diff.select(
        "o_orderkey",
        "source",
        "table",
        "op",
        F.col("before.o_orderstatus").alias("status_before"),
        F.col("after.o_orderstatus").alias("status_after"),
        F.coalesce("after.o_custkey", "before.o_custkey").alias("o_custkey"),
    )


@query
def snapshot_diff_customer(spark, sf_dir):
    """Changes between two states of ``customer``, null-safe."""
    customer = logs.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    old = customer.filter(key % 5 != 0).withColumn(
        "c_mktsegment", F.when(key % 3 != 0, F.col("c_mktsegment"))
    )
    new = customer.filter(key % 5 != 1).withColumn(
        "c_mktsegment", F.when(key % 3 != 1, F.col("c_mktsegment"))
    )
    diff = snapshot_diff(old, new, ["c_custkey"], "customer")
    return diff.select(
        "c_custkey",
        "op",
        F.col("before.c_mktsegment").alias("segment_before"),
        F.col("after.c_mktsegment").alias("segment_after"),
    )


# -- envelope ----------------------------------------------------------------------


def _stamped_events(spark, sf_dir):
    return events_of(decode(logs.events_log(spark, sf_dir)))


@query
def envelope_write(spark, sf_dir):
    """Every event as its JSON line."""
    return _stamped_events(spark, sf_dir).select("seq", env.envelope().alias("line"))


@query
def envelope_roundtrip(spark, sf_dir):
    """Every event written and read back."""
    lines = _stamped_events(spark, sf_dir).select("seq", env.envelope().alias("value"))
    read = env.parse_envelopes(lines)
    return _images(
        read.withColumn("ts_us", F.unix_micros("ts")), "seq", "source", "table", "op", "ts_us", "error"
    )


@query
def envelope_reader(spark, sf_dir):
    """Lines of which some are not envelopes."""
    n = F.col("event_id") % 8
    number = F.col("event_id").cast("string")
    line = (
        F.when(n == 0, F.lit("{broken"))
        .when(n == 1, F.lit("{}"))
        .when(n == 2, F.lit("[1]"))
        .when(n == 3, F.concat(F.lit('{"table":'), number, F.lit("}")))
        .when(n == 4, F.concat(F.lit('{"table":"t","after":{"id":'), number, F.lit('},"before":{}}')))
        .when(n == 5, F.lit('{"source":"s","table":"t","op":"create","ts":"yesterday"}'))
        .when(n == 6, F.lit('{"table":"t","after":[1]}'))
        .otherwise(F.lit('{"source":"s","op":"delete","ts":"2026-03-05T12:00:00.25+02:00","before":{"id":1}}'))
    )
    lines = logs.table(spark, sf_dir, "events").select("event_id", line.alias("value"))
    read = env.parse_envelopes(lines).withColumn("ts_us", F.unix_micros("ts"))
    good = F.col("error").isNull()
    return read.select(
        "event_id",
        "error",
        *(F.when(good, F.col(c)).alias(c) for c in ("source", "table", "op", "ts_us")),
        F.when(good, F.to_json("before")).alias("before_json"),
        F.when(good, F.to_json("after")).alias("after_json"),
    )


@query
def position_text(spark, sf_dir):
    """Positions as text."""
    key = F.col("o_orderkey")
    lsn = F.when(key % 10 != 0, logs.wrapped_product(key, 1311768467294))
    orders = logs.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", env.position_text(lsn).alias("position"))


# -- transforms --------------------------------------------------------------------


@query
def allow_list(spark, sf_dir):
    """The allow-list as a link: every event with its outcome."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    staged = T.chain(outcome.begin(events), [T.allow("users", "orders")])
    return staged.select("seq", "table", F.coalesce("status", F.lit(outcome.SUCCESS)).alias("status"))


@query
def chain_filter_enrich_mask(spark, sf_dir):
    """Filter, enrich from a dimension, mask a field."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    customers = logs.table(spark, sf_dir, "customer")
    links = [
        T.allow("users", "orders", "sales.orders"),
        T.enrich(customers, ("user_id", "c_custkey"), {"segment": "c_mktsegment"}),
        T.mask("amount"),
    ]
    staged = T.chain(outcome.begin(events), links).filter(outcome.is_live())
    return _images(staged, "seq", "table", "op")


@query
def enrich_large(spark, sf_dir):
    """Enriched from a dimension too large to send to every task, after a user function; one key is hot."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    customers = logs.table(spark, sf_dir, "customer")
    links = [
        T.UserFunction("crowd", crowd),
        T.enrich(customers, ("customer", "c_custkey"), {"segment": "c_mktsegment"}, broadcast_rows=10),
    ]
    staged = T.chain(outcome.begin(events), links).filter(outcome.is_live())
    return staged.select("seq", "op", F.try_variant_get("after", "$.segment", "string").alias("segment"), "attempts")


def crowd(event: dict) -> dict:
    """Every third customer's events become customer 1's."""
    if "after" in event:
        user = event["after"].pop("user_id", None)
        event["after"]["customer"] = 1 if user is not None and user % 3 == 0 else user
    return event


def settle(event: dict) -> dict | None:
    """Drops deletes, refuses some rows, and rewrites the rest."""
    if event["op"] == "delete":
        return None
    user = event["after"].get("user_id", 0)
    if user % 10 == 3:
        raise ValueError(f"user {user} refused")
    event["after"]["cents"] = int(event["after"]["amount"].replace(".", ""))
    event["table"] = f"{event['table']}_settled"
    return event


def shout(event: dict) -> dict:
    event["op"] = event["op"].upper()
    return event


@query
def user_function(spark, sf_dir):
    """Two chained Python functions, with drops and failures."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    links = [T.UserFunction("settle", settle), T.UserFunction("shout", shout)]
    staged = T.chain(outcome.begin(events), links, max_attempts=2, backoff_ms=0)
    return staged.select(
        "seq",
        "table",
        "op",
        F.coalesce("status", F.lit(outcome.SUCCESS)).alias("status"),
        "error",
        "attempts",
        F.to_json("after").alias("after_json"),
    )


# -- outcomes ----------------------------------------------------------------------


def _finished(spark, sf_dir):
    """The orders log through a chain with drops and failures, routed with one bad topic."""
    decoded = decode(logs.orders_log(spark, sf_dir), ts_mode="transaction")
    after_key = F.expr("try_variant_get(coalesce(after, before), '$.order_key', 'bigint')")
    links = [
        T.keep(after_key % 4 != 0),
        T.reject(after_key % 10 == 7, "seven", "sevens"),
        T.rewrite(
            {"table": F.when(after_key % 10 == 1, F.lit("nowhere")).otherwise(F.col("table"))}
        ),
    ]
    staged = T.chain(outcome.begin(decoded), links)
    records = routing.to_records(staged, {"nowhere": ""})
    return outcome.finish(outcome.mark_unwritable(records), 3, dead_letters=True)


@query
def outcome_split(spark, sf_dir):
    """How every change of the log ends."""
    return _finished(spark, sf_dir).select(
        "seq", F.col("origin.table").alias("table"), "status", "stage", "error", "attempts"
    )


@query
def dead_letters(spark, sf_dir):
    """The dead letters of the same run; clock columns left out."""
    failed = _finished(spark, sf_dir).filter(F.col("status").isin(*outcome.FAILED))
    letters = outcome.dead_letters(failed, F.current_timestamp())

    def part(path, kind="string"):
        return F.try_variant_get("after", f"$.{path}", kind)

    return letters.select(
        "seq",
        "source",
        "table",
        "op",
        part("event.table").alias("event_table"),
        part("event.op").alias("event_op"),
        part("event.ts").alias("event_ts"),
        F.coalesce(part("event.after.order_key", "bigint"), part("event.before.order_key", "bigint")).alias(
            "order_key"
        ),
        part("error").alias("error"),
        part("stage").alias("stage"),
        part("attempts", "int").alias("attempts"),
    )


@query
def high_water_mark(spark, sf_dir):
    """The position to resume from after that run."""
    ledger = outcome.ledger_rows(_finished(spark, sf_dir), F.current_timestamp())
    return outcome.high_water_mark(ledger).select(
        "lsn", F.unix_micros("commit_ts").alias("commit_us")
    )


# -- routing and sinks -------------------------------------------------------------


@query
def topic_route(spark, sf_dir):
    """Topic of each table, mapped or default."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    topic = routing.topic_of(F.col("table"), TOPICS).alias("topic")
    return events.groupBy("table", topic).agg(F.count(F.lit(1)).alias("n"))


@query
def topic_route_table(spark, sf_dir):
    """Topics from a mapping table: customers by market segment, segments mapped from the data."""
    customers = logs.table(spark, sf_dir, "customer")
    mapping = (
        customers.filter(F.col("c_mktsegment") < "G")
        .groupBy(F.col("c_mktsegment").alias("table"))
        .agg(F.concat(F.lit("seg."), F.min("c_custkey").cast("string")).alias("topic"))
    )
    events = customers.select("c_custkey", F.col("c_mktsegment").alias("table"))
    return routing.with_topic(events, mapping)


def _text(records: DataFrame) -> DataFrame:
    return records.select(
        "seq", "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


@query
def default_records(spark, sf_dir):
    """Records keyed by table with the envelope as value."""
    return _text(routing.to_records(_stamped_events(spark, sf_dir), TOPICS))


OUTBOX = routing.Outbox("aggregate_id", "event_type", "payload")


@query
def outbox_shape(spark, sf_dir):
    """Key, topic and value from outbox columns, each falling back on its own."""
    events = events_of(decode(logs.outbox_log(spark, sf_dir), ts_mode=None))
    return _text(routing.to_records(events, None, OUTBOX))


@query
def key_order(spark, sf_dir):
    """Records out of order per key, after arranging them."""
    events = events_of(decode(logs.outbox_log(spark, sf_dir), ts_mode=None))
    ordered = routing.in_key_order(routing.to_records(events, None, OUTBOX), 16)
    return routing.order_violations(ordered).select(
        "topic", F.col("key").cast("string").alias("key"), "n_records", "violations"
    )


@query
def sink_topic_log(spark, sf_dir):
    """Records written by topic and read back."""
    sink = TopicLogSink(_scratch(spark, "topics"), TOPICS)
    sink.write(sink.prepare(_stamped_events(spark, sf_dir)), 0)
    stored = spark.read.parquet(sink.path)
    return stored.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.sum(F.octet_length("value")).alias("value_bytes"),
    )


@query
def sink_json_lines(spark, sf_dir):
    """Lines written to files and read back."""
    sink = JsonLinesSink(_scratch(spark, "lines"))
    sink.write(sink.prepare(_stamped_events(spark, sf_dir)), 0)
    stored = spark.read.text(f"{sink.path}/lines")
    table = F.get_json_object("value", "$.table").alias("table")
    return stored.groupBy(table).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("line_bytes")
    )


@query
def sink_segments(spark, sf_dir):
    """Rotation: all lines are in some segment, and no segment is over the limit."""
    lines = _stamped_events(spark, sf_dir).select("seq", env.envelope().alias("line"))
    segments = (
        with_segments(lines, SEGMENT_BYTES)
        .groupBy("writer", "segment")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("line") + 1).alias("bytes"))
    )
    return segments.agg(
        F.sum("n").alias("n_lines"),
        F.sum("bytes").alias("n_bytes"),
        F.count_if(F.col("bytes") > SEGMENT_BYTES).alias("over_limit"),
    )


# -- metrics -----------------------------------------------------------------------


def _ledger(spark, sf_dir):
    """A ledger derived from ``events``: times and durations come from its columns."""
    events = logs.table(spark, sf_dir, "events")
    event_id = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    status = (
        F.when(event_id % 11 == 0, F.lit(outcome.TRANSFORM_ERROR))
        .when(event_id % 13 == 0, F.lit(outcome.SINK_ERROR))
        .when(event_id % 17 == 0, F.lit(outcome.LOST))
        .when(event_id % 19 == 0, F.lit(outcome.FILTERED))
        .when(event_id % 23 == 0, F.lit(outcome.DECODE_ERROR))
        .otherwise(F.lit(outcome.SUCCESS))
    )
    ts = F.col("ts").cast("timestamp")
    return events.select(
        event_id.alias("seq"),
        (event_id * 64).alias("lsn"),
        F.col("event_type").alias("table"),
        F.when(event_id % 4 == 0, F.lit("create")).otherwise(F.lit("update")).alias("op"),
        status.alias("status"),
        F.when(event_id % 11 == 0, F.lit("transform"))
        .when((event_id % 13 == 0) | (event_id % 17 == 0), F.lit("sink"))
        .alias("stage"),
        (k / 65536).alias("transform_s"),
        (k * k / 1024).alias("sink_s"),
        F.when(event_id % 29 != 0, ts).alias("ts"),
        (ts + F.expr("make_dt_interval(0, 0, 0, CAST(event_id % 60 AS DECIMAL(18, 6)))")).alias("processed_at"),
    )


@query
def events_processed(spark, sf_dir):
    """Counter of events by table, operation and outcome."""
    return metrics.events_processed(_ledger(spark, sf_dir))


@query
def pipeline_errors(spark, sf_dir):
    """Counter of errors by component and kind."""
    return metrics.pipeline_errors(_ledger(spark, sf_dir))


@query
def replication_lag(spark, sf_dir):
    """Lag of the last event."""
    return metrics.replication_lag(_ledger(spark, sf_dir))


@query
def lag_by_table(spark, sf_dir):
    """Lag of each table's last event."""
    return metrics.replication_lag(_ledger(spark, sf_dir), by_table=True)


def _buckets(df: DataFrame) -> DataFrame:
    le = F.when(F.col("le") == float("inf"), F.lit("+Inf")).otherwise(
        (F.col("le") * 10000).cast("bigint").cast("string")
    )
    return df.select(le.alias("le"), "n", "count", "sum")


@query
def transform_histogram(spark, sf_dir):
    """Histogram of transform times; ``le`` in tenths of a millisecond."""
    return _buckets(metrics.histogram(_ledger(spark, sf_dir), "transform_s", metrics.TRANSFORM_BOUNDS))


@query
def sink_histogram(spark, sf_dir):
    """Histogram of sink times; ``le`` in tenths of a millisecond."""
    return _buckets(metrics.histogram(_ledger(spark, sf_dir), "sink_s", metrics.SINK_BOUNDS))


@query
def scope_drift(spark, sf_dir):
    """Captured tables against configured ones."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    configured = spark.createDataFrame(
        [(t,) for t in ("users", "orders", "products", "users")], "table string"
    )
    return metrics.scope_drift(configured, events.select("table"))


# -- whole runs --------------------------------------------------------------------


def _run_spec(folder: str, **source) -> PipelineSpec:
    return PipelineSpec(
        source=SourceSpec(**source),
        transform=TransformSpec(enabled=True, modules=(T.allow("users", "orders", "sales.orders"),)),
        sink=SinkSpec(type="topic_log", path=f"{folder}/out"),
        work_dir=f"{folder}/work",
    )


def _summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("table", "op", "status").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.unix_micros("ts")).alias("first_ts_us"),
        F.max(F.unix_micros("ts")).alias("last_ts_us"),
    )


@query
def run_batch(spark, sf_dir):
    """The whole pipeline over the whole log: what its ledger says."""
    folder = _scratch(spark, "batch")
    raw = logs.raw_log(logs.events_log(spark, sf_dir))
    return _summary(build(spark, _run_spec(folder)).run_batch(raw))


@query
def run_stream(spark, sf_dir):
    """The same log landed in files and streamed in several micro-batches."""
    folder = _scratch(spark, "stream")
    land_in_order(logs.raw_log(logs.events_log(spark, sf_dir)), f"{folder}/log", min_files=3)
    pipeline = build(spark, _run_spec(folder, path=f"{folder}/log"))
    pipeline.run_stream(stream_log(spark, f"{folder}/log", max_files=1)).awaitTermination()
    return _summary(pipeline.ledger.read_all())


# -- recovery ----------------------------------------------------------------------


def _in_three_runs(spark, sf_dir):
    """The log landed in three parts, cut inside transactions, with a batch run after each."""
    folder = _scratch(spark, "resume")
    raw = logs.raw_log(logs.events_log(spark, sf_dir))
    last = logs.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    cuts = [None, last // 3 * 10 + 5, last * 2 // 3 * 10 + 5, None]
    pipeline = build(spark, _run_spec(folder, path=f"{folder}/log", resume=True))
    for after, until in zip(cuts, cuts[1:]):
        part = raw if after is None else raw.filter(F.col("seq") > after)
        part = part if until is None else part.filter(F.col("seq") <= until)
        part.write.mode("append").parquet(f"{folder}/log")
        pipeline.run_batch()
    return pipeline


@query
def resume_batch(spark, sf_dir):
    """Three batch runs, each from where the one before stopped, say what one over the whole log says."""
    return _summary(_in_three_runs(spark, sf_dir).ledger.read_all())


@query
def offset_ledger(spark, sf_dir):
    """The position that each of these runs reached."""
    reached = _in_three_runs(spark, sf_dir).offsets.table()
    return reached.select("batch", "lsn", F.unix_micros("commit_time").alias("commit_us"))


def _delivered_twice(spark, sf_dir, later: str = "INTERVAL '0' HOUR"):
    """The log, and after it all of it again under new sequence numbers."""
    raw = logs.raw_log(logs.events_log(spark, sf_dir))
    last = logs.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    again = raw.withColumns(
        {"seq": F.col("seq") + (last + 10_000) * 10, "commit_ts": F.col("commit_ts") + F.expr(later)}
    )
    return raw.unionByName(again)


@query
def replayed_stream(spark, sf_dir):
    """A log delivered twice and streamed in micro-batches: every event once, the rest accounted for."""
    folder = _scratch(spark, "replay")
    land_in_order(_delivered_twice(spark, sf_dir), f"{folder}/log", min_files=4)
    pipeline = build(spark, _run_spec(folder, path=f"{folder}/log", deliveries="first"))
    pipeline.run_stream(stream_log(spark, f"{folder}/log", max_files=1)).awaitTermination()
    return _summary(pipeline.ledger.read_all())


@query
def replayed_batch(spark, sf_dir):
    """The same log in one batch."""
    folder = _scratch(spark, "replay")
    pipeline = build(spark, _run_spec(folder, deliveries="first"))
    return _summary(pipeline.run_batch(_delivered_twice(spark, sf_dir)))


@query
def commit_time_redelivered(spark, sf_dir):
    """Commit times where every transaction is delivered twice, the second time an hour later."""
    log = ChangeLog.of(_delivered_twice(spark, sf_dir, "INTERVAL '1' HOUR"))

    def stamped(mode):
        times = decode(log, ts_mode=mode)
        return times.select("seq", "xid", F.lit(mode).alias("mode"), F.unix_micros("ts").alias("ts_us"))

    return stamped("transaction").unionByName(stamped("last_seen_commit"))


@query
def unreadable_input(spark, sf_dir):
    """Landed lines that can't be used, or only in part, by reason; the usable ones with their positions."""
    n, number = F.col("event_id") % 11, F.col("event_id").cast("string")

    def line(seq, lsn, kind):
        return F.concat(F.lit(f"{{{seq}"), number, F.lit(f',"lsn":"{lsn}'), number, F.lit(f'"{kind}}}'))

    value = (
        F.when(n == 0, F.lit("{broken"))
        .when(n == 1, line('"xid":', "", ',"kind":"I"'))
        .when(n == 2, line('"seq":', "", ""))
        .when(n == 3, line('"seq":', "x", ',"kind":"U"'))
        .when(n == 4, F.lit("  "))
        .otherwise(line('"seq":', "", ',"kind":"D"'))
    )
    landed = landing.parsed_lines(logs.table(spark, sf_dir, "events").select(value.alias("value")))
    bad = landing.rejects(landed).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("total")
    )
    good = landing.usable(landed).agg(F.count(F.lit(1)).alias("n"), F.sum("lsn").alias("total"))
    return bad.unionByName(good.select(F.lit("usable").alias("reason"), "n", "total"))


# -- the rest of a run -------------------------------------------------------------


@query
def unchanged_columns(spark, sf_dir):
    """A large column that most updates do not send: from the old row, or from its row's last state."""
    log = logs.cards_log(spark, sf_dir)
    events = events_of(decode(fill_unchanged(log, logs.CARD_KEYS), ts_mode=None))
    plain = events_of(decode(log, ts_mode=None))

    def body(df, name):
        return df.select("seq", "op", F.try_variant_get("after", "$.body", "string").alias(name))

    return body(events, "body").join(body(plain, "unfilled"), ["seq", "op"])


@query
def sink_retention(spark, sf_dir):
    """Three batches of lines into a sink that keeps few segments: what is kept is the newest, and enough."""
    folder, kept = _scratch(spark, "retention"), 3
    sink = JsonLinesSink(folder, SEGMENT_BYTES, kept)
    lines = _stamped_events(spark, sf_dir).select("seq", F.concat(F.col("seq").cast("string"), F.lit(" "), env.envelope()).alias("line"))
    for part in range(3):
        sink.write(lines.filter(F.floor(F.col("seq") / 10) % 3 == part), part)
    every = lines.select(F.col("seq"), F.floor(F.col("seq") / 10) % 3, F.octet_length("line") + 1).toDF("seq", "batch", "bytes")
    stored = spark.read.text(f"{folder}/lines").select(F.split("value", " ")[0].cast("bigint").alias("seq"))
    marked = every.join(stored.withColumn("is_kept", F.lit(True)), "seq", "left")
    # Batches follow one another, and lines within a batch.
    order = F.struct("batch", "seq")
    found = marked.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("total"),
        F.sum(F.when(F.col("is_kept"), F.col("bytes"))).alias("left"),
        F.min(F.when(F.col("is_kept"), order)).alias("first"),
        F.max(F.when(F.col("is_kept").isNull(), order)).alias("last_gone"),
    )
    limit = kept * SEGMENT_BYTES
    return found.select(
        F.col("n").alias("n_lines"),
        (F.col("left") >= F.least("total", F.lit(limit))).alias("enough"),
        (F.col("left") <= limit + SEGMENT_BYTES).alias("not_too_much"),
        F.coalesce(F.col("last_gone") < F.col("first"), F.lit(True)).alias("newest"),
        F.lit(sink.segments(spark).count() > 0).alias("listed"),
    )


@query
def topic_log_text_topics(spark, sf_dir):
    """Topics that look like numbers and dates, written and read back as text."""
    topics = {"users": "007", "orders": "12", "sales.orders": "2026-01-01", "sessions": "1e3", "app.audit_logs": "true"}
    sink = TopicLogSink(_scratch(spark, "topics"), topics)
    events = _stamped_events(spark, sf_dir)
    for part in range(2):
        sink.write(sink.prepare(events.filter(F.floor(F.col("seq") / 10) % 2 == part)), part)
    return sink.read(spark).groupBy("batch", "topic").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("last_seq"))


@query
def outbox_not_finite(spark, sf_dir):
    """Outbox rows of which only the payload is written: a NaN elsewhere does no harm, one in it does."""
    decoded = decode(logs.orders_log(spark, sf_dir), ts_mode=None)
    records = routing.to_records(outcome.begin(decoded), None, routing.Outbox("cust_key", "", "order_date"))
    whole = outcome.mark_unwritable(records).filter(F.col("status").isNull() | (F.col("status") != outcome.DECODE_ERROR))
    rated = routing.to_records(outcome.begin(decoded), None, routing.Outbox("", "", "rate"))
    alone = outcome.mark_unwritable(rated).select("seq", F.col("error").alias("rate_error"))
    return whole.select("seq", "status", F.col("value").cast("string").alias("value")).join(alone, "seq")


def _counted(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status", "stage", "attempts").agg(F.count(F.lit(1)).alias("n"))


class _Unsteady(TopicLogSink):
    """A sink of one's own whose first write of a batch fails."""

    writes = 0

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self.writes += 1
        if self.writes == 1:
            raise ConnectionError("no route to the broker")
        super().write(rows, batch_id)


@query
def sink_retry(spark, sf_dir):
    """A registered sink that fails once: every event is written by the second try."""
    folder, registry = _scratch(spark, "retry"), SinkRegistry()
    registry.register("unsteady", lambda spec, topics: _Unsteady(spec.path, topics))
    spec = PipelineSpec(sink=SinkSpec(type="unsteady", path=f"{folder}/out"), retry=RetrySpec(2, 1), work_dir=f"{folder}/work")
    pipeline = build(spark, spec, registry=registry)
    ledger = pipeline.run_batch(logs.raw_log(logs.events_log(spark, sf_dir)))
    written = pipeline.sink.read(spark).agg(F.count(F.lit(1)).alias("n"))
    return _counted(ledger).unionByName(written.selectExpr("'written' AS status", "'sink' AS stage", "2 AS attempts", "n"))


@query
def dead_letter_runs(spark, sf_dir):
    """Failures without a dead-letter sink, with one, and with one that fails too.

    Dead letters are whole events, although the sink they go to is set up with an outbox.
    """
    raw = logs.raw_log(logs.events_log(spark, sf_dir))
    refuse = T.reject(F.col("table") == "orders", "no orders")
    registry = SinkRegistry()
    registry.register("broken", lambda spec, topics: _Broken(spec.path, topics))
    out = None
    for name, kind in (("off", None), ("on", "topic_log"), ("broken", "broken")):
        folder = _scratch(spark, f"dlq-{name}")
        box = routing.Outbox("", "", "error")
        spec = PipelineSpec(
            transform=TransformSpec(enabled=True, modules=(refuse,)),
            sink=SinkSpec(type="topic_log", path=f"{folder}/out"),
            dlq=kind and DlqSpec(True, SinkSpec(type=kind, path=f"{folder}/dlq", outbox=box, pretty_print=True)),
            retry=RetrySpec(2, 1),
            work_dir=f"{folder}/work",
        )
        pipeline = build(spark, spec, registry=registry)
        rows = _counted(pipeline.run_batch(raw))
        if name == "on":
            letters = env.parse_envelopes(pipeline.dlq.read(spark).select("topic", F.col("value").cast("string").alias("value")))
            error = F.try_variant_get("after", "$.error", "string")
            rows = rows.unionByName(
                letters.groupBy(F.concat_ws(" ", "topic", "op", error).alias("status"))
                .agg(F.count(F.lit(1)).alias("n"))
                .selectExpr("status", "'letter' AS stage", "CAST(NULL AS INT) AS attempts", "n")
            )
        rows = rows.withColumn("dlq", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


class _Broken(TopicLogSink):
    def write(self, rows: DataFrame, batch_id: int) -> None:
        raise ConnectionError("gone")


@query
def run_reports(spark, sf_dir):
    """Live counts of a run as it goes, and that the times in its ledger add up to those measured."""
    folder, reports = _scratch(spark, "reports"), []
    pipeline = build(spark, _run_spec(folder), on_batch=reports.append)
    ledger = pipeline.run_batch(logs.raw_log(logs.events_log(spark, sf_dir)))
    counts = spark.createDataFrame([(k, int(v)) for r in reports for k, v in r.counts.items()], "name string, n bigint")
    taken = {r.stage: r.seconds for r in pipeline.times.read(0).collect()}
    close = lambda column, stage: (F.abs(F.sum(column) - taken[stage]) < 1e-6).cast("bigint")
    sums = ledger.agg(close("sink_s", "sink").alias("sink_s adds up"))
    buckets = metrics.histogram(pipeline.times.read_all().filter("stage = 'sink'"), "seconds", metrics.SINK_BOUNDS)
    one = metrics.merged(buckets).filter("le = double('inf')").selectExpr("'sink batches' AS name", "n")
    return counts.unionByName(sums.selectExpr("'sink_s adds up' AS name", "`sink_s adds up` AS n")).unionByName(one)


@query
def envelope_pretty(spark, sf_dir):
    """Every event as indented JSON, and read back from it."""
    lines = _stamped_events(spark, sf_dir).select("seq", env.envelope(pretty=True).alias("value"))
    indented = F.col("value").startswith("{\n  \"source\"").alias("indented")
    read = env.parse_envelopes(lines.withColumn("indented", indented))
    return _images(read, "seq", "indented", "table", "op")


@query
def identity_chain(spark, sf_dir):
    """A chain without links changes nothing."""
    events = events_of(decode(logs.events_log(spark, sf_dir), ts_mode=None))
    staged = T.chain(outcome.begin(events), [])
    return _images(staged.filter("status IS NULL AND stage IS NULL AND error IS NULL"), "seq", "table", "op")


def inflate(event: dict) -> dict:
    """Makes some events larger than a result may be, and fails some with as long a text."""
    key = event.get("after", {}).get("order_key", 1)
    if key % 1000 == 2:
        event["after"]["blob"] = "x" * (16 * 1024 * 1024)
    if key % 1000 == 4:
        raise ValueError("y" * (16 * 1024 * 1024 + 1))
    return event


@query
def result_cap(spark, sf_dir):
    """Results and errors of user functions that are over the limit."""
    events = events_of(decode(logs.orders_log(spark, sf_dir), ts_mode=None))
    staged = T.chain(outcome.begin(events), [T.UserFunction("inflate", inflate)], 1, 0)
    said = F.regexp_extract("error", "(result [a-z]+ too large)", 1).alias("said")
    return staged.filter("status = 'transform_error' AND NOT not_finite").select("seq", "op", said)
