import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import routing
from millrace.operators.routing import Outbox
from millrace.sinks.kafka import KafkaSink, check_records, kafka_options

OUTBOX = Outbox("aggregate_id", "event_type", "payload")


def records(spark, after, outbox=None, mapping=None, table="outbox_events"):
    df = spark.createDataFrame([(0, "postgres", table, "create", None if after is None else json.dumps(after))],
                               "seq bigint, source string, table string, op string, after string")
    df = df.select("*", F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("variant").alias("before"))
    df = df.withColumn("after", F.try_parse_json("after"))
    row = routing.to_records(df, mapping, outbox).select("topic", "key", "value").first()
    return row.topic, bytes(row.key).decode(), bytes(row.value).decode()


def test_topics(spark):
    mapping = {"users": "prod.users.events", "orders": "prod.orders.events", "bad": ""}
    df = spark.createDataFrame([(t,) for t in ("users", "orders", "other", "bad")], "table string")
    assert [r[0] for r in df.select(routing.topic_of(F.col("table"), mapping)).collect()] == [
        "prod.users.events", "prod.orders.events", "cdc.other", "",
    ]
    assert df.select(routing.topic_of(F.col("table"))).first()[0] == "cdc.users"


def test_default_record(spark):
    topic, key, value = records(spark, {"id": 1}, table="users")
    assert (topic, key) == ("cdc.users", "users") and json.loads(value)["after"] == {"id": 1}


@pytest.mark.parametrize(
    "after, want",
    [
        ({"aggregate_id": "abc-123", "event_type": "transfer.requested", "payload": {"transferId": "abc-123"}},
         ("transfer.requested", "abc-123", '{"transferId":"abc-123"}')),
        ({"event_type": "e", "payload": {"x": 1}}, ("e", "outbox_events", '{"x":1}')),
        ({"aggregate_id": "a", "payload": {"x": 1}}, ("cdc.outbox_events", "a", '{"x":1}')),
        ({"aggregate_id": None, "event_type": "", "payload": {"x": 1}}, ("cdc.outbox_events", "outbox_events", '{"x":1}')),
        ({"aggregate_id": 42, "event_type": "e", "payload": '{"foo":"bar"}'}, ("e", "42", '{"foo":"bar"}')),
        ({"aggregate_id": "a", "event_type": "e", "payload": [1, 2]}, ("e", "a", "[1,2]")),
        ({"aggregate_id": "a", "event_type": "e", "payload": 0}, ("e", "a", "0")),
        ({"aggregate_id": "a", "event_type": "e", "payload": False}, ("e", "a", "false")),
    ],
)
def test_outbox(spark, after, want):
    assert records(spark, after, OUTBOX) == want


def test_outbox_fallback_to_envelope(spark):
    for payload in ({}, {"payload": None}, {"payload": ""}):
        _, _, value = records(spark, {"aggregate_id": "a", **payload}, OUTBOX)
        assert json.loads(value)["source"] == "postgres"
    topic, key, value = records(spark, None, OUTBOX)
    assert (topic, key) == ("cdc.outbox_events", "outbox_events")
    assert json.loads(value)["table"] == "outbox_events"


def test_bytes_payload(spark):
    df = spark.createDataFrame([(bytearray(b'{"foo":"bar"}'),)], "b binary")
    image = F.to_variant_object(F.struct(F.col("b").alias("payload")))
    from millrace.functions.images import payload_bytes

    assert bytes(df.select(payload_bytes(image, "payload")).first()[0]) == b'{"foo":"bar"}'


def test_key_order_with_a_hot_key(spark):
    rows = [(i, "t", b"hot" if i % 3 else b"k%d" % (i % 10)) for i in range(3000)]
    df = spark.createDataFrame(rows, "seq bigint, topic string, key binary").repartition(7)
    ordered = routing.in_key_order(df, 8)
    seen = {r.key: (r.n_records, r.violations) for r in routing.order_violations(ordered).collect()}
    assert sum(n for n, _ in seen.values()) == 3000 and all(v == 0 for _, v in seen.values())
    parts = ordered.filter(F.col("key") == b"hot").select(F.spark_partition_id()).distinct().count()
    assert parts > 1  # the hot key is spread
    shuffled = df.sortWithinPartitions(F.desc("seq"))
    assert sum(r.violations for r in routing.order_violations(shuffled).collect()) > 0


def test_kafka_options_and_schema(spark):
    assert kafka_options(["a:9092", "b:9092"], {"acks": "all", "kafka.linger.ms": 5}) == {
        "kafka.bootstrap.servers": "a:9092,b:9092", "kafka.acks": "all", "kafka.linger.ms": "5",
    }
    with pytest.raises(ValueError, match="kafka brokers is required"):
        kafka_options([])
    good = spark.createDataFrame([(1, "t", b"k", b"v")], "seq bigint, topic string, key binary, value binary")
    assert check_records(good).columns == ["topic", "key", "value"]
    with pytest.raises(ValueError, match="key must be binary"):
        check_records(good.withColumn("key", F.lit("text")))


def test_kafka_slices_cover_everything(spark):
    df = spark.range(1000).withColumnRenamed("id", "seq")
    sink = KafkaSink(["b:1"], slice_rows=300)
    parts = sink.slices(df)
    assert len(parts) >= 4
    assert sorted(r.seq for p in parts for r in p.collect()) == list(range(1000))
    assert max(p.count() for p in parts) <= 330
    assert len(KafkaSink(["b:1"]).slices(df)) == 1
