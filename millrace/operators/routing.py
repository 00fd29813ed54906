"""Events to records: topic, key and value, and the order they are delivered in."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.envelope import envelope
from millrace.functions.images import not_finite_field, payload_bytes, usable_text
from millrace.operators.lookup import MAX_BROADCAST_ROWS, within

# Fixed value: prefix of a table's default topic.
TOPIC_PREFIX = "cdc."


@dataclass(frozen=True)
class Outbox:
    """Columns of ``after`` that give key, topic and body; an empty name means the default."""

    key_field: str = ""
    route_field: str = ""
    payload_field: str = ""


def topic_of(table: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """Mapped topic, else the default one. A mapped topic is taken as it is, even empty."""
    default = F.concat(F.lit(TOPIC_PREFIX), table)
    if not mapping:
        return default
    entries = F.create_map(*(F.lit(part) for pair in mapping.items() for part in pair))
    return F.coalesce(F.try_element_at(entries, table), default)


def with_topic(events: DataFrame, mapping: DataFrame) -> DataFrame:
    """Topics from a mapping table (``table, topic``), for mappings too long to spell out."""
    routes = mapping.select("table", F.col("topic").alias("_topic"))
    if within(routes, MAX_BROADCAST_ROWS):
        routes = F.broadcast(routes)
    return events.join(routes, "table", "left").withColumn(
        "topic", F.coalesce("_topic", topic_of(F.col("table")))
    ).drop("_topic")


def to_records(
    events: DataFrame,
    mapping: Mapping[str, str] | None = None,
    outbox: Outbox | None = None,
) -> DataFrame:
    """Add ``topic, key, value`` to events; other columns are kept.

    Each part of an outbox record falls back to the default on its own. With an outbox payload,
    ``value_not_finite`` says whether the value holds a number that JSON cannot carry.
    """
    table, after = F.col("table"), F.col("after")
    topic = F.col("topic") if "topic" in events.columns else topic_of(table, mapping)
    key = table.cast("binary")
    value = envelope().cast("binary")
    if outbox:
        if outbox.key_field:
            key = F.coalesce(usable_text(after, outbox.key_field).cast("binary"), key)
        if outbox.route_field:
            topic = F.coalesce(usable_text(after, outbox.route_field), topic)
        if outbox.payload_field:
            payload = payload_bytes(after, outbox.payload_field)
            value = F.coalesce(payload, value)
            if "not_finite" in events.columns:
                # Only what is written has to be writable.
                alone = not_finite_field(after, outbox.payload_field)
                unwritable = F.when(payload.isNotNull(), alone).otherwise(F.col("not_finite"))
                return events.withColumns({"topic": topic, "key": key, "value": value, "value_not_finite": unwritable})
    return events.withColumns({"topic": topic, "key": key, "value": value})


def in_key_order(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Arrange records so that each key's records are in arrival order.

    Ranges of (topic, key, seq): within a partition rows are sorted, and a key
    too large for one partition continues in the next one, later rows last.
    """
    order = ["topic", "key", "seq"]
    placed = (
        records.repartitionByRange(partitions, *order)
        if partitions
        else records.repartitionByRange(*order)
    )
    return placed.sortWithinPartitions(*order)


def order_violations(ordered: DataFrame) -> DataFrame:
    """Per topic and key: rows, and rows that come after a later one of the same key.

    Looks inside each partition, then between a key's consecutive partitions.
    """
    from pyspark.sql import Window as W

    placed = ordered.select(
        "topic",
        "key",
        "seq",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_place"),
    )
    part = ["topic", "key", "_part"]
    inside = W.partitionBy(*part).orderBy("_place")
    steps = placed.withColumn("_back", F.lag("seq").over(inside) > F.col("seq"))
    runs = steps.groupBy(*part).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("_back").alias("back"),
        F.min("seq").alias("lo"),
        F.max("seq").alias("hi"),
    )
    across = W.partitionBy("topic", "key").orderBy("_part")
    return (
        runs.withColumn("jump", F.coalesce(F.lag("hi").over(across) > F.col("lo"), F.lit(False)))
        .groupBy("topic", "key")
        .agg(
            F.sum("n").alias("n_records"),
            (F.sum("back") + F.count_if("jump")).alias("violations"),
        )
    )
