"""Records to Kafka through Spark's connector, which the cluster has to bring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.routing import Outbox, to_records

RECORD = {"topic": "string", "key": "binary", "value": "binary"}


def kafka_options(brokers: Sequence[str], extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Writer options; producer settings may be given with or without the ``kafka.`` prefix."""
    if not brokers:
        raise ValueError("kafka brokers is required")
    options = {"kafka.bootstrap.servers": ",".join(brokers)}
    for name, value in (extra or {}).items():
        options[name if name.startswith("kafka.") else f"kafka.{name}"] = str(value)
    return options


def check_records(records: DataFrame) -> DataFrame:
    """The three columns the connector takes, or an error before any job."""
    types = dict(records.dtypes)
    for name, kind in RECORD.items():
        if types.get(name) != kind:
            raise ValueError(f"kafka record column {name} must be {kind}, is {types.get(name)}")
    return records.select(*RECORD)


class KafkaSink:
    """Keeps each key's order: one key's rows are sent by one task, in arrival order.

    A batch is sent in slices of the sequence, one after another, so even a key
    that holds most of a batch gives a task at most ``slice_rows`` rows.
    """

    def __init__(
        self,
        brokers: Sequence[str],
        topics: Mapping[str, str] | None = None,
        outbox: Outbox | None = None,
        slice_rows: int = 20_000_000,
        producer: Mapping[str, str] | None = None,
        fmt: str = "kafka",
    ) -> None:
        self.options = kafka_options(brokers, producer)
        self.topics, self.outbox = topics, outbox
        self.slice_rows, self.format = slice_rows, fmt

    def prepare(self, events: DataFrame) -> DataFrame:
        return to_records(events, self.topics, self.outbox)

    def slices(self, rows: DataFrame) -> list[DataFrame]:
        n, low, high = rows.agg(F.count(F.lit(1)), F.min("seq"), F.max("seq")).first()
        parts = -(-n // self.slice_rows)
        if parts <= 1:
            return [rows]
        cuts = rows.approxQuantile("seq", [i / parts for i in range(1, parts)], 0.001)
        edges = [low, *(int(c) for c in cuts), high + 1]
        return [
            rows.filter((F.col("seq") >= a) & (F.col("seq") < b))
            for a, b in zip(edges, edges[1:])
            if a < b
        ]

    def write(self, rows: DataFrame, batch_id: int) -> None:
        for part in self.slices(rows):
            placed = part.repartition("topic", "key").sortWithinPartitions("seq")
            check_records(placed).write.format(self.format).options(**self.options).save()
