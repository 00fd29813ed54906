"""Sinks by name. A sink prepares events for writing and writes a batch of them.

Writing the same batch number again replaces what was written, so a retried
batch leaves its rows once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Protocol

from pyspark.sql import DataFrame

from millrace.sinks.console import ConsoleSink
from millrace.sinks.files import JsonLinesSink, TopicLogSink
from millrace.sinks.kafka import KafkaSink
from millrace.spec import SinkSpec


class Sink(Protocol):
    def prepare(self, events: DataFrame) -> DataFrame:
        """Add the columns to be written: ``topic, key, value`` or ``line``."""

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Write prepared rows (with ``seq``) of one batch."""


Builder = Callable[[SinkSpec, Mapping[str, str]], Sink]


class SinkRegistry:
    def __init__(self) -> None:
        self._builders: dict[str, Builder] = {
            "kafka": lambda spec, topics: KafkaSink(spec.brokers, topics, spec.outbox, **spec.options),
            "topic_log": lambda spec, topics: TopicLogSink(spec.path, topics, spec.outbox),
            "file": lambda spec, _: JsonLinesSink(spec.path, spec.max_size, spec.max_files),
            "stdout": lambda spec, _: ConsoleSink(spec.pretty_print),
        }

    def register(self, name: str, builder: Builder) -> None:
        self._builders[name] = builder

    def names(self) -> tuple[str, ...]:
        return tuple(self._builders)

    def create(self, spec: SinkSpec, topics: Mapping[str, str] | None = None) -> Sink:
        builder = self._builders.get(spec.type)
        if builder is None:
            raise ValueError(f"unsupported sink type: {spec.type}")
        return builder(spec, topics or {})
