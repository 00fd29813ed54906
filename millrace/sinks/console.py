"""Events as lines on standard output, for development."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from millrace.functions.envelope import envelope
from millrace.session import ship_package


def _print_lines(rows) -> None:
    for row in rows:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        print(f"[{now}] {row.line}", flush=True)


class ConsoleSink:
    """Each task prints its rows in arrival order; nothing passes through the driver."""

    def __init__(self, pretty: bool = False) -> None:
        self.pretty = pretty

    def prepare(self, events: DataFrame) -> DataFrame:
        return events.withColumn("line", envelope(pretty=self.pretty))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        ship_package(rows.sparkSession)
        rows.sortWithinPartitions("seq").select("line").foreachPartition(_print_lines)
