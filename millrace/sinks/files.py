"""Events on files: JSON lines with rotation, and records by topic."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace import store
from millrace.functions.envelope import envelope
from millrace.operators.routing import Outbox, in_key_order, to_records
from millrace.session import ship_package

ORDER = ("batch", "writer", "segment")


class TopicLogSink:
    """Records as Parquet, ``batch=N/topic=T``, each key's rows in arrival order over the files."""

    def __init__(
        self,
        path: str,
        topics: Mapping[str, str] | None = None,
        outbox: Outbox | None = None,
    ) -> None:
        self.path, self.topics, self.outbox = path.rstrip("/"), topics, outbox

    def prepare(self, events: DataFrame) -> DataFrame:
        return to_records(events, self.topics, self.outbox)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        placed = in_key_order(rows.select("topic", "key", "value", "seq"))
        placed.write.partitionBy("topic").mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark) -> DataFrame:
        """All records, with their batch. Topics are text, also those that look like numbers or dates."""
        schema = "key binary, value binary, seq bigint, topic string, batch bigint"
        return spark.read.schema(schema).parquet(self.path)


def with_segments(lines: DataFrame, max_size: int) -> DataFrame:
    """Number the segments of each writer: a line that would overfill one starts the next.

    Writers are ranges of arrival order, one per task. The size so far is kept
    while the lines of a task pass by, so no task holds more than a batch, and
    only the line lengths go to Python.
    """

    @F.pandas_udf("long")
    def rotate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        segment, size = 0, 0
        for lengths in batches:
            out = []
            for length in lengths:
                if size and size + length > max_size:
                    segment, size = segment + 1, 0
                size += length
                out.append(segment)
            yield pd.Series(out, dtype="int64")

    ship_package(lines.sparkSession)
    length = F.octet_length("line") + 1
    return (
        lines.repartitionByRange("seq")
        .sortWithinPartitions("seq")
        .withColumn("segment", rotate.asNondeterministic()(length))
        .withColumn("writer", F.spark_partition_id())
    )


def retained(segments: DataFrame, max_files: int, max_size: int) -> DataFrame:
    """The newest segments; 0 files keeps all.

    A segment goes only when those after it hold more than ``max_files`` full segments' worth
    of bytes, so what stays does not depend on how many tasks wrote it. Sums run over one row per
    writer, and inside each writer on their own.
    """
    if max_files <= 0:
        return segments
    writers = segments.groupBy("batch", "writer").agg(F.sum("bytes").alias("_total"))
    later = W.orderBy(F.desc("batch"), F.desc("writer")).rowsBetween(W.unboundedPreceding, -1)
    writers = writers.select("batch", "writer", F.coalesce(F.sum("_total").over(later), F.lit(0)).alias("_later"))
    newer = W.partitionBy("batch", "writer").orderBy(F.desc("segment")).rowsBetween(W.unboundedPreceding, -1)
    placed = segments.join(writers, ["batch", "writer"])
    after = F.col("_later") + F.coalesce(F.sum("bytes").over(newer), F.lit(0))
    kept = placed.withColumn("_after", after).filter(F.col("_after") <= max_files * max_size)
    return kept.select(*segments.columns)


class JsonLinesSink:
    """One envelope per line, in a folder per batch; with ``max_size`` in segments.

    Segments are folders ``batch=N/writer=W/segment=S``; a batch's share of the
    manifest lists them with rows and bytes. With ``max_files`` the manifest is compacted: ``live`` of batch N
    holds what is left after N, and the next batch reads it and its own share alone. So the work of
    a batch depends on what is kept and what it adds, not on its history.
    """

    def __init__(self, path: str, max_size: int = 0, max_files: int = 0) -> None:
        self.path, self.max_size, self.max_files = path.rstrip("/"), max_size, max_files

    def prepare(self, events: DataFrame) -> DataFrame:
        return events.withColumn("line", envelope())

    def write(self, rows: DataFrame, batch_id: int) -> None:
        target = f"{self.path}/lines/batch={batch_id}"
        lines = rows.select("seq", F.col("line"))
        if self.max_size <= 0:
            lines.sortWithinPartitions("seq").select("line").write.mode("overwrite").text(target)
            return
        numbered = with_segments(lines, self.max_size)
        placed = numbered.sortWithinPartitions("writer", "segment", "seq")
        placed.select("line", "writer", "segment").write.partitionBy("writer", "segment").mode(
            "overwrite"
        ).text(target)
        spark = rows.sparkSession
        written = (
            spark.read.text(target)
            .groupBy("writer", "segment")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.octet_length("value") + 1).alias("bytes"),
            )
            .withColumns({c: F.col(c).cast("bigint") for c in ("writer", "segment")})
        )
        written.write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}")
        if self.max_files > 0:
            self.drop_expired(spark, batch_id)

    SEGMENTS = "writer bigint, segment bigint, n bigint, bytes bigint, batch bigint"

    def _live(self, spark) -> store.BatchTable:
        return store.BatchTable(spark, f"{self.path}/live", self.SEGMENTS)

    def segments(self, spark) -> DataFrame:
        """The segments there are."""
        live = self._live(spark).numbers()
        if live:
            return self._live(spark).read(max(live))
        return spark.read.schema(self.SEGMENTS).parquet(f"{self.path}/manifest")

    def drop_expired(self, spark, batch_id: int) -> None:
        """Settle what is left after a batch, and delete the rest; doing it again does nothing.

        What a batch before this one left is not changed by it, so a batch that is done again settles the same.
        """
        live = self._live(spark)
        own = spark.read.schema("writer bigint, segment bigint, n bigint, bytes bigint").parquet(
            f"{self.path}/manifest/batch={batch_id}"
        )
        segments = own.withColumn("batch", F.lit(batch_id).cast("bigint"))
        earlier = [n for n in live.numbers() if n < batch_id]
        if earlier:
            segments = segments.unionByName(live.read(max(earlier)))
        live.write(retained(segments, self.max_files, self.max_size), batch_id)
        gone = segments.join(live.read(batch_id), list(ORDER), "left_anti")
        folder = F.format_string(f"{self.path}/lines/batch=%d/writer=%d/segment=%d", *ORDER)
        store.delete_all(spark, (r.folder for r in gone.select(folder.alias("folder")).toLocalIterator()))
        for number in earlier[:-1] if len(earlier) > 1 else []:
            live.drop(number)
            store.delete(spark, f"{self.path}/manifest/batch={number}")
