"""What a batch has to know about the batches before it, versioned by batch number.

Batch N reads the state of N-1, which never changes, and replaces its own. So a
batch that is run again sees and leaves the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.store import BatchTable

MARK_SCHEMA = "held_from bigint, last_commit_ts timestamp, last_commit_seq bigint"


@dataclass(frozen=True)
class Mark:
    """First batch whose tail is still held back, and the last commit seen: its time and its place."""

    held_from: int | None = None
    last_commit_ts: datetime | None = None
    last_commit_seq: int | None = None


class StreamState:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.marks = BatchTable(spark, f"{path}/marks", MARK_SCHEMA)
        self.relations = BatchTable(spark, f"{path}/relations")
        self.held = BatchTable(spark, f"{path}/held")
        self.seen = BatchTable(spark, f"{path}/seen", "seq bigint, xid bigint, lsn bigint, kind string, nth int")
        self.repeats = BatchTable(spark, f"{path}/repeats", "seq bigint")

    def mark(self, batch_id: int) -> Mark:
        if batch_id < 0 or not self.marks.has(batch_id):
            return Mark()
        micros = F.unix_micros("last_commit_ts").alias("micros")
        row = self.marks.read(batch_id).select("held_from", "last_commit_ts", "last_commit_seq", micros).first()
        return Mark(row.held_from, row.last_commit_ts, row.last_commit_seq)

    def relations_before(self, batch_id: int) -> DataFrame | None:
        """The layouts that rows after the previous batch, or held back by it, can need."""
        if batch_id < 1 or not self.relations.has(batch_id - 1):
            return None
        return self.relations.read(batch_id - 1)

    def held_before(self, batch_id: int, mark: Mark) -> DataFrame | None:
        """Rows of transactions whose commit had not arrived."""
        if mark.held_from is None:
            return None
        return self.held.read_range(mark.held_from, batch_id - 1)

    def seen_before(self, batch_id: int, remember: int) -> DataFrame | None:
        """Identities of the changes of the last ``remember`` batches."""
        return self.seen.read_range(max(batch_id - remember, 0), batch_id - 1)

    def see(self, batch_id: int, identities: DataFrame, remember: int) -> DataFrame:
        """Keep a batch's identities, and drop those that neither it nor a rerun of the one before needs."""
        self.seen.write(identities, batch_id)
        for number in self.seen.numbers():
            if number < batch_id - remember - 1:
                self.seen.drop(number)
        return self.seen.read(batch_id)

    def repeats_of(self, batch_id: int, repeated: DataFrame) -> DataFrame:
        """Fix which changes of a batch are repeated, as its rows and its ledger both ask; only the newest are kept."""
        self.repeats.write(repeated, batch_id)
        if batch_id:
            self.repeats.drop(batch_id - 1)
        return self.repeats.read(batch_id)

    def save(
        self, batch_id: int, mark: Mark, relations: DataFrame, held: DataFrame | None
    ) -> None:
        """Store the state after a batch; ``relations`` may repeat a table's layouts.

        Of each table the newest layout is kept; where rows are held back, the newest one before them and
        all later ones, as those rows belong to the layout in force when they arrived.
        """
        layout = F.struct("seq", "ns", "rel", "cols")
        settled = F.lit(True)
        if held is not None:
            settled = F.col("seq") <= F.lit(-1 if mark.last_commit_seq is None else mark.last_commit_seq)
        newest = (
            relations.filter(settled)
            .groupBy("relation_id")
            .agg(F.max_by(layout, "seq").alias("r"))
            .select("r.seq", "relation_id", "r.ns", "r.rel", "r.cols")
        )
        later = relations.filter(~settled).select(*newest.columns).dropDuplicates(["relation_id", "seq"])
        self.relations.write(newest.unionByName(later).coalesce(1), batch_id)
        if held is not None:
            self.held.write(held.select(*(f.name for f in S.RAW_LOG.fields)), batch_id)
        row = self.spark.createDataFrame([(mark.held_from, mark.last_commit_ts, mark.last_commit_seq)], MARK_SCHEMA)
        self.marks.write(row.coalesce(1), batch_id)

    def forget(self, batch_id: int, mark: Mark) -> None:
        """Delete what neither this batch nor a rerun of it can need."""
        old = batch_id - 2
        if old < 0:
            return
        oldest, previous = self.mark(old), self.mark(batch_id - 1)
        starts = [m.held_from for m in (mark, previous) if m.held_from is not None]
        first = old if oldest.held_from is None else oldest.held_from
        for number in range(first, min([batch_id - 1, *starts])):
            self.held.drop(number)
        self.marks.drop(old)
        self.relations.drop(old)
