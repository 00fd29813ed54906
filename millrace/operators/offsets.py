"""The positions a pipeline has reached, one append per batch."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import store
from millrace.functions.envelope import RFC3339, rfc3339


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@dataclass(frozen=True)
class Offset:
    lsn: int = 0
    commit_time: datetime | None = None

    @property
    def is_zero(self) -> bool:
        return self.lsn == 0


class OffsetLedger:
    """JSON lines ``{lsn, commit_time}`` in a folder per batch. The highest batch counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._marked: Offset | None = None

    def mark(self, offset: Offset) -> None:
        """Remember a position; it is kept only by ``flush``, and the last one wins."""
        self._marked = offset

    def flush(self, batch_id: int) -> None:
        """Store the marked position; does nothing when there is none."""
        if self._marked is None:
            return
        row = self.spark.createDataFrame(
            [(self._marked.lsn, self._marked.commit_time)], "lsn bigint, commit_time timestamp"
        )
        text = row.select("lsn", rfc3339(F.col("commit_time")).alias("commit_time"))
        text.coalesce(1).write.mode("overwrite").json(f"{self.path}/batch={batch_id}")
        self._marked = None

    def table(self) -> DataFrame:
        """All stored positions; a line that does not parse is an error."""
        schema = "lsn bigint, commit_time string, batch bigint"
        time = F.when(F.col("commit_time").rlike(RFC3339), F.col("commit_time").try_cast("timestamp"))
        return (
            self.spark.read.schema(schema)
            .option("mode", "FAILFAST")
            .json(self.path)
            .select("batch", "lsn", time.alias("commit_time"))
        )

    def load(self) -> Offset:
        """The position of the highest batch; zero when nothing was ever stored."""
        if not store.exists(self.spark, self.path):
            return Offset()
        newest = F.max_by(F.struct("lsn", F.unix_micros("commit_time").alias("micros")), "batch")
        try:
            row = self.table().agg(newest.alias("at")).select("at.*").first()
        except Exception as cause:
            raise ValueError(f"parse offset ledger: {cause}") from cause
        if row.lsn is None:
            return Offset()
        time = None if row.micros is None else EPOCH + timedelta(microseconds=row.micros)
        return Offset(row.lsn, time)


@dataclass(frozen=True)
class Run:
    """One batch of a log: the rows after ``after`` (none: from the start) up to ``last``."""

    batch_id: int
    after: int | None
    last: int


class RunLedger:
    """Which parts of a log were planned as batches and which are done, for runs that go on where one stopped.

    A batch is planned before anything is written and done after everything is. So a run that broke off
    is taken up with the same rows under the same number, and its output replaces what it left. Only the
    newest entries are kept.
    """

    KEPT = 10
    SCHEMA = "after bigint, last bigint"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.plans = store.BatchTable(spark, f"{path.rstrip('/')}/planned", self.SCHEMA)
        self.done = store.BatchTable(spark, f"{path.rstrip('/')}/done", self.SCHEMA)

    @staticmethod
    def _read(table: store.BatchTable, batch_id: int) -> Run:
        row = table.read(batch_id).first()
        return Run(batch_id, row.after, row.last)

    def newest(self) -> Run | None:
        """The last batch that is done."""
        numbers = self.done.numbers()
        return self._read(self.done, max(numbers)) if numbers else None

    def unfinished(self) -> Run | None:
        """The batch that was planned but is not done."""
        numbers = self.plans.numbers()
        if not numbers or self.done.has(max(numbers)):
            return None
        return self._read(self.plans, max(numbers))

    def plan(self, log: DataFrame) -> Run | None:
        """The next batch over a log: an unfinished one again, else all beyond the last one's rows."""
        begun = self.unfinished()
        if begun is not None:
            return begun
        before = self.newest()
        rest = log if before is None else log.filter(F.col("seq") > before.last)
        last = rest.agg(F.max("seq")).first()[0]
        if last is None:
            return None
        run = Run(0 if before is None else before.batch_id + 1, before and before.last, last)
        self._write(self.plans, run)
        return run

    def finish(self, run: Run) -> None:
        self._write(self.done, run)
        for table in (self.plans, self.done):
            for number in sorted(table.numbers())[: -self.KEPT]:
                table.drop(number)

    def _write(self, table: store.BatchTable, run: Run) -> None:
        row = self.spark.createDataFrame([(run.after, run.last)], self.SCHEMA)
        table.write(row.coalesce(1), run.batch_id)


def rows_of(log: DataFrame, run: Run) -> DataFrame:
    """The rows of a batch; the range is compared with the column alone, so that it reaches the scan."""
    kept = log.filter(F.col("seq") <= run.last)
    return kept if run.after is None else kept.filter(F.col("seq") > run.after)
