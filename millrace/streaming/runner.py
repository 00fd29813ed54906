"""Running a pipeline, over a whole log or a stream of it, with the same steps."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas as S
from millrace.operators import delivery, metrics, outcome
from millrace.operators.commits import TRANSACTION
from millrace.operators.decode import ChangeLog, decode
from millrace.operators.offsets import Offset, OffsetLedger, RunLedger, rows_of
from millrace.operators.transforms import Transform, UserFunction, chain
from millrace.session import configure, shared_folder
from millrace.sinks.registry import Sink, SinkRegistry
from millrace.sources import landing
from millrace.sources.landing import from_position, stream_log
from millrace.spec import ModuleSpec, PipelineSpec, parse_position
from millrace.store import BatchTable
from millrace.streaming.state import Mark, StreamState


def load_link(path: str) -> Transform | UserFunction:
    """A link by import path; a plain function becomes a user function."""
    module, _, name = path.partition(":")
    found = getattr(importlib.import_module(module), name)
    return found if isinstance(found, (Transform, UserFunction)) else UserFunction(name, found)


def links_of(spec: PipelineSpec) -> list[Transform | UserFunction]:
    t = spec.transform
    if t is None or not t.enabled:
        return []
    if not t.modules:
        return [load_link(t.path)]
    return [load_link(m.path) if isinstance(m, ModuleSpec) else m for m in t.modules]


@dataclass
class BatchReport:
    """Counts of one batch, observed while it was written, and how its sink write went."""

    batch_id: int
    counts: dict[str, int] = field(default_factory=dict)
    sink_attempts: int = 0
    sink_s: float | None = None
    stage_s: float = 0.0
    sink_error: str | None = None
    lost: bool = False


class Pipeline:
    """Decode, transform, route, deliver and account, as laid down in a spec.

    Everything kept between batches is in ``work_dir``: ``staged`` (the rows of
    the running batch, fixed before any output), ``ledger``, ``rejects`` (rows not
    usable as landed), ``times``, ``offsets``, ``runs`` and ``state``.
    """

    def __init__(
        self,
        spark: SparkSession,
        spec: PipelineSpec,
        registry: SinkRegistry | None = None,
        now: Callable[[], Column] | None = None,
        on_batch: Callable[[BatchReport], None] | None = None,
    ) -> None:
        registry = registry or SinkRegistry()
        spec.validate(registry.names())
        self.spark, self.spec = configure(spark), spec
        self.links = links_of(spec)
        topics = spec.mapping.table_stream_map
        self.sink: Sink = registry.create(spec.sink, topics)
        self.dlq: Sink | None = None
        if spec.dlq is not None and spec.dlq.enabled:
            # Dead letters are whole events, one per line or record.
            self.dlq = registry.create(replace(spec.dlq.sink, outbox=None, pretty_print=False), topics)
        self.now = now or F.current_timestamp
        self.on_batch = on_batch
        work = spec.work_dir.rstrip("/") or f"{shared_folder(spark)}/millrace"
        self.work_dir = work
        self.staged = BatchTable(spark, f"{work}/staged")
        self.ledger = BatchTable(spark, f"{work}/ledger", S.LEDGER.simpleString()[7:-1].replace(":", " "))
        self.offsets = OffsetLedger(spark, f"{work}/offsets")
        self.rejects = BatchTable(spark, f"{work}/rejects", landing.REJECTS)
        self.times = BatchTable(spark, f"{work}/times", metrics.TIMES)
        self.runs = RunLedger(spark, f"{work}/runs")
        self.state = StreamState(spark, f"{work}/state")

    # -- one batch ---------------------------------------------------------------

    def process(self, log: ChangeLog, batch_id: int, last_before: datetime | None = None) -> BatchReport:
        """Take one part of the log through all steps."""
        spec, report = self.spec, BatchReport(batch_id)
        log, repeated = self._first_deliveries(log, batch_id)
        decoded = decode(log, spec.source.ts_mode, spec.source.tables, last_before)
        begun = outcome.begin(decoded)
        numbered = bool(spec.transform and spec.transform.modules)
        chained = chain(
            begun, self.links, spec.retry.max_attempts, spec.retry.backoff_ms, numbered
        )
        started = time.perf_counter()
        self._stage(chained, batch_id, report)
        report.stage_s = time.perf_counter() - started
        staged = self.staged.read(batch_id)
        self._deliver(staged, batch_id, report)

        failed = staged.filter(F.col("status").isin(*outcome.FAILED))
        if report.sink_error is not None:
            if spec.on_sink_failure == "fail":
                raise RuntimeError(f"sink write failed: {report.sink_error}")
            failed = failed.unionByName(self._undelivered(staged, begun, report))
        lost = self.dlq is None or not self._bury(failed, batch_id, report)
        report.lost = lost

        # A batch is one write: each of its events has an equal share of the time, so sums are what it took.
        live = max(report.counts.get(outcome.SUCCESS, 0), 1)
        done = staged.withColumn(
            "sink_s", F.when(outcome.is_live(), F.lit((report.sink_s or 0.0) / live).cast("double"))
        )
        if self.links and not any(isinstance(link, UserFunction) for link in self.links):
            # Native links run in the same pass as decoding, which is timed as a whole.
            share = report.stage_s / max(report.counts.get("events", 0), 1)
            decoded_rows = F.col("status").isNull() | (F.col("status") != outcome.DECODE_ERROR)
            done = done.withColumn("transform_s", F.when(decoded_rows, F.lit(share)))
        attempts = report.sink_attempts
        if report.sink_error is not None:
            error = F.lit(report.sink_error)
            done = outcome.mark(done, F.lit(True), outcome.SINK_ERROR, "sink", error)
        elif attempts > 1:
            done = done.withColumn(
                "attempts", F.when(outcome.is_live(), F.lit(attempts)).otherwise(F.col("attempts"))
            )
        done = outcome.finish(done, spec.retry.max_attempts, dead_letters=not lost)
        rows = outcome.ledger_rows(done, self.now())
        for left_out in (repeated, self._unreadable(batch_id)):
            if left_out is not None:
                rows = rows.unionByName(left_out)
        self.ledger.write(rows, batch_id)
        self._acknowledge(batch_id)
        self._note_times(report)
        if batch_id:
            self.staged.drop(batch_id - 1)
        if self.on_batch:
            self.on_batch(report)
        return report

    def _first_deliveries(self, log: ChangeLog, batch_id: int) -> tuple[ChangeLog, DataFrame | None]:
        """The log without changes delivered before, and ledger rows for those."""
        source = self.spec.source
        if source.deliveries != "first":
            return log, None
        seen = self.state.seen_before(batch_id, source.remember)
        found = self.state.see(batch_id, delivery.identified(log.changes, log.begins), source.remember)
        again = self.state.repeats_of(batch_id, delivery.repeated(found, delivery.near(seen, found)))
        rows = log.changes.select("seq", "lsn", "kind").join(again, "seq", "left_semi")
        left_out = outcome.left_out_rows(rows, outcome.REPEATED, F.lit(None), self.now())
        return replace(log, changes=log.changes.join(again, "seq", "left_anti")), left_out

    def _unreadable(self, batch_id: int) -> DataFrame | None:
        """Ledger rows for what could not be used as it was landed."""
        if not self.rejects.has(batch_id):
            return None
        lost = self.rejects.read(batch_id).filter(F.col("reason").isin(*landing.LEFT_OUT))
        return outcome.left_out_rows(lost, outcome.UNREADABLE, F.col("reason"), self.now())

    def _usable(self, raw: DataFrame, batch_id: int) -> DataFrame:
        """The usable rows; what is wrong with any row is kept beside the ledger."""
        landed = landing.checked(raw)
        self.rejects.write(landing.rejects(landed), batch_id)
        return landing.usable(landed)

    def _stage(self, chained: DataFrame, batch_id: int, report: BatchReport) -> None:
        """Fix the outcome of decode and transforms, and the records to write.

        The original images are only needed where something already failed.
        """
        prepared = outcome.mark_unwritable(self.sink.prepare(chained))
        record = [c for c in ("topic", "key", "value", "line") if c in prepared.columns]
        live = outcome.is_live()
        keep_images = F.col("status").isin(*outcome.FAILED)
        origin = F.struct(
            *(F.col(f"origin.{c}").alias(c) for c in ("source", "table", "op", "ts")),
            *(F.when(keep_images, F.col(f"origin.{c}")).alias(c) for c in ("before", "after")),
        )
        extra = [c for c in ("source", "table", "op", "ts", "before", "after") if not record]
        rows = prepared.select(
            "seq",
            "lsn",
            origin.alias("origin"),
            "status",
            "stage",
            "error",
            "attempts",
            "transform_s",
            *(F.when(live, F.col(c)).alias(c) for c in (*record, *extra)),
        )
        seen = Observation(f"batch-{batch_id}")
        self.staged.write(rows.observe(seen, *metrics.live_counts()), batch_id)
        report.counts = dict(seen.get)

    def _deliver(self, staged: DataFrame, batch_id: int, report: BatchReport) -> None:
        """Write the live rows, trying again after a pause; the first try is timed."""
        live = staged.filter(outcome.is_live())
        retry = self.spec.retry
        for attempt in range(1, retry.max_attempts + 1):
            report.sink_attempts, started = attempt, time.perf_counter()
            try:
                self.sink.write(live, batch_id)
                report.sink_error = None
            except Exception as cause:  # whatever a connector raises
                report.sink_error = str(cause).splitlines()[0] if str(cause) else repr(cause)
            if attempt == 1:
                report.sink_s = time.perf_counter() - started
            if report.sink_error is None:
                return
            if attempt < retry.max_attempts:
                time.sleep(retry.backoff_ms / 1000)

    def _undelivered(self, staged: DataFrame, begun: DataFrame, report: BatchReport) -> DataFrame:
        """Rows an outage kept from the sink, with their original images decoded again."""
        live = staged.filter(outcome.is_live()).drop("origin")
        originals = begun.select("seq", "origin")
        marked = outcome.mark(
            live, F.lit(True), outcome.SINK_ERROR, "sink", F.lit(report.sink_error)
        )
        return marked.join(originals, "seq").select(*staged.columns)

    def _bury(self, failed: DataFrame, batch_id: int, report: BatchReport) -> bool:
        """Write dead letters; when that fails too, the events are dropped and the run goes on."""
        attempted = failed.withColumn("attempts", F.lit(self.spec.retry.max_attempts))
        letters = self.dlq.prepare(outcome.dead_letters(attempted, self.now()))
        try:
            self.dlq.write(letters, batch_id)
        except Exception:
            return False
        return True

    def _note_times(self, report: BatchReport) -> None:
        """One row per stage of a batch: what histograms over batches are made of."""
        events = report.counts.get("events", 0)
        rows = [
            (report.batch_id, "stage", events, 1, report.stage_s),
            (report.batch_id, "sink", report.counts.get(outcome.SUCCESS, 0), report.sink_attempts, report.sink_s),
        ]
        self.times.write(self.spark.createDataFrame(rows, metrics.TIMES).coalesce(1), report.batch_id)

    def _acknowledge(self, batch_id: int) -> None:
        reached = outcome.high_water_mark(self.ledger.read(batch_id)).first()
        if reached is not None and reached.lsn is not None:
            self.offsets.mark(Offset(reached.lsn, reached.commit_ts))
        self.offsets.flush(batch_id)

    # -- whole log ---------------------------------------------------------------

    def _given(self, raw: DataFrame | None) -> DataFrame:
        """The log handed over, or the one the spec names, from the position the spec gives."""
        source = self.spec.source
        if raw is None:
            raw = landing.read_landed(self.spark, source.path, source.format)
        return from_position(raw, parse_position(source.start_lsn))

    def run_batch(self, raw: DataFrame | None = None, batch_id: int = 0) -> DataFrame:
        """Process a whole log; returns its ledger. Changes without a commit have no time.

        With ``source.resume`` it is the next part of the log, see ``run_next``.
        """
        if self.spec.source.resume:
            self.run_next(raw)
            newest = self.runs.newest()
            return self.spark.createDataFrame([], S.LEDGER) if newest is None else self.ledger.read(newest.batch_id)
        self.process(ChangeLog.of(self._usable(self._given(raw), batch_id)), batch_id)
        return self.ledger.read(batch_id)

    def run_next(self, raw: DataFrame | None = None, final: bool = False) -> DataFrame | None:
        """Process what the log has beyond the batches done so far, as the next batch; returns its ledger.

        None if there is nothing new. A batch that broke off is done again first, with the rows it had. The
        layouts, last commit and open transactions before it come from the state, not from the log, so only
        the new range is read. Changes of a transaction without its commit wait for the next
        batch, unless this one is ``final``. A ledger of positions left by other runs is honoured: the
        first batch then starts after its position.
        """
        log = landing.checked(self._given(raw))
        if self.runs.newest() is None and self.runs.unfinished() is None:
            reached = self.offsets.load()
            if not reached.is_zero:
                log = from_position(log, reached.lsn + 1)
        run = self.runs.plan(log)
        if run is None:
            return None
        part = rows_of(log, run)
        if run.after is None:
            # Rows without a place belong to the first batch.
            part = log.filter(F.col("seq").isNull() | (F.col("seq") <= run.last))
        self._stream_batch(part, run.batch_id, final)
        self.runs.finish(run)
        return self.ledger.read(run.batch_id)

    # -- stream ------------------------------------------------------------------

    def run_stream(
        self, raw: DataFrame | None = None, checkpoint: str | None = None, **trigger
    ) -> StreamingQuery:
        """Start the stream; by default it takes all there is and stops."""
        source = self.spec.source
        start = parse_position(source.start_lsn)
        if raw is None:
            raw = stream_log(self.spark, source.path, source.format, start)
        else:
            raw = from_position(raw, start)
        return (
            raw.writeStream.foreachBatch(self.stream_batch)
            .option("checkpointLocation", checkpoint or f"{self.work_dir}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def stream_batch(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: join it with the state before it, process, store the state after it.

        By transaction, changes wait until their commit has arrived. Transactions
        arrive whole, one after another, so those still open are exactly the
        rows after the last commit.
        """
        batch = batch.persist(StorageLevel.DISK_ONLY)
        spread = landing.spread_out(batch)
        if spread is not batch:
            spread = spread.persist(StorageLevel.DISK_ONLY)
        try:
            self._stream_batch(spread, batch_id)
        finally:
            spread.unpersist()
            batch.unpersist()

    def _stream_batch(self, batch: DataFrame, batch_id: int, final: bool = False) -> None:
        batch = self._usable(batch, batch_id)
        mark = self.state.mark(batch_id - 1)
        known = self.state.relations_before(batch_id)
        held = self.state.held_before(batch_id, mark)
        full = batch if held is None else held.unionByName(batch)
        commits = full.filter(F.col("kind") == S.COMMIT)
        last = commits.agg(F.max(F.struct("seq", "commit_ts")).alias("c")).select("c.*").first()
        newest = last.commit_ts if last.seq is not None else mark.last_commit_ts

        by_transaction = self.spec.source.ts_mode == TRANSACTION and not final
        tail, held_from = None, None
        if by_transaction:
            cut = -1 if last.seq is None else last.seq
            tail = batch.filter(F.col("seq") > cut)
            held_from = batch_id
            if last.seq is None and mark.held_from is not None:
                held_from = mark.held_from
            full = full.filter(F.col("seq") <= cut)

        log = ChangeLog.of(full)
        relations = log.relations if known is None else known.unionByName(log.relations)
        log = replace(log, relations=relations)
        after = Mark(held_from, newest, mark.last_commit_seq if last.seq is None else last.seq)
        self.state.save(batch_id, after, relations, tail)
        self.process(log, batch_id, mark.last_commit_ts)
        self.state.forget(batch_id, after)


def build(spark: SparkSession, spec: PipelineSpec, **kwargs) -> Pipeline:
    """A checked pipeline, ready for ``run_batch`` or ``run_stream``."""
    return Pipeline(spark, spec, **kwargs)
