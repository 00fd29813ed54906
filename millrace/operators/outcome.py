"""One row per event through the stages: what happened to it, where, and after how many tries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions.envelope import envelope, rfc3339
from millrace.functions.once import once

# The operation of a kind of message.
OP = "CASE kind WHEN 'I' THEN 'create' WHEN 'U' THEN 'update' WHEN 'D' THEN 'delete' END"

SUCCESS = "success"
FILTERED = "filtered"
TRANSFORM_ERROR = "transform_error"
SINK_ERROR = "sink_error"
DECODE_ERROR = "decode_error"
LOST = "lost"
# Rows that never became events: delivered before, or not usable as they were landed.
REPEATED = "repeated"
UNREADABLE = "unreadable"
FAILED = (TRANSFORM_ERROR, SINK_ERROR)

# Fixed value: what a JSON encoder says about a number it cannot write.
NOT_FINITE = "json: unsupported value: NaN or Infinity"


def is_live() -> Column:
    """Still on its way to the sink."""
    return F.col("status").isNull()


def begin(decoded: DataFrame) -> DataFrame:
    """Stage columns for decoded changes, and ``origin``: the event as decoded.

    Counts and dead letters refer to the origin. Changes that did not decode
    are already settled.
    """
    error = F.col("error") if "error" in decoded.columns else F.lit(None).cast("string")
    return decoded.withColumns(
        {
            "origin": F.struct(*S.ENVELOPE_COLUMNS),
            "status": F.when(error.isNotNull(), F.lit(DECODE_ERROR)),
            "stage": F.when(error.isNotNull(), F.lit("decode")),
            "error": error,
            "attempts": F.lit(None).cast("int"),
            "transform_s": F.lit(None).cast("double"),
        }
    )


def mark(df: DataFrame, condition: Column, status: str, stage: str | None, error: Column) -> DataFrame:
    """Give live rows meeting ``condition`` a final status."""
    return once(df, _hit=is_live() & F.coalesce(condition, F.lit(False))).withColumns(
        {
            "status": F.when(F.col("_hit"), F.lit(status)).otherwise(F.col("status")),
            "stage": F.when(F.col("_hit"), F.lit(stage)).otherwise(F.col("stage")),
            "error": F.when(F.col("_hit"), error).otherwise(F.col("error")),
        }
    ).drop("_hit")


def mark_unwritable(records: DataFrame) -> DataFrame:
    """Row-level sink failures, found before any write so they never fail the whole batch."""
    unwritable = "value_not_finite" if "value_not_finite" in records.columns else "not_finite"
    checks = F.when(F.col(unwritable), F.lit(f"marshal event: {NOT_FINITE}"))
    if "topic" in records.columns:
        checks = checks.when(
            F.col("topic").isNull() | (F.col("topic") == ""), F.lit("produce: empty topic")
        )
        checks = checks.when(F.col("value").isNull(), F.lit("event is nil"))
    if "line" in records.columns:
        checks = checks.when(F.col("line").isNull(), F.lit("event is nil"))
    return mark(records, checks.isNotNull(), SINK_ERROR, "sink", checks)


def finish(records: DataFrame, max_attempts: int, dead_letters: bool) -> DataFrame:
    """Final statuses: what is still live succeeded; failures without a dead-letter sink are lost."""
    failed = F.col("status").isin(*FAILED)
    final = F.when(is_live(), F.lit(SUCCESS))
    if not dead_letters:
        final = final.when(failed, F.lit(LOST))
    return records.withColumns(
        {
            "attempts": F.when(failed, F.lit(max_attempts)).otherwise(
                F.coalesce("attempts", F.lit(1))
            ),
            "status": final.otherwise(F.col("status")),
        }
    )


def dead_letters(failed: DataFrame, now: Column) -> DataFrame:
    """Failed events as events of table ``dlq``; the original is the event as decoded.

    Takes rows with ``origin, error, stage, attempts``. Numbers JSON cannot
    carry are kept as text.
    """
    after = F.struct(
        F.try_parse_json(envelope("origin")).alias("event"),
        F.col("error"),
        F.col("stage"),
        F.col("attempts"),
        rfc3339(now).alias("failed_at"),
    )
    return failed.select(
        "seq",
        F.col("origin.source").alias("source"),
        F.lit("dlq").alias("table"),
        F.lit("dlq").alias("op"),
        now.alias("ts"),
        F.lit(None).cast("variant").alias("before"),
        F.to_variant_object(after).alias("after"),
    )


def ledger_rows(done: DataFrame, now: Column) -> DataFrame:
    """The account of a batch: one row per change, decoded or not.

    ``table``, ``op`` and ``ts`` are those of the event before transforms.
    """
    sink_s = F.col("sink_s") if "sink_s" in done.columns else F.lit(None).cast("double")
    return done.select(
        "seq",
        "lsn",
        F.col("origin.table").alias("table"),
        F.col("origin.op").alias("op"),
        "status",
        "stage",
        "error",
        "attempts",
        "transform_s",
        sink_s.alias("sink_s"),
        F.col("origin.ts").alias("ts"),
        now.alias("processed_at"),
    )


def left_out_rows(rows: DataFrame, status: str, error: Column, now: Column) -> DataFrame:
    """Ledger rows for what was left out at the source: ``seq`` and, if they have them, ``lsn`` and ``kind``."""
    has = rows.columns
    values = {
        "seq": F.col("seq"),
        "lsn": F.col("lsn") if "lsn" in has else F.lit(None),
        "table": F.lit(None),
        "op": F.expr(OP) if "kind" in has else F.lit(None),
        "status": F.lit(status),
        "stage": F.lit("source"),
        "error": error,
        "attempts": F.lit(1),
        "processed_at": now,
    }
    return rows.select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.LEDGER.fields)
    )


def high_water_mark(ledger: DataFrame) -> DataFrame:
    """Position of the last event that reached the sink; later successes cover earlier failures."""
    reached = ledger.filter((F.col("status") == SUCCESS) & F.col("lsn").isNotNull())
    return reached.agg(
        F.max_by(F.struct("lsn", F.col("ts").alias("commit_ts")), "seq").alias("at")
    ).select("at.*")
