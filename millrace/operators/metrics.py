"""The counters, gauge and histograms of a run, as aggregations over its ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import outcome

# Upper bounds of the histogram buckets, in seconds.
TRANSFORM_BOUNDS = (0.0005, 0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0)
SINK_BOUNDS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
# How long each stage of each batch took: the first try, and how many there were.
TIMES = "batch_id bigint, stage string, events bigint, attempts int, seconds double"


def events_processed(ledger: DataFrame) -> DataFrame:
    """Events by table, operation and outcome."""
    return ledger.groupBy("table", "op", "status").agg(F.count(F.lit(1)).alias("n"))


def pipeline_errors(ledger: DataFrame) -> DataFrame:
    """Exhausted events by component; each counts as an exhausted retry and as a dead letter."""
    failed = ledger.filter(F.col("status").isin(*outcome.FAILED, outcome.LOST))
    kinds = F.array(F.lit("retry_exhausted"), F.lit("dlq"))
    return (
        failed.groupBy(F.col("stage").alias("component"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("component", F.explode(kinds).alias("error_type"), "n")
    )


def replication_lag(ledger: DataFrame, by_table: bool = False) -> DataFrame:
    """Seconds between an event's time and its processing, for the last decoded event with a time."""
    timed = ledger.filter(
        F.col("ts").isNotNull() & (F.col("status") != outcome.DECODE_ERROR)
    ).withColumn("lag_micros", F.unix_micros("processed_at") - F.unix_micros("ts"))
    grouped = timed.groupBy("table") if by_table else timed.groupBy()
    last = F.max_by("lag_micros", "seq")
    return grouped.agg((last / 1e6).alias("lag_s"))


def histogram(ledger: DataFrame, column: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative bucket counts, sum and count of a duration column, in one pass.

    One row per bound; ``le`` of the last row is infinity.
    """
    duration = F.col(column)
    counts = [F.count_if(duration <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)]
    totals = ledger.agg(*counts, F.count(duration).alias("n"), F.sum(duration).alias("total"))
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("n").alias("n")))
    return totals.select(
        F.explode(F.array(*rows)).alias("bucket"),
        F.col("n").alias("count"),
        F.col("total").alias("sum"),
    ).select("bucket.le", F.col("bucket.n").alias("n"), "count", "sum")


def merged(histograms: DataFrame) -> DataFrame:
    """Histograms of parts, as ``histogram`` gives them, added up into one."""
    return histograms.groupBy("le").agg(*(F.sum(c).alias(c) for c in ("n", "count", "sum")))


def live_counts(observed: str = "status") -> list[Column]:
    """Aggregates to observe on a batch as it is written, without another pass."""
    names = (
        outcome.SUCCESS,
        outcome.FILTERED,
        outcome.TRANSFORM_ERROR,
        outcome.SINK_ERROR,
        outcome.LOST,
    )
    status = F.coalesce(F.col(observed), F.lit(outcome.SUCCESS))
    return [F.count(F.lit(1)).alias("events"), *(F.count_if(status == n).alias(n) for n in names)]


def scope_drift(configured: DataFrame, observed: DataFrame) -> DataFrame:
    """Tables only configured or only captured; no rows means the sets are equal.

    Both sides have a ``table`` column; order and repeats do not matter.
    """
    left, right = configured.select("table").distinct(), observed.select("table").distinct()
    missing = left.exceptAll(right).withColumn("drift", F.lit("configured_only"))
    extra = right.exceptAll(left).withColumn("drift", F.lit("captured_only"))
    return missing.unionByName(extra)
