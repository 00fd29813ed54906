"""Commit times for changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.lookup import MAX_BROADCAST_ROWS, asof_lookup, within

TRANSACTION = "transaction"
LAST_SEEN = "last_seen_commit"
# Commits are put in arrival order piece by piece; a piece spans this many seq values.
PIECE = 1 << 22


def previous_commit(commits: DataFrame, piece: int = PIECE) -> DataFrame:
    """For each transaction, the commit time that was current while its changes arrived.

    The order is total, but no task holds it all: ``lag`` runs inside pieces of
    the sequence, and the last commit of each piece (one row per piece) is
    carried into the next.
    """
    cut = commits.select("xid", "seq", "commit_ts").withColumn(
        "_piece", F.floor(F.col("seq") / F.lit(piece))
    )
    ends = cut.groupBy("_piece").agg(F.max(F.struct("seq", "commit_ts")).alias("_end"))
    carried = ends.select(
        "_piece", F.lag("_end.commit_ts").over(W.orderBy("_piece")).alias("_carried")
    )
    inside = W.partitionBy("_piece").orderBy("seq")
    return (
        cut.withColumn("_rank", F.row_number().over(inside))
        .withColumn("_lag", F.lag("commit_ts").over(inside))
        .join(carried, "_piece", "left")
        .select(
            "xid",
            "seq",
            F.when(F.col("_rank") == 1, F.col("_carried")).otherwise(F.col("_lag")).alias("ts"),
        )
    )


def own_spans(commits: DataFrame) -> DataFrame:
    """Each commit with the part of the sequence whose changes it commits.

    A transaction may be delivered again, and its number used again: a change belongs to
    the next commit of its number, so the part begins after the one before.
    """
    before = F.lag("seq").over(W.partitionBy("xid").orderBy("seq"))
    spans = commits.withColumns(
        {"_from": F.coalesce(before + 1, F.lit(-(1 << 62))), "_to": F.col("seq") + 1}
    )
    return spans.drop("seq")


def stamp_commit_time(
    changes: DataFrame,
    commits: DataFrame,
    mode: str = TRANSACTION,
    broadcast_rows: int = MAX_BROADCAST_ROWS,
    last_before=None,
) -> DataFrame:
    """Add ``ts`` to changes.

    ``transaction``: the commit time of the change's own transaction.
    ``last_seen_commit``: the last commit that arrived before the change, that
    is the previous transaction's, as transactions arrive whole one after
    another; unset before the first commit. ``last_before`` is the commit time
    carried in from an earlier part of the log.
    """
    if mode == TRANSACTION:
        own = own_spans(commits.select("xid", "seq", F.col("commit_ts").alias("ts")))
        return _of_own_commit(changes, own, broadcast_rows)
    if mode != LAST_SEEN:
        raise ValueError(f"unknown ts mode: {mode}")
    carried = F.lit(last_before).cast("timestamp")
    earlier = own_spans(previous_commit(commits)).withColumn("_own", F.lit(True))
    stamped = _of_own_commit(changes, earlier, broadcast_rows)
    # A change whose own commit is not in this part of the log follows all commits in it.
    newest = commits.agg(F.max(F.struct("seq", "commit_ts"))["commit_ts"]).first()[0]
    tail = F.coalesce(F.lit(newest).cast("timestamp"), carried)
    return stamped.withColumn(
        "ts", F.when(F.col("_own"), F.coalesce("ts", carried)).otherwise(tail)
    ).drop("_own")


def _of_own_commit(changes: DataFrame, spans: DataFrame, broadcast_rows: int) -> DataFrame:
    small = within(spans, broadcast_rows)
    return asof_lookup(changes, spans, "xid", ("_from", "_to"), small).drop("_from", "_to")
