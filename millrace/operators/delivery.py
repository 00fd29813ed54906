"""Recognising changes that were delivered before.

A source that is interrupted sends whole transactions again, with new sequence numbers. A change is
known by its transaction, its log position, its kind, and which of the changes with these three it is: rows
copied in by one statement share a position. That number restarts with every delivery of the transaction, told
by its begin messages. Changes without a transaction or a position can't be recognised and always pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

POSITION = ("xid", "lsn", "kind")
IDENTITY = (*POSITION, "nth")


def identified(changes: DataFrame, begins: DataFrame) -> DataFrame:
    """``seq`` and the identity of every change that has one: narrow rows, whatever the images weigh.

    The array of begins is one row per transaction, and only of those that began more than once. A begin has
    to be in the same part of the log as its changes, as it is where whole transactions are taken.
    """
    narrow = changes.select("seq", *POSITION).filter("xid IS NOT NULL AND lsn IS NOT NULL")
    starts = (
        begins.groupBy("xid")
        .agg(F.sort_array(F.collect_set("seq")).alias("_starts"))
        .filter(F.size("_starts") > 1)
    )
    delivery = F.when(
        F.col("_starts").isNotNull(), F.size(F.filter("_starts", lambda start: start <= F.col("seq")))
    ).otherwise(F.lit(0))
    # One shuffle for this window and the one below: both split these groups further.
    placed = narrow.join(starts, "xid", "left").withColumn("_delivery", delivery).repartition(*POSITION)
    within = W.partitionBy(*POSITION, "_delivery").orderBy("seq")
    return placed.withColumn("nth", F.row_number().over(within)).select("seq", *IDENTITY)


def repeated(identities: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """``seq`` of all deliveries of a change but the first, or of all of them if it was ``seen`` before."""
    order = W.partitionBy(*IDENTITY).orderBy("seq")
    again = identities.repartition(*POSITION).withColumn("_turn", F.row_number().over(order))
    if seen is None:
        return again.filter("_turn > 1").select("seq")
    known = seen.select(*IDENTITY).distinct().withColumn("_known", F.lit(True))
    return again.join(known, list(IDENTITY), "left").filter("_turn > 1 OR _known").select("seq")


def near(seen: DataFrame | None, identities: DataFrame) -> DataFrame | None:
    """Identities seen before that can be among these: those in their range of positions.

    Each batch kept its identities in files of its own, whose statistics tell the range. So batches
    that lie elsewhere in the log are not read, however many are remembered.
    """
    if seen is None:
        return None
    low, high = identities.agg(F.min("lsn"), F.max("lsn")).first()
    return None if low is None else seen.filter(F.col("lsn").between(low, high))


def first_deliveries(changes: DataFrame, begins: DataFrame) -> DataFrame:
    """Each change once, as it first arrived."""
    return changes.join(repeated(identified(changes, begins)), "seq", "left_anti")
