"""Binding a change to the table layout in force when it arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.lookup import asof_lookup

END_OF_LOG = (1 << 63) - 1
# Broadcast limits for the layouts: versions, and columns over all versions.
MAX_VERSIONS = 50_000
MAX_COLUMNS = 2_000_000
# As many ids are listed in a filter at most.
MAX_PUSHED_IDS = 10_000


def table_name(ns: Column, rel: Column) -> Column:
    """Bare name in the default schema, else ``schema.name``."""
    return F.when(F.coalesce(ns, F.lit("")).isin("", "public"), rel).otherwise(
        F.concat(ns, F.lit("."), rel)
    )


def relation_spans(relations: DataFrame) -> DataFrame:
    """Each announced layout with the range of ``seq`` it is valid for.

    A layout announced again unchanged (as after a reconnect) does not start a
    new span. The windows run over announcements only, never over changes.
    """
    by_id = W.partitionBy("relation_id").orderBy("seq")
    layout = F.struct("ns", "rel", "cols")
    return (
        relations.select("relation_id", "seq", "ns", "rel", "cols")
        .withColumn("_previous", F.lag(layout).over(by_id))
        .withColumn("_first", F.row_number().over(by_id) == 1)
        .filter(F.col("_first") | ~F.col("_previous").eqNullSafe(layout))
        .withColumn(
            "seq_to", F.coalesce(F.lead("seq").over(by_id), F.lit(END_OF_LOG).cast("bigint"))
        )
        .select(
            "relation_id",
            F.col("seq").alias("seq_from"),
            "seq_to",
            table_name(F.col("ns"), F.col("rel")).alias("table"),
            "rel",
            "cols",
            (F.size(F.array_distinct("cols.name")) < F.size("cols")).alias("repeated_name"),
        )
    )


def spans_are_small(relations: DataFrame) -> bool:
    """Measure the announcements against the broadcast limits."""
    n, columns = relations.agg(F.count(F.lit(1)), F.sum(F.size("cols"))).first()
    return n <= MAX_VERSIONS and (columns or 0) <= MAX_COLUMNS


def out_of_scope(relations: DataFrame, tables: Sequence[str], limit: int = MAX_PUSHED_IDS) -> list[int]:
    """Ids that never stand for one of the tables, for a filter that the scan can take; none beyond the limit."""
    named = relations.groupBy("relation_id").agg(
        F.bool_or(table_name(F.col("ns"), F.col("rel")).isin(*tables)).alias("wanted")
    )
    ids = named.filter("NOT wanted AND relation_id IS NOT NULL").select("relation_id").limit(limit + 1).collect()
    return [] if len(ids) > limit else sorted(r.relation_id for r in ids)


def attach_relations(changes: DataFrame, spans: DataFrame, small: bool) -> DataFrame:
    """Add ``table, rel, cols`` of the covering span; NULL where none covers the change."""
    return asof_lookup(changes, spans, "relation_id", ("seq_from", "seq_to"), small).drop(
        "seq_from", "seq_to"
    )
