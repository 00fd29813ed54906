"""Changes between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _side(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """One row struct per key; a repeated key fails the job.

    The window needs the same partitioning and sort as the join that follows,
    so checking the keys costs no shuffle or sort of its own.
    """
    by_key = W.partitionBy(*keys).orderBy(*keys)
    message = F.lit(f"{name} snapshot: repeated key in {', '.join(keys)}")
    row = F.struct(*columns)
    checked = F.when(F.col("_nth") > 1, F.raise_error(message).cast(df.select(row).schema[0].dataType))
    return df.withColumn("_nth", F.row_number().over(by_key)).select(
        *keys, checked.otherwise(row).alias(name)
    )


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], table: str, source: str = "postgres"
) -> DataFrame:
    """Events with struct images: new keys are creates, gone ones deletes, differing rows updates."""
    columns = new.columns
    if set(columns) != set(old.columns):
        raise ValueError("snapshots have different columns")
    before = _side(old.select(*columns), keys, columns, "before")
    after = _side(new.select(*columns), keys, columns, "after")
    pairs = before.join(after, list(keys), "full_outer").filter(
        ~F.col("before").eqNullSafe(F.col("after"))
    )
    op = (
        F.when(F.col("before").isNull(), F.lit("create"))
        .when(F.col("after").isNull(), F.lit("delete"))
        .otherwise(F.lit("update"))
    )
    return pairs.select(
        *keys,
        F.lit(source).alias("source"),
        F.lit(table).alias("table"),
        op.alias("op"),
        "before",
        "after",
    )


def as_events(diff: DataFrame, keys: Sequence[str], version: int, ts=None) -> DataFrame:
    """A snapshot diff as ordinary events; all share the new snapshot's version as ``seq``."""
    return diff.drop(*keys).select(
        F.lit(version).cast("bigint").alias("seq"),
        F.lit(None).cast("bigint").alias("lsn"),
        F.lit(None).cast("bigint").alias("xid"),
        "source",
        "table",
        "op",
        F.lit(ts).cast("timestamp").alias("ts"),
        F.to_variant_object("before").alias("before"),
        F.to_variant_object("after").alias("after"),
        F.lit(False).alias("not_finite"),
    )
