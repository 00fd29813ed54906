"""Left joins of a large log to a lookup table that may or may not be small.

A lookup side is broadcast only after its size was measured. Beyond the limit
the join shuffles, with keys that hold a large part of the log spread first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import shared_folder

# At most this many keys can each hold more than 1/MAX_HOT_KEYS of the rows.
MAX_HOT_KEYS = 2000
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 << 20


def within(df: DataFrame, rows: int, size: int | None = None) -> bool:
    """Whether a table has at most ``rows`` rows, and ``size`` bytes if given; stops reading soon after the limit."""
    if size is None:
        return df.select(F.lit(1)).limit(rows + 1).count() <= rows
    weight = F.octet_length(F.to_json(F.struct("*")))
    n, total = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(weight)).first()
    return n <= rows and (total or 0) <= size


def hot_keys(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keys holding more than 1/MAX_HOT_KEYS of the rows, with count and range of ``order``.

    Counting combines on the map side, so a hot key costs one row per task. The
    result has fewer than MAX_HOT_KEYS rows by construction.
    """
    counts = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(order).alias("_lo"), F.max(order).alias("_hi")
    )
    total = counts.agg(F.sum("_n")).first()[0] or 0
    floor = max(total // MAX_HOT_KEYS, 1)
    return counts.filter(F.col(key).isNotNull() & (F.col("_n") > floor)).withColumn(
        "_parts", F.ceil(F.col("_n") / F.lit(floor)).cast("int")
    )


def left_lookup(
    log: DataFrame,
    lookup: DataFrame,
    key: str,
    order: str = "seq",
    broadcast_rows: int = MAX_BROADCAST_ROWS,
    broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``log`` left-joined to ``lookup``, which has one row per key.

    A large lookup needs the counts of keys before the join. The log is written to the shared folder first, so
    whatever made it, user functions among it, runs once and both steps see the same rows.
    """
    if within(lookup, broadcast_rows, broadcast_bytes):
        return log.join(F.broadcast(lookup), key, "left")
    return _salted_join(fixed(log), lookup, key, order)


def fixed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, by all tasks, and read from there."""
    path = f"{shared_folder(df.sparkSession)}/millrace-fixed/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _salted_join(log: DataFrame, lookup: DataFrame, key: str, order: str) -> DataFrame:
    """Shuffle join on (key, salt): the rows of a hot key are dealt out by a hash, its lookup row goes to every salt.

    A hash spreads a key however its rows lie in the log, in one burst too. Rows without a key match nothing
    and are spread likewise.
    """
    hot = F.broadcast(hot_keys(log, key, order).select(key, "_parts"))
    parts = F.coalesce("_parts", F.when(F.col(key).isNull(), F.lit(MAX_HOT_KEYS)).otherwise(F.lit(1)))
    salt = F.pmod(F.xxhash64(order), parts).cast("int")
    left = log.join(hot, key, "left").withColumn("_salt", salt).drop("_parts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    right = lookup.join(hot, key, "left").withColumn("_salt", every).drop("_parts")
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def _slice_of(key: str, order: str) -> Column:
    """Which of a hot key's slices a row falls in; 0 for any other key.

    Rows without a key match nothing and are spread at random.
    """
    width = F.greatest(F.expr("(_hi - _lo) div _parts + 1"), F.lit(1))
    return (
        F.when(F.col(key).isNull(), F.pmod(F.hash(order), F.lit(MAX_HOT_KEYS)))
        .when(F.col("_parts").isNull(), F.lit(0))
        .otherwise(F.least(F.greatest(F.floor((F.col(order) - F.col("_lo")) / width), F.lit(0)), F.col("_parts") - 1).cast("int"))
    )


def _spread_join(log: DataFrame, lookup: DataFrame, key: str, order: str, span: tuple[str, str]) -> DataFrame:
    """Shuffle join on (key, slice): each hot key is cut into ranges of ``order``.

    The lookup rows are valid for ``span[0] <= order < span[1]`` and go only to the slices they overlap.
    """
    hot = F.broadcast(hot_keys(log, key, order))
    sides = ["_n", "_lo", "_hi", "_parts"]
    left = log.join(hot, key, "left").withColumn("_slice", _slice_of(key, order)).drop(*sides)
    right = lookup.join(hot, key, "left")
    last = (F.coalesce(F.col("_parts"), F.lit(1)) - 1).cast("bigint")
    low, high = span
    width = F.greatest(F.expr("(_hi - _lo) div _parts + 1"), F.lit(1))
    # Rows outside the counted range are in the outermost slices.
    cut = lambda c: F.least(F.greatest(F.coalesce(F.floor((c - F.col("_lo")) / width), F.lit(0)), F.lit(0)), last)
    first, last = cut(F.col(low)).cast("int"), cut(F.col(high) - 1).cast("int")
    right = (
        right.withColumn("_first", first)
        .withColumn("_last", last)
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("_slice", F.explode(F.sequence(F.col("_first").cast("int"), F.col("_last").cast("int"))))
        .drop("_first", "_last", *sides)
    )
    l, r = left.alias("l"), right.alias("r")
    condition = (
        (F.col(f"l.{key}") == F.col(f"r.{key}"))
        & (F.col("l._slice") == F.col("r._slice"))
        & (F.col(f"l.{order}") >= F.col(f"r.{span[0]}"))
        & (F.col(f"l.{order}") < F.col(f"r.{span[1]}"))
    )
    extra = [F.col(f"r.{c}") for c in lookup.columns if c != key]
    return l.join(r, condition, "left").select(*(F.col(f"l.{c}") for c in log.columns), *extra)


def asof_lookup(
    log: DataFrame,
    spans: DataFrame,
    key: str,
    span: tuple[str, str],
    small: bool,
    order: str = "seq",
) -> DataFrame:
    """``log`` left-joined to the one span of its key that covers ``order``."""
    if not small:
        return _spread_join(log, spans, key, order, span)
    l, r = log.alias("l"), F.broadcast(spans.alias("r"))
    condition = (
        (F.col(f"l.{key}") == F.col(f"r.{key}"))
        & (F.col(f"l.{order}") >= F.col(f"r.{span[0]}"))
        & (F.col(f"l.{order}") < F.col(f"r.{span[1]}"))
    )
    extra = [F.col(f"r.{c}") for c in spans.columns if c != key]
    return l.join(r, condition, "left").select(*(F.col(f"l.{c}") for c in log.columns), *extra)
