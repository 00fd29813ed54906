"""Large columns that an update left as they were, and that the source therefore did not send.

In the raw log such a value is marked by the text U+0000, which no text column can hold. Unless it is filled,
it reads as NULL. It is filled from the old row where that was sent, else from the last state of the row's key
in the log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.decode import ChangeLog
from millrace.schemas import UNCHANGED

# States of a key are put in order piece by piece; a piece spans this many seq values.
PIECE = 1 << 22


def _marked(values: str) -> Column:
    return F.coalesce(F.array_contains(values, UNCHANGED), F.lit(False))


def from_old_row(changes: DataFrame) -> DataFrame:
    """Marks replaced by the value at the same place of the old row, where there is one."""
    filled = F.zip_with(
        "new",
        F.slice("old", F.lit(1), F.least(F.size("old"), F.size("new"))),
        lambda now, was: F.when((now == UNCHANGED) & was.isNotNull(), was).otherwise(now),
    )
    return changes.withColumn("new", F.when(_marked("new") & F.col("old").isNotNull(), filled).otherwise(F.col("new")))


def fill_unchanged(log: ChangeLog, keys: Mapping[str, Sequence[str]], piece: int = PIECE) -> ChangeLog:
    """The log with marks filled; ``keys`` names the key columns of each table.

    Only the marked columns of keys that have marks are followed, by name, so a new layout does not matter.
    Their states are ordered inside pieces of the sequence, with one carried row per piece: a key with
    most of the changes is no task's alone. Marks without any earlier state, and those of tables
    without named keys, stay and read as NULL.
    """
    filled = replace(log, changes=from_old_row(log.changes))
    bound = filled.with_relations().filter(F.col("cols").isNotNull())
    row = F.coalesce("new", "old")
    # The old row says where an update moved the key from; the new one is the state from then on.
    key = F.lit(None).cast("array<string>")
    for table, names in keys.items():
        parts = [F.get(row, (F.array_position(F.transform("cols", lambda c: c["name"]), n) - 1).cast("int")) for n in names]
        key = F.when(F.col("table") == table, F.array(*parts)).otherwise(key)
    states = bound.select("seq", "table", key.alias("key"), "kind", "cols", "new").filter(
        F.col("key").isNotNull() & ~F.exists("key", lambda k: k.isNull() | (k == UNCHANGED))
    )
    values = F.arrays_zip(
        F.slice(F.transform("cols", lambda c: c["name"]), F.lit(1), F.size("new")).alias("name"),
        F.slice("new", F.lit(1), F.size("cols")).alias("text"),
    )
    # A deleted row has no state: whatever comes under its key later is another row.
    cells = states.withColumn(
        "_values", F.when(F.col("kind") == "D", F.transform("cols", lambda c: F.struct(c["name"].alias("name"), F.lit(None).cast("string").alias("text")))).otherwise(values)
    ).select("seq", "table", "key", F.posexplode("_values").alias("at", "_v"))
    cells = cells.select("seq", "table", "key", "at", F.col("_v.name").alias("name"), F.col("_v.text").alias("text"))
    by = ["table", "key", "name"]
    wanted = cells.filter(F.col("text") == UNCHANGED).select(*by).distinct()
    followed = cells.join(wanted, by, "left_semi").withColumn("_piece", F.floor(F.col("seq") / piece))
    # A state is a struct, so that a NULL value is a state too.
    state = F.when(F.col("text").isNull() | (F.col("text") != UNCHANGED), F.struct("text"))
    followed = followed.withColumn("_state", state)
    ends = followed.groupBy(*by, "_piece").agg(F.max_by("_state", F.when(F.col("_state").isNotNull(), F.col("seq"))).alias("_end"))
    carried = F.last("_end", ignorenulls=True).over(
        W.partitionBy(*by).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    )
    ends = ends.select(*by, "_piece", carried.alias("_carried"))
    inside = W.partitionBy(*by, "_piece").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    placed = followed.withColumn("_last", F.last("_state", ignorenulls=True).over(inside)).filter(F.col("text") == UNCHANGED)
    found = (
        placed.join(ends, [*by, "_piece"])
        .withColumn("_found", F.coalesce("_last", "_carried"))
        .filter(F.col("_found").isNotNull())
        .groupBy("seq")
        .agg(F.map_from_entries(F.collect_list(F.struct("at", F.col("_found.text").alias("text")))).alias("_fills"))
    )
    value = F.transform(
        "new",
        lambda text, i: F.when(
            (text == UNCHANGED) & F.map_contains_key("_fills", i), F.try_element_at("_fills", i)
        ).otherwise(text),
    )
    changes = filled.changes.join(found, "seq", "left")
    changes = changes.withColumn("new", F.when(F.col("_fills").isNotNull(), value).otherwise(F.col("new")))
    return replace(filled, changes=changes.select(*filled.changes.columns))
