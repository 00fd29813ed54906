"""Mixing sources to target weights by capped water-filling. Built-in functions only.

Sources are ranked by code point, NULL last, and take the weights in turn. A
source's target is its share of all words, but at most ``max_epochs`` times its
own; the excess goes to the other sources by weight until none is above. Words
taken are whole repetitions of every document and a fractional one: documents in
the order of a seeded digest until the target is met, the last of them in part.

Defined results: a NULL or empty text has size 0 and takes nothing. A NULL
source is a source. Rows with the same id, size and source are drawn together;
where they meet the edge, each takes an equal part. An empty table gives an empty
result. Extra columns are ignored by ``mix`` and kept by ``repeated``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fixed, numbered

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20
FEW, FEW_BYTES = 100_000, 16 << 20  # sources, and bytes of their names, that are handed to every task
SALTS = 16


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def draw_of(doc_id: Column, seed: int) -> Column:
    """The order in which documents are drawn."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size`` in; ``target`` added. Each round clamps sources and shares their excess again."""
    ranked = numbered(sizes, "mix-sources", F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    table = fixed(ranked.select("source", "source_size", weight.alias("weight")), "mix-weights")
    cap, level = F.col("source_size") * max_epochs, None
    while True:
        clamped = F.lit(False) if level is None else cap <= F.col("weight") * level
        row = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(clamped, cap).otherwise(0)).alias("clamped"),
            F.sum(F.when(clamped, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if not row["free"]:
            break
        raised = (row["all"] - row["clamped"]) / row["free"]
        if level is not None and raised <= level:
            break
        level = raised
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level or 0.0)))
    return table.select("source", "source_size", target.alias("target"))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    row = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"))
    return row.withColumn("draw", draw_of(F.col("doc_id"), seed))


def shares(rows: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """For each source its target, the whole repetitions, and the document where the fractional one ends.

    The order within a source is cut into 4,096 ranges of the digest, so that a
    large source is many groups; the sum of the earlier ranges is carried in.
    """
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.floor(F.col("target") / F.col("source_size"))
    plan = fixed(
        targets(per_source, weights, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, whole).otherwise(0).cast("long"))
        .withColumn("rest", (F.round("target") - F.col("whole") * F.col("source_size")).cast("long")),
        "mix-plan",
    )
    units = rows.filter("size > 0").groupBy("source", F.substring("draw", 1, 3).alias("range"), "draw", "doc_id", "size")
    units = units.agg(F.count("*").alias("n"))
    ranges = units.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    by_source = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("words").over(by_source), F.lit(0)))
    parts = ranges.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    parts = parts.filter("p.rest > 0 and r.before < p.rest and r.before + r.words >= p.rest")
    parts = parts.select("p.source", "r.range", (F.col("p.rest") - F.col("r.before")).alias("left"))
    ends = units.alias("u").join(
        parts.alias("e"), F.col("u.source").eqNullSafe(F.col("e.source")) & (F.col("u.range") == F.col("e.range"))
    )
    ends = ends.select("u.source", "u.draw", "u.doc_id", "u.size", "u.n", "e.left")
    order = Window.partitionBy("source").orderBy("draw", "doc_id", "size")
    earlier = F.coalesce(F.sum(F.col("size") * F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.withColumn("left", F.col("left") - earlier).filter("left > 0 and left <= size * n")
    edge = ends.select(
        F.col("source").alias("edge_source"),
        F.struct("draw", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "size").alias("edge"),
        F.floor(F.col("left") / F.col("n")).alias("edge_words"),
    )
    plan = plan.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source", "rest")
    return fixed(plan, "mix-shares")


def _with_shares(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds the words a row takes. ``plan`` has one row for each source. It is broadcast after its rows and the bytes
    of its names were counted; if there is more of it, rows meet it by source and salt, so a large source is many groups."""
    renamed = plan.select(*[F.col(c).alias(f"__mix_{c}") for c in plan.columns])
    same = F.col("__mix_row.source").eqNullSafe(F.col("__mix_source"))
    total = plan.agg(F.count("*").alias("n"), F.sum(F.octet_length("source")).alias("bytes")).first()
    if total["n"] <= FEW and (total["bytes"] or 0) <= FEW_BYTES:
        joined = rows.join(F.broadcast(renamed), same)
    else:
        salted = rows.withColumn("__mix_salt", F.pmod(F.xxhash64("__mix_row"), F.lit(SALTS)).cast("int"))
        each = renamed.withColumn("__mix_side", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(each, same & (F.col("__mix_salt") == F.col("__mix_side")))
    own = F.struct(
        F.col("__mix_row.draw").alias("draw"),
        F.coalesce("__mix_row.doc_id", F.lit(-(1 << 63))).alias("doc_id"),
        F.col("__mix_row.size").alias("size"),
    )
    size = F.col("__mix_row.size")
    part = F.when(own < F.col("__mix_edge"), size).when(own == F.col("__mix_edge"), F.col("__mix_edge_words"))
    return joined.withColumn("__mix_taken", (F.col("__mix_whole") * size + F.coalesce(part, F.lit(0))).cast("long"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """How many words the mix takes of every document."""
    rows = fixed(sized(docs, seed), "mix-sizes")
    plan = shares(rows, weights, max_epochs)
    taken = _with_shares(rows.select(F.struct("doc_id", "source", "size", "draw").alias("__mix_row")), plan)
    return taken.select(
        "__mix_row.doc_id",
        "__mix_row.source",
        "__mix_row.size",
        F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        F.col("__mix_taken").alias("taken"),
    )


def repeated(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """The mix itself: each document as often as it is taken, all its columns kept, the last one of a source cut."""
    rows = fixed(sized(docs, seed), "mix-sizes")
    plan = shares(rows, weights, max_epochs)
    row = F.struct("doc_id", "source", size_of(F.col("text")).alias("size"), draw_of(F.col("doc_id"), seed).alias("draw"))
    taken = _with_shares(docs.withColumn("__mix_row", row), plan)
    size = F.col("__mix_row.size")
    times = F.ceil(F.col("__mix_taken") / size).cast("int")
    each = taken.filter("__mix_taken > 0").withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), times)))
    words = F.col("__mix_taken") - (F.col("__mix_copy") - 1) * size
    # Every piece is white space and the word after it; only a cut document is split.
    parts = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(parts, F.lit(1), words.cast("int")), "")
    text = F.when(words >= size, F.col("text")).otherwise(cut)
    return each.withColumn("text", text).select(*docs.columns)


SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS draw FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, sum(source_size) OVER () AS t, sum(w) OVER () AS tw,
         coalesce(sum(3 * source_size) OVER k, 0) AS c, coalesce(sum(w) OVER k, 0) AS cw
  FROM s WINDOW k AS (ORDER BY 3 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), m AS (SELECT *, 3 * source_size * (tw - cw) <= w * (t - c) AS clamped FROM o
), l AS (
  SELECT (max(t) - sum(CASE WHEN clamped THEN 3 * source_size ELSE 0 END))::DOUBLE
         / sum(CASE WHEN clamped THEN 0 ELSE w END)::DOUBLE AS level FROM m
), p AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, coalesce(w * level, 3.0 * source_size)) AS target
  FROM s, l
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM p
), r AS (
  SELECT d.doc_id, d.source, d.size, q.source_size, q.target, q.whole,
         (round(q.target) - q.whole * q.source_size)::BIGINT
         - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, source, size, source_size, target,
       (whole * size + greatest(0, least(size, room)))::BIGINT AS taken FROM r
"""
