"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from ..session import shared_folder, ship_package

# What separates words in all contracts: space and the five ASCII controls from tab to return.
WORD = r"[^\x20\x09-\x0D]+"


# The most that a batch handed to Python holds, beyond its last row: texts differ in length by thousands.
BATCH_BYTES = 1 << 20
# Of a text that is too long to learn from whole, at most so many parts are candidates.
WINDOWS = 16


def prepare(spark: SparkSession) -> None:
    """Ships the package and bounds the bytes of a batch, which is kept on both sides of the pipe to Python."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) != str(BATCH_BYTES):
        spark.conf.set(key, str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fixed(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that later steps see them once and for all."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/millrace-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % parts


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    """Whether a row is kept from training. A row without an id is never learned from, and not held out."""
    return F.coalesce(fold(doc_id, parts) == rest, F.lit(False))


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Adds ``position`` from 0 in the given order, from sorted ranges and one total for each range."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = fixed(ranged.withColumns({"__part": F.spark_partition_id(), "__at": in_part}), name)
    before = part_offsets(placed.groupBy("__part").agg(F.count("*").alias("__n")), "__part", "__n")
    joined = placed.join(before, "__part")
    return joined.withColumn("position", F.col("__at") + F.col("__before")).drop("__part", "__at", "__before")


def part_offsets(totals: DataFrame, part: str, n: str) -> DataFrame:
    """``__before``: the sum of all earlier parts. One row for each partition, so the window is small."""
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias("__before"))


def chance(doc_id: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the id and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(1 << 30)) / float(1 << 30)


def labelled_sample(
    rows: DataFrame,
    longest: int,
    share: Callable[[int], int],
    seed: int,
    usable: Column | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """At most ``share(number of labels)`` distinct rows (doc_id, text, label) of every label, the same in every run.

    They are drawn by a hash of id and text among the texts of at most ``longest`` characters. A label without
    such texts gives windows of that length, which lie evenly over the whole of its texts. ``usable`` says of
    a text or window whether it can be learned from. With ``labels`` (doc_id, label), the label of a row is
    looked up there, and only ids, hashes and lengths are joined before the rows are drawn.
    """
    usable = F.lit(True) if usable is None else usable
    texts = rows.filter("doc_id is not null and text is not null").filter(usable)
    texts = texts.withColumn("__hash", F.xxhash64(F.lit(seed), "doc_id", "text"))
    size, short = F.length("text"), F.length("text") <= longest
    if labels is None:
        rows = texts.select("doc_id", "text", "label", "__hash").filter("label is not null")
    else:
        rows, short = texts.select("doc_id", "__hash", short.alias("__fits")).join(labels, "doc_id"), F.col("__fits")
    counts = rows.groupBy("label").agg(
        F.approx_count_distinct("__hash"), F.approx_count_distinct(F.when(short, F.col("__hash")))
    )
    found = counts.collect()
    if not found:
        return texts.select("doc_id", "text", F.lit(None).cast(rows.schema["label"].dataType).alias("label")).limit(0)
    most = share(len(found))
    # Some more than asked for, as the counts are estimates; the ranks below keep the bound.
    rates = [(label, n > 0, min(1.0, (1.25 * most + 20) / max(n or everything, 1))) for label, everything, n in found]
    table = StructType([rows.schema["label"]]).add("__short", BooleanType()).add("__rate", DoubleType())
    drawn = rows.join(F.broadcast(rows.sparkSession.createDataFrame(rates, table)), "label")
    drawn = drawn.filter(short | ~F.col("__short"))
    drawn = drawn.filter(F.pmod("__hash", F.lit(1 << 30)) / float(1 << 30) < F.col("__rate")).dropDuplicates(["label", "__hash"])
    if labels is not None:
        # Some 1.25 * most of each label, so small at any scale.
        drawn = F.broadcast(drawn.select("doc_id", "__hash", "label"))
        drawn = texts.select("doc_id", "text", "__hash").join(drawn, ["doc_id", "__hash"]).dropDuplicates(["label", "__hash"])
    count = F.least(F.lit(WINDOWS), F.ceil(size / longest)).cast("int")
    begin = F.when(count < 2, F.lit(0)).otherwise(F.floor(F.col("__nth") * (size - longest) / (count - 1)))
    cut = drawn.withColumn("__nth", F.explode(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)))
    cut = cut.withColumn("text", F.substring("text", (begin + 1).cast("int"), F.lit(longest))).filter(usable)
    order = Window.partitionBy("label").orderBy(F.xxhash64("__hash", "__nth"), "__hash", "__nth")
    return cut.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= most).select("doc_id", "text", "label")


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1_500_000):
    """Runs of rows with about ``most`` bytes of text: bounded working memory whatever the batch size.

    A single longer text is a run of its own. NULL texts count as empty. What was freed is given back in the end.
    """
    try:
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            start, size = 0, 0
            for i, n in enumerate(lengths):
                if i > start and size + n > most:
                    yield batch.slice(start, i - start)
                    start, size = i, 0
                size += n
            if start < batch.num_rows:
                yield batch.slice(start)
    finally:
        give_back()


def give_back() -> None:
    """Hands freed memory to the system: a worker outlives its task, and the next one may be another operator's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, each between two line feeds, and where each begins; one more place at the end."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    edge = pa.scalar("", pa.large_string())
    framed = pc.binary_join_element_wise(edge, texts, edge, pa.scalar("\n", pa.large_string()))
    if isinstance(framed, pa.ChunkedArray):
        framed = framed.combine_chunks()
    _, offsets, data = framed.buffers()
    starts = np.frombuffer(offsets, np.int64)[framed.offset : framed.offset + len(framed) + 1]
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def plain_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array without anything between them, and where each begins."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i]:starts[i+1]]``; empty segments give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64), np.cumsum(values, 0, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixing permutation of unsigned 64-bit numbers (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x
