"""Reading a landed change log, whole or as it grows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas as S
from millrace import store

# In text form the position is written as a decimal string and may be missing or malformed.
TEXT_LOG = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "lsn" else f.dataType)
        for f in S.RAW_LOG.fields
    ]
)


# Landed files are cut at least this fine, which is also how fine Spark cuts a file for its tasks.
ROW_GROUP_BYTES = 4 << 20

# What can be wrong with a row as it was landed. An unreadable position does not keep a row from being used.
MALFORMED, NO_SEQ, NO_KIND, BAD_LSN = "malformed", "no seq", "no kind", "unreadable lsn"
LEFT_OUT = (MALFORMED, NO_SEQ, NO_KIND)
REJECTS = "seq bigint, reason string, text string"


def parsed_lines(lines: DataFrame) -> DataFrame:
    """The raw log from lines of JSON in ``value``, with ``problem`` and, where there is one, the line itself."""
    broken = T.StructType([*TEXT_LOG.fields, T.StructField("_broken", T.StringType())])
    text = F.col("value").cast("string")
    read = lines.filter(F.trim(text) != "").select(
        text.alias("line"), F.from_json(text, broken, {"columnNameOfCorruptRecord": "_broken"}).alias("m")
    )
    lsn = F.col("m.lsn").try_cast("bigint")
    problem = (
        F.when(F.col("m").isNull() | F.col("m._broken").isNotNull(), F.lit(MALFORMED))
        .when(F.col("m.seq").isNull(), F.lit(NO_SEQ))
        .when(F.col("m.kind").isNull(), F.lit(NO_KIND))
        .when(F.col("m.lsn").isNotNull() & lsn.isNull(), F.lit(BAD_LSN))
    )
    fields = ((lsn if f.name == "lsn" else F.col(f"m.{f.name}")).alias(f.name) for f in S.RAW_LOG.fields)
    return read.select(*fields, problem.alias("problem"), F.when(problem.isNotNull(), F.col("line")).alias("line"))


def checked(raw: DataFrame) -> DataFrame:
    """A raw log with ``problem``, what is wrong with a row or NULL, and ``line``, its text if it had one.

    Rows without a sequence number have no place in the log; rows without a kind say nothing.
    """
    if "problem" in raw.columns:
        return raw
    problem = F.when(F.col("seq").isNull(), F.lit(NO_SEQ)).when(F.col("kind").isNull(), F.lit(NO_KIND))
    return raw.withColumns({"problem": problem, "line": F.lit(None).cast("string")})


def usable(landed: DataFrame) -> DataFrame:
    """The rows of a checked log that can be used, as a plain raw log."""
    kept = landed.filter(F.col("problem").isNull() | ~F.col("problem").isin(*LEFT_OUT))
    return kept.select(*(f.name for f in S.RAW_LOG.fields))


def rejects(landed: DataFrame) -> DataFrame:
    """What was wrong in a checked log: ``seq, reason, text``, one row each."""
    row = F.to_json(F.struct(*(F.col(f.name) for f in S.RAW_LOG.fields)))
    return landed.filter(F.col("problem").isNotNull()).select(
        "seq", F.col("problem").alias("reason"), F.coalesce("line", row).alias("text")
    )


def _landed(reader, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return checked(reader.schema(S.RAW_LOG).parquet(path))
    if fmt == "json":
        return parsed_lines(reader.text(path))
    raise ValueError(f"unsupported log format: {fmt}")


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Everything landed under ``path``, unreadable rows too: see ``usable`` and ``rejects``."""
    return _landed(spark.read, path, fmt)


def read_log(
    spark: SparkSession, path: str, fmt: str = "parquet", start_lsn: int | None = None
) -> DataFrame:
    """The usable rows of the raw log under ``path``.

    A position of 0 or none starts at the beginning. Only changes are cut by
    the position: layouts and commits before it are still needed.
    """
    return from_position(usable(read_landed(spark, path, fmt)), start_lsn)


def from_position(raw: DataFrame, start_lsn: int | None) -> DataFrame:
    if not start_lsn:
        return raw
    # A change without a position is not known to lie before it.
    late = F.col("lsn").isNull() | (F.col("lsn") >= F.lit(start_lsn))
    return raw.filter(F.coalesce(~F.col("kind").isin(*S.CHANGE_KINDS), F.lit(True)) | late)


def stream_log(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    start_lsn: int | None = None,
    max_files: int = 1000,
) -> DataFrame:
    """The raw log as a stream of files, landed in arrival order. Unreadable rows stay in it, marked."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return from_position(_landed(reader, path, fmt), start_lsn)


def log_from_messages(messages: DataFrame) -> DataFrame:
    """The raw log from messages whose ``value`` is one JSON line of it, as a Kafka reader gives them.

    Values that are not such lines are left out, like malformed lines of a file.
    """
    return usable(parsed_lines(messages))


def stream_kafka(spark: SparkSession, brokers: Sequence[str], topic: str, **options) -> DataFrame:
    """The raw log from one Kafka topic of a single partition, which keeps arrival order; bad messages are marked.

    The cluster has to bring Spark's connector.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", ",".join(brokers))
    return parsed_lines(reader.option("subscribe", topic).options(**options).load())


def spread_out(batch: DataFrame, least_rows: int = 10_000) -> DataFrame:
    """A persisted part of a log over all cores.

    A file with large row groups, or one that can't be split, comes as one partition, and all that follows would
    be one task. So the rows of the partitions are counted, and dealt out if one has over twice its share.
    """
    cores = batch.sparkSession.sparkContext.defaultParallelism
    counts = [r["count"] for r in batch.groupBy(F.spark_partition_id()).count().collect()]
    total = sum(counts)
    if total < least_rows or max(counts) * cores <= 2 * total:
        return batch
    # Rows without a place in the log are dealt out by their text.
    by = [c for c in ("seq", "lsn", "xid", "line") if c in batch.columns]
    return batch.repartition(max(cores, len(counts)), *by)


def land_in_order(raw: DataFrame, path: str, rows_per_file: int = 5_000_000, min_files: int = 1) -> None:
    """Land a log as files whose age follows arrival order, as a stream reads them.

    All tasks write their range of the log at once, to a folder beside the landing; then the files are
    published one after the other, each dated after the one before. That takes two or three jobs,
    however many files there are. A file holds about ``rows_per_file`` rows, in groups small enough
    that all tasks share the reading of one file.
    """
    spark = raw.sparkSession
    staging = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex}"
    files = max(min_files, -(-raw.count() // rows_per_file))
    placed = raw.repartitionByRange(files, "seq").sortWithinPartitions("seq")
    placed.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(staging)
    store.publish_in_order(spark, staging, path)
