"""The fixed table shapes that pass between the parts."""

from __future__ import annotations

from pyspark.sql import types as T

# Message kinds in the raw log: relation, begin, commit, insert, update, delete, truncate.
RELATION, BEGIN, COMMIT, INSERT, UPDATE, DELETE, TRUNCATE = "R", "B", "C", "I", "U", "D", "T"
CHANGE_KINDS = (INSERT, UPDATE, DELETE)
SILENT_KINDS = (RELATION, BEGIN, COMMIT, TRUNCATE)

# Stands for a value that the source did not send because it did not change.
UNCHANGED = "\u0000"

COLUMNS_TYPE = T.ArrayType(
    T.StructType([T.StructField("name", T.StringType()), T.StructField("oid", T.IntegerType())])
)

RAW_LOG = T.StructType(
    [
        T.StructField("seq", T.LongType()),  # arrival order; never the log position
        T.StructField("lsn", T.LongType()),
        T.StructField("xid", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("relation_id", T.IntegerType()),
        T.StructField("ns", T.StringType()),
        T.StructField("rel", T.StringType()),
        T.StructField("cols", COLUMNS_TYPE),  # kind R
        T.StructField("old", T.ArrayType(T.StringType())),  # tuple text, null = NULL
        T.StructField("new", T.ArrayType(T.StringType())),
        T.StructField("commit_ts", T.TimestampType()),  # kind C
    ]
)

EVENT_COLUMNS = ("seq", "lsn", "xid", "source", "table", "op", "ts", "before", "after")
ENVELOPE_COLUMNS = ("source", "table", "op", "ts", "before", "after")

LEDGER = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("lsn", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("transform_s", T.DoubleType()),
        T.StructField("sink_s", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)
