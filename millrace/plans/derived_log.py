"""Change logs derived by Spark from ordinary tables, for queries, benchmarks and tests.

Every row of the source table becomes one change, so the log grows with the table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import pgtext as P
from millrace.operators.decode import ChangeLog

# Layouts of the log derived from ``events``: seq, id, schema, name, columns.
# The second layout of 102 arrives mid-log.
EVENT_LAYOUTS = (
    (0, 101, "public", "users", (("user_id", P.INT8), ("amount", P.NUMERIC), ("props", P.JSONB))),
    (1, 102, "public", "orders", (("user_id", P.INT4), ("amount", P.NUMERIC), ("props", P.JSON))),
    (2, 103, "app", "audit_logs", (("actor", P.INT8), ("amount", P.NUMERIC), ("detail", P.TEXT))),
    (3, 104, "", "sessions", (("user_id", P.INT8), ("amount", P.NUMERIC), ("props", P.JSONB))),
    (30003, 102, "sales", "orders", (("customer", P.INT8), ("amount", P.NUMERIC), ("note", P.TEXT))),
)
EVENT_RELATIONS = {"signup": 101, "purchase": 102, "error": 103, "click": 104}
UNKNOWN_RELATION = 199

ORDER_COLUMNS = (
    ("order_key", P.INT8),
    ("cust_key", P.INT4),
    ("status", P.BPCHAR),
    ("total", P.NUMERIC),
    ("rate", P.FLOAT8),
    ("order_date", P.DATE),
    ("created", P.TIMESTAMP),
    ("seen", P.TIMESTAMPTZ),
    ("at", P.TIME),
    ("urgent", P.BOOL),
    ("priority", P.VARCHAR),
    ("meta", P.JSONB),
    ("tags", P.TEXT_ARRAY),
    ("blob", P.BYTEA),
    ("uid", P.UUID),
)
# A table made anew gets another id, and announces its layout again after a reconnect.
ORDER_IDS, OUTBOX_IDS = (301, 302, 303, 304), (401, 402)
ORDER_LAYOUTS = (
    *((i, rid, "public", "order_facts", ORDER_COLUMNS) for i, rid in enumerate(ORDER_IDS)),
    (4002, 302, "public", "order_facts", ORDER_COLUMNS),
)
OUTBOX_COLUMNS = (("aggregate_id", P.INT8), ("event_type", P.TEXT), ("payload", P.JSON))
OUTBOX_LAYOUTS = tuple((0, rid, "public", "outbox_events", OUTBOX_COLUMNS) for rid in OUTBOX_IDS)
# One table whose layout changes: columns are added, change places and types, and go.
DRIFT_VIEW = (
    ("order_key", P.INT8),
    ("cust_key", P.INT8),
    ("status", P.BPCHAR),
    ("total", P.NUMERIC, "decimal(14,2)"),
)
DRIFT_LAYOUTS = (
    (0, 501, "", "drifting", (("order_key", P.INT8), ("cust_key", P.INT4), ("status", P.BPCHAR))),
    (5002, 501, "", "drifting", (("status", P.BPCHAR), ("total", P.NUMERIC), ("order_key", P.INT8), ("cust_key", P.INT8))),
    (10002, 501, "", "drifting", (("order_key", P.INT8), ("note", P.TEXT), ("total", P.FLOAT8), ("status", P.TEXT))),
    (1, 502, "", "elsewhere", (("order_key", P.INT8),)),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a table of fewer splits; larger tables are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def layout_rows(spark: SparkSession, layouts) -> DataFrame:
    """The announcements as a literal table: its size is fixed by the code above."""
    rows = [
        (seq, rid, ns, rel, [(name, oid) for name, oid in cols])
        for seq, rid, ns, rel, cols in layouts
    ]
    schema = "seq bigint, relation_id int, ns string, rel string, cols array<struct<name:string,oid:int>>"
    return spark.createDataFrame(rows, schema)


def cents_text(value: Column) -> Column:
    """Two-decimal text built from whole cents, so engines agree on every digit."""
    cents = F.round(value * 100).cast("bigint")
    sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.abs(cents)
    return F.concat(
        sign,
        F.floor(whole / 100).cast("string"),
        F.lit("."),
        F.lpad((whole % 100).cast("string"), 2, "0"),
    )


def wrapped_product(value: Column, factor: int) -> Column:
    """Product as an unsigned 64-bit position, in the bigint of the same bits: beyond 64 bits it starts again at 0."""
    half, whole = F.lit(Decimal(1 << 63)), F.lit(Decimal(1 << 64))
    unsigned = F.pmod(value.cast("decimal(19,0)") * F.lit(factor).cast("decimal(19,0)"), whole)
    return F.when(unsigned >= half, unsigned - whole).otherwise(unsigned).cast("bigint")


def events_log(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """One insert, update or delete per row of ``events``, ten rows to a transaction."""
    events = table(spark, sf_dir, "events")
    spread_events = spread(events)
    event_id = F.col("event_id")
    xid = F.expr("event_id div 10")
    seq = (event_id * 10 + 5).alias("seq")
    relation = F.coalesce(
        F.try_element_at(
            F.create_map(*(F.lit(p) for pair in EVENT_RELATIONS.items() for p in pair)),
            F.col("event_type"),
        ),
        F.lit(UNKNOWN_RELATION),
    )
    turn = event_id % 4
    kind = (
        F.when(turn == 0, S.INSERT).when(turn == 2, S.DELETE).otherwise(F.lit(S.UPDATE))
    )
    user = F.col("user_id").cast("string")
    now = F.array(user, cents_text(F.col("value")), F.col("props"))
    was = F.array(user, cents_text(F.col("value") + 1), F.col("props"))
    changes = spread_events.select(
        seq,
        (event_id * 64 + 16777216).alias("lsn"),
        xid.alias("xid"),
        kind.alias("kind"),
        relation.alias("relation_id"),
        F.when(turn.isin(1, 2), was).alias("old"),
        F.when(turn != 2, now).alias("new"),
    )
    commits = (
        events.groupBy(xid.alias("xid"))
        .agg(F.max("event_id").alias("last"), F.max("ts").cast("timestamp").alias("commit_ts"))
        .select((F.col("last") * 10 + 6).alias("seq"), "xid", "commit_ts")
    )
    return ChangeLog(changes, layout_rows(spark, EVENT_LAYOUTS), commits, small_relations=True)


def orders_log(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """One change per row of ``orders`` with a column of almost every type, some of it bad."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    hour = F.lpad((key % 24).cast("string"), 2, "0")
    clock = F.concat(hour, F.lit(":"), F.lpad((key % 60).cast("string"), 2, "0"), F.lit(":07"))
    texts = [
        F.when(key % 97 == 0, F.lit("n/a")).otherwise(key.cast("string")),
        F.when(key % 89 == 0, F.lit("99999999999")).otherwise(F.col("o_custkey").cast("string")),
        F.rpad("o_orderstatus", 3, " "),
        cents_text(F.col("o_totalprice")),
        F.when(key % 61 == 0, F.lit("NaN"))
        .when(key % 67 == 0, F.lit("1e400"))
        .otherwise(F.concat((key % 8).cast("string"), F.lit(".25"))),
        F.when(
            key % 83 == 0,
            F.date_format("o_orderdate", "dd-MM-yyyy"),
        ).otherwise(day),
        F.concat(day, F.lit(" "), clock, F.when(key % 2 == 0, F.lit(".50")).otherwise(F.lit(""))),
        F.concat(day, F.lit(" "), clock, F.lit("+05")),
        F.when(key % 79 == 0, F.lit("25:00:00")).otherwise(clock),
        F.when(key % 3 == 0, F.lit("t")).otherwise(F.lit("f")),
        F.when(key % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")),
        F.when(key % 7 == 0, F.lit("{broken"))
        .when(key % 13 == 0, F.lit(""))
        .otherwise(
            F.concat(F.lit('\u0001{"k":'), key.cast("string"), F.lit(',"a":[1,2]}'))
        ),
        F.concat(F.lit("{"), F.col("o_custkey").cast("string"), F.lit(",x}")),
        F.concat(F.lit("\\x"), F.lpad(F.hex(key), 8, "0")),
        F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(key.cast("string"), 12, "0")),
    ]
    # Mostly whole tuples; some lack the last value, some have one too many.
    length = (
        F.when(key % 113 == 0, len(texts) + 1).when(key % 5 == 0, len(texts) - 1).otherwise(len(texts))
    )
    values = F.slice(F.array(*texts, F.lit("extra")), 1, length)
    turn = key % 3
    orders = table(spark, sf_dir, "orders")
    changes = spread(orders).withColumn("_values", values).select(
        (key * 10 + 1).alias("seq"),
        (key * 64 + 16777216).alias("lsn"),
        F.expr("o_orderkey div 20").alias("xid"),
        F.when(turn == 0, S.INSERT).when(turn == 1, S.UPDATE).otherwise(S.DELETE).alias("kind"),
        (F.lit(ORDER_IDS[0]) + key % len(ORDER_IDS)).cast("int").alias("relation_id"),
        F.when(turn == 2, F.col("_values")).alias("old"),
        F.when(turn != 2, F.col("_values")).alias("new"),
    )
    commits = (
        orders.groupBy(F.expr("o_orderkey div 20").alias("xid"))
        .agg(
            F.max("o_orderkey").alias("last"),
            F.max("o_orderdate").cast("timestamp").alias("commit_ts"),
        )
        .select((F.col("last") * 10 + 2).alias("seq"), "xid", "commit_ts")
    )
    return ChangeLog(changes, layout_rows(spark, ORDER_LAYOUTS), commits, small_relations=True)


def outbox_log(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Inserts into an outbox table, one per row of ``orders``, some fields unusable."""
    key = F.col("o_orderkey")
    number = key.cast("string")
    texts = F.array(
        F.when(key % 10 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string")),
        F.when(key % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("order."), F.lower("o_orderstatus"))),
        F.when(key % 8 == 0, F.lit(None))
        .when(key % 8 == 1, F.concat(F.lit("raw "), number))
        .when(key % 8 == 2, F.concat(F.lit('"quoted '), number, F.lit('"')))
        .when(key % 8 == 3, number)
        .otherwise(F.concat(F.lit('{"id":'), number, F.lit("}"))),
    )
    changes = spread(table(spark, sf_dir, "orders")).select(
        (key * 10 + 1).alias("seq"),
        (key * 64 + 16777216).alias("lsn"),
        F.expr("o_orderkey div 20").alias("xid"),
        F.lit(S.INSERT).alias("kind"),
        (F.lit(OUTBOX_IDS[0]) + key % len(OUTBOX_IDS)).cast("int").alias("relation_id"),
        F.lit(None).cast("array<string>").alias("old"),
        texts.alias("new"),
    )
    commits = changes.limit(0).select("seq", "xid", F.lit(None).cast("timestamp").alias("commit_ts"))
    return ChangeLog(changes, layout_rows(spark, OUTBOX_LAYOUTS), commits, small_relations=True)


def drifting_log(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """One change per row of ``orders``, of a table whose layout changes twice."""
    key = F.col("o_orderkey")
    number = F.when(key % 97 == 0, F.lit("n/a")).otherwise(key.cast("string"))
    # Fits eight bytes, not four.
    customer = F.when(key % 89 == 0, F.lit("99999999999")).otherwise(F.col("o_custkey").cast("string"))
    status = F.col("o_orderstatus")
    # Fits a floating column, not a decimal one.
    total = F.when(key % 83 == 0, F.lit("NaN")).otherwise(cents_text(F.col("o_totalprice")))
    seq = key * 10 + 1
    values = (
        F.when(seq < 5002, F.array(number, customer, status))
        .when(seq < 10002, F.array(status, cents_text(F.col("o_totalprice")), number, customer))
        .otherwise(F.array(number, F.lit("-"), total, status))
    )
    elsewhere = key % 10 == 9
    values = F.when(elsewhere, F.array(number)).otherwise(
        F.when(key % 79 == 0, F.concat(values, F.array(F.lit("extra")))).otherwise(values)
    )
    orders = table(spark, sf_dir, "orders")
    changes = spread(orders).withColumn("_values", values).select(
        seq.alias("seq"),
        (key * 64 + 16777216).alias("lsn"),
        F.expr("o_orderkey div 20").alias("xid"),
        F.when(key % 2 == 0, S.INSERT).otherwise(S.DELETE).alias("kind"),
        F.when(elsewhere, F.lit(502)).otherwise(F.lit(501)).alias("relation_id"),
        F.when(key % 2 == 1, F.col("_values")).alias("old"),
        F.when(key % 2 == 0, F.col("_values")).alias("new"),
    )
    commits = changes.limit(0).select("seq", "xid", F.lit(None).cast("timestamp").alias("commit_ts"))
    return ChangeLog(changes, layout_rows(spark, DRIFT_LAYOUTS), commits, small_relations=True)


CARD_KEYS = {"cards": ("id",)}
CARD_LAYOUTS = (
    (0, 601, "", "cards", (("id", P.INT8), ("status", P.TEXT), ("body", P.TEXT))),
    (4002, 601, "", "cards", (("body", P.TEXT), ("id", P.INT8), ("status", P.TEXT))),
)


def cards_log(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """Changes of few rows with a large column: most updates leave it as it was and do not send it."""
    key = F.col("o_orderkey")
    seq = key * 10 + 1
    turn = key % 6
    body = F.concat(F.lit("body "), key.cast("string"))
    card, status = (key % 97).cast("string"), F.col("o_orderstatus")
    now = F.when(turn.isin(0, 1), body).when(turn != 5, F.lit(S.UNCHANGED))
    was = F.concat(F.lit("old "), key.cast("string"))

    def row(value):
        return F.when(seq < 4002, F.array(card, status, value)).otherwise(F.array(value, card, status))

    changes = spread(table(spark, sf_dir, "orders")).select(
        seq.alias("seq"),
        (key * 64 + 16777216).alias("lsn"),
        F.expr("o_orderkey div 20").alias("xid"),
        F.when(turn == 0, S.INSERT).when(turn == 5, S.DELETE).otherwise(F.lit(S.UPDATE)).alias("kind"),
        F.when(key >= 0, F.lit(601)).alias("relation_id"),
        F.when(turn == 2, row(was)).when(turn == 5, row(F.lit(None))).alias("old"),
        F.when(turn != 5, row(now)).alias("new"),
    )
    commits = changes.limit(0).select("seq", "xid", F.lit(None).cast("timestamp").alias("commit_ts"))
    return ChangeLog(changes, layout_rows(spark, CARD_LAYOUTS), commits, small_relations=True)


def raw_log(log: ChangeLog) -> DataFrame:
    """The pieces of a log put back into one raw table, with its begin messages."""

    def shaped(df: DataFrame, kind: str | None) -> DataFrame:
        if kind:
            df = df.withColumn("kind", F.lit(kind))
        for field in S.RAW_LOG.fields:
            if field.name not in df.columns:
                df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
        return df.select(*(F.col(f.name).cast(f.dataType) for f in S.RAW_LOG.fields))

    begins = log.changes.groupBy("xid").agg((F.min("seq") - 1).alias("seq"))
    return (
        shaped(log.changes, None)
        .unionByName(shaped(log.relations, S.RELATION))
        .unionByName(shaped(log.commits, S.COMMIT))
        .unionByName(shaped(begins, S.BEGIN))
    )
