"""For each registered query, the same result in plain SQL over the same tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

# The change log derived from ``events``, bound to its layouts.
EVENTS_LOG = """
log AS (
  SELECT event_id * 10 + 5 AS seq, event_id * 64 + 16777216 AS lsn, event_id // 10 AS xid,
    CASE event_type WHEN 'signup' THEN 101 WHEN 'purchase' THEN 102 WHEN 'error' THEN 103
      WHEN 'click' THEN 104 ELSE 199 END AS relation_id,
    CASE event_id % 4 WHEN 0 THEN 'create' WHEN 2 THEN 'delete' ELSE 'update' END AS op,
    event_id % 4 AS turn, user_id, props, event_id,
    CAST(round(value * 100) AS BIGINT) AS cents,
    CAST(round((value + 1) * 100) AS BIGINT) AS old_cents
  FROM events),
layouts(seq_from, relation_id, tbl, shape) AS (VALUES
  (0, 101, 'users', 'user'), (1, 102, 'orders', 'user'), (2, 103, 'app.audit_logs', 'audit'),
  (3, 104, 'sessions', 'user'), (30003, 102, 'sales.orders', 'sale')),
spans AS (
  SELECT *, coalesce(lead(seq_from) OVER (PARTITION BY relation_id ORDER BY seq_from),
    9223372036854775807) AS seq_to
  FROM layouts),
bound AS (
  SELECT l.*, r.tbl, r.shape FROM log l LEFT JOIN spans r
  ON l.relation_id = r.relation_id AND l.seq >= r.seq_from AND l.seq < r.seq_to),
commits AS (
  SELECT event_id // 10 AS xid, max(ts) AS commit_ts FROM events GROUP BY 1),
texts AS (
  SELECT *, CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS amount,
    CAST(old_cents // 100 AS VARCHAR) || '.' || lpad(CAST(old_cents % 100 AS VARCHAR), 2, '0') AS old_amount,
    replace(props, ' ', '') AS doc, '"' || replace(props, '"', '\\"') || '"' AS quoted
  FROM bound),
imaged AS (
  SELECT *,
    CASE WHEN turn IN (1, 2) THEN CASE shape
      WHEN 'user' THEN '{"amount":"' || old_amount || '","props":' || doc || ',"user_id":' || user_id || '}'
      WHEN 'audit' THEN '{"actor":' || user_id || ',"amount":"' || old_amount || '","detail":' || quoted || '}'
      WHEN 'sale' THEN '{"amount":"' || old_amount || '","customer":' || user_id || ',"note":' || quoted || '}'
    END END AS before_json,
    CASE WHEN turn <> 2 THEN CASE shape
      WHEN 'user' THEN '{"amount":"' || amount || '","props":' || doc || ',"user_id":' || user_id || '}'
      WHEN 'audit' THEN '{"actor":' || user_id || ',"amount":"' || amount || '","detail":' || quoted || '}'
      WHEN 'sale' THEN '{"amount":"' || amount || '","customer":' || user_id || ',"note":' || quoted || '}'
    END END AS after_json
  FROM texts),
stamped AS (
  SELECT i.*, c.commit_ts, epoch_us(c.commit_ts) AS ts_us,
    strftime(c.commit_ts, '%Y-%m-%dT%H:%M:%S') ||
      CASE WHEN epoch_us(c.commit_ts) % 1000000 = 0 THEN ''
        ELSE '.' || rtrim(lpad(CAST(epoch_us(c.commit_ts) % 1000000 AS VARCHAR), 6, '0'), '0') END
      || 'Z' AS ts_text
  FROM imaged i JOIN commits c USING (xid)),
lines AS (
  SELECT *, '{"source":"postgres","table":"' || tbl || '","op":"' || op || '","ts":"' || ts_text || '"'
    || coalesce(',"before":' || before_json, '') || coalesce(',"after":' || after_json, '') || '}' AS line
  FROM stamped WHERE tbl IS NOT NULL)
"""

# The change log derived from ``orders``, with the reason a tuple does not convert.
ORDERS_LOG = """
facts AS (
  SELECT o_orderkey AS k, o_orderkey * 10 + 1 AS seq, o_orderkey * 64 + 16777216 AS lsn, o_orderkey // 20 AS xid,
    CASE o_orderkey % 3 WHEN 0 THEN 'create' WHEN 1 THEN 'update' ELSE 'delete' END AS op,
    CASE o_orderkey % 3 WHEN 1 THEN 'new tuple' ELSE 'tuple' END AS label,
    strftime(o_orderdate, '%Y-%m-%d') AS day,
    lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':07' AS clock,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents, *
  FROM orders),
failures AS (
  SELECT *, CASE
    WHEN k % 97 = 0 THEN 'failed to convert column order_key: invalid int8 value "n/a"'
    WHEN k % 89 = 0 THEN 'failed to convert column cust_key: invalid int4 value "99999999999"'
    WHEN k % 61 <> 0 AND k % 67 = 0 THEN 'failed to convert column rate: invalid float8 value "1e400"'
    WHEN k % 83 = 0 THEN 'failed to convert column order_date: invalid date value "' || strftime(o_orderdate, '%d-%m-%Y') || '"'
    WHEN k % 79 = 0 THEN 'failed to convert column at: invalid time value "25:00:00"'
    WHEN k % 113 = 0 THEN 'column index 15 out of range for relation order_facts'
    END AS reason
  FROM facts),
parsed AS (
  SELECT *, 'failed to parse ' || label || ': ' || reason AS decode_error,
    rpad(o_orderstatus, 3, ' ') AS status_text,
    CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS total,
    CASE WHEN k % 7 = 0 THEN '"{broken"' WHEN k % 13 = 0 THEN NULL
      ELSE '{"a":[1,2],"k":' || k || '}' END AS meta_json,
    CASE WHEN k % 11 <> 0 THEN o_orderpriority END AS priority,
    '{' || o_custkey || ',x}' AS tags,
    '\\x' || lpad(upper(printf('%x', k)), 8, '0') AS blob_text,
    CASE WHEN k % 5 <> 0 THEN '00000000-0000-0000-0000-' || lpad(CAST(k AS VARCHAR), 12, '0') END AS uid
  FROM failures),
order_images AS (
  SELECT *,
    '{"at":"0000-01-01T' || clock || 'Z","blob":"' || base64(encode(blob_text)) || '","created":"' || day || 'T'
    || clock || CASE WHEN k % 2 = 0 THEN '.5' ELSE '' END || 'Z","cust_key":' || o_custkey
    || ',"meta":' || coalesce(meta_json, 'null') || ',"order_date":"' || day || 'T00:00:00Z","order_key":' || k
    || ',"priority":' || coalesce('"' || priority || '"', 'null') || ',"rate":'
    || CASE WHEN k % 61 = 0 THEN '"NaN"' ELSE (k % 8) || '.25' END || ',"seen":"' || day || 'T' || clock
    || '+05:00","status":"' || status_text || '","tags":"' || tags || '","total":"' || total || '"'
    || coalesce(',"uid":"' || uid || '"', '') || ',"urgent":' || CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END
    || '}' AS image
  FROM parsed),
settled AS (
  SELECT *, CASE
    WHEN reason IS NOT NULL THEN 'decode_error'
    WHEN k % 61 = 0 THEN 'transform_error'
    WHEN k % 4 = 0 THEN 'filtered'
    WHEN k % 10 = 7 THEN 'transform_error'
    WHEN k % 10 = 1 THEN 'sink_error'
    ELSE 'success' END AS status,
    CASE
    WHEN reason IS NOT NULL THEN decode_error
    WHEN k % 61 = 0 THEN 'transform 0 failed' || chr(10) || 'failed to marshal event: json: unsupported value: NaN or Infinity'
    WHEN k % 4 = 0 THEN NULL
    WHEN k % 10 = 7 THEN 'transform 1 failed' || chr(10) || 'seven'
    WHEN k % 10 = 1 THEN 'produce: empty topic' END AS error
  FROM order_images),
order_commits AS (
  SELECT o_orderkey // 20 AS xid, max(o_orderdate) AS commit_ts FROM orders GROUP BY 1)
"""

LEDGER = """
ledger AS (
  SELECT event_id AS seq, event_type AS tbl,
    CASE WHEN event_id % 4 = 0 THEN 'create' ELSE 'update' END AS op,
    CASE WHEN event_id % 11 = 0 THEN 'transform_error' WHEN event_id % 13 = 0 THEN 'sink_error'
      WHEN event_id % 17 = 0 THEN 'lost' WHEN event_id % 19 = 0 THEN 'filtered'
      WHEN event_id % 23 = 0 THEN 'decode_error' ELSE 'success' END AS status,
    CASE WHEN event_id % 11 = 0 THEN 'transform'
      WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN 'sink' END AS stage,
    CAST(json_extract(props, '$.k') AS INTEGER) / 65536.0 AS transform_s,
    CAST(json_extract(props, '$.k') AS INTEGER) * CAST(json_extract(props, '$.k') AS INTEGER) / 1024.0 AS sink_s,
    CASE WHEN event_id % 29 <> 0 THEN ts END AS ts, event_id % 60 AS lag
  FROM events)
"""


def oracle(name: str, ctes: str, body: str) -> None:
    SQL[name] = f"WITH {ctes.strip()}\n{body.strip()}" if ctes else body.strip()


oracle(
    "routed_changes",
    EVENTS_LOG,
    """
    SELECT tbl AS "table", op,
      CASE tbl WHEN 'users' THEN 'prod.users.events' WHEN 'orders' THEN 'prod.orders.events'
        ELSE 'cdc.' || tbl END AS topic, count(*) AS n
    FROM bound WHERE tbl IN ('users', 'orders', 'sales.orders', 'sessions') GROUP BY ALL
    """,
)
oracle(
    "decode_events",
    EVENTS_LOG,
    """
    SELECT seq, lsn, 'postgres' AS source, tbl AS "table", op, before_json, after_json
    FROM imaged WHERE tbl IS NOT NULL
    """,
)
oracle(
    "decode_images",
    ORDERS_LOG,
    """
    SELECT seq, 'order_facts' AS "table", op, k % 61 = 0 AS not_finite,
      CASE WHEN op = 'delete' THEN image END AS before_json,
      CASE WHEN op <> 'delete' THEN image END AS after_json
    FROM order_images WHERE reason IS NULL
    """,
)
oracle(
    "decode_typed",
    ORDERS_LOG,
    """
    SELECT seq, op, k AS order_key, o_custkey AS cust_key, status_text AS status, total,
      k % 61 = 0 AS rate_is_nan, CASE WHEN k % 61 <> 0 THEN (k % 8) + 0.25::DOUBLE END AS rate,
      day AS order_date,
      epoch_us(CAST(day || ' ' || clock AS TIMESTAMP)) + CASE WHEN k % 2 = 0 THEN 500000 ELSE 0 END AS created_us,
      epoch_us(CAST(day || ' ' || clock AS TIMESTAMP)) - 18000000000 AS seen_us,
      clock AS "at", k % 3 = 0 AS urgent, priority, meta_json, tags, 10 AS blob_bytes, uid
    FROM parsed WHERE reason IS NULL
    """,
)
oracle(
    "decode_errors",
    EVENTS_LOG,
    "SELECT seq, lsn, op, 'unknown relation ID: 199' AS error FROM bound WHERE tbl IS NULL",
)
oracle(
    "tuple_errors",
    ORDERS_LOG,
    """
    SELECT seq, 'order_facts' AS "table", op, decode_error AS error
    FROM parsed WHERE reason IS NOT NULL
    """,
)
oracle(
    "commit_time_transaction",
    EVENTS_LOG,
    "SELECT seq, xid, ts_us FROM stamped",
)
oracle(
    "commit_time_last_seen",
    EVENTS_LOG,
    """
    SELECT l.seq, l.xid, epoch_us(p.prev_ts) AS ts_us
    FROM log l JOIN (SELECT xid, lag(commit_ts) OVER (ORDER BY xid) AS prev_ts FROM commits) p USING (xid)
    """,
)
oracle(
    "message_kinds",
    EVENTS_LOG,
    """
    SELECT CASE op WHEN 'create' THEN 'I' WHEN 'update' THEN 'U' ELSE 'D' END AS kind, true AS is_change,
      count(*) AS n FROM log GROUP BY ALL
    UNION ALL SELECT 'R', false, count(*) FROM layouts
    UNION ALL SELECT 'C', false, count(*) FROM commits
    UNION ALL SELECT 'B', false, count(*) FROM commits
    """,
)
oracle(
    "scope_filter",
    EVENTS_LOG,
    """SELECT seq, tbl AS "table", op FROM bound WHERE tbl IN ('users', 'sales.orders')""",
)
oracle(
    "start_position",
    EVENTS_LOG,
    """SELECT seq, lsn, tbl AS "table", op FROM bound WHERE tbl IS NOT NULL AND lsn >= 16777216 + 64 * 500""",
)
oracle(
    "snapshot_diff_orders",
    "",
    """
    WITH o AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 0),
    n AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
      FROM orders WHERE o_orderkey % 10 <> 1)
    SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, 'postgres' AS source, 'orders' AS "table",
      CASE WHEN o.o_orderkey IS NULL THEN 'create' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS op,
      o.o_orderstatus AS status_before, n.o_orderstatus AS status_after,
      coalesce(n.o_custkey, o.o_custkey) AS o_custkey
    FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey
    WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
    """,
)
oracle(
    "snapshot_diff_customer",
    "",
    """
    WITH o AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS s
      FROM customer WHERE c_custkey % 5 <> 0),
    n AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 1 THEN c_mktsegment END AS s
      FROM customer WHERE c_custkey % 5 <> 1)
    SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
      CASE WHEN o.c_custkey IS NULL THEN 'create' WHEN n.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS op,
      o.s AS segment_before, n.s AS segment_after
    FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey
    WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.s IS DISTINCT FROM n.s
    """,
)
oracle("envelope_write", EVENTS_LOG, "SELECT seq, line FROM lines")
oracle(
    "envelope_roundtrip",
    EVENTS_LOG,
    """
    SELECT seq, 'postgres' AS source, tbl AS "table", op, ts_us, CAST(NULL AS VARCHAR) AS error,
      before_json, after_json FROM lines
    """,
)
oracle(
    "envelope_reader",
    "",
    """
    SELECT event_id,
      CASE event_id % 8 WHEN 0 THEN 'failed to unmarshal event: invalid JSON object'
        WHEN 2 THEN 'failed to unmarshal event: invalid JSON object'
        WHEN 3 THEN 'failed to unmarshal event: table is not a string'
        WHEN 5 THEN 'failed to unmarshal event: bad ts'
        WHEN 6 THEN 'failed to unmarshal event: after is not an object' END AS error,
      CASE event_id % 8 WHEN 1 THEN '' WHEN 4 THEN '' WHEN 7 THEN 's' END AS source,
      CASE event_id % 8 WHEN 1 THEN '' WHEN 4 THEN 't' WHEN 7 THEN '' END AS "table",
      CASE event_id % 8 WHEN 1 THEN '' WHEN 4 THEN '' WHEN 7 THEN 'delete' END AS op,
      CASE event_id % 8 WHEN 7 THEN epoch_us(TIMESTAMP '2026-03-05 10:00:00.25') END AS ts_us,
      CASE event_id % 8 WHEN 7 THEN '{"id":1}' END AS before_json,
      CASE event_id % 8 WHEN 4 THEN '{"id":' || event_id || '}' END AS after_json
    FROM events
    """,
)
oracle(
    "position_text",
    "",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE
      ((o_orderkey * 1311768467294) >> 32) || '/' || ((o_orderkey * 1311768467294) & 4294967295) END AS position
    FROM orders
    """,
)
oracle(
    "allow_list",
    EVENTS_LOG,
    """
    SELECT seq, tbl AS "table", CASE WHEN tbl IN ('users', 'orders') THEN 'success' ELSE 'filtered' END AS status
    FROM bound WHERE tbl IS NOT NULL
    """,
)
oracle(
    "chain_filter_enrich_mask",
    EVENTS_LOG,
    """
    SELECT seq, tbl AS "table", op,
      CASE WHEN turn IN (1, 2) THEN CASE shape
        WHEN 'user' THEN '{"amount":"' || sha256(old_amount) || '","props":' || doc || ',"user_id":' || user_id || '}'
        ELSE '{"amount":"' || sha256(old_amount) || '","customer":' || user_id || ',"note":' || quoted || '}'
      END END AS before_json,
      CASE WHEN turn <> 2 THEN CASE shape
        WHEN 'user' THEN '{"amount":"' || sha256(amount) || '","props":' || doc || ',"segment":'
          || coalesce('"' || c_mktsegment || '"', 'null') || ',"user_id":' || user_id || '}'
        ELSE '{"amount":"' || sha256(amount) || '","customer":' || user_id || ',"note":' || quoted || ',"segment":null}'
      END END AS after_json
    FROM texts LEFT JOIN customer ON user_id = c_custkey
    WHERE tbl IN ('users', 'orders', 'sales.orders')
    """,
)
oracle(
    "user_function",
    EVENTS_LOG,
    """
    SELECT seq,
      tbl || CASE WHEN NOT bad AND op <> 'delete' THEN '_settled' ELSE '' END AS "table",
      CASE WHEN NOT bad AND op <> 'delete' THEN upper(op) ELSE op END AS op,
      CASE WHEN op = 'delete' THEN 'filtered' WHEN bad THEN 'transform_error' ELSE 'success' END AS status,
      CASE WHEN bad AND op <> 'delete' THEN 'transform 0 failed' || chr(10) || 'user ' || user_id || ' refused' END AS error,
      CASE WHEN bad AND op <> 'delete' THEN 2 ELSE 1 END AS attempts,
      CASE WHEN op = 'delete' OR bad THEN after_json ELSE CASE shape
        WHEN 'user' THEN '{"amount":"' || amount || '","cents":' || cents || ',"props":' || doc || ',"user_id":' || user_id || '}'
        WHEN 'audit' THEN '{"actor":' || user_id || ',"amount":"' || amount || '","cents":' || cents || ',"detail":' || quoted || '}'
        ELSE '{"amount":"' || amount || '","cents":' || cents || ',"customer":' || user_id || ',"note":' || quoted || '}'
      END END AS after_json
    FROM (SELECT *, shape = 'user' AND user_id % 10 = 3 AS bad FROM imaged WHERE tbl IS NOT NULL)
    """,
)
oracle(
    "outcome_split",
    ORDERS_LOG,
    """
    SELECT seq, 'order_facts' AS "table", status,
      CASE status WHEN 'success' THEN NULL WHEN 'decode_error' THEN 'decode' WHEN 'sink_error' THEN 'sink'
        ELSE 'transform' END AS stage,
      error, CASE WHEN status IN ('transform_error', 'sink_error') THEN 3 ELSE 1 END AS attempts
    FROM settled
    """,
)
oracle(
    "dead_letters",
    ORDERS_LOG,
    """
    SELECT seq, 'postgres' AS source, 'dlq' AS "table", 'dlq' AS op, 'order_facts' AS event_table, op AS event_op,
      strftime(commit_ts, '%Y-%m-%dT%H:%M:%SZ') AS event_ts, k AS order_key, error,
      CASE status WHEN 'sink_error' THEN 'sink' ELSE 'transform' END AS stage, 3 AS attempts
    FROM settled JOIN order_commits USING (xid) WHERE status IN ('transform_error', 'sink_error')
    """,
)
oracle(
    "high_water_mark",
    ORDERS_LOG,
    """
    SELECT lsn, epoch_us(commit_ts) AS commit_us FROM settled JOIN order_commits USING (xid)
    WHERE status = 'success' ORDER BY seq DESC LIMIT 1
    """,
)
oracle(
    "topic_route",
    EVENTS_LOG,
    """
    SELECT tbl AS "table", CASE tbl WHEN 'users' THEN 'prod.users.events' WHEN 'orders' THEN 'prod.orders.events'
      ELSE 'cdc.' || tbl END AS topic, count(*) AS n
    FROM bound WHERE tbl IS NOT NULL GROUP BY ALL
    """,
)
oracle(
    "topic_route_table",
    "",
    """
    SELECT c_custkey, c.c_mktsegment AS "table", coalesce(topic, 'cdc.' || c.c_mktsegment) AS topic
    FROM customer c LEFT JOIN (SELECT c_mktsegment, 'seg.' || min(c_custkey) AS topic FROM customer
      WHERE c_mktsegment < 'G' GROUP BY 1) m ON c.c_mktsegment = m.c_mktsegment
    """,
)
oracle(
    "default_records",
    EVENTS_LOG,
    """
    SELECT seq, CASE tbl WHEN 'users' THEN 'prod.users.events' WHEN 'orders' THEN 'prod.orders.events'
      ELSE 'cdc.' || tbl END AS topic, tbl AS key, line AS value FROM lines
    """,
)
OUTBOX_LOG = """
shaped AS (
  SELECT o_orderkey AS k, o_orderkey * 10 + 1 AS seq,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS aggregate_id,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'order.' || lower(o_orderstatus) ELSE '' END AS event_type
  FROM orders),
boxed AS (
  SELECT *, CASE k % 8 WHEN 0 THEN 'null' WHEN 1 THEN '"raw ' || k || '"' WHEN 2 THEN '"quoted ' || k || '"'
      WHEN 3 THEN '' || k ELSE '{"id":' || k || '}' END AS payload_json,
    CASE WHEN k % 9 <> 0 THEN event_type ELSE 'cdc.outbox_events' END AS topic,
    CASE WHEN k % 10 <> 0 THEN '' || aggregate_id ELSE 'outbox_events' END AS key
  FROM shaped)
"""
oracle(
    "outbox_shape",
    OUTBOX_LOG,
    """
    SELECT seq, topic, key, CASE k % 8 WHEN 0 THEN
        '{"source":"postgres","table":"outbox_events","op":"create","ts":"0001-01-01T00:00:00Z","after":{"aggregate_id":'
        || coalesce('' || aggregate_id, 'null') || ',"event_type":"' || event_type || '","payload":null}}'
      WHEN 1 THEN 'raw ' || k WHEN 2 THEN 'quoted ' || k ELSE payload_json END AS value
    FROM boxed
    """,
)
oracle(
    "key_order",
    OUTBOX_LOG,
    "SELECT topic, key, count(*) AS n_records, 0 AS violations FROM boxed GROUP BY topic, key",
)
oracle(
    "sink_topic_log",
    EVENTS_LOG,
    """
    SELECT CASE tbl WHEN 'users' THEN 'prod.users.events' WHEN 'orders' THEN 'prod.orders.events'
      ELSE 'cdc.' || tbl END AS topic, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq,
      CAST(sum(strlen(line)) AS BIGINT) AS value_bytes FROM lines GROUP BY 1
    """,
)
oracle(
    "sink_json_lines",
    EVENTS_LOG,
    """
    SELECT tbl AS "table", count(*) AS n, CAST(sum(strlen(line)) AS BIGINT) AS line_bytes FROM lines GROUP BY 1
    """,
)
oracle(
    "sink_segments",
    EVENTS_LOG,
    """
    SELECT count(*) AS n_lines, CAST(sum(strlen(line) + 1) AS BIGINT) AS n_bytes, 0 AS over_limit FROM lines
    """,
)
oracle(
    "events_processed",
    LEDGER,
    """SELECT tbl AS "table", op, status, count(*) AS n FROM ledger GROUP BY ALL""",
)
oracle(
    "pipeline_errors",
    LEDGER,
    """
    SELECT stage AS component, error_type, count(*) AS n
    FROM ledger, (VALUES ('retry_exhausted'), ('dlq')) t(error_type)
    WHERE status IN ('transform_error', 'sink_error', 'lost') GROUP BY ALL
    """,
)
oracle(
    "replication_lag",
    LEDGER,
    """
    SELECT CAST(arg_max(lag, seq) AS DOUBLE) AS lag_s FROM ledger
    WHERE ts IS NOT NULL AND status <> 'decode_error'
    """,
)
oracle(
    "lag_by_table",
    LEDGER,
    """
    SELECT tbl AS "table", CAST(arg_max(lag, seq) AS DOUBLE) AS lag_s FROM ledger
    WHERE ts IS NOT NULL AND status <> 'decode_error' GROUP BY 1
    """,
)
for _name, _column, _bounds in (
    ("transform_histogram", "transform_s", (5, 10, 50, 100, 500, 1000, 5000, 10000)),
    ("sink_histogram", "sink_s", (10, 50, 100, 500, 1000, 5000, 10000, 50000)),
):
    _arms = " UNION ALL ".join(
        f"SELECT '{b}' AS le, count(*) FILTER ({_column} <= {b} / 10000.0) AS n, count({_column}) AS \"count\", "
        f'CAST(sum({_column}) AS DOUBLE) AS "sum" FROM ledger'
        for b in _bounds
    )
    oracle(
        _name,
        LEDGER,
        _arms + f" UNION ALL SELECT '+Inf', count({_column}), count({_column}), CAST(sum({_column}) AS DOUBLE) FROM ledger",
    )
oracle(
    "scope_drift",
    EVENTS_LOG,
    """
    SELECT tbl AS "table", 'configured_only' AS drift
      FROM (VALUES ('users'), ('orders'), ('products')) c(tbl) WHERE tbl NOT IN (SELECT tbl FROM bound WHERE tbl IS NOT NULL)
    UNION ALL
    SELECT DISTINCT tbl, 'captured_only' FROM bound
      WHERE tbl IS NOT NULL AND tbl NOT IN ('users', 'orders', 'products')
    """,
)
for _name in ("run_batch", "run_stream", "resume_batch"):
    oracle(
        _name,
        EVENTS_LOG,
        """
        SELECT tbl AS "table", op,
          CASE WHEN tbl IS NULL THEN 'decode_error' WHEN tbl IN ('users', 'orders', 'sales.orders') THEN 'success'
            ELSE 'filtered' END AS status,
          count(*) AS n, min(ts_us) AS first_ts_us, max(ts_us) AS last_ts_us
        FROM stamped GROUP BY ALL
        """,
    )

oracle(
    "offset_ledger",
    EVENTS_LOG,
    """
    SELECT CAST(batch AS BIGINT) AS batch, arg_max(lsn, seq) AS lsn, arg_max(ts_us, seq) AS commit_us
    FROM (SELECT s.*, CASE WHEN last * 10 + 6 <= top // 3 * 10 + 5 THEN 0 WHEN last * 10 + 6 <= top * 2 // 3 * 10 + 5 THEN 1
        ELSE 2 END AS batch
      FROM stamped s JOIN (SELECT event_id // 10 AS xid, max(event_id) AS last FROM events GROUP BY 1) USING (xid),
        (SELECT max(event_id) AS top FROM events)
      WHERE tbl IN ('users', 'orders', 'sales.orders'))
    GROUP BY 1
    """,
)
for _name in ("replayed_stream", "replayed_batch"):
    oracle(
        _name,
        EVENTS_LOG,
        """
        SELECT tbl AS "table", op,
          CASE WHEN tbl IS NULL THEN 'decode_error' WHEN tbl IN ('users', 'orders', 'sales.orders') THEN 'success'
            ELSE 'filtered' END AS status,
          count(*) AS n, min(ts_us) AS first_ts_us, max(ts_us) AS last_ts_us
        FROM stamped GROUP BY ALL
        UNION ALL SELECT NULL, op, 'repeated', count(*), NULL, NULL FROM log GROUP BY op
        """,
    )
oracle(
    "commit_time_redelivered",
    EVENTS_LOG,
    """
    SELECT seq, xid, 'transaction' AS mode, ts_us FROM stamped
    UNION ALL SELECT seq + (top + 10000) * 10, xid, 'transaction', ts_us + 3600000000
      FROM stamped, (SELECT max(event_id) AS top FROM events)
    UNION ALL SELECT l.seq + turn_no * (top + 10000) * 10, xid, 'last_seen_commit', epoch_us(prev_ts)
      FROM log l JOIN (
        SELECT xid, turn_no, lag(commit_ts + turn_no * INTERVAL 1 HOUR) OVER (ORDER BY turn_no, xid) AS prev_ts
        FROM commits, (VALUES (0), (1)) t(turn_no)) p USING (xid), (SELECT max(event_id) AS top FROM events)
    """,
)
oracle(
    "unreadable_input",
    "",
    """
    WITH lines AS (
      SELECT event_id % 11 AS n, event_id, length('' || event_id) AS digits FROM events)
    SELECT CASE n WHEN 0 THEN 'malformed' WHEN 1 THEN 'no seq' WHEN 2 THEN 'no kind' ELSE 'unreadable lsn' END AS reason,
      count(*) AS n, CAST(sum(CASE n WHEN 0 THEN 7 WHEN 1 THEN 28 + 2 * digits WHEN 2 THEN 17 + 2 * digits
        ELSE 29 + 2 * digits END) AS BIGINT) AS total
    FROM lines WHERE n <= 3 GROUP BY 1
    UNION ALL SELECT 'usable', count(*), CAST(sum(CASE WHEN n > 4 THEN event_id END) AS BIGINT) FROM lines WHERE n = 3 OR n > 4
    """,
)
oracle(
    "typed_view_layouts",
    "",
    """
    WITH t AS (
      SELECT *, o_orderkey AS k, o_orderkey * 10 + 1 AS seq,
        CASE WHEN o_orderkey * 10 + 1 < 5002 THEN 1 WHEN o_orderkey * 10 + 1 < 10002 THEN 2 ELSE 3 END AS v,
        CAST(round(o_totalprice * 100) AS BIGINT) AS cents
      FROM orders WHERE o_orderkey % 10 <> 9),
    e AS (
      SELECT *, CASE
          WHEN k % 97 = 0 AND v <> 2 THEN 'failed to convert column order_key: invalid int8 value "n/a"'
          WHEN k % 89 = 0 AND v = 1 THEN 'failed to convert column cust_key: invalid int4 value "99999999999"'
          WHEN k % 97 = 0 THEN 'failed to convert column order_key: invalid int8 value "n/a"'
          WHEN k % 83 = 0 AND v = 3 THEN 'failed to convert column total: invalid numeric value "NaN"'
          WHEN k % 79 = 0 THEN 'column index ' || CASE v WHEN 1 THEN 3 ELSE 4 END || ' out of range for relation drifting'
        END AS reason
      FROM t)
    SELECT seq, CASE WHEN k % 2 = 0 THEN 'create' ELSE 'delete' END AS op,
      CASE WHEN reason IS NULL THEN k END AS order_key,
      CASE WHEN reason IS NULL AND v < 3 THEN CASE WHEN k % 89 = 0 THEN 99999999999 ELSE o_custkey END END AS cust_key,
      CASE WHEN reason IS NULL THEN o_orderstatus END AS status,
      CASE WHEN reason IS NULL AND v > 1 THEN CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
        END AS total,
      reason IS NOT NULL AS failed, 'failed to parse tuple: ' || reason AS error
    FROM e
    """,
)
oracle(
    "enrich_large",
    EVENTS_LOG,
    """
    SELECT seq, op, CASE WHEN turn <> 2 AND shape = 'user' THEN c_mktsegment END AS segment, 1 AS attempts
    FROM bound LEFT JOIN customer ON c_custkey = CASE WHEN user_id % 3 = 0 THEN 1 ELSE user_id END
    WHERE tbl IS NOT NULL
    """,
)
oracle(
    "unchanged_columns",
    "",
    """
    WITH c AS (
      SELECT o_orderkey AS k, o_orderkey * 10 + 1 AS seq, o_orderkey % 6 AS turn, o_orderkey % 97 AS card FROM orders),
    v AS (
      SELECT *, CASE WHEN turn < 2 THEN 'body ' || k WHEN turn = 2 THEN 'old ' || k END AS sent,
        max(CASE WHEN turn IN (0, 1, 2, 5) THEN seq END) OVER (PARTITION BY card ORDER BY seq) AS known FROM c)
    SELECT v.seq, CASE v.turn WHEN 0 THEN 'create' WHEN 5 THEN 'delete' ELSE 'update' END AS op,
      CASE WHEN v.turn <> 5 THEN s.sent END AS body,
      CASE WHEN v.turn < 2 THEN 'body ' || v.k END AS unfilled
    FROM v LEFT JOIN v s ON s.seq = v.known
    """,
)
oracle(
    "sink_retention",
    EVENTS_LOG,
    "SELECT count(*) AS n_lines, true AS enough, true AS not_too_much, true AS newest, true AS listed FROM lines",
)
oracle(
    "topic_log_text_topics",
    EVENTS_LOG,
    """
    SELECT event_id % 2 AS batch, CASE tbl WHEN 'users' THEN '007' WHEN 'orders' THEN '12' WHEN 'sales.orders' THEN '2026-01-01'
      WHEN 'sessions' THEN '1e3' ELSE 'true' END AS topic, count(*) AS n, max(seq) AS last_seq
    FROM lines GROUP BY ALL
    """,
)
oracle(
    "outbox_not_finite",
    ORDERS_LOG,
    """
    SELECT seq, CASE WHEN op = 'delete' AND k % 61 = 0 THEN 'sink_error' END AS status,
      CASE WHEN op <> 'delete' THEN day || 'T00:00:00Z' ELSE '{"source":"postgres","table":"order_facts","op":"delete",'
        || '"ts":"0001-01-01T00:00:00Z","before":' || image || '}' END AS value,
      CASE WHEN k % 61 = 0 THEN 'marshal event: json: unsupported value: NaN or Infinity' END AS rate_error
    FROM order_images WHERE reason IS NULL
    """,
)
oracle(
    "sink_retry",
    EVENTS_LOG,
    """
    SELECT CASE WHEN tbl IS NULL THEN 'decode_error' ELSE 'success' END AS status,
      CASE WHEN tbl IS NULL THEN 'decode' END AS stage, CASE WHEN tbl IS NULL THEN 1 ELSE 2 END AS attempts, count(*) AS n
    FROM bound GROUP BY ALL
    UNION ALL SELECT 'written', 'sink', 2, count(*) FROM bound WHERE tbl IS NOT NULL
    """,
)
oracle(
    "dead_letter_runs",
    EVENTS_LOG,
    """
    SELECT dlq, CASE WHEN tbl IS NULL THEN 'decode_error' WHEN tbl <> 'orders' THEN 'success'
        WHEN dlq = 'on' THEN 'transform_error' ELSE 'lost' END AS status,
      CASE WHEN tbl IS NULL THEN 'decode' WHEN tbl = 'orders' THEN 'transform' END AS stage,
      CASE WHEN tbl = 'orders' THEN 2 ELSE 1 END AS attempts, count(*) AS n
    FROM bound, (VALUES ('off'), ('on'), ('broken')) d(dlq) GROUP BY ALL
    UNION ALL SELECT 'on', 'cdc.dlq dlq transform 0 failed' || chr(10) || 'no orders', 'letter', NULL, count(*)
      FROM bound WHERE tbl = 'orders' HAVING count(*) > 0
    """,
)
oracle(
    "run_reports",
    EVENTS_LOG,
    """
    SELECT 'events' AS name, count(*) AS n FROM bound
    UNION ALL SELECT 'success', count(*) FROM bound WHERE tbl IN ('users', 'orders', 'sales.orders')
    UNION ALL SELECT 'filtered', count(*) FROM bound WHERE tbl IN ('app.audit_logs', 'sessions')
    UNION ALL SELECT unnest(['transform_error', 'sink_error', 'lost']), 0
    UNION ALL SELECT unnest(['sink_s adds up', 'sink batches']), 1
    """,
)
oracle(
    "envelope_pretty",
    EVENTS_LOG,
    """SELECT seq, true AS indented, tbl AS "table", op, before_json, after_json FROM lines""",
)
oracle(
    "identity_chain",
    EVENTS_LOG,
    """SELECT seq, tbl AS "table", op, before_json, after_json FROM imaged WHERE tbl IS NOT NULL""",
)
oracle(
    "result_cap",
    ORDERS_LOG,
    """
    SELECT seq, op, CASE k % 1000 WHEN 2 THEN 'result data too large' ELSE 'result error too large' END AS said
    FROM parsed WHERE reason IS NULL AND k % 61 <> 0 AND op <> 'delete' AND k % 1000 IN (2, 4)
    """,
)
