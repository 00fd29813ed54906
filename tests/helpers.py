"""Small hand-made logs."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from millrace import schemas as S

USERS = (100, "public", "users", [("id", 23), ("name", 25)])
ORDERS = (200, "public", "orders", [("id", 23), ("user_id", 23), ("amount", 1700)])


def at(second: int) -> datetime:
    return datetime(2026, 3, 5, 12, 0, second, tzinfo=timezone.utc)


def relation(seq, layout):
    rid, ns, rel, cols = layout
    return (seq, None, None, "R", rid, ns, rel, cols, None, None, None)


def change(seq, kind, rid, old=None, new=None, xid=1):
    return (seq, 1000 + seq, xid, kind, rid, None, None, None, old, new, None)


def commit(seq, xid, second):
    return (seq, 1000 + seq, xid, "C", None, None, None, None, None, None, at(second))


def begin(seq, xid):
    return (seq, 1000 + seq, xid, "B", None, None, None, None, None, None, None)


def raw(spark, rows):
    return spark.createDataFrame(rows, S.RAW_LOG)


def by_seq(df):
    """Rows as dicts by seq, images parsed."""
    text = df.withColumns({c: F.to_json(c) for c in ("before", "after") if c in df.columns})
    out = {}
    for row in text.collect():
        values = row.asDict(recursive=True)
        for side in ("before", "after"):
            if values.get(side) is not None:
                values[side] = json.loads(values[side])
        out[values["seq"]] = values
    return out


def count_by(df, *columns):
    rows = df.groupBy(*columns).count().collect()
    return {tuple(r[:-1]) if len(columns) > 1 else r[0]: r[-1] for r in rows}
