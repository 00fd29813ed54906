"""Text to values, for every type number."""

import json
import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import pgtext as P

BAD = "<bad>"
# (type number, text, value on the wire)
VECTORS = [
    (21, "32767", 32767),
    (21, "-32768", -32768),
    (21, "0", 0),
    (21, "32768", BAD),
    (21, "not-a-number", BAD),
    (21, "99999999999", BAD),
    (23, "2147483647", 2147483647),
    (23, "-2147483648", -2147483648),
    (23, "+7", 7),
    (23, "overflow123", BAD),
    (23, "", BAD),
    (23, " 5", BAD),
    (23, "5.0", BAD),
    (20, "9223372036854775807", 9223372036854775807),
    (20, "-9223372036854775808", -9223372036854775808),
    (20, "9223372036854775808", BAD),
    (700, "3.14159", 3.141590118408203),
    (700, "1.23e10", 12300000256.0),
    (700, "1e39", BAD),
    (700, "not-a-float", BAD),
    (701, "3.14159265358979", 3.14159265358979),
    (701, ".5", 0.5),
    (701, "5.", 5.0),
    (701, "5d", BAD),
    (701, "1e400", BAD),
    (701, "", BAD),
    (701, " 1", BAD),
    (1700, "123456789.1234567890123456789", "123456789.1234567890123456789"),
    (25, "hello world", "hello world"),
    (1043, "こんにちは", "こんにちは"),
    (25, "test 🚀", "test 🚀"),
    (18, "c", "c"),
    (1042, "padded  ", "padded  "),
    (25, "", ""),
    (16, "t", True),
    (16, "true", True),
    (16, "f", False),
    (16, "anything", False),
    (1082, "2026-03-05", "2026-03-05T00:00:00Z"),
    (1082, "03-05-2026", BAD),
    (1082, "2026", BAD),
    (1082, "2026-3-5", BAD),
    (1082, "2026-02-30", BAD),
    (1082, "infinity", BAD),
    (1083, "14:30:00", "0000-01-01T14:30:00Z"),
    (1083, "09:15:30.250", "0000-01-01T09:15:30.25Z"),
    (1083, "9:15:30", "0000-01-01T09:15:30Z"),
    (1083, "25:00:00", BAD),
    (1083, "24:00:00", BAD),
    (1266, "14:30:00+05", "0000-01-01T14:30:00+05:00"),
    (1266, "09:00:00-08", "0000-01-01T09:00:00-08:00"),
    (1266, "09:00:00+05:30", "0000-01-01T09:00:00+05:30"),
    (1266, "09:00:00Z", "0000-01-01T09:00:00Z"),
    (1266, "9:00:00.50-00:00", "0000-01-01T09:00:00.5Z"),
    (1266, "9:00:00.5+00:30", "0000-01-01T09:00:00.5+00:30"),
    (1266, "09:00:00", BAD),
    (1114, "2026-03-05 14:30:00", "2026-03-05T14:30:00Z"),
    (1114, "2026-03-05 14:30:00.123456", "2026-03-05T14:30:00.123456Z"),
    (1114, "2026-03-05 14:30:00.100000", "2026-03-05T14:30:00.1Z"),
    (1114, "2026-03-05 14:30:10.000", "2026-03-05T14:30:10Z"),
    (1114, "2026-03-05 4:30:10", "2026-03-05T04:30:10Z"),
    (1114, "2026-03-05 4:30:10.", BAD),
    (1114, "2026-03-05", BAD),
    (1114, "2026-03-05T14:30:00", BAD),
    (1114, "not-a-timestamp", BAD),
    (1184, "2026-03-05 14:30:00Z", "2026-03-05T14:30:00Z"),
    (1184, "2026-03-05 14:30:00+00", "2026-03-05T14:30:00Z"),
    (1184, "2026-03-05 14:30:00.123456+05", "2026-03-05T14:30:00.123456+05:00"),
    (1184, "2026-03-05 14:30:00-08", "2026-03-05T14:30:00-08:00"),
    (1184, "2026-03-05 14:30:00+05:30", "2026-03-05T14:30:00+05:30"),
    (1184, "2026-03-05 14:30:00", BAD),
    (114, '{"key":"value"}', {"key": "value"}),
    (114, "[1,2,3]", [1, 2, 3]),
    (114, '"hello"', "hello"),
    (114, "42", 42),
    (114, "100.0", 100),
    (114, "true", True),
    (114, "null", None),
    (114, "", None),
    (114, "{invalid json}", "{invalid json}"),
    (114, "1 2", "1 2"),
    (114, '{"a":1} x', '{"a":1} x'),
    (114, "1,2", "1,2"),
    (114, "1] junk", "1] junk"),
    (114, "1,2] junk", "1,2] junk"),
    (114, '{"a":1}}', '{"a":1}}'),
    (114, "1e400", "1e400"),
    (114, '{"x":"1e400"}', {"x": "1e400"}),
    (114, " [1] ", [1]),
    (114, "NaN", "NaN"),
    (114, '{"a":1,"a":2}', {"a": 2}),
    (114, '{"users":[{"id":1,"name":"alice"}]}', {"users": [{"id": 1, "name": "alice"}]}),
    (3802, '\x01{"version":1}', {"version": 1}),
    (3802, '\x01["a","b","c"]', ["a", "b", "c"]),
    (3802, '{"plain":true}', {"plain": True}),
    (3802, "\x01{bad", "{bad"),
    (2950, "550E8400-E29B-41D4-A716-446655440000", "550E8400-E29B-41D4-A716-446655440000"),
    (17, "\\xdeadbeef", "XHhkZWFkYmVlZg=="),
    (17, "", ""),
    (1007, "{1,2,3}", "{1,2,3}"),
    (1009, "{a,b,c}", "{a,b,c}"),
    (1016, "{100,200,300}", "{100,200,300}"),
    (1005, "{}", "{}"),
    (1015, "{x}", "{x}"),
    (99999, "custom", "custom"),
    (0, "x", "x"),
]


@pytest.fixture(scope="module")
def wired(spark):
    df = spark.createDataFrame([(i, o, t) for i, (o, t, _) in enumerate(VECTORS)], "i int, oid int, text string")
    value = F.expr(P.wire_value("text", "oid"))
    rows = df.select("i", value.isNull().alias("missing"), F.to_json(value).alias("json")).collect()
    return {r.i: r for r in rows}


@pytest.mark.parametrize("i", range(len(VECTORS)), ids=lambda i: f"{VECTORS[i][0]}-{VECTORS[i][1]!r}")
def test_wire_value(wired, i):
    oid, text, want = VECTORS[i]
    row = wired[i]
    if want is BAD:
        assert row.missing and oid not in P.NULLABLE_OIDS
    elif want is None:
        assert row.json in (None, "null")
    else:
        assert json.loads(row.json) == want


def test_null_is_null_for_every_type(spark):
    oids = [oid for kind in (*P.CONVERTED, P.TEXT_LIKE) for oid in kind.oids] + [99999]
    df = spark.createDataFrame([(o, None) for o in oids], "oid int, text string")
    assert df.filter(F.expr(P.wire_value("text", "oid")).isNotNull()).count() == 0


def test_non_finite_floats(spark):
    texts = ["NaN", "Infinity", "-Infinity", "inf"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for oid in (700, 701):
        got = [r[0] for r in df.select(F.expr(P.typed_value("text", oid))).collect()]
        assert math.isnan(got[0]) and got[1:] == [math.inf, -math.inf, math.inf]


def test_typed_accepts_what_wire_accepts(spark):
    df = spark.createDataFrame([(i, o, t) for i, (o, t, _) in enumerate(VECTORS)], "i int, oid int, text string")
    for kind in P.CONVERTED:
        if kind.null_is_valid:
            continue
        rows = (
            df.filter(F.col("oid") == kind.oids[0])
            .select("i", F.expr(f"({kind.typed('text')}) IS NULL").alias("missing"))
            .collect()
        )
        assert rows
        for row in rows:
            assert row.missing == (VECTORS[row.i][2] is BAD), VECTORS[row.i]
