import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import envelope as env
from millrace.functions import images

EVENT = "source string, table string, op string, ts timestamp, before string, after string"


def lines(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, EVENT)
    df = df.withColumns({c: F.try_parse_json(c) for c in ("before", "after")})
    return [r[0] for r in df.select(env.envelope(**kwargs)).collect()]


def test_write(spark):
    from tests.helpers import at

    special = 'alice "bob" <carol>\n\t☃世界'
    rows = [
        ("postgres", "users", "create", at(0), None, '{"id":1,"name":"alice"}'),
        ("postgres", "orders", "delete", at(1), '{"id":99}', None),
        ("postgres", "users", "update", None, '{"n":null}', json.dumps({"s": special, "e": ""})),
        (None, None, None, None, None, None),
    ]
    got = lines(spark, rows)
    assert got[0] == (
        '{"source":"postgres","table":"users","op":"create","ts":"2026-03-05T12:00:00Z","after":{"id":1,"name":"alice"}}'
    )
    assert json.loads(got[1]) == {
        "source": "postgres", "table": "orders", "op": "delete", "ts": "2026-03-05T12:00:01Z", "before": {"id": 99},
    }
    third = json.loads(got[2])
    assert third["ts"] == "0001-01-01T00:00:00Z" and third["before"] == {"n": None}
    assert third["after"] == {"s": special, "e": ""}
    assert json.loads(got[3]) == {"source": "", "table": "", "op": "", "ts": "0001-01-01T00:00:00Z"}


def test_pretty(spark):
    rows = [("postgres", "users", "create", None, None, '{"id":1}')]
    plain, pretty = lines(spark, rows)[0], lines(spark, rows, pretty=True)[0]
    assert json.loads(plain) == json.loads(pretty) and '\n  "table"' in pretty


def test_time_text_ignores_the_session_zone(spark):
    from tests.helpers import at

    rows = [("s", "t", "create", at(5), None, None)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert json.loads(lines(spark, rows)[0])["ts"] == "2026-03-05T12:00:05Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "line, want",
    [
        ("{}", ("", "", "", None, None, None)),
        ("null", ("", "", "", None, None, None)),
        ('{"source":"postgres","table":"users","op":"create","after":{"id":1}}', ("postgres", "users", "create", None, None, '{"id":1}')),
        ('{"table":"t","ts":"2026-03-05T12:00:00Z","before":null,"after":{}}', ("", "t", "", 1772712000000000, None, None)),
        ('{"table":"t","ts":"0001-01-01T00:00:00Z"}', ("", "t", "", None, None, None)),
        ('{"after":{"n":null,"deep":{"a":[1,2.5,"x"]}}}', ("", "", "", None, None, '{"deep":{"a":[1,2.5,"x"]},"n":null}')),
        ("{invalid", None),
        ("", None),
        ("[1]", None),
        ('{"table":5}', None),
        ('{"ts":"not a time"}', None),
        ('{"after":"text"}', None),
    ],
)
def test_read(spark, line, want):
    row = (
        env.parse_envelopes(spark.createDataFrame([(line,)], "value string"))
        .select("source", "table", "op", F.unix_micros("ts"), F.to_json("before"), F.to_json("after"), "error")
        .first()
    )
    if want is None:
        assert row.error.startswith("failed to unmarshal event")
    else:
        assert row.error is None and tuple(row[:6]) == want


def test_position_text(spark):
    cases = {None: "", 0: "0/0", 1: "0/1", 1311768467294899695: "305419896/2427178479", 4294967296: "1/0"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "lsn bigint, want string")
    assert df.filter(env.position_text(F.col("lsn")) != F.col("want")).count() == 0


def test_image_fields(spark):
    doc = {"a": 1, "s": "x", "e": "", "n": None, "o": {"k": 1}, "it's": "q"}
    df = spark.createDataFrame([(json.dumps(doc),)], "d string").select(F.try_parse_json("d").alias("d"))
    texts = {n: df.select(images.usable_text(F.col("d"), n)).first()[0] for n in (*doc, "missing", "")}
    assert texts == {"a": "1", "s": "x", "e": None, "n": None, "o": '{"k":1}', "it's": "q", "missing": None, "": None}
    changed = images.with_fields(F.col("d"), {"a": F.lit("new"), "z": F.lit(None).cast("string")})
    got = json.loads(df.select(F.to_json(changed)).first()[0])
    assert got == {**doc, "a": "new", "z": None}
    masked = json.loads(df.select(F.to_json(images.masked_fields(F.col("d"), ("s", "n", "missing")))).first()[0])
    assert len(masked["s"]) == 64 and masked["n"] is None and masked["a"] == 1
