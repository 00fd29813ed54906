"""Landing in order, unchanged columns, retry rounds, and retention that does not look back."""

import os

import pytest
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import pgtext as P
from millrace.operators import userfn
from millrace.operators.decode import ChangeLog, decode
from millrace.operators.unchanged import fill_unchanged
from millrace.sinks.files import JsonLinesSink, TopicLogSink
from millrace.sources.landing import land_in_order, read_log, stream_log
from tests.helpers import USERS, by_seq, change, raw, relation

MARK = S.UNCHANGED


# -- landing -----------------------------------------------------------------------


def aged(path):
    files = [f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet")]
    return sorted(files, key=lambda f: os.stat(f).st_mtime_ns)


@pytest.mark.parametrize("files", [1, 4, 12])
def test_landing_takes_the_same_jobs_for_any_number_of_files(spark, tmp_path, files):
    rows = [change(s, "I", 100, new=["1", "a"]) for s in range(600)]
    log, path = raw(spark, rows).repartition(5).cache(), str(tmp_path / "log")
    log.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"landing-{files}", "landing")
    land_in_order(log, path, min_files=files)
    jobs = len(tracker.getJobIdsForGroup(f"landing-{files}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 5
    edges = [spark.read.parquet(f).agg(F.min("seq"), F.max("seq")).first() for f in aged(path)]
    assert len(edges) >= files // 2 and [e[0] for e in edges][0] == 0
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))
    assert len({os.stat(f).st_mtime_ns for f in aged(path)}) == len(edges)
    assert not [f for f in os.listdir(tmp_path) if "staging" in f]


def test_landing_more_comes_after_what_is_there(spark, tmp_path):
    path, got = str(tmp_path / "log"), []
    for first in (0, 100, 200):
        land_in_order(raw(spark, [change(s, "I", 100, new=["1", "a"]) for s in range(first, first + 100)]), path, min_files=3)
    stream = stream_log(spark, path, max_files=1).writeStream.foreachBatch(
        lambda batch, _: got.append(batch.agg(F.min("seq"), F.max("seq")).first())
    )
    stream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    assert got[0][0] == 0 and got[-1][1] == 299 and all(a[1] < b[0] for a, b in zip(got, got[1:]))
    land_in_order(raw(spark, []), str(tmp_path / "empty"))
    assert read_log(spark, path).count() == 300


# -- unchanged columns -------------------------------------------------------------

NOTES = (7, "public", "notes", [("id", P.INT4), ("body", P.TEXT), ("n", P.INT4)])


def notes():
    return [
        relation(0, NOTES),
        change(1, "I", 7, new=["1", "first", "0"]),
        change(2, "I", 7, new=["2", None, "0"]),
        change(3, "U", 7, new=["1", MARK, "1"]),  # from the key's last state
        change(4, "U", 7, new=["2", MARK, "1"]),  # the last state is NULL
        change(5, "U", 7, old=["1", "older", "1"], new=["1", MARK, "2"]),  # from the old row
        change(6, "U", 7, new=["1", MARK, "3"]),  # which is the state from then on
        change(7, "D", 7, old=["1", None, None]),
        change(8, "U", 7, new=["1", MARK, "4"]),  # no state after a deletion
        change(9, "U", 7, new=["3", MARK, MARK]),  # never seen
        relation(10, (7, "public", "notes", [("n", P.INT4), ("id", P.INT4), ("body", P.TEXT)])),
        change(11, "I", 7, new=["0", "5", "moved"]),
        change(12, "U", 7, new=["1", "5", MARK]),
        change(13, "U", 7, new=["1", "2", MARK]),  # by name, over layouts
        change(14, "U", 8, new=["1", "2", MARK]),  # unknown layout
        change(15, "U", 7, new=["1", None, MARK]),  # no key
    ]


BODIES = {1: "first", 2: None, 3: "first", 4: None, 5: "older", 6: "older", 8: None, 9: None, 11: "moved", 12: "moved", 13: None, 15: None}


@pytest.mark.parametrize("piece", [1, 3, 1 << 22])
def test_unchanged_columns_are_filled(spark, piece):
    log = fill_unchanged(ChangeLog.of(raw(spark, notes())), {"notes": ("id",)}, piece)
    got = by_seq(decode(log, None).filter("error IS NULL AND after IS NOT NULL"))
    assert {s: r["after"]["body"] for s, r in got.items()} == BODIES
    assert got[9]["after"]["n"] is None and got[13]["after"] == {"n": 1, "id": 2, "body": None}


def test_unchanged_columns_read_as_null_otherwise(spark):
    got = by_seq(decode(ChangeLog.of(raw(spark, notes())), None).filter("error IS NULL AND after IS NOT NULL"))
    assert {s: r["after"]["body"] for s, r in got.items()} == {s: b if s in (1, 11) else None for s, b in BODIES.items()}
    unnamed = fill_unchanged(ChangeLog.of(raw(spark, notes())), {"others": ("id",)})
    bodies = {s: r["after"]["body"] for s, r in by_seq(decode(unnamed, None).filter("error IS NULL AND after IS NOT NULL")).items()}
    assert bodies[5] == "older" and bodies[3] is None


def test_keys_of_several_columns(spark):
    layout = (7, "", "t", [("a", P.INT4), ("b", P.TEXT), ("body", P.TEXT)])
    rows = [relation(0, layout), change(1, "I", 7, new=["1", "x", "one"]), change(2, "I", 7, new=["1", "y", "two"])]
    rows += [change(3, "U", 7, new=["1", "x", MARK]), change(4, "U", 7, new=["1", "y", MARK])]
    got = by_seq(decode(fill_unchanged(ChangeLog.of(raw(spark, rows)), {"t": ("a", "b")}), None))
    assert (got[3]["after"]["body"], got[4]["after"]["body"]) == ("one", "two")


# -- retries -----------------------------------------------------------------------


def test_one_pause_a_round_however_many_fail(monkeypatch):
    pauses, calls = [], {}
    monkeypatch.setattr(userfn.time, "sleep", pauses.append)

    def steady_after(event):
        n = calls[event["n"]] = calls.get(event["n"], 0) + 1
        if n <= event["n"] % 4:
            raise ValueError(f"try {n}")
        return None if event["n"] % 4 == 2 else event

    texts = [None if n == 5 else f'{{"n":{n}}}' for n in range(400)]
    out = userfn.call_in_rounds(texts, [("p: ", steady_after)], 3, 250)
    assert pauses == [0.25, 0.25]
    assert out[5] == (None,) * 5
    for n in (0, 4, 8):
        assert out[n][:4] == (None, None, 1, f'{{"n":{n}}}')
    assert out[1][:3] == (None, None, 2) and out[2][:4] == ("filtered", None, 3, None)
    assert out[3][:4] == ("transform_error", "p: try 3", 3, None) and out[3][4] >= 0
    pauses.clear()
    assert userfn.call_in_rounds([None, '{"n":0}'], [("", steady_after)], 3, 250)[1][2] == 1 and pauses == []
    assert userfn.call_in_rounds([], [], 3, 250) == []


# -- sinks -------------------------------------------------------------------------


def line_rows(spark, first, n):
    return spark.createDataFrame([(i, f'{{"id":{i:05d}}}') for i in range(first, first + n)], "seq bigint, line string").coalesce(2)


def test_retention_reads_what_is_kept_and_added(spark, tmp_path):
    sink = JsonLinesSink(str(tmp_path / "kept"), max_size=60, max_files=4)
    for batch in range(5):
        sink.write(line_rows(spark, batch * 30, 30), batch)
    left = sorted(r.value for r in spark.read.text(f"{sink.path}/lines").collect())
    assert left[-1] == '{"id":00149}' and left == [f'{{"id":{i:05d}}}' for i in range(150 - len(left), 150)]
    assert 4 * 60 <= sum(len(x) + 1 for x in left) <= 5 * 60
    assert sum(s.n for s in sink.segments(spark).collect()) == len(left)
    # History is let go: the last batches' manifests are all there is.
    assert len(os.listdir(f"{sink.path}/manifest")) <= 3 and len(os.listdir(f"{sink.path}/live")) <= 3
    before = left
    sink.write(line_rows(spark, 120, 30), 4)  # done again
    assert sorted(r.value for r in spark.read.text(f"{sink.path}/lines").collect()) == before
    assert sum(s.n for s in sink.segments(spark).collect()) == len(before)


def test_topics_stay_text(spark, tmp_path):
    rows = spark.createDataFrame([("007", b"k", b"v", 1), ("1e3", None, b"w", 2)], "topic string, key binary, value binary, seq bigint")
    sink = TopicLogSink(str(tmp_path / "log"))
    sink.write(rows, 0)
    assert {(r.topic, bytes(r.value), r.batch) for r in sink.read(spark).collect()} == {("007", b"v", 0), ("1e3", b"w", 0)}
    assert USERS[2] == "users"
