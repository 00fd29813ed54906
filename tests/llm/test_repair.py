"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import cache

import pyarrow.parquet as pq
import pytest

from millrace.llm import repair
from millrace.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string, audit string, rows string, present boolean"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain_faults(rows):
    out = []
    for i, (_, role, text) in enumerate(rows):
        if not re.search(r"[^\x20\x09-\x0D]", text):
            out.append("blank")
        elif any(r[1:] == (role, text) for r in rows[:i]):
            out.append("duplicate")
        else:
            out.append("" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
    return out


def plainly_repaired(rows):
    """All edit sequences with at most three inserts in a row, by exhaustion; (cost, audit, rows) is least."""
    faults = plain_faults(rows)
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, last, inserts):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))

        def add(cost, edit, row, *then):
            rest = best(*then)
            if rest is not None:
                options.append((cost + rest[0], edit + rest[1], ((row,) if row else ()) + rest[2]))

        names = [n for n in ("user", "assistant") if n[0] in allowed[last]]
        if inserts < 3:
            for name in names:
                add(2, "I", (name, ""), i, name[0], inserts + 1)
        if i < len(rows):
            _, role, text = rows[i]
            cut = faults[i] == "truncated"
            add(3, "D", None, i + 1, last, 0)
            if faults[i] not in ("blank", "duplicate"):
                if role and role[0] in allowed[last]:
                    add(cut, "K", (role, text), i + 1, role[0], 0)
                for name in names:
                    add(2 + cut, "R", (name, text), i + 1, name[0], 0)
        return min(options, default=None)

    return faults, best(0, "", 0)


def plain_report(conv_id, rows):
    faults, (cost, audit, out) = plainly_repaired(rows)
    turns = {t for t, _, _ in rows if t is not None}
    roles = [r[1][:1] for r in rows]
    said = "\n".join(f"{role}:{text}" for role, text in out)
    return (
        conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False)),
        cost, audit, hashlib.sha256(said.encode()).hexdigest(),
    )


def plainly(rows):
    """Damage and repair of (conv_id, turn, role, text)."""
    whole = {}
    for conv_id, turn, role, text in rows:
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(name.encode()) % 20
        kept = whole.setdefault(conv_id, [])
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        kept.extend([(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return Counter(plain_report(c, sorted(rows, key=order)) for c, rows in whole.items())


def counted(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_repair_query_equals_the_plain_version(spark):
    rows = pq.read_table(f"{SMALL}/conversations.parquet").to_pylist()
    want = plainly([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows])
    assert counted(QUERIES["op12_repair"](spark, SMALL)) == want


def test_repair_of_odd_rows(spark):
    rng = random.Random(3)
    texts = ["Yes.", "No", "", " \t\n", None, "What? ", "ok!\r\n", "a ", "said.", "said."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "uber"]
    rows = [
        (rng.choice([None, *range(60)]), rng.choice([None, 0, 1, 2, 5, 9]), rng.choice(roles[: rng.choice([3, 8])]), rng.choice(texts))
        for _ in range(500)
    ]
    rows += [(-5, t, "user", "x.") for t in range(3)] + [rows[0]] * 3
    table = spark.createDataFrame([(*r, "a", "b", None) for r in rows], TURNS)
    assert counted(repair.digests(repair.repair(repair.damaged(table), repair.F.col("present")))) == plainly(rows)
    assert repair.repair(table.limit(0)).collect() == []


def test_a_conversation_of_dropped_rows_stays(spark):
    conv = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (1,)))
    table = spark.createDataFrame([(conv, 1, "user", "hi.")], "conv_id int, turn int, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert counted(repair.digests(repair.repair(repair.damaged(table), repair.F.col("present")))) == Counter(
        [(conv, 0, 0, 0, 0, 0, 0, "", empty)]
    )


def test_cheapest_edits_equal_exhaustion():
    rng = random.Random(11)
    for _ in range(3000):
        n = rng.randrange(0, 9)
        alphabet = rng.choice(["ua", "sua", "suax", "u", "a", "sx"])
        rows = [(i, rng.choice(alphabet), rng.choice(["a.", "b.", f"{i}.", f"{i}.", f"{i}.", f"{i}", ""])) for i in range(n)]
        faults, want = plainly_repaired(rows)
        weights = {"": 0, "truncated": 1, "blank": 3, "duplicate": 3}
        got = repair.cheapest_edits([r[1] for r in rows], [weights[f] for f in faults])
        assert got == want[:2], rows


def test_the_lower_bound_never_exceeds_the_cost():
    rng = random.Random(12)
    for _ in range(1000):
        n = rng.randrange(1, 8)
        rows = [(i, rng.choice("suax"), rng.choice([f"{i}.", f"{i}", ""])) for i in range(n)]
        faults, want = plainly_repaired(rows)
        weights = [{"": 0, "truncated": 1, "blank": 3}[f] for f in faults]
        assert repair.LowerBound([r[1] for r in rows], weights)(0, repair.START) <= want[0]


@pytest.mark.parametrize("damage", [0.02, 0.2])
def test_a_long_conversation_is_searched_in_time(damage):
    rng = random.Random(13)
    roles = [rng.choice("sx") if rng.random() < damage / 10 else "ua"[i % 2] for i in range(20_000) if rng.random() > damage]
    faults = [rng.choice([1, 3]) if rng.random() < damage else 0 for _ in roles]
    cost, audit = repair.cheapest_edits(roles, faults)
    weight = {"D": 3, "I": 2, "K": 0, "R": 2}
    rows = iter(faults)
    assert cost == sum(weight[e] + (next(rows) % 3 if e in "KR" else 0 * (e == "D" and next(rows))) for e in audit)
