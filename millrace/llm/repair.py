"""Repair of conversation structure by iterative-deepening A*.

A conversation is well formed if its roles read ``system? (user assistant)*`` and no row is blank or said
twice. The cheapest edits (keep, rerole, delete, insert) that make it so are searched depth first, in ASCII
order of the edits' initials, under a cost bound that grows by one: the first path that is accepted is
the cheapest and, among those, the least. States that failed with some budget are remembered, over all
bounds, so a state is searched again only with more budget than ever before.

The lower bound of what is left: rows that have to go, marks of cut-off rows, and two for each pair of
neighbouring breaks of the role order. An edit touches the two borders of one row, so it mends at most two
breaks, and those only if they are neighbours: a run of k breaks takes at least half as many edits.

Defined results: NULL roles and texts are one space. Rows are taken by turn, NULL turns first, then by role
and text; repeated rows are duplicates. A role that is not system, user or assistant counts by its first
character, as these do; an empty role can't be kept. A conversation without rows costs nothing. A NULL
conversation id is a conversation. An empty table gives no rows. Extra columns are ignored. A conversation
is one value: its rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

SPACES = " \t\n\x0b\x0c\r"
OK, TRUNCATED, FORCED = 0, 1, 3
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST = 0, 2, 3, 2
# States: nothing said yet, or who spoke last.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
# Whom an inserted or reroled row makes speak: the only one who may.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL_PAIRS = ("su", "ua", "au")
REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired array<struct<role:string,text:string>>"
)


class LowerBound:
    """What the rows from ``i`` on cost at least, after ``state``."""

    def __init__(self, initials: list[str], faults: list[int]) -> None:
        n = len(initials)
        self.forced = [0] * (n + 1)  # marks and deletions that no edit avoids
        self.next = [n] * (n + 1)  # the next row that may stay
        # Breaks between rows that may stay: length of the run that begins at a row, pairs in all later runs.
        self.lead, self.tail = [0] * (n + 1), [0] * (n + 1)
        self.initials = initials
        after = n
        for i in range(n - 1, -1, -1):
            self.forced[i] = self.forced[i + 1] + faults[i]
            if faults[i] == FORCED:
                self.next[i] = after
                continue
            if self._breaks(STATE_OF.get(initials[i]), after):
                self.lead[i], self.tail[i] = self.lead[after] + 1, self.tail[after]
            else:
                self.tail[i] = self.tail[after] + (self.lead[after] + 1) // 2
            self.next[i] = after = i

    def _breaks(self, state: int | None, row: int) -> bool:
        if state is None:
            return True
        if row == len(self.initials):
            return state not in (START, ASSISTANT)
        return self.initials[row] not in KEPT[state]

    def __call__(self, i: int, state: int) -> int:
        row = self.next[i]
        run = self.lead[row] + self._breaks(state, row)
        return self.forced[i] + 2 * (self.tail[row] + (run + 1) // 2)


def cheapest_edits(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """Cost and initials of the edits: (D)elete, (I)nsert, (K)eep, (R)erole."""
    least = LowerBound(initials, faults)
    failed: dict[tuple[int, int], int] = {}
    bound = least(0, START)
    while True:
        audit = _within(bound, initials, faults, least, failed)
        if audit is not None:
            return bound, audit
        bound += 1


def _within(bound: int, initials: list[str], faults: list[int], least: LowerBound, failed: dict) -> str | None:
    """The first accepting path of at most ``bound``, or None."""
    n = len(initials)
    path: list[str] = []
    # Row, state, budget left, and the edits not tried yet, the next one last.
    stack: list[tuple[int, int, int, list]] = []

    def enter(i: int, state: int, budget: int) -> bool:
        if least(i, state) > budget or failed.get((i, state), -1) >= budget:
            return False
        target, edits = NEXT[state], []
        if i < n:
            fault = faults[i]
            if fault != FORCED:
                edits.append(("R", i + 1, target, budget - REROLE_COST - fault))
                if initials[i] in KEPT[state]:
                    edits.append(("K", i + 1, KEPT[state][initials[i]], budget - KEEP_COST - fault))
            edits.append(("I", i, target, budget - INSERT_COST))
            edits.append(("D", i + 1, state, budget - DELETE_COST))
        else:
            edits.append(("I", i, target, budget - INSERT_COST))
        stack.append((i, state, budget, edits))
        return True

    enter(0, START, bound)
    while stack:
        i, state, budget, edits = stack[-1]
        if i == n and state in (START, ASSISTANT):
            return "".join(path)
        while edits:
            edit, *then = edits.pop()
            if enter(*then):
                path.append(edit)
                break
        else:
            failed[(i, state)] = max(budget, failed.get((i, state), -1))
            stack.pop()
            if path:
                path.pop()
    return None


def faults_of(rows: list[dict]) -> list[str]:
    """The first fault of each row, or an empty string."""
    seen, out = set(), []
    for row in rows:
        said = (row["role"], row["text"])
        text = row["text"].rstrip(SPACES)
        if not text:
            out.append("blank")
        elif said in seen:
            out.append("duplicate")
        else:
            out.append("" if text[-1] in ".!?" else "truncated")
        seen.add(said)
    return out


def repaired_rows(rows: list[dict], audit: str) -> list[dict]:
    """The rows after the edits."""
    out, at, state = [], 0, START
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            out.append({"role": rows[at]["role"], "text": rows[at]["text"]})
            state = KEPT[state][rows[at]["role"][:1]]
        else:
            state = NEXT[state]
            out.append({"role": NAMES[state], "text": "" if edit == "I" else rows[at]["text"]})
        at += edit != "I"
    return out


def _report(conv_id: int | None, rows: list[dict]) -> dict:
    faults = faults_of(rows)
    initials = [row["role"][:1] for row in rows]
    weights = {"": OK, "truncated": TRUNCATED, "blank": FORCED, "duplicate": FORCED}
    cost, audit = cheapest_edits(initials, [weights[f] for f in faults])
    turns = {row["turn"] for row in rows if row["turn"] is not None}
    pairs = zip(initials, initials[1:], strict=False)
    return {
        "conv_id": conv_id,
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in LEGAL_PAIRS for a, b in pairs),
        "cost": cost,
        "audit": audit,
        "repaired": repaired_rows(rows, audit),
    }


KINDS = pa.schema(
    [
        ("conv_id", pa.int64()),
        *((name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()),
        ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
    ]
)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows = batch.column("rows")[i].as_py() or []
            yield pa.RecordBatch.from_pylist([_report(batch.column("conv_id")[i].as_py(), rows)], KINDS)


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id, turn, role, text`` in, one row for each conversation out.

    ``gaps`` in the turns, rows by first fault (``blank``, ``duplicate``, ``truncated``), ``illegal``
    neighbours, ``cost`` and ``audit`` of the cheapest edits, and the ``repaired`` rows. Rows that are not
    ``present`` only make their conversation known.
    """
    prepare(turns.sparkSession)
    space = F.lit(" ")
    row = F.struct(
        F.col("turn").isNotNull().alias("numbered"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    shown = row if present is None else F.when(present, row)
    whole = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(shown)).alias("rows")
    )
    return whole.mapInArrow(_repair, REPORT)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults put in by ``crc32(conv_id:turn) % 20``, and ``present``: false for those dropped."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    hit = F.crc32(name) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(hit == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(hit == 1, F.lit(""))
        .when(hit == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        (hit != 0).alias("present"),
        F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"),
    )
    return rows.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def digests(report: DataFrame) -> DataFrame:
    said = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    return report.select(
        *(c for c in report.columns if c != "repaired"),
        F.sha2(F.array_join(said, "\n"), 256).alias("repaired_sha256"),
    )
