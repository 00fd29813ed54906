"""From the raw log to change events."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import pgtext
from millrace.functions.once import once
from millrace.operators.commits import stamp_commit_time
from millrace.operators.outcome import OP
from millrace.operators.relations import attach_relations, out_of_scope, relation_spans, spans_are_small

SOURCE = "postgres"


@dataclass(frozen=True)
class ChangeLog:
    """A raw log split by what its messages are for.

    ``changes`` holds inserts, updates, deletes and messages of unknown kind;
    ``relations`` the layouts; ``commits`` and ``begins`` the ends and starts of transactions.
    ``small_relations`` states that the layouts were already found small.
    """

    changes: DataFrame
    relations: DataFrame
    commits: DataFrame
    small_relations: bool | None = None
    begins: DataFrame | None = None

    @classmethod
    def of(cls, raw: DataFrame) -> ChangeLog:
        return cls(
            changes=raw.filter(
                F.col("kind").isNotNull() & ~F.col("kind").isin(*S.SILENT_KINDS)
            ).select("seq", "lsn", "xid", "kind", "relation_id", "old", "new"),
            relations=raw.filter(F.col("kind") == S.RELATION).select(
                "seq", "relation_id", "ns", "rel", "cols"
            ),
            commits=raw.filter(F.col("kind") == S.COMMIT).select("seq", "xid", "commit_ts"),
            begins=raw.filter(F.col("kind") == S.BEGIN).select("seq", "xid"),
        )

    def starting_at(self, lsn: int | None) -> ChangeLog:
        """Only changes from a position on; an unset or zero position means all of them."""
        if not lsn:
            return self
        return replace(self, changes=self.changes.filter(F.col("lsn").isNull() | (F.col("lsn") >= F.lit(lsn))))

    def in_scope(self, tables: Sequence[str] | None) -> ChangeLog:
        """Without changes of ids that never stand for one of the tables, left out by the scan itself."""
        out = out_of_scope(self.relations, tables) if tables else []
        if not out:
            return self
        kept = F.col("relation_id").isNull() | ~F.col("relation_id").isin(*out)
        return replace(self, changes=self.changes.filter(kept))

    def with_relations(self) -> DataFrame:
        """Changes with ``table, rel, cols``."""
        small = self.small_relations
        if small is None:
            small = spans_are_small(self.relations)
        return attach_relations(self.changes, relation_spans(self.relations), small)


def in_scope(df: DataFrame, tables: Sequence[str] | None) -> DataFrame:
    """Only the named tables; no names means all. Changes of unknown layout stay visible."""
    if not tables:
        return df
    return df.filter(F.col("table").isin(*tables) | F.col("table").isNull())


def _fields(side: str) -> Column:
    """Positional pairing of column definitions and tuple text, converted.

    A tuple may be shorter than the layout. A value beyond the layout has no
    definition, shown by a NULL ``oid``.
    """
    return F.expr(
        f"zip_with(slice(cols, 1, size({side})), {side}, (c, t) -> named_struct("
        "'name', coalesce(c.name, ''), 'oid', c.oid, 'text', t, "
        f"'value', {pgtext.wire_value('t', 'c.oid')}))"
    )


def _without_marks(side: str) -> Column:
    """Values that were not sent, as they had not changed, read as NULL."""
    marked = F.coalesce(F.array_contains(side, S.UNCHANGED), F.lit(False))
    return F.when(marked, F.transform(side, lambda x: F.nullif(x, F.lit(S.UNCHANGED)))).otherwise(F.col(side))


NULLABLE = ", ".join(map(str, pgtext.NULLABLE_OIDS))
FAILED = f"(f.oid IS NULL OR (f.text IS NOT NULL AND f.value IS NULL AND f.oid NOT IN ({NULLABLE})))"
FLOATS = ", ".join(map(str, pgtext.FLOAT_OIDS))
NOT_FINITE = f"(f.oid IN ({FLOATS}) AND f.text RLIKE '{pgtext.NON_FINITE_TEXT}')"


def _tuple_error(fields: str, label: str) -> str:
    """Message for the first field that does not convert, or NULL."""
    message = (
        "CASE WHEN f.oid IS NULL "
        "THEN 'column index ' || size(cols) || ' out of range for relation ' || rel "
        "ELSE 'failed to convert column ' || f.name || ': invalid ' || "
        f"{pgtext.type_label('f.oid')} || ' value \"' || f.text || '\"' END"
    )
    return (
        f"CASE WHEN exists({fields}, f -> {FAILED}) THEN 'failed to parse {label}: ' || "
        f"element_at(transform(filter({fields}, f -> {FAILED}), f -> {message}), 1) END"
    )


def _image(fields: str) -> str:
    """The row image, or NULL for an absent or empty tuple."""
    return (
        f"CASE WHEN error IS NULL AND size({fields}) > 0 THEN to_variant_object("
        f"map_from_entries(transform({fields}, f -> struct(f.name, f.value)))) END"
    )


def decode_changes(bound: DataFrame) -> DataFrame:
    """Changes that carry their layout (and ``ts``, if stamped) to events with ``error``.

    ``not_finite`` marks images holding NaN or an infinity, which JSON cannot carry.
    """
    parsed = (
        bound if "ts" in bound.columns else bound.withColumn("ts", F.lit(None).cast("timestamp"))
    )
    parsed = parsed.withColumn("new", _without_marks("new"))
    known = F.col("cols").isNotNull()
    parsed = once(
        parsed,
        _old=F.when(F.col("kind").isin(S.UPDATE, S.DELETE) & known, _fields("old")),
        _new=F.when(F.col("kind").isin(S.INSERT, S.UPDATE) & known, _fields("new")),
    )
    error = f"""
        CASE WHEN kind NOT IN ('I', 'U', 'D') THEN 'unknown message type: ' || kind
             WHEN cols IS NULL THEN 'unknown relation ID: ' || relation_id
             WHEN repeated_name THEN 'failed to parse tuple: repeated column name in relation ' || rel
             WHEN (kind IN ('I', 'U') AND new IS NULL) OR (kind = 'D' AND old IS NULL)
             THEN 'failed to parse tuple: missing'
             WHEN kind = 'I' THEN {_tuple_error("_new", "tuple")}
             WHEN kind = 'D' THEN {_tuple_error("_old", "tuple")}
             ELSE coalesce({_tuple_error("_old", "old tuple")}, {_tuple_error("_new", "new tuple")})
        END"""
    not_finite = " OR ".join(
        f"coalesce(exists({side}, f -> {NOT_FINITE}), false)" for side in ("_old", "_new")
    )
    return parsed.withColumn("error", F.expr(error)).select(
        "seq",
        "lsn",
        "xid",
        F.lit(SOURCE).alias("source"),
        "table",
        F.expr(OP).alias("op"),
        "ts",
        F.expr(_image("_old")).alias("before"),
        F.expr(_image("_new")).alias("after"),
        F.expr(f"error IS NULL AND ({not_finite})").alias("not_finite"),
        "error",
    )


def decode(
    log: ChangeLog,
    ts_mode: str | None = "transaction",
    tables: Sequence[str] | None = None,
    last_before=None,
) -> DataFrame:
    """The whole decode step: layout, scope, commit time, images. ``error`` marks failures."""
    bound = in_scope(log.in_scope(tables).with_relations(), tables)
    if ts_mode:
        bound = stamp_commit_time(bound, log.commits, ts_mode, last_before=last_before)
    return decode_changes(bound)


def events_of(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("error").isNull()).drop("error")


def errors_of(decoded: DataFrame) -> DataFrame:
    """Failed changes: kept and counted, never retried or dead-lettered."""
    return decoded.filter(F.col("error").isNotNull()).select("seq", "lsn", "table", "op", "error")


def _view_columns(columns: Iterable[tuple]) -> list[tuple[str, int, str | None]]:
    out = [(c[0], c[1], c[2] if len(c) > 2 else None) for c in columns]
    for name, oid, as_type in out:
        if as_type and (oid != pgtext.NUMERIC or not as_type.lower().startswith("decimal")):
            raise ValueError(f"column {name}: only numeric columns can be shown as {as_type}")
    return out


def table_view(
    log: ChangeLog,
    table: str,
    columns: Iterable[tuple],
    ts_mode: str | None = None,
    keep_errors: bool = False,
) -> DataFrame:
    """Changes of one table with typed ``before`` and ``after`` structs, whatever its layout was at the time.

    ``columns`` are (name, type number) as the view shows them, or (name, numeric, "decimal(p,s)"). A value is
    found by the column's place in the layout in force; a column that layout lacks is NULL. Text has to
    fit the type in force and the type shown. The places are worked out once per layout, so the
    conversion compiles, and columns not read are not converted. With ``keep_errors`` a change that
    does not fit stays, with ``error``.
    """
    columns = _view_columns(columns)
    spans = relation_spans(log.relations).filter(F.col("table") == table)
    # Per layout: the place of each shown column, and which shown columns had another type.
    place = {i: f"_at{i}" for i in range(len(columns))}
    names = F.transform("cols", lambda c: c["name"])
    spans = spans.withColumns(
        {place[i]: F.nullif(F.array_position(names, name), F.lit(0)) - 1 for i, (name, _, _) in enumerate(columns)}
    ).withColumns(
        {
            "_others": F.array_compact(
                F.array(
                    *(
                        F.when(F.expr(f"get(cols, CAST({place[i]} AS INT)).oid") != oid, F.lit(name))
                        for i, (name, oid, _) in enumerate(columns)
                    )
                )
            )
        }
    )
    small = log.small_relations
    if small is None:
        small = spans_are_small(log.relations)
    bound = attach_relations(log.in_scope([table]).changes, spans, small).filter(F.col("table").isNotNull())
    if ts_mode:
        bound = stamp_commit_time(bound, log.commits, ts_mode)
    else:
        bound = bound.withColumn("ts", F.lit(None).cast("timestamp"))

    def text(side: str, i: int) -> str:
        return f"get({side}, CAST({place[i]} AS INT))"

    def shown(side: str, i: int) -> str:
        _, oid, as_type = columns[i]
        return f"try_cast({text(side, i)} AS {as_type})" if as_type else pgtext.typed_value(text(side, i), oid)

    def may_fail(i: int) -> bool:
        _, oid, as_type = columns[i]
        rule = pgtext.pg_type(oid)
        return bool(as_type) or (rule is not pgtext.TEXT_LIKE and not rule.null_is_valid)

    def checked(side: str) -> Column:
        """Values that can fail, and so are looked at more than once."""
        values = [f"{shown(side, i)} AS `{columns[i][0]}`" for i in place if may_fail(i)]
        return F.expr(f"struct({', '.join(values)})" if values else "struct(1 AS none)")

    def image(side: str) -> Column:
        """All values. JSON never fails; it is parsed here, outside the compiled part above."""
        values = [
            f"{f'_{side}.`{name}`' if may_fail(i) else shown(side, i)} AS `{name}`" for i, (name, _, _) in enumerate(columns)
        ]
        return F.expr(f"CASE WHEN {side} IS NOT NULL AND error IS NULL THEN struct({', '.join(values)}) END")

    def failure(side: str, label: str) -> str:
        """The first thing wrong with a tuple, in the order of its layout; the type in force before the type shown."""
        found = [
            f"CASE WHEN {text(side, i)} IS NOT NULL AND _{side}.`{name}` IS NULL THEN struct(CAST({place[i]} AS INT) AS at, 1 AS nth, "
            f"'failed to convert column {name}: invalid {_label(oid)} value \"' || {text(side, i)} || '\"' AS said) END"
            for i, (name, oid, _) in enumerate(columns)
            if may_fail(i)
        ]
        # Columns that had another type have to fit that one too; seldom, so not compiled.
        other = (
            f"filter(zip_with(slice(cols, 1, size({side})), {side}, (c, t) -> named_struct('name', c.name, 'oid', c.oid, "
            f"'text', t, 'value', CASE WHEN array_contains(_others, c.name) THEN {pgtext.wire_value('t', 'c.oid')} END)), "
            f"f -> array_contains(_others, f.name) AND {FAILED})"
        )
        message = (
            "'failed to convert column ' || f.name || ': invalid ' || "
            f"{pgtext.type_label('f.oid')} || ' value \"' || f.text || '\"'"
        )
        found.append(
            f"CASE WHEN size(_others) > 0 THEN get(transform({other}, f -> struct("
            f"CAST(array_position(transform(cols, c -> c.name), f.name) - 1 AS INT) AS at, 0 AS nth, {message} AS said)), 0) END"
        )
        found.append(
            f"CASE WHEN size({side}) > size(cols) THEN struct(size(cols) AS at, 0 AS nth, "
            f"'column index ' || size(cols) || ' out of range for relation ' || rel AS said) END"
        )
        return f"'failed to parse {label}: ' || array_min(array_compact(array({', '.join(found)}))).said"

    # Tuples a kind of change does not use are not looked at.
    used = bound.withColumns(
        {
            "old": F.when(F.col("kind").isin(S.UPDATE, S.DELETE), F.col("old")),
            "new": F.when(F.col("kind").isin(S.INSERT, S.UPDATE), _without_marks("new")),
        }
    )
    error = F.expr(
        f"""CASE WHEN kind NOT IN ('I', 'U', 'D') THEN 'unknown message type: ' || kind
            WHEN repeated_name THEN 'failed to parse tuple: repeated column name in relation ' || rel
            WHEN (kind IN ('I', 'U') AND new IS NULL) OR (kind = 'D' AND old IS NULL) THEN 'failed to parse tuple: missing'
            WHEN kind = 'I' THEN {failure("new", "tuple")}
            WHEN kind = 'D' THEN {failure("old", "tuple")}
            ELSE coalesce({failure("old", "old tuple")}, {failure("new", "new tuple")}) END"""
    )
    converted = once(used, _old=checked("old"), _new=checked("new"))
    out = once(converted, error=error).select(
        "seq",
        "lsn",
        "xid",
        F.lit(SOURCE).alias("source"),
        "table",
        F.expr(OP).alias("op"),
        "ts",
        image("old").alias("before"),
        image("new").alias("after"),
        F.col("error").isNotNull().alias("failed"),
        "error",
    )
    return out if keep_errors else out.filter(~F.col("failed")).drop("failed", "error")


def _label(oid: int) -> str:
    rule = pgtext.pg_type(oid)
    return "numeric" if oid == pgtext.NUMERIC else rule.name
