"""Column text to typed values, driven by the type number announced for the column.

Two forms of each type: ``wire`` is the value as it appears in an event's JSON
image (a VARIANT), ``typed`` is the Spark column a single-table view shows.
Both give NULL for text the type does not accept, so a caller can tell a
failure (text present, value absent) from a NULL column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

# Type numbers of the PostgreSQL catalogue.
BOOL = 16
BYTEA = 17
CHAR = 18
INT8 = 20
INT2 = 21
INT4 = 23
TEXT = 25
JSON = 114
FLOAT4 = 700
FLOAT8 = 701
INT2_ARRAY = 1005
INT4_ARRAY = 1007
TEXT_ARRAY = 1009
VARCHAR_ARRAY = 1015
INT8_ARRAY = 1016
BPCHAR = 1042
VARCHAR = 1043
DATE = 1082
TIME = 1083
TIMESTAMP = 1114
TIMESTAMPTZ = 1184
TIMETZ = 1266
NUMERIC = 1700
UUID = 2950
JSONB = 3802

# Spark's casts take more spellings than the source does, hence the guards.
INTEGER_TEXT = "^[+-]?[0-9]+$"
DECIMAL_TEXT = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
NON_FINITE_TEXT = "(?i)^([+-]?inf(inity)?|nan)$"
DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
CLOCK = "([01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]([.][0-9]+)?"
ZONE = "(Z|[+-]([01][0-9]|2[0-4])(:[0-5][0-9])?)"
ZONE_TAIL = "(Z|[+-][0-9]{2}(?::[0-9]{2})?)$"


# Each rule maps the SQL text of a string expression to the SQL text of its value.
def _integer(width: str) -> Callable[[str], str]:
    return lambda x: f"CAST(CASE WHEN {x} RLIKE '{INTEGER_TEXT}' THEN try_cast({x} AS {width}) END AS BIGINT)"


def _floating(width: str) -> Callable[[str], str]:
    # A finite spelling that overflows is a failure, not an infinity.
    return lambda x: (
        f"CAST(CASE WHEN {x} RLIKE '{DECIMAL_TEXT}' THEN "
        f"CASE WHEN abs(try_cast({x} AS {width})) < {width}('Infinity') THEN try_cast({x} AS {width}) END "
        f"WHEN {x} RLIKE '{NON_FINITE_TEXT}' THEN try_cast({x} AS {width}) END AS DOUBLE)"
    )


def _same(x: str) -> str:
    return x


def _boolean(x: str) -> str:
    return f"({x} IN ('t', 'true'))"


def _bytes(x: str) -> str:
    return f"CAST({x} AS BINARY)"


def _guarded(pattern: str, value: str) -> Callable[[str], str]:
    return lambda x: f"CASE WHEN {x} RLIKE '^{pattern}$' THEN {value.format(x=x)} END"


_date = _guarded(DAY, "try_cast({x} AS DATE)")
_time = _guarded(CLOCK, "{x}")
_timetz = _guarded(CLOCK + ZONE, "{x}")
_timestamp = _guarded(f"{DAY} {CLOCK}", "try_cast({x} AS TIMESTAMP_NTZ)")
_timestamptz = _guarded(f"{DAY} {CLOCK}{ZONE}", "try_cast({x} AS TIMESTAMP)")


def _tidy_clock(x: str) -> str:
    """Two-digit hour, no trailing zeros in the fraction."""
    padded = f"CASE WHEN {x} RLIKE '^[0-9]:' THEN '0' || {x} ELSE {x} END"
    tidied = f"regexp_replace({padded}, '([.][0-9]*?[1-9])0+$|[.]0+$', '$1')"
    return f"CASE WHEN length({x}) = 8 THEN {x} ELSE {tidied} END"


def _tidy_zone(x: str) -> str:
    """The zone at the end of an accepted text, as ``Z`` or with minutes."""
    return (
        f"CASE WHEN right({x}, 1) = 'Z' OR right({x}, 3) IN ('+00', '-00') "
        f"OR right({x}, 6) IN ('+00:00', '-00:00') THEN 'Z' "
        f"WHEN substr({x}, -3, 1) IN ('+', '-') THEN right({x}, 3) || ':00' ELSE right({x}, 6) END"
    )


def _without_zone(x: str) -> str:
    return f"regexp_replace({x}, '{ZONE_TAIL}', '')"


def _wired(rule: Callable[[str], str], text: Callable[[str], str]) -> Callable[[str], str]:
    """The given text where the rule accepts the value."""
    return lambda x: f"CASE WHEN ({rule(x)}) IS NOT NULL THEN {text(x)} END"


def _after_day(x: str) -> str:
    return f"substr({x}, 12)"


_date_wire = _wired(_date, lambda x: f"{x} || 'T00:00:00Z'")
_time_wire = _wired(_time, lambda x: f"'0000-01-01T' || {_tidy_clock(x)} || 'Z'")
_timetz_wire = _wired(
    _timetz, lambda x: f"'0000-01-01T' || {_tidy_clock(_without_zone(x))} || {_tidy_zone(x)}"
)
_timestamp_wire = _wired(
    _timestamp, lambda x: f"substr({x}, 1, 10) || 'T' || {_tidy_clock(_after_day(x))} || 'Z'"
)
_timestamptz_wire = _wired(
    _timestamptz,
    lambda x: (
        f"substr({x}, 1, 10) || 'T' || {_tidy_clock(_without_zone(_after_day(x)))} || {_tidy_zone(x)}"
    ),
)


def _json(x: str) -> str:
    """Parsed JSON; text that is not exactly one JSON value stays a string; empty is NULL.

    ``try_parse_json`` ignores whatever follows the first value, so the text is
    parsed as the first element of an array whose second is the text's hash:
    anything after the value would displace it. Only a number too large for a
    double can turn into an infinity.
    """
    long_number = f"{x} RLIKE '[eE][+]?[0-9]{{3}}|[0-9]{{300}}'"
    overflow = f"{long_number} AND to_json(doc) RLIKE '\"-?Infinity\"'"
    checked = (
        f"CASE WHEN try_variant_get(doc, '$[1]', 'bigint') = xxhash64({x}) AND NOT ({overflow}) "
        f"THEN try_variant_get(doc, '$[0]', 'variant') ELSE CAST({x} AS VARIANT) END"
    )
    doc = f"try_parse_json('[' || {x} || ',' || xxhash64({x}) || ']')"
    # An object whose only closing brace is its last character cannot be followed by anything.
    flat = f"startswith({x}, '{{') AND locate('}}', {x}) = length({x}) AND NOT ({long_number})"
    return (
        f"CASE WHEN {flat} THEN coalesce(try_parse_json({x}), CAST({x} AS VARIANT)) "
        f"WHEN length({x}) > 0 THEN element_at(transform(array({doc}), doc -> {checked}), 1) END"
    )


def _jsonb(x: str) -> str:
    """As JSON, after the leading version byte."""
    return _json(f"(CASE WHEN ascii({x}) = 1 THEN substr({x}, 2) ELSE {x} END)")


@dataclass(frozen=True)
class PgType:
    name: str
    oids: tuple[int, ...]
    typed: Callable[[str], str]
    wire: Callable[[str], str]
    null_is_valid: bool = False  # conversion may give NULL without being a failure


TEXT_LIKE = PgType(
    "text",
    (
        TEXT,
        VARCHAR,
        CHAR,
        BPCHAR,
        NUMERIC,
        UUID,
        INT2_ARRAY,
        INT4_ARRAY,
        INT8_ARRAY,
        TEXT_ARRAY,
        VARCHAR_ARRAY,
    ),
    _same,
    _same,
)
CONVERTED = (
    PgType("int8", (INT8,), _integer("BIGINT"), _integer("BIGINT")),
    PgType("int4", (INT4,), _integer("INT"), _integer("INT")),
    PgType("int2", (INT2,), _integer("SMALLINT"), _integer("SMALLINT")),
    PgType("bool", (BOOL,), _boolean, _boolean),
    PgType("timestamp", (TIMESTAMP,), _timestamp, _timestamp_wire),
    PgType("timestamptz", (TIMESTAMPTZ,), _timestamptz, _timestamptz_wire),
    PgType("jsonb", (JSONB,), _jsonb, _jsonb, null_is_valid=True),
    PgType("json", (JSON,), _json, _json, null_is_valid=True),
    PgType("float8", (FLOAT8,), _floating("DOUBLE"), _floating("DOUBLE")),
    PgType("float4", (FLOAT4,), _floating("FLOAT"), _floating("FLOAT")),
    PgType("date", (DATE,), _date, _date_wire),
    PgType("time", (TIME,), _time, _time_wire),
    PgType("timetz", (TIMETZ,), _timetz, _timetz_wire),
    PgType("bytea", (BYTEA,), _bytes, _bytes),
)

_BY_OID = {oid: kind for kind in (*CONVERTED, TEXT_LIKE) for oid in kind.oids}

NULLABLE_OIDS = tuple(oid for kind in CONVERTED if kind.null_is_valid for oid in kind.oids)
FLOAT_OIDS = (FLOAT4, FLOAT8)


def pg_type(oid: int) -> PgType:
    """The rule for a type number; unknown numbers are text."""
    return _BY_OID.get(oid, TEXT_LIKE)


def typed_value(text: str, oid: int) -> str:
    """SQL for the Spark-typed value of a column whose type is known when the plan is built."""
    return pg_type(oid).typed(text)


@cache
def wire_value(text: str, oid: str) -> str:
    """SQL for the VARIANT value of a column whose type number is itself data."""
    plain = ", ".join(map(str, TEXT_LIKE.oids))
    arms = [f"WHEN {oid} IN ({plain}) THEN CAST({text} AS VARIANT)"]
    arms += [f"WHEN {oid} = {k.oids[0]} THEN CAST({k.wire(text)} AS VARIANT)" for k in CONVERTED]
    return f"CASE {' '.join(arms)} ELSE CAST({text} AS VARIANT) END"


@cache
def type_label(oid: str) -> str:
    """SQL for the type name used in messages."""
    arms = " ".join(f"WHEN {k.oids[0]} THEN '{k.name}'" for k in CONVERTED)
    return f"CASE {oid} {arms} ELSE 'text' END"
