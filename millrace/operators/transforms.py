"""Event transforms and their chaining.

A transform works on staged events (see ``outcome.begin``): it may rewrite the
event columns, drop an event or fail it. Native ones are plain column
expressions; a chain of them is one projection. Adjacent Python functions run
in a single Python pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import images
from millrace.operators import outcome
from millrace.operators.lookup import MAX_BROADCAST_ROWS, left_lookup
from millrace.operators.userfn import EventFunction, run_functions


@dataclass(frozen=True)
class Transform:
    """A native link: ``apply`` takes staged events and the prefix for error messages."""

    name: str
    apply: Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class UserFunction:
    """A Python link: event dict to event dict, None to drop, or an exception to fail."""

    name: str
    function: EventFunction


def allow_tables(events: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Plain filter form of the allow-list, for events outside a chain."""
    return events.filter(F.col("table").isin(*tables))


def _column(given: Column | str) -> Column:
    """A column, or one given as SQL text: links may be made before a session exists."""
    return F.expr(given) if isinstance(given, str) else given


def keep(condition: Column | str, name: str = "keep") -> Transform:
    """Drop events for which the condition is not true."""

    def apply(df: DataFrame, _: str) -> DataFrame:
        dropped = ~F.coalesce(_column(condition), F.lit(False))
        return outcome.mark(df, dropped, outcome.FILTERED, "transform", F.lit(None))

    return Transform(name, apply)


def allow(*tables: str) -> Transform:
    """Keep events of the named tables, whatever the operation."""

    def apply(df: DataFrame, prefix: str) -> DataFrame:
        return keep(F.col("table").isin(*tables)).apply(df, prefix)

    return Transform("allow", apply)


def reject(condition: Column | str, message: str, name: str = "reject") -> Transform:
    """Fail events for which the condition is true."""

    def apply(df: DataFrame, prefix: str) -> DataFrame:
        error = F.lit(f"{prefix}{message}")
        return outcome.mark(df, _column(condition), outcome.TRANSFORM_ERROR, "transform", error)

    return Transform(name, apply)


def rewrite(columns: Mapping[str, Column | str], name: str = "rewrite") -> Transform:
    """Replace event columns of live events."""
    unknown = set(columns) - set(S.ENVELOPE_COLUMNS)
    if unknown:
        raise ValueError(f"not event columns: {sorted(unknown)}")

    def apply(df: DataFrame, _: str) -> DataFrame:
        live = outcome.is_live()
        return df.withColumns(
            {c: F.when(live, _column(value)).otherwise(F.col(c)) for c, value in columns.items()}
        )

    return Transform(name, apply)


def mask(*fields: str, name: str = "mask") -> Transform:
    """Replace fields of both images by the SHA-256 of their text."""

    def apply(df: DataFrame, prefix: str) -> DataFrame:
        masked = {s: images.masked_fields(F.col(s), fields) for s in ("before", "after")}
        return rewrite(masked).apply(df, prefix)

    return Transform(name, apply)


def enrich(
    dim: DataFrame,
    on: tuple[str, str],
    fields: Mapping[str, str],
    name: str = "enrich",
    broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> Transform:
    """Add dimension columns to the ``after`` image.

    ``on`` is (image field, dimension column), the latter unique; ``fields``
    maps image field to dimension column. The dimension is broadcast only if it
    was found small enough.
    """
    image_field, key = on
    grouped = (
        dim.groupBy(F.col(key).cast("string").alias("_key"))
        .agg(F.first(F.struct(*fields.values())).alias("_dim"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_key").isNotNull())
    )
    repeated = F.raise_error(F.lit(f"{name}: repeated key in {key}"))
    checked = F.when(F.col("_n") > 1, repeated.cast(grouped.schema["_dim"].dataType))
    picked = grouped.select("_key", checked.otherwise(F.col("_dim")).alias("_dim"))

    def apply(df: DataFrame, _: str) -> DataFrame:
        live = outcome.is_live()
        keyed = df.withColumn("_key", F.when(live, images.usable_text(F.col("after"), image_field)))
        joined = left_lookup(keyed, picked, "_key", broadcast_rows=broadcast_rows)
        enriched = images.with_fields(
            F.col("after"), {f: F.col(f"_dim.{c}") for f, c in fields.items()}
        )
        return joined.withColumn("after", F.when(live, enriched).otherwise(F.col("after"))).drop(
            "_key", "_dim"
        )

    return Transform(name, apply)


def frame(function: Callable[[DataFrame], DataFrame], name: str = "frame") -> Transform:
    """Any DataFrame step that keeps the stage columns and one row per event."""
    return Transform(name, lambda df, _: function(df))


def chain(
    staged: DataFrame,
    links: Sequence[Transform | UserFunction],
    max_attempts: int = 3,
    backoff_ms: int = 100,
    numbered: bool = True,
) -> DataFrame:
    """Apply links in order; an event leaves the chain at the first drop or failure.

    ``numbered`` puts ``transform {i} failed`` before the cause of a failure.
    """
    if not links:
        return staged

    def prefix(i: int) -> str:
        return f"transform {i} failed\n" if numbered else ""

    # A transform sees the event as JSON, which cannot hold such numbers.
    staged = outcome.mark(
        staged,
        F.col("not_finite"),
        outcome.TRANSFORM_ERROR,
        "transform",
        F.lit(f"{prefix(0)}failed to marshal event: {outcome.NOT_FINITE}"),
    )
    i = 0
    while i < len(links):
        if isinstance(links[i], Transform):
            staged = links[i].apply(staged, prefix(i))
            i += 1
            continue
        run = []
        while i < len(links) and isinstance(links[i], UserFunction):
            run.append((prefix(i), links[i].function))
            i += 1
        staged = run_functions(staged, run, max_attempts, backoff_ms)
    return staged
