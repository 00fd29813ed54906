"""The event envelope as JSON text, both ways, and the text form of a position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.once import once

# How an unset time is written, and the layout times are read in.
UNSET_TIME = "0001-01-01T00:00:00Z"
RFC3339 = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?"
    r"(Z|[+-][0-9]{2}:[0-9]{2})$"
)
IMAGE = "map<string,variant>"


def rfc3339(ts: Column) -> Column:
    """UTC text of an instant, whatever the session time zone is."""
    utc = F.timestamp_add(
        "MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )
    return F.concat(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def envelope(event: str | None = None, pretty: bool = False) -> Column:
    """Envelope JSON of the event columns, or of the event struct column named ``event``.

    Absent images are left out; a null inside an image stays.
    """

    def get(name: str) -> Column:
        return F.col(f"{event}.{name}" if event else name)

    fields = [
        *(F.coalesce(get(n), F.lit("")).alias(n) for n in ("source", "table", "op")),
        F.coalesce(rfc3339(get("ts")), F.lit(UNSET_TIME)).alias("ts"),
        get("before").alias("before"),
        get("after").alias("after"),
    ]
    options = {"pretty": "true"} if pretty else {}
    return F.to_json(F.struct(*fields), options)


def with_parsed(df: DataFrame, text: Column, into: str = "_event") -> DataFrame:
    """Parse envelope JSON to a struct column of the event columns plus ``error``.

    A missing field is empty, as is ``{}``; a text that is not JSON or has a
    field of the wrong type gives an error instead. No text gives no struct.
    """
    parsed = once(df, _doc=F.try_parse_json(text), _given=text.isNotNull())
    names = ("source", "table", "op", "ts", "before", "after")
    parts = {f"_{n}": F.try_variant_get("_doc", f"$.{n}", "variant") for n in names}
    images = {f"_{n}_image": F.try_variant_get("_doc", f"$.{n}", IMAGE) for n in ("before", "after")}
    parsed = once(parsed, **parts, **images)

    def absent(name: str) -> Column:
        return F.col(f"_{name}").isNull() | F.is_variant_null(F.col(f"_{name}"))

    def string(name: str) -> Column:
        return F.try_variant_get(F.col(f"_{name}"), "$", "string")

    def wrong(what: str) -> Column:
        return F.lit(f"failed to unmarshal event: {what}")

    time = F.when(string("ts").rlike(RFC3339), string("ts").try_cast("timestamp"))
    doc = F.col("_doc")
    is_object = F.is_variant_null(doc) | F.startswith(F.schema_of_variant(doc), F.lit("OBJECT"))
    error = F.when(doc.isNull() | ~is_object, wrong("invalid JSON object"))
    for name in ("source", "table", "op"):
        is_string = F.schema_of_variant(F.col(f"_{name}")) == "STRING"
        error = error.when(~absent(name) & ~is_string, wrong(f"{name} is not a string"))
    error = error.when(~absent("ts") & time.isNull(), wrong("bad ts"))
    for name in ("before", "after"):
        not_object = ~absent(name) & F.col(f"_{name}_image").isNull()
        error = error.when(not_object, wrong(f"{name} is not an object"))
    event = F.struct(
        *(F.coalesce(string(n), F.lit("")).alias(n) for n in ("source", "table", "op")),
        F.when(string("ts") != UNSET_TIME, time).alias("ts"),
        *(F.when(F.size(f"_{n}_image") > 0, F.col(f"_{n}")).alias(n) for n in ("before", "after")),
        error.alias("error"),
    )
    return parsed.withColumn(into, F.when(F.col("_given"), event)).drop(
        "_doc", "_given", *parts, *images
    )


def parse_envelopes(lines: DataFrame, text: str = "value") -> DataFrame:
    """Envelope lines to event columns and ``error``; other columns are kept."""
    kept = [c for c in lines.columns if c != text]
    parsed = with_parsed(lines, F.coalesce(F.col(text), F.lit("")), "_event")
    return parsed.select(*kept, "_event.*")


def position_text(lsn: Column) -> Column:
    """Log position as ``high/low`` in decimal; no position is the empty string."""
    return F.coalesce(
        F.concat(
            F.shiftrightunsigned(lsn, 32).cast("string"),
            F.lit("/"),
            lsn.bitwiseAND(F.lit(0xFFFFFFFF)).cast("string"),
        ),
        F.lit(""),
    )
