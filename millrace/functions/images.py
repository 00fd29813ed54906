"""Reading and rewriting fields of a row image held as VARIANT."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE = "map<string,variant>"


def field_path(name: str) -> str:
    """Path of a top-level field, whatever characters its name has."""
    if "'" not in name:
        return f"$['{name}']"
    if '"' not in name:
        return f'$["{name}"]'
    raise ValueError(f"field name mixes both quote characters: {name}")


def field(image: Column, name: str) -> Column:
    """A field as VARIANT; NULL when the image or the field is missing."""
    return F.try_variant_get(image, field_path(name), "variant")


def usable_text(image: Column, name: str) -> Column:
    """A field as text; NULL when there is no name, no image, no field, a null, or ``""``."""
    if not name:
        return F.lit(None).cast("string")
    return F.nullif(F.try_variant_get(image, field_path(name), "string"), F.lit(""))


def payload_bytes(image: Column, name: str) -> Column:
    """A field as message bytes: text and bytes as they are, anything else as JSON."""
    if not name:
        return F.lit(None).cast("binary")
    path = field_path(name)
    value = F.try_variant_get(image, path, "variant")
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "BINARY", F.try_variant_get(image, path, "binary"))
        .when(kind == "STRING", usable_text(image, name).cast("binary"))
        .when(kind != "VOID", F.to_json(value).cast("binary"))
    )


def not_finite_field(image: Column, name: str) -> Column:
    """Whether a field is NaN or an infinity. JSON has no such numbers, so none is nested in a field."""
    number = F.try_variant_get(image, field_path(name), "double")
    kind = F.schema_of_variant(field(image, name))
    found = kind.isin("DOUBLE", "FLOAT") & (F.isnan(number) | (F.abs(number) == float("inf")))
    return F.coalesce(found, F.lit(False))


def with_fields(image: Column, fields: Mapping[str, Column]) -> Column:
    """The image with fields set or replaced; an absent image stays absent."""
    added = F.create_map(
        *(part for name, value in fields.items() for part in (F.lit(name), value.cast("variant")))
    )
    names = F.array(*(F.lit(name) for name in fields))
    rest = F.map_filter(image.cast(IMAGE), lambda k, _: ~F.array_contains(names, k))
    return F.when(image.isNotNull(), F.to_variant_object(F.map_concat(rest, added)))


def masked_fields(image: Column, names: tuple[str, ...]) -> Column:
    """The image with the named non-null fields replaced by the SHA-256 of their text."""
    hidden = F.transform_values(
        image.cast(IMAGE),
        lambda k, v: F.when(
            k.isin(*names) & ~F.is_variant_null(v), F.sha2(v.cast("string"), 256).cast("variant")
        ).otherwise(v),
    )
    return F.when(image.isNotNull(), F.to_variant_object(hidden))
