"""Strict JSON parsing and VARIANT shape tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_json(text: Column) -> Column:
    """VARIANT of a JSON text, NULL unless the whole text is one JSON value.

    try_parse_json stops after the first value and ignores what follows it. Parsing the
    text as the first item of a two-item array, whose second item is a digest of the text,
    makes trailing characters break the array.
    """
    seal = F.xxhash64(text).cast("string")
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), seal, F.lit('"]')))

    def opened(parsed: Column) -> Column:
        sealed = F.try_variant_get(parsed, "$[1]", "string") == seal
        return F.when(sealed, F.try_variant_get(parsed, "$[0]", "variant"))

    # The one-item array lets both uses share one parse.
    return F.get(F.transform(F.array(pair), opened), F.lit(0))


def child(value: Column, path: str) -> Column:
    """Member of a VARIANT: NULL when absent, a null VARIANT when it is JSON null."""
    return F.try_variant_get(value, path, "variant")


def as_string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def as_items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("ARRAY"), F.lit(False))


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def is_truthy(value: Column) -> Column:
    """False for absent, null, false, zero, and empty strings, arrays and objects."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.isNull() | (kind == "VOID"), False)
        .when(kind.startswith("ARRAY"), child(value, "$[0]").isNotNull())
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .when(kind == "STRING", as_string(value) != "")
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .otherwise(F.try_variant_get(value, "$", "double") != 0)
    )
