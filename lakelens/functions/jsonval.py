"""JSON values with dynamic types: serialize, parse to VARIANT, typed field access, truthiness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_json_text(struct: Column) -> Column:
    """JSON object text that keeps null fields (the original payloads carry explicit nulls)."""
    return F.to_json(struct, {"ignoreNullFields": "false"})


def parse(text: Column) -> Column:
    """VARIANT of the text, NULL when the text is not JSON."""
    return F.try_parse_json(text)


def kind(v: Column) -> Column:
    """Top-level JSON type: OBJECT, ARRAY, STRING, BIGINT, ..., NULL as 'VOID'."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v) == "OBJECT", F.lit(False))


def has_field(v: Column, name: str) -> Column:
    """True when the object has the key, even with a null value."""
    return F.try_variant_get(v, f"$.{name}", "variant").isNotNull()


def get_string(v: Column, name: str) -> Column:
    """Field as text; numbers and booleans are rendered, nested values as JSON."""
    return F.try_variant_get(v, f"$.{name}", "string")


def get_long(v: Column, name: str) -> Column:
    """Field as bigint; numeric text such as "12" binds, other text gives NULL."""
    return F.try_variant_get(v, f"$.{name}", "bigint")


def field_text(v: Column, name: str) -> Column:
    """Field rendered as JSON text (NULL when absent)."""
    return F.to_json(F.variant_get(v, f"$.{name}", "variant"))


def is_truthy(v: Column, name: str) -> Column:
    """Python truthiness of a field: null, "", 0, 0.0, false, [] and {} are false."""
    return truthy_text(field_text(v, name))


def truthy_text(text: Column) -> Column:
    """Python truthiness of a value rendered by ``field_text``."""
    return F.coalesce(
        ~text.isin("null", '""', "0", "0.0", "false", "[]", "{}") & ~text.rlike(r"^-?0(\.0+)?([eE][+-]?\d+)?$"),
        F.lit(False),
    )
