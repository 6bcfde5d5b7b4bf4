"""Reading single values out of a JSON record held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_of(*keys: str) -> str:
    """The JSON path of nested keys; a dot inside a key is part of the key."""
    return "$" + "".join(f'["{key}"]' if "'" in key else f"['{key}']" for key in keys)


def is_object(record: Column) -> Column:
    return F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))


def value_of(record: Column, field: str) -> Column:
    return F.try_variant_get(record, path_of(field), "variant")


def has_field(record: Column, field: str) -> Column:
    """The key is there, even if its value is JSON null."""
    return F.schema_of_variant(value_of(record, field)).isNotNull()


def text_of(record: Column, field: str) -> Column:
    """Scalars as text, lists and objects as JSON text."""
    return F.try_variant_get(record, path_of(field), "string")


def is_truthy(record: Column, field: str) -> Column:
    """False for a missing key and for null, "", 0, false, [] and {}.

    The type comes from the record, so the number 0 is empty and the string "0" is not.
    """
    text = text_of(record, field)
    kind = F.schema_of_variant(value_of(record, field))
    number = kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
    return F.coalesce(
        F.when(kind == "VOID", False)
        .when(kind == "BOOLEAN", text == "true")
        .when(number, text.try_cast("double") != 0)
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(text != ""),
        F.lit(False),
    )
