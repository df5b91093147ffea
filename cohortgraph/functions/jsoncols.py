"""JSON-array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json_array(c: Column, schema: T.ArrayType) -> Column:
    """Array of structs from JSON text, also when the text is itself a JSON string.

    Empty arrays, invalid text and non-arrays give NULL ("no entries").
    """
    inner = F.when(
        F.ltrim(c).startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v")
    ).otherwise(c)
    is_array = c.rlike(r'^\s*"?\s*\[\s*[^\]\s]')
    return F.when(is_array, F.from_json(inner, schema, {"mode": "PERMISSIVE"}))


def has_fields(entry: Column, fields: tuple[str, ...]) -> Column:
    """All required keys are present."""
    out = F.lit(True)
    for name in fields:
        out = out & entry[name].isNotNull()
    return out
