"""Flat presentation of nested results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fields(struct: T.StructType):
    def text(s: Column) -> Column:
        return F.concat_ws("|", *[F.coalesce(s[f.name].cast("string"), F.lit("null")) for f in struct.fields])

    return text


def as_text(df: DataFrame) -> DataFrame:
    """Arrays become delimited text, struct items their fields joined by ``|`` and sorted."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            if isinstance(f.dataType.elementType, T.StructType):
                c = F.array_join(F.array_sort(F.transform(c, _fields(f.dataType.elementType))), ";")
            else:
                c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)
