"""Flat, comparable result rows: the form query results are reported in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and timestamps as ISO text, arrays as ``|``-joined text."""
    def show(field: T.StructField) -> Column:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            out = col.cast("double")
        elif isinstance(kind, T.DateType):
            out = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            out = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            out = F.concat_ws("|", F.transform(col, lambda x: x.cast("string")))
        else:
            out = col
        return out.alias(field.name)

    return df.select(*[show(f) for f in df.schema.fields])
