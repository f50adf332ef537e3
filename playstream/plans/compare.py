"""Presentation step for oracle comparison.

Arrays become comma-joined strings, doubles are rounded to 6 places and
timestamps print as ``yyyy-MM-dd HH:mm:ss``, in
the Spark result here and by hand in each oracle statement, so that engine
differences in array and float printing do not hide equal results. Nothing
is dropped or filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            inner = f.dataType.elementType
            if isinstance(inner, (T.DoubleType, T.FloatType)):
                c = F.transform(c, lambda x: F.round(x.cast("double"), digits))
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def nullable_ints_as_double(df: DataFrame, cols: list[str]) -> DataFrame:
    """Integer columns that hold nulls by design, presented as doubles on
    both sides: pandas turns a Spark int column with nulls into float64 but
    a DuckDB one into a nullable integer type, so the same numbers would
    print differently."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})
