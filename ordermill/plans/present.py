"""Presentation of results for cross-engine comparison.

Library operators return ``decimal(10,2)`` money and ``date`` report days.
The registered checks compare Spark results with an SQL oracle through
client libraries that map those two types differently, so the registered
queries present money as double (an exact image of a 2-decimal amount) and
dates/timestamps as zoneless timestamps. Values are unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast(T.DoubleType())
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = c.cast(T.TimestampNTZType())
        cols.append(c.alias(f.name))
    return df.select(*cols)
