"""Final projection used by registered queries so results compare cleanly
with an independent SQL engine: doubles rounded (NULL where not finite, which
not every comparison can hold), decimals as doubles,
integers widened, dates as ISO text, string arrays joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 9


def present(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = c.cast("double")
            c = F.when(F.abs(c) < F.lit(float("inf")), F.round(c, digits))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(f.name))
    return df.select(*out)
