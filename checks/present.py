"""Result columns in the plain types both engines agree on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def present(df: DataFrame, digits: int = 9, money: int = 9, **names) -> DataFrame:
    """Decimals as rounded doubles (values and hours may take other digits), counts as bigint, times and dates as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            wide = any(w in f.name for w in ("value", "duration"))
            c = F.round(c, money if wide else digits).cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(names.get(f.name, f.name)))
    return df.select(*out)
