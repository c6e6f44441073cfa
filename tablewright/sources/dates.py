"""Columns called ``date`` are parsed to timestamps when they arrive as text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_COLUMNS = ("date",)


def parse_date_columns(df: DataFrame, names: Iterable[str] = DATE_COLUMNS) -> DataFrame:
    """Parse the named string columns to ``timestamp_ntz``; other types stay.

    Text with a zone offset is converted to UTC wall time (it goes through a
    zoned timestamp first, so ``03:00+02:00`` becomes ``01:00``); unparseable
    text becomes null. Integral columns are read as epoch seconds.
    """
    wanted = set(names)
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if field.name in wanted and isinstance(field.dataType, T.StringType):
            col = F.try_to_timestamp(col).cast("timestamp_ntz")
        elif field.name in wanted and isinstance(field.dataType, (T.IntegerType, T.LongType)):
            col = F.timestamp_seconds(col).cast("timestamp_ntz")
        out.append(col.alias(field.name))
    return df.select(out)
