"""Small typed frames for hand-built cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from plateflow.functions.literal import table_of
from plateflow.model import TABLES, from_frames


def convert(value, kind):
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value)).quantize(Decimal(1).scaleb(-kind.scale))
    if isinstance(kind, T.DateType) and isinstance(value, str):
        return dt.date.fromisoformat(value)
    if isinstance(kind, T.TimestampNTZType) and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value


def frame(spark, table, rows):
    """Rows as dicts; only the columns that occur are in the frame."""
    names = list(dict.fromkeys(k for r in rows for k in r))
    fields = {f.name: f.dataType for f in TABLES[table].schema}
    schema = T.StructType([T.StructField(n, fields[n]) for n in names])
    return table_of(spark, [tuple(convert(r.get(n), fields[n]) for n in names) for r in rows], schema)


def market(spark, **tables):
    return from_frames(spark, {name: frame(spark, name, rows) for name, rows in tables.items()})


def dicts(df):
    return [r.asDict() for r in df.collect()]
