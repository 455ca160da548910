"""Small constant tables as local relations, so the planner knows their size."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def table_of(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    arrow = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=schema)
