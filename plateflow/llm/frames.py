"""Shared plumbing of the text operators: running an Arrow function beside kept columns, and reading tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plateflow.session import shared_dir


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def column(df: DataFrame, name: str):
    """The column of that very name, also where it holds dots or backticks."""
    return df["`" + name.replace("`", "``") + "`"]


def kept(columns: Sequence[str], outputs: Sequence[str]) -> list[str]:
    """``columns`` without those that an output replaces; Spark ignores case in names."""
    taken = {name.lower() for name in outputs}
    return [name for name in columns if name.lower() not in taken]


#: Rows worked on and sent back at a time; bounds what either side holds of a batch.
ROWS_AT_ONCE = 2048

Compute = Callable[[Sequence[pa.Array]], Sequence[Sequence | pa.Array]]


def append(df: DataFrame, inputs: Sequence[str], outputs: str, make: Callable[[], Compute],
           keep: Sequence[str] = (), most_bytes: int | None = None) -> DataFrame:
    """``keep`` columns of ``df`` followed by the columns that ``make()`` computes from ``inputs``.

    ``make`` runs once per task and returns a function from the Arrow arrays of some rows to the
    output columns. One row in, one row out, in place: no shuffle. A kept column whose name is
    that of an output is replaced by the output. With ``most_bytes`` the function is also given no more
    than so many bytes of its first input, a text, at once, but one row at least.
    """
    added = T._parse_datatype_string(outputs)
    carry = kept(keep, added.names)
    # An input that is kept crosses to Python once.
    more = [c for c in dict.fromkeys(inputs) if c not in carry]
    place = [carry.index(c) if c in carry else len(carry) + more.index(c) for c in inputs]
    frame = df.select(*[column(df, c).alias(f"k{i}") for i, c in enumerate(carry)],
                      *[column(df, c).alias(f"x{i}") for i, c in enumerate(more)])
    schema = T.StructType(
        [T.StructField(f"k{i}", frame.schema[f"k{i}"].dataType) for i in range(len(carry))] + list(added.fields))
    n = len(carry)
    types = [arrow_type(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            compute = compute or make()
            for start, rows in pieces(batch.column(place[0]), most_bytes):
                some = batch.slice(start, rows)
                results = compute([some.column(i) for i in place])
                arrays = [some.column(i) for i in range(n)]
                arrays += [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(results, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return frame.mapInArrow(run, schema).toDF(*carry, *added.names)


def pieces(array: pa.Array, most_bytes: int | None = None) -> Iterator[tuple[int, int]]:
    """Where runs of rows begin and how many each has: ``ROWS_AT_ONCE`` and ``most_bytes`` of text at most, one row at least."""
    if most_bytes is None:
        yield from ((start, min(ROWS_AT_ONCE, len(array) - start)) for start in range(0, len(array), ROWS_AT_ONCE))
        return
    lengths = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths, dtype=np.int64), 0
    while start < len(array):
        before = ends[start - 1] if start else 0
        fit = int(np.searchsorted(ends, before + most_bytes, "right")) - start
        rows = min(max(fit, 1), ROWS_AT_ONCE, len(array) - start)
        yield start, rows
        start += rows


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind.fields])
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.FloatType: pa.float32(),
            T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}[type(kind)]


def texts(array: pa.Array, step: int = 512) -> Iterator[str]:
    """The strings of an Arrow array, a few at a time in Python; null is the empty text."""
    for start in range(0, len(array), step):
        for value in array.slice(start, step).to_pylist():
            yield value or ""


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A new folder in the cluster's shared one, deleted when the block ends.

    What is returned from the block must not read it: ``cut`` it first.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        discard(spark, folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read again: cuts the lineage and keeps columns apart."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap(values: DataFrame, name: str, bits: int) -> np.ndarray:
    """A bit array of 2**bits (as bytes) in which the top bits of every 64-bit hash ``name`` are set.

    Its size is fixed, whatever the data; on a larger input it only lets more through.
    """
    place = F.shiftrightunsigned(F.col(name), 64 - bits)
    placed = values.select(F.shiftright(place, 15).cast("int").alias("block"), place.bitwiseAND(F.lit(32767)).alias("bit"))
    blocks = placed.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in blocks.collect():
        out[row["block"] * 4096:(row["block"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def in_bitmap(array: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes have their bit set."""
    place = hashes.view(np.uint64) >> np.uint64(64 - bits)
    return (array[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
