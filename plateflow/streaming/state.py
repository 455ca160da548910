"""Versioned state of a stream in a folder: which files of each bucket hold after which batch.

A batch writes new files under its own number and then, in one rename, a manifest that names for
every bucket the batches whose files count. A batch that failed half-way leaves no manifest and is
run again over the same files; one that was committed is not run twice.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plateflow.session import files

#: Batches of files a bucket may consist of before it is written anew as one.
MOST_FILES = 16


def bucket_of(keys: tuple[str, ...] | list[str], buckets: int) -> Column:
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets))


@dataclass
class Manifest:
    """After batch ``number``: table -> bucket -> numbers of the batches that hold it."""

    number: int = -1
    tables: dict[str, dict[int, list[int]]] = field(default_factory=dict)

    def following(self, number: int) -> Manifest:
        return Manifest(number, {t: dict(b) for t, b in self.tables.items()})

    def parts(self, table: str, only: set[int] | None = None) -> list[tuple[int, int]]:
        """(batch, bucket) of the files that count, of all buckets or some."""
        return [(batch, bucket) for bucket, batches in sorted(self.tables.get(table, {}).items())
                if only is None or bucket in only for batch in batches]

    def replace(self, table: str, bucket: int, batches: list[int]) -> None:
        self.tables.setdefault(table, {})[bucket] = batches


class Store:
    """Tables of one stream, each dealt to buckets by a hash of its keys."""

    def __init__(self, spark: SparkSession, path: str, buckets: int) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets

    def _numbers(self) -> list[int]:
        """Committed batches whose manifests are still there."""
        fs, make = files(self.spark, self.path)
        folder = make(f"{self.path}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def _load(self, number: int) -> Manifest:
        fs, make = files(self.spark, self.path)
        stream = fs.open(make(f"{self.path}/manifests/{number}"))
        stored = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        return Manifest(number, {t: {int(b): v for b, v in by.items()} for t, by in stored.items()})

    def manifest(self) -> Manifest:
        """The newest committed one."""
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else Manifest()

    def commit(self, manifest: Manifest) -> None:
        """Make a manifest the newest. What neither it nor the one before names is deleted, so whoever reads by the
        one before is not disturbed."""
        fs, make = files(self.spark, self.path)
        draft = make(f"{self.path}/manifests/_draft-{manifest.number}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest.tables), "utf-8"))
        out.close()
        if not fs.rename(draft, make(f"{self.path}/manifests/{manifest.number}")):
            raise RuntimeError(f"cannot commit batch {manifest.number} of {self.path}")
        *past, before, after = [Manifest(), *map(self._load, self._numbers())]
        for old in past:
            for table in old.tables:
                named = {*before.parts(table), *after.parts(table)}
                for batch, bucket in set(old.parts(table)) - named:
                    fs.delete(make(f"{self.path}/{table}/batch={batch}/bucket={bucket}"), True)
            if old.number >= 0:
                fs.delete(make(f"{self.path}/manifests/{old.number}"), False)

    def write(self, table: str, number: int, rows: DataFrame) -> None:
        """Rows with their ``bucket``, under a batch's number; a repeated run replaces what it wrote. The hint sizes the
        files: small buckets have one each, a large one is split."""
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{table}/batch={number}")

    def read(self, table: str, schema: T.StructType, parts: list[tuple[int, int]]) -> DataFrame:
        """The rows of these files, with ``bucket``; nothing else is listed or opened."""
        full = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        if not parts:
            return self.spark.createDataFrame([], full)
        root = f"{self.path}/{table}"
        rows = self.spark.read.schema(full).option("basePath", root)
        return rows.parquet(*[f"{root}/batch={batch}/bucket={bucket}" for batch, bucket in parts]).select(*full.names)

    def written(self, table: str, number: int) -> list[int]:
        """The buckets for which a batch has files."""
        fs, make = files(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(make(f"{self.path}/{table}/batch={number}"))]
        return sorted(int(n[7:]) for n in names if n.startswith("bucket="))
