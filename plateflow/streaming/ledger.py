"""Running figures that are kept, not recounted: a hash-bucketed ledger of entries with folded sums beside it.

An entry is what a stream has said last (or first) of one key: the delivery of an order, the newest
version of a rating. A micro-batch reads the buckets its keys fall into, finds repeats there by key,
and appends the entries that are new or replace another, together with what they replaced. Each of
these is one delta to the figures: the old entry out, the new one in. Figures live in buckets of
their own, by the key they are kept for, and only the touched ones are written anew. Reading them
costs the number of figures and no entry is opened.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plateflow.streaming.state import MOST_FILES, Manifest, Store, bucket_of


@dataclass(frozen=True)
class Ledger:
    """What is kept, and how.

    ``schema``: the columns of an entry. ``keys`` tell entries apart. Of several versions of an
    entry that with the greatest ``newest`` columns counts, or, without such columns, that with the
    smallest rest; so arrival order changes nothing. ``figure`` names the column figures are kept
    for; entries without it have none. ``sums`` maps a figure's name to an expression over an
    entry, ``latest`` names a column whose greatest value is kept. The number of entries is ``n``.
    """

    schema: str
    keys: Sequence[str]
    figure: str
    sums: Mapping[str, str] = field(default_factory=dict)
    latest: str | None = None
    newest: Sequence[str] = ()
    buckets: int = 16

    # ---- shapes ----------------------------------------------------------------------

    @cached_property
    def entry(self) -> T.StructType:
        return T._parse_datatype_string(self.schema)

    @property
    def rest(self) -> list[str]:
        return [c for c in self.entry.names if c not in self.keys]

    def _version(self) -> Column:
        """An entry's version as one value that orders versions."""
        first = [c for c in self.newest if c in self.rest]
        return F.struct(*first, *[c for c in self.rest if c not in first])

    def _better(self, a: Column, b: Column) -> Column:
        return a > b if self.newest else a < b

    def _one(self, rows: DataFrame) -> DataFrame:
        """One version of each entry."""
        pick = F.max if self.newest else F.min
        return rows.groupBy(*self.keys).agg(pick(self._version()).alias("_v")).select(
            *self.keys, *[F.col(f"_v.{c}").alias(c) for c in self.rest])

    def _segment(self) -> T.StructType:
        version = T.StructType([self.entry[c] for c in self._version_names()])
        return T.StructType([self.entry[k] for k in self.keys]
                            + [T.StructField("_now", version), T.StructField("_was", version)])

    def _version_names(self) -> list[str]:
        first = [c for c in self.newest if c in self.rest]
        return [*first, *[c for c in self.rest if c not in first]]

    def _deltas(self, segment: DataFrame) -> DataFrame:
        """Figures' changes: old entries out, new ones in."""
        signs = F.array(F.struct(F.lit(1).alias("sign"), F.col("_now").alias("e")),
                        F.struct(F.lit(-1).alias("sign"), F.col("_was").alias("e")))
        signed = segment.select(*self.keys, F.explode(signs).alias("_s")).filter(F.col("_s.e").isNotNull()).select(
            F.col("_s.sign").alias("_sign"), *self.keys, "_s.e.*").filter(F.col(self.figure).isNotNull())
        summed = [F.sum(F.expr(f"_sign * coalesce({e}, 0)")).alias(n) for n, e in {"n": "1", **self.sums}.items()]
        if self.latest:
            at = F.col(self.latest)
            summed += [F.max(F.when(F.col("_sign") > 0, at)).alias("_come"), F.max(F.when(F.col("_sign") < 0, at)).alias("_gone")]
        return signed.groupBy(self.figure).agg(*summed)

    def _figures(self, spark: SparkSession) -> T.StructType:
        """Columns of the figures; the types follow from the expressions."""
        version = spark.createDataFrame([], self._segment())
        deltas = self._deltas(version)
        fields = [T.StructField(f.name, f.dataType) for f in deltas.schema if not f.name.startswith("_")]
        if self.latest:
            fields.append(T.StructField("latest", self.entry[self.latest].dataType))
        return T.StructType(fields)

    # ---- folding ---------------------------------------------------------------------

    def store(self, spark: SparkSession, path: str) -> Store:
        return Store(spark, path, self.buckets)

    def fold(self, batch: DataFrame, number: int, path: str) -> None:
        """Take a micro-batch into the ledger at ``path``. A number that was committed is passed over."""
        spark = batch.sparkSession
        store = self.store(spark, path)
        state = store.manifest()
        if number <= state.number:
            return
        after = state.following(number)
        came = self._one(batch.select(*[F.col(f.name).cast(f.dataType) for f in self.entry])).withColumn(
            "bucket", bucket_of(list(self.keys), self.buckets)).persist()
        try:
            touched = {r[0] for r in came.select("bucket").distinct().collect()}  # one number per bucket
            if touched:
                self._append(store, state, after, came, touched)
                self._refold(store, state, after)
        finally:
            came.unpersist()
        store.commit(after)

    def _append(self, store: Store, state: Manifest, after: Manifest, came: DataFrame, touched: set[int]) -> None:
        """Write the entries that are new or replace another; crowded buckets are written anew as a whole."""
        segment = self._segment()
        known = self._one(store.read("entries", segment, state.parts("entries", touched)).select(*self.keys, "_now.*"))
        now, was = came.select(*self.keys, "bucket", self._version().alias("_now")), known.select(*self.keys, self._version().alias("_was"))
        on = None
        for k in self.keys:
            same = now[k].eqNullSafe(was[k])
            on = same if on is None else on & same
        both = now.join(was, on, "left").select(*[now[k] for k in self.keys], "bucket", "_now", "_was")
        changed = both.filter(F.col("_was").isNull() | self._better(F.col("_now"), F.col("_was")))
        store.write("entries", after.number, changed)
        for bucket in store.written("entries", after.number):
            after.replace("entries", bucket, [*state.tables.get("entries", {}).get(bucket, []), after.number])

    def _refold(self, store: Store, state: Manifest, after: Manifest) -> None:
        """Add this batch's deltas to the figures they touch; then crowded buckets of entries are written as one."""
        spark, number = store.spark, after.number
        fresh = [(number, b) for b, batches in after.tables.get("entries", {}).items() if batches and batches[-1] == number]
        if not fresh:
            return
        deltas = self._deltas(store.read("entries", self._segment(), fresh)).withColumn(
            "bucket", bucket_of([self.figure], self.buckets)).persist()
        measures = ["n", *self.sums]
        figures = self._figures(spark)
        gone = F.count("_gone") if self.latest else F.lit(0)
        seen = deltas.agg(F.collect_set("bucket").alias("b"), gone.alias("g")).first()
        old = store.read("figures", figures, state.parts("figures", set(seen["b"])))
        if self.latest:
            old = old.withColumnRenamed("latest", "_latest")
        joined = old.alias("o").join(deltas.alias("d"), [self.figure], "full")
        types = {f.name: f.dataType for f in figures}
        columns = [F.col(self.figure), F.coalesce(F.col("d.bucket"), F.col("o.bucket")).alias("bucket")]
        columns += [(F.coalesce(F.col(f"o.{m}"), F.lit(0)) + F.coalesce(F.col(f"d.{m}"), F.lit(0))).cast(types[m]).alias(m) for m in measures]
        if self.latest:
            columns.append(F.greatest("_latest", "_come").alias("latest"))
            columns.append((F.col("_gone").isNotNull() & (F.col("_gone") >= F.col("_latest"))
                            & (F.col("_come").isNull() | (F.col("_come") < F.col("_latest")))).alias("_recount"))
        rows = joined.select(*columns).filter(F.col("n") > 0)
        if self.latest:
            if seen["g"]:
                rows = self._recounted(store, after, rows)
            rows = rows.drop("_recount")
        store.write("figures", number, rows)
        deltas.unpersist()
        held = set(store.written("figures", number))
        for bucket in seen["b"]:
            after.replace("figures", bucket, [number] if bucket in held else [])
        for bucket in sorted(b for b, batches in after.tables["entries"].items() if len(batches) > MOST_FILES):
            self._compact(store, after, bucket)

    def _recounted(self, store: Store, after: Manifest, rows: DataFrame) -> DataFrame:
        """Where the entry with the latest value was replaced, the latest of those that are left; only then entries are searched."""
        entries = self._one(store.read("entries", self._segment(), after.parts("entries")).select(*self.keys, "_now.*"))
        asked = rows.filter("_recount").select(self.figure)
        left = entries.join(asked, self.figure, "left_semi").groupBy(self.figure).agg(F.max(self.latest).alias("_left"))
        return rows.join(left, self.figure, "left").withColumn(
            "latest", F.when(F.col("_recount"), F.col("_left")).otherwise(F.col("latest"))).drop("_left")

    def _compact(self, store: Store, after: Manifest, bucket: int) -> None:
        """One bucket of entries as one file set, under a table of its own batch number."""
        entries = self._one(store.read("entries", self._segment(), after.parts("entries", {bucket})).select(*self.keys, "_now.*"))
        version = self._segment()["_was"].dataType
        whole = entries.select(*self.keys, self._version().alias("_now"), F.lit(None).cast(version).alias("_was"))
        whole.write.mode("overwrite").parquet(f"{store.path}/entries/batch={-after.number - 2}/bucket={bucket}")
        after.replace("entries", bucket, [-after.number - 2])

    # ---- reading ---------------------------------------------------------------------

    def figures(self, spark: SparkSession, path: str) -> DataFrame:
        """The figure column, ``n``, the sums and ``latest``, as of the newest committed batch."""
        store = self.store(spark, path)
        return store.read("figures", self._figures(spark), store.manifest().parts("figures")).drop("bucket")

    def entries(self, spark: SparkSession, path: str) -> DataFrame:
        """Every entry once, as the ledger has it."""
        store = self.store(spark, path)
        rows = store.read("entries", self._segment(), store.manifest().parts("entries")).select(*self.keys, "_now.*")
        return self._one(rows).select(*self.entry.names)

    def consumer(self, path: str, prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``."""
        return lambda batch, number: self.fold(prepare(batch) if prepare else batch, number, path)
