"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Settings a cluster deployment should carry as well; the shuffle width is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints of finished queries need not stay on shared storage.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plateflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster; on one machine a temporary one where none is configured.

    Executors of a cluster cannot see a temporary folder of the driver, so there it must be set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plateflow-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor cannot change it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Spark deletes the shuffle files of a query when it ends, not when the driver next collects its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """``df`` written as Parquet and read again; no shuffle files of its making are left on disk."""
    spark, void = df.sparkSession, [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        df.drop(*void).write.mode(mode).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)
    read = spark.read.schema(df.drop(*void).schema).parquet(path)
    return read.withColumns({name: F.lit(None) for name in void}).select(*df.columns) if void else read


def kept(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, a fraction of a checkpoint's size.

    The folder is deleted like a checkpoint's: when no frame made from the result is left.
    """
    spark = df.sparkSession
    shared_dir(spark)
    context = spark.sparkContext._jsc.sc()
    # An empty table stands for the folder: plans hold on to it, the optimizer drops it, and Spark's cleaner waits for it.
    rdd = spark.createDataFrame([], df.schema)._jdf.queryExecution().toRdd()
    path = f"{context.getCheckpointDir().get()}/rdd-{rdd.id()}"
    if context.cleaner().isDefined():
        context.cleaner().get().registerRDDCheckpointDataForCleanup(rdd, rdd.id())
    owner = DataFrame(spark._jsparkSession.internalCreateDataFrame(rdd, df._jdf.schema(), False), spark)
    return written(df, path).union(owner.filter(F.lit(False)))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A new folder in the shared one, deleted when the block ends; what is returned from it must not read it."""
    folder = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete(spark, folder)


def files(spark: SparkSession, path: str):
    """The file system of a path, and the class of its paths."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def delete(spark: SparkSession, path: str) -> None:
    fs, make = files(spark, path)
    fs.delete(make(path), True)
