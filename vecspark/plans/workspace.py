"""Where jobs keep intermediate tables: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = checkpoint.get() if checkpoint.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="vecspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder; nothing is written there yet."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that it is computed once; its shuffle files go at the end of the write."""
    spark = df.sparkSession
    path, before = scratch_path(spark, purpose), spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


SMALL_SPLIT = 16 << 20    # a scan of less than this per core is spread before heavy row work


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size of the tables that a frame reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread_small(df: DataFrame) -> DataFrame:
    """Use all cores for heavy row work on an input of few splits; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if plan_bytes(df) < cores * SMALL_SPLIT else df
