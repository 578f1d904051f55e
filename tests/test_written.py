"""Tables kept between jobs, and what their jobs leave behind."""

import time

from pyspark.sql import functions as F
from vecspark.plans import workspace
from vecspark.plans.collection import VectorStore


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(i)) for i in range(files.size()) if "shuffle_" in str(files.apply(i))}


def test_shuffle_files_go_with_the_write(spark):
    spark.conf.set(workspace.SHUFFLE_CLEANUP, "false")
    before = shuffle_files(spark)
    rows = spark.range(50_000).groupBy((F.col("id") % 1000).alias("n")).agg(F.count("*").alias("rows"))
    kept = workspace.written(rows, "rows")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == 1000 and spark.conf.get(workspace.SHUFFLE_CLEANUP) == "false"


def test_queries_keep_single_precision(spark, tmp_path):
    collection = VectorStore(spark, str(tmp_path / "store")).create("some", bytes(32))
    for kind, kept in (("array<float>", "array<float>"), ("array<double>", "array<double>"), ("array<int>", "array<double>")):
        queries = spark.range(2).select(F.col("id").alias("query_id"), F.array(F.lit(1), F.lit(2)).cast(kind).alias("qv"))
        assert collection._query_frame(collection.state(), queries, None).schema["qv"].dataType.simpleString() == kept
