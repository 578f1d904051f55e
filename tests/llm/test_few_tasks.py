import pytest
from pyspark.sql import functions as F
from vecspark.llm import components, pii


@pytest.fixture
def many_partitions(spark):
    """A shuffle makes far more partitions than the rows give work, and none are put together."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def few(spark, df):
    return 0 < len(df.inputFiles()) <= spark.sparkContext.defaultParallelism


def test_rounds_of_components_take_few_tasks(many_partitions):
    spark = many_partitions
    links = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") - F.col("id") % 50).alias("b"))
    labels = components.components(links)
    assert few(spark, labels)
    assert {tuple(r) for r in labels.collect()} == {(i, i - i % 50) for i in range(2000)}


def test_rounds_of_patterns_take_few_tasks(many_partitions):
    spark = many_partitions
    edges = spark.range(3000).select(
        F.concat(F.lit("after p"), F.col("id") % 500).alias("pattern"), F.concat(F.lit("i"), F.col("id") % 1500).alias("instance"),
        (F.col("id") % 3 == 0).alias("seed"), F.lit(0).cast("long").alias("plain"))
    patterns, trusted = pii._bootstrapped(components.kept_table(edges, "test-edges"), 2, 1, 0.1)
    assert few(spark, patterns)
    assert trusted.count() == 500


def test_rows_ask_for_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(components, "TASK_ROWS", 10)
    rows = spark.range(400, numPartitions=30)
    assert len(components.kept_table(rows, "test-rows", 400).inputFiles()) == 30
    assert len(components.kept_table(rows, "test-rows", 200).inputFiles()) == 20
    assert components.kept_table(rows, "test-rows", 0).count() == 400
