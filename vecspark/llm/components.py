"""Connected components of a graph given by its links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import scratch_path

TASK_ROWS = 1 << 17      # short rows that a task writes


def kept_table(df: DataFrame, purpose: str, rows: int | None = None, **options) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there.

    ``rows``: about how many short rows it has at most. No more tasks write it
    than these give work or cores run at once, however many partitions a
    shuffle makes; a job of many rounds mostly waits for such tasks otherwise.
    """
    path = scratch_path(df.sparkSession, purpose)
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links (a, b)``: the smallest node that it can reach.

    Every round, the larger neighbours of a node and its smaller ones move to
    the smallest node in sight, until nothing changes; rounds grow with the
    logarithm of the longest path. A node with very many links is one key of a
    join whose other side has a row per node, so that it can be split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges, state = kept_table(edges, "links", links.count()), None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == state:
            break
        state, rows = mark, mark[0]
        around = edges.union(edges.select("v", "u")).groupBy("u").agg(F.min("v").alias("low"))
        # written first: a side that an aggregation has dealt out keeps the join from splitting a hot node
        lowest = kept_table(around.select(F.col("u").alias("v"), F.least("u", "low").alias("low")), "lowest", 2 * rows)
        larger = kept_table(edges.join(lowest, "v").select("u", F.col("low").alias("v")).distinct(), "larger", rows)
        below = kept_table(larger.groupBy("u").agg(F.min("v").alias("low")), "below", rows)
        smaller = larger.join(below, "u")
        moved = smaller.select("u", F.col("low").alias("v")).union(
            smaller.where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v")))
        edges = kept_table(moved.distinct(), "links", 2 * rows)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return kept_table(nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()), "labels", 2 * state[0])
