"""Keyed table operations: get, delete, upsert and id sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.workspace import plan_bytes

LARGE_BATCH = 4 << 30           # bytes from which repeated ids are looked for first
MAX_BROADCAST_IDS = 1_000_000   # ids in one broadcast side, counted before use


def id_frame(spark: SparkSession, ids: list[str]) -> DataFrame:
    """A list of ids as rows ``(pos, id)`` in list order."""
    return spark.createDataFrame(list(enumerate(ids)), "pos long, id string")


def bounded(side: DataFrame, limit: int = MAX_BROADCAST_IDS) -> DataFrame:
    """Mark a side for broadcast when it has at most ``limit`` rows; else leave it to the planner."""
    few = side.select(F.lit(1)).limit(limit + 1).count() <= limit
    return F.broadcast(side) if few else side


def get_by_ids(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``items`` for each requested ``(pos, id)``; unknown ids give no row."""
    return items.join(bounded(wanted), "id")


def delete_by_ids(items: DataFrame, ids: DataFrame) -> DataFrame:
    """``items`` without the listed ids; unknown ids are ignored."""
    return items.join(bounded(ids.select("id")), "id", "left_anti")


def latest_per_id(batch: DataFrame, order: Column | None = None) -> DataFrame:
    """One row per id: the last by ``order`` (by default the last in row order).

    The window limit runs before the shuffle too, so an id repeated many times
    sends one row per task. A large batch is split first by a count over its
    ids alone: only the rows of repeated ids are then shuffled. Rows without
    an id are all kept, for validation to judge.
    """
    staged = batch.withColumn("_seq", F.monotonically_increasing_id() if order is None else order)
    if plan_bytes(batch) < LARGE_BATCH:
        return _last_rows(staged)
    repeated = bounded(batch.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"))
    single = staged.join(repeated, "id", "left_anti").drop("_seq")
    return single.unionByName(_last_rows(staged.join(repeated, "id", "left_semi")))


def _last_rows(staged: DataFrame) -> DataFrame:
    apart = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
    window = Window.partitionBy("id", "_apart").orderBy(F.desc("_seq"))
    ranked = staged.withColumn("_apart", apart).withColumn("_rn", F.row_number().over(window))
    return ranked.where(F.col("_rn") == 1).drop("_rn", "_seq", "_apart")


def upsert_merge(items: DataFrame, batch: DataFrame, order: Column | None = None) -> DataFrame:
    """Replace rows with the batch's rows of the same id, add the rest."""
    last = latest_per_id(batch, order)
    return delete_by_ids(items, last).unionByName(last)


def id_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return expected.select("id").exceptAll(actual.select("id"))


def id_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("id").intersect(right.select("id"))


def list_ids(items: DataFrame) -> DataFrame:
    return items.select("id")


def num_vectors(items: DataFrame) -> DataFrame:
    return items.agg(F.count("*").alias("num_vectors"))
