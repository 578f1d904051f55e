"""Recall and result-size measures over hits and ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.filters import compile_filters

MAX_HITS_PER_QUERY = 100
SHAPES_DIFFER = "the shapes of the neighbors and results do not match"


def hit_ids(hits: DataFrame) -> DataFrame:
    """``(query_id, ids)``: the hit ids of each query in rank order."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "id")))
    return hits.groupBy("query_id").agg(F.transform(ordered, lambda x: x["id"]).alias("ids"))


def recall(found: Column, truth: Column) -> Column:
    """Share of the truth that was found; the two must have the same length."""
    share = F.size(F.array_intersect(truth, found)) / F.size(truth)
    return F.when(
        F.size(found) != F.size(truth),
        F.raise_error(F.lit(SHAPES_DIFFER)).cast("double"),
    ).otherwise(share)


def recall_per_query(hits: DataFrame, truth: DataFrame, strict: bool = False) -> DataFrame:
    """``(query_id, recall)`` from hits and truth ``(query_id, id)``.

    Equi-join on (query, id) with counts, so that no per-query list is built.
    ``strict`` raises unless every query has as many hits as truths.
    """
    sides = truth.select("query_id", "id", F.lit(1).alias("t"), F.lit(0).alias("h")).union(
        hits.select("query_id", "id", F.lit(0), F.lit(1)))
    pairs = sides.groupBy("query_id", "id").agg(F.sum("t").alias("t"), F.sum("h").alias("h"))
    counts = pairs.groupBy("query_id").agg(
        F.sum("t").alias("n_truth"), F.sum("h").alias("n_hits"), F.sum(F.least("t", "h")).alias("n_common"))
    share = F.when(F.col("n_truth") > 0, F.col("n_common") / F.col("n_truth"))
    if strict:
        share = F.when(F.col("n_truth") != F.col("n_hits"), F.raise_error(F.lit(SHAPES_DIFFER)).cast("double")).otherwise(share)
    rows = counts if strict else counts.where("n_truth > 0")
    return rows.select("query_id", share.alias("recall"))


def mean_recall(hits: DataFrame, truth: DataFrame, strict: bool = False) -> DataFrame:
    return recall_per_query(hits, truth, strict).agg(F.avg("recall").alias("recall"))


def truth_from_positions(positions: Column, candidates: Column) -> Column:
    """Ground-truth positions mapped through the candidate list; padding and out-of-range dropped."""
    inside = F.filter(positions, lambda p: (p >= 0) & (p < F.size(candidates)))
    return F.transform(inside, lambda p: F.get(candidates, p.cast("int")))


def filtered_recall(found: Column, expected: Column) -> Column:
    """Recall of a filtered query; both sides empty counts as 1, nothing expected but found as 0."""
    both_empty = (F.size(found) == 0) & (F.size(expected) == 0)
    too_many = F.size(found) > MAX_HITS_PER_QUERY
    common = F.size(F.array_intersect(expected, found))
    return (
        F.when(both_empty, F.lit(1.0))
        .when(too_many, F.raise_error(F.lit("more than 100 results returned")).cast("double"))
        .when(F.size(expected) == 0, F.lit(0.0))
        .otherwise(common / F.least(F.size(expected), F.lit(MAX_HITS_PER_QUERY)))
    )


def filtered_summary(df: DataFrame) -> DataFrame:
    """Per filter: mean recall, mean returned and mean expected hits.

    Takes one row per (filter_name, query_id) with arrays ``found`` and ``expected``.
    """
    return df.groupBy("filter_name").agg(
        F.avg(filtered_recall(F.col("found"), F.col("expected"))).alias("recall"),
        F.avg(F.size("found")).alias("mean_returned"),
        F.avg(F.size("expected")).alias("mean_expected"),
    )


def candidate_counts(items: DataFrame, filters: dict[str, dict], metadata: str = "metadata") -> DataFrame:
    """``(filter_name, n_match, n_total)`` for all filters in one pass."""
    names = list(filters)
    met = items.select(compile_filters([filters[n] for n in names], F.col(metadata)).alias("met"))
    row = met.agg(F.count("*").alias("n_total"), *[F.count_if(F.col("met")[i]).alias(f"c{i}") for i in range(len(names))])
    pairs = F.array(*[F.struct(F.lit(n).alias("filter_name"), F.col(f"c{i}").alias("n_match"))
                      for i, n in enumerate(names)])
    return row.select(F.inline(pairs), "n_total")
