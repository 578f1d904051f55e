"""Maximal marginal relevance over the hits of each query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.blocks import exact_distance, matrix
from ..functions.distance import COSINE

DEFAULT_LAMBDA = 0.5


def mmr_order(score: np.ndarray, vectors: np.ndarray, k: int, weight: float) -> list[int]:
    """Greedy picks: ``weight * score - (1 - weight) * max(0, similarity to the picked)``."""
    picked: list[int] = []
    near = np.zeros(len(score))
    free = np.ones(len(score), dtype=bool)
    while len(picked) < min(k, len(score)):
        value = score if not picked else weight * score - (1.0 - weight) * near
        best = int(np.argmax(np.where(free, value, -np.inf)))
        picked.append(best)
        free[best] = False
        near = np.maximum(near, 1.0 - exact_distance(vectors, np.broadcast_to(vectors[best], vectors.shape), COSINE))
    return picked


def mmr_select(hits: DataFrame, k: int, weight: float = DEFAULT_LAMBDA) -> DataFrame:
    """``hits`` (``query_id, rank, id, score, vector, ...``) cut to k picks with ``mmr_rank`` from 1.

    The hits of one query are the fetch size at most, so one row holds them.
    """
    wanted = max(k, 0)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def picks(scores: pa.Array, vectors: pa.Array) -> pa.Array:
        rows = []
        for score, vector in zip(scores, vectors):
            flat = vector.values
            x = matrix(flat) if len(flat) else np.zeros((0, 0))
            rows.append(mmr_order(np.array(score.as_py(), dtype=float), x, wanted, weight))
        return pa.array(rows, pa.list_(pa.int32()))

    fields = [c for c in hits.columns if c != "query_id"]
    lead = ["rank"] + [c for c in fields if c != "rank"]
    ordered = F.array_sort(F.collect_list(F.struct(*lead)), lambda a, b: a["rank"] - b["rank"])
    nested = hits.groupBy("query_id").agg(ordered.alias("hits"))
    chosen = nested.withColumn("picks", picks.asNondeterministic()(
        F.transform("hits", lambda h: h["score"]), F.transform("hits", lambda h: h["vector"])))
    one = chosen.select("query_id", "hits", F.posexplode("picks").alias("pos", "pick"))
    return one.select("query_id", (F.col("pos") + 1).alias("mmr_rank"), F.get("hits", F.col("pick")).alias("hit")) \
        .select("query_id", "mmr_rank", "hit.*")
