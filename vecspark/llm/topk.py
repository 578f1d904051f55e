"""Exact top k inner products by tiles of queries and shards.

Vectors become integers, ``floor(scale * x)``. Queries and vectors are each
packed into blocks of bounded size. A tile is one query block with one shard;
its matrix product gives all scores, a partial selection the best k per query,
packed into one row. Rows of one query block are merged in a tree of fixed
fan-in, so no task ever holds more than a few top lists. Tiles are dealt by an
equi join on the query block, of a stated query set against all rows: work is
queries x rows, memory and messages are not.

Ties go to the smaller id. A query's own row, and any row with its id, is no
candidate. Rows with a null id, a null vector or one that holds null, NaN or
infinity take no part; vectors meet vectors of their own length only, empty
ones score 0. Scores outside 64 bits saturate. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import kept_table

TOP_K = 20
SCALE = 64.0
QUERY_ROWS, SHARD_ROWS = 1024, 8192      # of one tile
FAN_IN = 8

_LONG = np.iinfo(np.int64)
_PACKED = "dim int, block long, shard long, ids binary, vectors binary"
_TOPS = "dim int, block long, shard long, ids binary, found binary, scores binary, counts binary"


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), dim)


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` rows of one length: ids and integer vectors as bytes."""
    def run(batches):
        held: dict[int, list] = {}
        number = task = None

        def block(dim):
            nonlocal number
            ids = np.concatenate([i for i, _ in held[dim]])
            vectors = np.concatenate([v for _, v in held[dim]])
            held[dim] = [(ids[size:], vectors[size:])]
            ids, vectors = ids[:size], vectors[:size]
            number = (task << 33) if number is None else number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([number]), pa.array([number]), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([vectors.tobytes()], pa.binary())],
                names=["dim", "block", "shard", "ids", "vectors"])

        for batch in batches:
            if batch.num_rows:
                task = batch.column(2)[0].as_py()
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                vectors = np.floor(_matrix(part.column(1), dim) * SCALE)
                held.setdefault(dim, []).append((part.column(0).to_numpy().astype(np.int64), vectors))
                while sum(len(i) for i, _ in held[dim]) >= size:
                    yield block(dim)
        for dim in list(held):
            if sum(len(i) for i, _ in held[dim]):
                yield block(dim)

    return rows.select("id", "vector", F.spark_partition_id().alias("task")).mapInArrow(run, _PACKED)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products; the narrowest arithmetic that holds them."""
    peak = (float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1]) if q.shape[1] else 0.0
    if peak < 2.0 ** 24:
        return (q.astype(np.float32) @ v.astype(np.float32).T).astype(np.int64)
    if peak < 2.0 ** 53:
        return (q @ v.T).astype(np.int64)
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(x, y)) for y in v.tolist()] for x in q.tolist()], dtype=object)
    return np.clip(exact, _LONG.min, _LONG.max).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, allowed: np.ndarray, k: int):
    """Per row the k largest scores, ties to smaller ids: ``(ids, scores)`` lists of arrays."""
    by_id = np.argsort(ids, kind="stable")
    ids, scores, allowed = ids[by_id], scores[:, by_id], allowed[:, by_id]
    found, values = [], []
    for row in range(len(scores)):
        own = scores[row]
        pick = np.flatnonzero(allowed[row])
        if len(pick) > k:
            part = own[pick]
            limit = np.partition(part, len(part) - k)[len(part) - k]
            over = pick[part > limit]
            pick = np.concatenate([over, pick[part == limit][:k - len(over)]])
        pick = pick[np.lexsort((ids[pick], ~own[pick]))]      # ~x falls as x rises
        found.append(ids[pick])
        values.append(own[pick])
    return found, values


def _tops(dim, block, shard, ids: np.ndarray, found: list, values: list) -> list:
    return [dim, block, shard, ids.tobytes(), np.concatenate([ids[:0], *found]).tobytes(),
            np.concatenate([ids[:0], *values]).tobytes(), np.array([len(f) for f in found], dtype=np.int64).tobytes()]


def _rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    names = ["dim", "block", "shard", "ids", "found", "scores", "counts"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)


def _split(row: dict):
    ids, found, scores, counts = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "found", "scores", "counts"))
    return ids, np.split(found, np.cumsum(counts)[:-1]), np.split(scores, np.cumsum(counts)[:-1])


def _tile_tops(tiles: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                t = {n: batch.column(i)[at].as_py() for i, n in enumerate(batch.schema.names)}
                qi, vi = (np.frombuffer(t[c], dtype=np.int64) for c in ("q_ids", "ids"))
                q = np.frombuffer(t["q_vectors"], dtype=np.float64).reshape(len(qi), t["dim"])
                v = np.frombuffer(t["vectors"], dtype=np.float64).reshape(len(vi), t["dim"])
                found, values = [], []
                for lo in range(0, len(qi), 128):
                    own = qi[lo:lo + 128]
                    f, s = _best(vi, _scores(q[lo:lo + 128], v), own[:, None] != vi[None, :], k)
                    found += f
                    values += s
                yield _rows([_tops(t["dim"], t["block"], t["shard"], qi, found, values)])

    return tiles.mapInArrow(run, _TOPS)


def _merge(tops: DataFrame, k: int) -> DataFrame:
    """Merge the rows of one query block that share ``shard // FAN_IN``."""
    def merge(table: pa.Table) -> pa.Table:
        parts = [(r["dim"], r["block"], r["up"], *_split(r)) for r in table.to_pylist()]
        dim, block, up, ids = parts[0][:4]
        found, values = [], []
        for q in range(len(ids)):
            i = np.concatenate([p[4][q] for p in parts])
            s = np.concatenate([p[5][q] for p in parts])
            order = np.lexsort((i, ~s))[:k]
            found.append(i[order])
            values.append(s[order])
        return pa.Table.from_batches([_rows([_tops(dim, block, up, ids, found, values)])])

    up = tops.withColumn("up", F.floor(F.col("shard") / FAN_IN).cast("long"))
    return up.groupBy("dim", "block", "up").applyInArrow(merge, _TOPS)


def exact_top_k(queries: DataFrame, vectors: DataFrame, k: int = TOP_K,
                query_rows: int = QUERY_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, id, score`` of the k best ``vectors (id, vector)`` per row of ``queries (id, vector)``."""
    def usable(rows: DataFrame) -> DataFrame:
        v = F.col("vector").cast("array<double>")
        fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return rows.select(F.col("id").cast("long").alias("id"), v.alias("vector")).where("id is not null and vector is not null").where(fine)

    blocks = kept_table(_packed(usable(queries), query_rows), "topk-queries")
    shards = kept_table(_packed(usable(vectors), shard_rows), "topk-shards")
    # shards are numbered without gaps, so that the tree above them is a full one
    numbers = shards.select("dim", "shard").withColumn("number", F.row_number().over(Window.partitionBy("dim").orderBy("shard")) - 1)
    blocks_of = blocks.select("dim", "block").groupBy("dim").agg(F.collect_list("block").alias("blocks"))
    dealt = shards.select("dim", "shard", "ids", "vectors").join(numbers, ["dim", "shard"]).join(blocks_of, "dim")
    dealt = dealt.select("dim", F.explode("blocks").alias("block"), F.col("number").cast("long").alias("shard"), "ids", "vectors")
    tiles = dealt.join(blocks.select("dim", "block", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), ["dim", "block"])
    tops = kept_table(_tile_tops(tiles, k), "topk-tops")
    left = shards.groupBy("dim").count().agg(F.max("count")).first()[0] or 0
    while left > 1:
        tops = kept_table(_merge(tops, k), "topk-tops")
        left = -(-left // FAN_IN)

    def flat(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, found, values = _split(row)
                counts = np.array([len(f) for f in found], dtype=np.int64)
                ranks = np.concatenate([np.arange(1, c + 1) for c in [0, *counts]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, counts)), pa.array(ranks), pa.array(np.concatenate([ids[:0], *found])),
                     pa.array(np.concatenate([ids[:0], *values]))], names=["query_id", "rank", "id", "score"])

    return tops.mapInArrow(flat, "query_id long, rank int, id long, score long")
