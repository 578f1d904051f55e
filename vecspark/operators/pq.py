"""Product quantisation: codebooks, codes and search over codes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.blocks import QueryBlock, matrix, nearest_rows, unit_rows
from ..functions.distance import COSINE, SQUARED_EUCLIDEAN, distance, to_double
from ..plans.workspace import written
from .merge import bounded
from .search import emit, hit_schema, postings_of, probed_lists, scan_batches, search, small_block, spread_scan, within_lists
from .train import DEFAULT_TOLERANCE, training_rows

DEFAULT_PQ_DIM = 32
DEFAULT_PQ_BITS = 8
START_FACTOR = 4                # rows looked at per code for different ones to start from
LLOYD_ROUNDS = 25
DEFAULT_RERANK = 4      # exact distances for this many times k candidates


def check_pq(dimension: int | None, pq_dim: int, pq_bits: int) -> None:
    if pq_dim < 1 or not 1 <= pq_bits <= 15:
        raise ValueError("pq_dim must be positive and pq_bits between 1 and 15")
    if dimension and dimension % pq_dim:
        raise ValueError(f"dimension {dimension} is not divisible by pq_dim {pq_dim}")


def _prepared(x: np.ndarray, metric: str) -> np.ndarray:
    return unit_rows(x) if metric == COSINE else x


def train_codebooks(
    items: DataFrame,
    metric: str,
    n: int,
    dimension: int,
    pq_dim: int = DEFAULT_PQ_DIM,
    pq_bits: int = DEFAULT_PQ_BITS,
    rounds: int = LLOYD_ROUNDS,
    tolerance: float = DEFAULT_TOLERANCE,
    seed: int = 17,
    sample_rows: int | None = None,
    initial: np.ndarray | None = None,
) -> np.ndarray:
    """Codebooks of shape (pq_dim, codes, dimension / pq_dim), fitted on all rows or on ``sample_rows`` of them.

    All sub-spaces are fitted together, one job per Lloyd round, from ``initial``
    codebooks or the first different rows by hash. A code that no row has takes
    half of the code of greatest error in its sub-space, so that as many codes
    are in use as there are different rows, if the rounds suffice.
    """
    check_pq(dimension, pq_dim, pq_bits)
    codes, width = 1 << pq_bits, dimension // pq_dim
    rows = training_rows(items, metric, n, sample_rows, seed)
    if sample_rows is not None:
        rows = rows.persist()      # bounded; whole tables are read again in every round
    try:
        books = _first_books(rows, metric, pq_dim, codes, width, seed) if initial is None else initial.astype(np.float64)
        for _ in range(rounds if books.shape[1] else 0):
            moved, split = _lloyd_round(rows, books, metric)
            shift = float(np.max(np.sum((moved - books) ** 2, axis=2)))
            books = moved
            if shift <= tolerance ** 2 and not split:
                break
        return books
    finally:
        rows.unpersist()


def _first_books(rows: DataFrame, metric: str, pq_dim: int, codes: int, width: int, seed: int) -> np.ndarray:
    """The first different rows by hash; the last one again where they are too few, to be moved by splits."""
    start = rows.orderBy(F.xxhash64("id", F.lit(seed))).limit(START_FACTOR * codes).select("vector").toArrow()
    x = _prepared(matrix(start.column(0), pq_dim * width), metric)
    x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])[:codes]]
    if 0 < len(x) < codes:
        x = np.concatenate([x, np.repeat(x[-1:], codes - len(x), axis=0)])
    return x.reshape(len(x), pq_dim, width).transpose(1, 0, 2).copy()


def _code_sums(rows: DataFrame, books: np.ndarray, metric: str) -> DataFrame:
    """``(sub, code, n, off, square)`` of every task: rows of a code, and per dimension the sums of their
    differences from its centre and of the squares of these."""
    pq_dim, codes, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def partial(batches):
        book = shared.value
        off, square, count = np.zeros(book.shape), np.zeros(book.shape), np.zeros(book.shape[:2])
        for batch in batches:
            x = _prepared(matrix(batch.column(0), pq_dim * width), metric).reshape(-1, pq_dim, width)
            for s in range(pq_dim):
                near = np.einsum("ij,ij->i", book[s], book[s])[None, :] - 2.0 * (x[:, s] @ book[s].T)
                code = near.argmin(axis=1)
                count[s] += np.bincount(code, minlength=codes)
                gap = x[:, s] - book[s][code]
                for j in range(width):
                    off[s, :, j] += np.bincount(code, weights=gap[:, j], minlength=codes)
                    square[s, :, j] += np.bincount(code, weights=gap[:, j] ** 2, minlength=codes)
        s, c = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(count[s, c].astype(np.int64)),
             pa.array(list(off[s, c]), pa.list_(pa.float64())), pa.array(list(square[s, c]), pa.list_(pa.float64()))],
            names=["sub", "code", "n", "off", "square"])

    return rows.select("vector").mapInArrow(partial, "sub int, code int, n long, off array<double>, square array<double>")


def _lloyd_round(rows: DataFrame, books: np.ndarray, metric: str) -> tuple[np.ndarray, bool]:
    """The books moved to the means of their rows, and whether a code without rows was placed anew."""
    cells = _code_sums(rows, books, metric).select(
        "sub", "code", "n", F.posexplode(F.arrays_zip("off", "square")).alias("pos", "at"))
    table = cells.groupBy("sub", "code", "pos").agg(
        F.sum("n").alias("n"), F.sum("at.off").alias("off"), F.sum("at.square").alias("square")).toArrow()   # at most dimension x codes cells
    at = tuple(table.column(c).to_numpy() for c in ("sub", "code", "pos"))
    count, off, square = np.zeros(books.shape), np.zeros(books.shape), np.zeros(books.shape)
    for sums, name in ((count, "n"), (off, "off"), (square, "square")):
        sums[at] = table.column(name).to_numpy()
    held = np.maximum(count, 1)
    moved = books + off / held
    spread = np.maximum(square - off ** 2 / held, 0.0)      # squared error about the mean, by dimension
    done = [_split_codes(moved[s], count[s, :, 0], spread[s]) for s in range(len(books))]
    return moved, any(done)


def _split_codes(book: np.ndarray, count: np.ndarray, spread: np.ndarray) -> bool:
    """Place each code without rows beside a code of great error, one deviation to either side along its widest dimension.

    A code is split once a round, ties by number; codes whose rows are all alike are not.
    """
    error = spread.sum(axis=1)
    empty = np.nonzero(count == 0)[0]
    scale = np.finfo(np.float64).eps * np.maximum(count, 1) * np.maximum((book ** 2).sum(axis=1), 1.0)
    givers = [c for c in np.argsort(-error, kind="stable") if count[c] > 1 and error[c] > 64 * scale[c]][:len(empty)]
    for code, giver in zip(empty, givers):
        wide = int(spread[giver].argmax())
        step = np.sqrt(spread[giver, wide] / count[giver])
        book[code] = book[giver]
        book[code, wide] += step
        book[giver, wide] -= step
    return len(givers) > 0


def codebook_errors(rows: DataFrame, books: np.ndarray, metric: str) -> DataFrame:
    """``(sub, code, n, error)``: rows of each code in use and their summed squared distance from its centre."""
    sums = _code_sums(training_rows(rows, metric, 0, None, 0), books, metric)
    return sums.groupBy("sub", "code").agg(
        F.sum("n").alias("n"), F.sum(F.aggregate("square", F.lit(0.0), lambda total, x: total + x)).alias("error"))


def pq_codes(items: DataFrame, books: np.ndarray, metric: str) -> Column:
    """The nearest code in each sub-space; null for a null vector."""
    shared = items.sparkSession.sparkContext.broadcast(books)
    pq_dim, _, width = books.shape

    @F.arrow_udf(T.ArrayType(T.ShortType()))
    def encode(vectors: pa.Array) -> pa.Array:
        book = shared.value
        there = np.nonzero(vectors.is_valid().to_numpy(zero_copy_only=False))[0]
        x = _prepared(matrix(vectors.take(pa.array(there)), pq_dim * width), metric)
        codes = np.empty((len(x), pq_dim), dtype=np.int16)
        for s in range(pq_dim):
            part = np.ascontiguousarray(x[:, s * width:(s + 1) * width])
            codes[:, s] = nearest_rows(part, book[s], 1, SQUARED_EUCLIDEAN).id[:, 0].astype(np.int16)
        rows = [None] * len(vectors)
        for at, row in zip(there, codes):
            rows[at] = row.tolist()
        return pa.array(rows, pa.list_(pa.int16()))

    return encode.asNondeterministic()(F.col("vector"))


def pq_encode(items: DataFrame, books: np.ndarray, metric: str) -> DataFrame:
    return items.withColumn("codes", pq_codes(items, books, metric))


def codebook_frame(spark, books: np.ndarray) -> DataFrame:
    rows = [(s, c, books[s, c].tolist()) for s in range(books.shape[0]) for c in range(books.shape[1])]
    return spark.createDataFrame(rows, "sub int, code int, centroid array<double>")


def codebook_array(frame: DataFrame) -> np.ndarray:
    table = frame.orderBy("sub", "code").toArrow()     # pq_dim x codes rows
    subs = max(table.column("sub").to_pylist()) + 1
    return matrix(table.column("centroid")).reshape(subs, table.num_rows // subs, -1)


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The vectors that codes stand for."""
    return np.concatenate([books[s][codes[:, s]] for s in range(books.shape[0])], axis=1)


def scan_codes(books: np.ndarray):
    """A scan for ``search`` that reads codes instead of vectors and returns estimates.

    An item's estimate is the query's distance to the vector its codes stand
    for. Cosine estimates are half the squared distance of unit vectors.
    """
    pq_dim = books.shape[0]

    def scan(table: pa.Table, queries: DataFrame, items: DataFrame, stored: DataFrame, k: int, metric: str) -> DataFrame:
        vectors, postings = matrix(table.column("qv")), postings_of(table)
        shared = items.sparkSession.sparkContext.broadcast(
            (table.column("query_id").combine_chunks(), _prepared(vectors, metric), postings, books))
        columns = ["id", "codes"] + (["list_id"] if postings is not None else [])
        schema = hit_schema(queries, items)
        inner = SQUARED_EUCLIDEAN if metric == COSINE else metric

        def run(batches):
            query_ids, qv, posts, book = shared.value

            def decoded(batch):
                codes = matrix(batch.column(1), pq_dim).astype(np.int64)
                return decode(codes, book)

            top, id_type = scan_batches(batches, QueryBlock(qv, inner), k, posts, decoded)
            if metric == COSINE:
                top.d /= 2.0
            yield from emit(top, query_ids, id_type)

        source = items.where(F.col("codes").isNotNull()).select(*columns)
        return spread_scan(source, len(vectors), pq_dim, k).mapInArrow(run, schema)

    return scan


def exact_hits(candidates: DataFrame, queries: DataFrame, stored: DataFrame, k: int, metric: str,
               payload: tuple[str, ...] = ()) -> DataFrame:
    """The k best of each query's candidates ``(query_id, id)`` by exact distance.

    ``stored`` is read once, for the vectors and the payload together. The
    candidates, written before, are broadcast if they are few enough, the
    queries if their bytes are.
    """
    columns = dict.fromkeys(("id", "vector", *payload))
    pairs = stored.select(*columns).join(bounded(candidates.select("query_id", "id")), "id")
    pairs = pairs.join(small_block(queries.select("query_id", "qv")), "query_id")
    exact = distance(metric, to_double(F.col("qv")), to_double(F.col("vector")))
    best = Window.partitionBy("query_id").orderBy("distance", "id")
    hits = pairs.select("query_id", "id", exact.alias("distance"), *payload).withColumn("rank", F.row_number().over(best))
    return hits.where(F.col("rank") <= k).select("query_id", "rank", "id", "distance", *payload)


def pq_search(queries: DataFrame, items: DataFrame, books: np.ndarray, k: int, metric: str,
              payload: tuple[str, ...] = (), rerank: int | None = DEFAULT_RERANK) -> DataFrame:
    """Top k over codes: a scan of the codes, then one of the vectors for the best ``rerank`` x k of each query.

    ``rerank=None`` returns the estimates.
    """
    if not rerank:
        return search(queries, items, k, metric, payload, scan=scan_codes(books))
    candidates = written(search(queries, items, k * rerank, metric, scan=scan_codes(books)), "candidates")
    return exact_hits(candidates, queries, within_lists(items, probed_lists(queries)), k, metric, payload)
