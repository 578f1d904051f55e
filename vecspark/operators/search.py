"""Nearest-neighbour search: exact, inverted-list and greedy probing.

Shapes: queries are ``(query_id, qv)``, items ``(id, vector[, list_id, ...])``,
hits ``(query_id, rank, id, distance, ...)``. A smaller distance is a better
hit, equal distances are ordered by id.

One scan takes a block of queries whose size is checked; the block is
broadcast, every task keeps only its running top k per query, and one shuffle
on ``query_id`` merges the tasks. Items are never shuffled or paired up in the
plan. Query sets beyond one block are never brought to the driver: queries and
items meet in bounded cells, in one job (see ``spread``). Only scans over codes
run such sets block after block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.blocks import CELLS, QueryBlock, TopK, by_list, matrix, nearest_rows
from ..functions.distance import check_metric
from ..plans.workspace import SMALL_SPLIT, plan_bytes, scratch_path, spread_small, written
from .merge import bounded
from .spread import spread_search

DEFAULT_TOP_K = 100
MAX_QUERY_ROWS = 1 << 14       # queries per block
MAX_QUERY_BYTES = 64 << 20     # bytes of one broadcast query block
MAX_HITS = 1 << 20             # queries x k held per task and broadcast for payload
MAX_POSTINGS = 1 << 22         # queries x probes per block
MAX_TASK_HITS = 1 << 30        # hits all tasks of a scan may send to the merge
MAX_MERGED_HITS = 1 << 22      # hits of one query that the merge sorts in one task
NAMED_LISTS = 10_000           # list ids named in a partition filter; more are joined, which prunes as well
EMIT_ROWS = 10_000
REACH_STEPS = 1024             # per radius of the nearest list, see ``list_steps``
MOST_STEPS = 1 << 16           # anything further off counts as this far


def rank_hits(hits: DataFrame, k: int) -> DataFrame:
    """Keep the k nearest per query and number them from 1."""
    window = Window.partitionBy("query_id").orderBy("distance", "id")
    ranked = hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "distance")


def search(
    queries: DataFrame,
    items: DataFrame,
    k: int = DEFAULT_TOP_K,
    metric: str = "euclidean",
    payload: tuple[str, ...] = (),
    scan=None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Top k per query.

    With an array column ``probes`` in ``queries`` only items whose ``list_id``
    is probed (or negative: not in any list) are compared. A query without a
    vector has no hits. ``payload`` names
    item columns to attach to the hits. ``scan`` replaces the distance scan
    (see ``pq``). ``stored`` is the frame to fetch payload from when ``items``
    is a costly filter over it.
    """
    check_metric(metric)
    if k < 1:
        raise ValueError("top_k must be at least 1")
    stored = items if stored is None else stored
    probing = "probes" in queries.columns
    queries = queries.where(F.col("qv").isNotNull()).select("query_id", "qv", *(["probes"] if probing else []))
    most, block = _one_block(queries, k, probing)
    if block is not None and block.num_rows == 0:
        return _with_payload(_no_hits(queries, items), stored, payload)

    def run(table: pa.Table) -> DataFrame:
        return _search_block(table, queries, items, stored, k, metric, payload, scan or scan_block)

    if block is not None:
        return run(block)
    if scan is not None:
        return _search_blocks(queries, most, run)
    hits = spread_search(queries, items, k, metric)
    return _with_any_payload(hits, stored, payload)


def _one_block(queries: DataFrame, k: int, probing: bool) -> tuple[int, pa.Table | None]:
    """Rows that a block may have, and the queries if they are one; judged by counts alone, before any is fetched."""
    spread = F.max(F.size("probes")) if probing else F.lit(1)
    known = queries.limit(MAX_QUERY_ROWS + 1).agg(F.count("*").alias("n"), F.max(F.size("qv")).alias("width"), spread.alias("spread")).first()
    most = min(MAX_QUERY_ROWS, MAX_HITS // k, MAX_QUERY_BYTES // (8 * max(known["width"] or 1, 1)), MAX_POSTINGS // max(known["spread"] or 1, 1))
    most = max(1, most)
    if known["n"] > most:
        return most, None
    table = queries.limit(most + 1).toArrow()
    return most, table if table.num_rows <= most else None


def small_block(queries: DataFrame) -> DataFrame:
    """Mark queries for broadcast when they are within the bytes and rows of one block, counted first."""
    known = queries.limit(MAX_QUERY_ROWS + 1).agg(F.count("*").alias("n"), F.max(F.size("qv")).alias("width")).first()
    few = known["n"] <= MAX_QUERY_ROWS and 8 * known["n"] * max(known["width"] or 1, 1) <= MAX_QUERY_BYTES
    return F.broadcast(queries) if few else queries


def _search_blocks(queries: DataFrame, most: int, run) -> DataFrame:
    """One scan per block of queries, each result kept in the shared folder."""
    spark = queries.sparkSession
    source, target = scratch_path(spark, "queries"), scratch_path(spark, "hits")
    rows = queries.count()
    n_blocks = math.ceil(rows / most)
    dealt = queries.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(n_blocks)))
    dealt.write.partitionBy("block").parquet(source)
    written = 0
    for number in range(n_blocks):
        block = spark.read.schema(dealt.schema).parquet(source).where(F.col("block") == number)
        table = block.drop("block").toArrow()
        for start in range(0, table.num_rows, most):
            run(table.slice(start, most)).write.parquet(f"{target}/part={written}")
            written += 1
    return spark.read.parquet(target).drop("part")


def _search_block(table, queries, items, stored, k, metric, payload, scan) -> DataFrame:
    if "probes" in queries.columns:
        lists = sorted({p for row in table.column("probes").to_pylist() for p in row})
        items, stored = (only_lists(rows, lists) for rows in (items, stored))
    hits = rank_hits(scan(table, queries, items, stored, k, metric), k)
    return _with_payload(hits, stored, payload)


def only_lists(rows: DataFrame, lists: list[int]) -> DataFrame:
    """Rows of the given lists and those in no list; files of other lists are not read."""
    if len(lists) <= NAMED_LISTS:
        return rows.where((F.col("list_id") < 0) | F.col("list_id").isin(lists))
    named = rows.sparkSession.createDataFrame([(x,) for x in {-1, *lists}], "list_id int")      # MAX_POSTINGS at most
    return rows.join(F.broadcast(named), "list_id", "left_semi").select(rows.columns)


def probed_lists(queries: DataFrame) -> list[int] | None:
    """The lists that any of the queries probes; None without probes or with more than can be named in a filter."""
    if "probes" not in queries.columns:
        return None
    found = queries.select(F.explode("probes").alias("list_id")).distinct().limit(NAMED_LISTS + 1).collect()
    return [r.list_id for r in found] if len(found) <= NAMED_LISTS else None


def within_lists(rows: DataFrame, lists: list[int] | None) -> DataFrame:
    return rows if lists is None else only_lists(rows, lists)


def _no_hits(queries: DataFrame, items: DataFrame) -> DataFrame:
    empty = queries.where(F.lit(False)).select(
        "query_id", F.lit(1).alias("rank"), F.lit("").cast(items.schema["id"].dataType).alias("id"),
        F.lit(0.0).alias("distance"))
    return empty


def _with_payload(hits: DataFrame, items: DataFrame, payload) -> DataFrame:
    """Attach item columns to the hits of one block (at most MAX_HITS rows, so broadcast)."""
    if not payload:
        return hits
    side = items.select("id", *payload)
    return side.join(F.broadcast(hits), "id").select("query_id", "rank", "id", "distance", *payload)


def _with_any_payload(hits: DataFrame, items: DataFrame, payload) -> DataFrame:
    """Attach item columns to hits of any number, written first: they are counted before the join."""
    if not payload:
        return hits
    return items.select("id", *payload).join(bounded(written(hits, "hits")), "id").select("query_id", "rank", "id", "distance", *payload)


def hit_schema(queries: DataFrame, items: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", items.schema["id"].dataType),
        T.StructField("distance", T.DoubleType()),
    ])


def postings_of(table: pa.Table):
    """List id -> positions of the queries that probe it; None when there are no probes."""
    if "probes" not in table.column_names:
        return None
    probes = table.column("probes").combine_chunks()
    counts = np.array([len(p) for p in probes])
    lists = probes.flatten().to_numpy(zero_copy_only=False)
    who = np.repeat(np.arange(len(probes)), counts)
    return {value: np.sort(who[rows]) for value, rows in by_list(lists)}


def scan_batches(batches, block: QueryBlock, k: int, postings, vectors_of):
    """Offer item batches ``(id, ..., [list_id])`` to the block; (running top k, id type)."""
    top, everyone, id_type = TopK(len(block), k), np.arange(len(block)), pa.string()
    for batch in batches:
        ids, x = batch.column(0), vectors_of(batch)
        id_type = ids.type
        if postings is None:
            block.offer(top, everyone, x, ids)
            continue
        for value, rows in by_list(batch.column(2).to_numpy(zero_copy_only=False)):
            who = everyone if value < 0 else postings.get(value)
            if who is not None:
                block.offer(top, who, x[rows], ids.take(pa.array(rows)))
    return top, id_type


def emit(top: TopK, query_ids: pa.Array, id_type: pa.DataType):
    """What is held, as Arrow batches ``(query_id, id, distance)``."""
    schema = pa.schema([("query_id", query_ids.type), ("id", id_type), ("distance", pa.float64())])
    q, ids, d = top.entries()
    for at in range(0, len(q), EMIT_ROWS):
        part = slice(at, at + EMIT_ROWS)
        yield pa.RecordBatch.from_arrays(
            [query_ids.take(pa.array(q[part])), pa.array(ids[part].tolist(), id_type), pa.array(d[part])], schema=schema)


def spread_scan(items: DataFrame, n_queries: int, width: int, k: int) -> DataFrame:
    """Fit the number of scan tasks to the work.

    A small file is one split, so heavy work on it is spread first; a huge
    scan gets fewer, longer tasks, since each sends up to queries x k hits.
    """
    cores = items.sparkSession.sparkContext.defaultParallelism
    size = plan_bytes(items)
    work = size / 8.0 * n_queries
    if work > 4e9 and size < cores * SMALL_SPLIT:
        return items.repartition(cores)
    return items.coalesce(max(4 * cores, min(MAX_TASK_HITS // (n_queries * k), MAX_MERGED_HITS // k)))


def scan_block(table: pa.Table, queries: DataFrame, items: DataFrame, stored: DataFrame, k: int, metric: str) -> DataFrame:
    """Running top k per query and task over the streamed items."""
    spark = items.sparkSession
    vectors = matrix(table.column("qv"))
    postings = postings_of(table)
    shared = spark.sparkContext.broadcast((table.column("query_id").combine_chunks(), vectors, postings))
    width, n_queries = vectors.shape[1], len(vectors)
    schema = hit_schema(queries, items)
    columns = ["id", "vector"] + (["list_id"] if postings is not None else [])

    def run(batches):
        query_ids, qv, posts = shared.value
        top, id_type = scan_batches(batches, QueryBlock(qv, metric), k, posts, lambda b: matrix(b.column(1), width))
        yield from emit(top, query_ids, id_type)

    source = items.where(F.col("vector").isNotNull()).select(*columns)
    return spread_scan(source, n_queries, width, k).mapInArrow(run, schema)


def probe_lists(
    queries: DataFrame,
    centroids: np.ndarray,
    metric: str,
    n_probes: int | None = None,
    sizes: np.ndarray | None = None,
    k: int | None = None,
    radii: np.ndarray | None = None,
    reach: int | None = None,
) -> DataFrame:
    """Add ``probes``: the nearest lists per query, nearest first.

    Either a fixed ``n_probes``, or (greedy) as many lists as it takes until
    their running ``sizes`` reach ``k``, or (adaptive) the lists that are at
    most ``reach`` steps further off than the nearest (see ``list_steps``): a
    query deep inside a list reads few, one between lists reads many.
    """
    n_lists = len(centroids)
    want = n_lists if n_probes is None else max(1, min(n_probes, n_lists))
    shared = queries.sparkSession.sparkContext.broadcast((centroids, sizes, radii))
    step = max(1, CELLS // want)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest_lists(vectors: pa.Array) -> pa.Array:
        near, held, radius = shared.value
        x, rows = matrix(vectors, near.shape[1]), []
        for at in range(0, len(x), step):
            top = nearest_rows(x[at:at + step], near, want, metric)
            chosen = top.id.astype(np.int32)
            if held is not None:
                before = np.cumsum(held[chosen], axis=1) - held[chosen]
                chosen = [row[b < k] for row, b in zip(chosen, before)]
            elif radius is not None:
                chosen = [row[off <= reach] for row, off in zip(chosen, steps_off(top.d, radius[chosen[:, 0]]))]
            rows.extend(row.tolist() for row in chosen)
        return pa.array(rows, pa.list_(pa.int32()))

    queries = spread_small(queries.where(F.col("qv").isNotNull()))
    return queries.select("query_id", "qv", nearest_lists.asNondeterministic()("qv").alias("probes"))


def steps_off(d: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Distances of lists, nearest first in a row, as steps beyond the nearest: 1,024 make the radius of that one.

    Where distances are not finite nothing can be told, so that the list counts as near.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        off = np.ceil(REACH_STEPS * (d - d[:, :1]) / radius[:, None])
    return np.minimum(np.nan_to_num(off, nan=0.0, posinf=MOST_STEPS), MOST_STEPS).astype(np.int32)


def list_steps(queries: DataFrame, centroids: np.ndarray, metric: str, radii: np.ndarray) -> DataFrame:
    """``(query_id, list_id, step)``: how much further off than the nearest list each list is.

    The excess of its centroid's distance is measured by the radius of the
    nearest list: the neighbours of a query in a tight list are near as well,
    those in a wide one are further off. A query without a vector has no rows.
    """
    shared = queries.sparkSession.sparkContext.broadcast((centroids, radii))
    part = max(1, CELLS // len(centroids))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def steps(vectors: pa.Array) -> pa.Array:
        near, radius = shared.value
        x, rows = matrix(vectors, near.shape[1]), []
        for at in range(0, len(x), part):
            top = nearest_rows(x[at:at + part], near, len(near), metric)
            lists = top.id.astype(np.int64)
            off = np.empty(lists.shape, dtype=np.int32)
            np.put_along_axis(off, lists, steps_off(top.d, radius[lists[:, 0]]), axis=1)
            rows.extend(off.tolist())
        return pa.array(rows, pa.list_(pa.int32()))

    queries = queries.where(F.col("qv").isNotNull()).select("query_id", steps.asNondeterministic()("qv").alias("steps"))
    return queries.select("query_id", F.posexplode("steps").alias("list_id", "step"))


def nest_hits(hits: DataFrame) -> DataFrame:
    """One row per query with its hits as an array in rank order."""
    fields = [c for c in hits.columns if c != "query_id"]
    ordered = ["rank"] + [c for c in fields if c != "rank"]
    return hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct(*ordered)), lambda a, b: a["rank"] - b["rank"]).alias("hits"))


def only_included(hits: DataFrame, include, known=("distance", "metadata", "vector", "contents", "is_text")) -> DataFrame:
    """``query_id, rank, id`` plus the included columns; unknown names are ignored."""
    return hits.select("query_id", "rank", "id", *[c for c in known if c in include and c in hits.columns])
