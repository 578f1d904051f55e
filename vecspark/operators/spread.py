"""Search for any number of queries in one job: nothing of the query side passes the driver.

Queries and items meet in cells. Lists (one holds everything where there are no
probes) are put together in bins; a query is sent once to each bin in which it
probes lists, an item to the bin of its list. A bin is cut into parts of its
items and blocks of its queries, by hashes and by counts that Spark takes first;
a cell is a part and a block of one bin. Each part copies the queries, and their
hits, and each block the items, so bins, parts and blocks are chosen to move the
fewest bytes that give all cores work (see ``shape``). A cell is a task: its
queries come first and are held, with their top k, then its items stream past in
the order of their ids, a chunk at a time, so that its memory is bounded by the
block and the chunk. It sends its k best per query; these are merged in rounds
of at most ``FAN`` cells a query and task. Equal distances are ordered by id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.blocks import QueryBlock, TopK, by_list, matrix, stored_matrix
from ..functions.distance import check_metric
from ..plans.workspace import written
from .merge import bounded

ITEM_BYTES = 32 << 20       # of vectors that a cell compares at a time
QUERY_BYTES = 32 << 20      # of vectors of a cell's queries
CELL_HITS = 1 << 21         # queries x k of a cell
CELL_ITEMS = 1 << 20        # items of a cell, whose ids it holds
RUN_ROWS = 1 << 13          # queries of a cell that are compared at a time
PIECES = 8                  # parts, and blocks, that the wish for small cells may cut one list into; with several lists fewer of each
LEAST_ROWS = 1 << 12        # of a cell's sides, unless the caller wishes for fewer
BIN_ROWS = 1 << 13          # items of the lists that are put together in a bin
CELLS_PER_CORE = 2
HIT_BYTES = 20              # of a hit on its way to the merge
GROUP_ROWS = 1 << 12        # items of short lists, or so many times k, that are compared at once,
GROUP_FACTOR = 256
GROUP_SHARE = 8             # if this share of the pairs is asked for
MAX_TASKS = 1 << 12
EMIT_ROWS = 1 << 14
FAN = 256                   # cells whose hits of one query are merged at a time
EVERYWHERE = -1             # list of the items in no list; every query looks at them


def shape(asked: int, held: int, probed: float, row_bytes: int, k: int, most: int, cells: int) -> tuple[int, int]:
    """``(pieces, blocks)``: into how many pieces the items, and blocks the queries of a piece, are best cut.

    ``probed`` lists a query has on average: a query goes to no more pieces than that. Of the cuts that
    make as many ``cells`` as the rows have work for, the one that moves the fewest bytes.
    """
    least_blocks, least_pieces = -(-asked // most), -(-held // CELL_ITEMS)
    most_blocks, most_pieces = max(least_blocks, -(-asked // LEAST_ROWS)), max(least_pieces, -(-held // LEAST_ROWS))
    cells = min(cells, most_blocks * most_pieces)
    best = None
    for pieces in range(max(1, least_pieces), max(1, least_pieces, min(most_pieces, cells)) + 1):
        blocks = max(1, least_blocks, min(most_blocks, -(-cells // pieces)))
        if blocks * pieces < cells and pieces < most_pieces:
            continue
        seen = pieces * (1 - (1 - 1 / pieces) ** probed) if probed else pieces
        moved = asked * seen * (row_bytes + (k * HIT_BYTES if pieces > 1 else 0)) + held * blocks * row_bytes
        if best is None or moved < best[0]:
            best = moved, pieces, blocks
    return best[1:]


def bins_of(counts: DataFrame, size: int, parts, apart: bool) -> DataFrame:
    """``list_id, bin, parts``: the lists of ``counts`` in bins of about ``size`` items; a row for each list.

    Lists in order fill one bin after the other; one of many parts, or each if they are kept ``apart``, has a bin to itself.
    """
    order = Window.orderBy("list_id").rowsBetween(Window.unboundedPreceding, -1)      # a row for each list
    before = F.coalesce(F.sum(F.when(F.col("parts") == 1, F.col("held"))).over(order), F.lit(0))
    binned = counts.withColumn("parts", parts).withColumn("before", before)
    alone = (F.col("parts") > 1) | F.lit(apart)
    binned = binned.select("list_id", F.when(alone, F.struct(F.lit(1).alias("alone"), F.col("list_id").cast("long").alias("at")))
                         .otherwise(F.struct(F.lit(0).alias("alone"), F.floor(F.col("before") / size).alias("at"))).alias("place"), "parts")
    return written(binned.select("list_id", F.dense_rank().over(Window.orderBy("place")).alias("bin"), "parts"), "bins")


def pieces(rows, wish: int, most: int, lists: int):
    """Into how many pieces of ``wish`` rows a list is cut: as many as its share of ``PIECES`` allows, or as ``most`` rows a piece demand."""
    share = max(1, math.ceil(PIECES / math.sqrt(max(lists, 1))))
    return F.greatest(F.ceil(rows / most), F.least(F.ceil(rows / wish), F.lit(share))).cast("int")


def spread_search(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str = "euclidean",
    query_rows: int | None = None,
    item_rows: int | None = None,
) -> DataFrame:
    """``query_id, rank, id, distance``: the top k of each query ``(query_id, qv[, probes])``.

    ``query_rows`` and ``item_rows`` are wishes for the rows of a cell, heard as
    long as they cut a list into few pieces, since each piece more copies all
    rows of the other side.
    """
    check_metric(metric)
    spark = items.sparkSession
    probing = "probes" in queries.columns
    queries = queries.where(F.col("qv").isNotNull())
    items = items.where(F.col("vector").isNotNull()).select("id", "vector", F.col("list_id") if probing else F.lit(0).alias("list_id"))
    probes = F.array_distinct(F.concat(F.array(F.lit(EVERYWHERE)), F.col("probes"))) if probing else F.array(F.lit(0))
    if probing:
        items = items.withColumn("list_id", F.greatest("list_id", F.lit(EVERYWHERE)))
    # read again by the counts and by the cells
    queries = written(queries.select("query_id", "qv", probes.alias("probes")), "queries")
    known = queries.agg(F.max(F.size("qv")).alias("width"), F.count("*").alias("n")).first()
    width, asked = known["width"], known["n"]
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("id", items.schema["id"].dataType),
        T.StructField("distance", T.DoubleType()), T.StructField("part", T.IntegerType())])
    if width is None:
        return spark.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "id", "distance")
    kind = _vector_type(queries.schema["qv"].dataType, items.schema["vector"].dataType)
    row_bytes = max(width, 1) * (4 if kind == "array<float>" else 8)
    most = max(1, min(QUERY_BYTES // row_bytes, CELL_HITS // k))
    wanted = queries.select(F.explode("probes").alias("list_id")).groupBy("list_id").agg(F.count("*").alias("asked"))
    counts = written(items.groupBy("list_id").agg(F.count("*").alias("held")).join(wanted, "list_id"), "counts")
    known = counts.agg(F.count("*").alias("lists"), F.sum("held").alias("held"), F.sum("asked").alias("asked")).first()
    n_lists, held = known["lists"], known["held"] or 0
    if item_rows or query_rows:
        wish, room = item_rows or LEAST_ROWS, max(1, ITEM_BYTES // row_bytes)
        size, apart = min(room, max(BIN_ROWS, -(-held // PIECES))), n_lists <= PIECES
        parts = pieces(F.col("held"), wish, room, n_lists)
    else:
        cells = CELLS_PER_CORE * spark.sparkContext.defaultParallelism
        n_pieces, n_blocks = shape(asked, held, (known["asked"] or 0) / asked if probing else 0, row_bytes, k, most, cells)
        size, apart = max(1, -(-held // n_pieces)), False
        parts = F.ceil(F.col("held") / size).cast("int")
    lists = bins_of(counts, size, parts, apart)
    # a query once for each bin, with its lists there
    bins = _bins(lists)
    per_bin = written(queries.select(F.explode(bins(F.col("probes"))["bin"]).alias("bin")), "postings").groupBy("bin").agg(F.count("*").alias("asked"))
    n_bins = lists.agg(F.count_distinct("bin")).first()[0]
    if item_rows or query_rows:
        blocks = pieces(F.col("asked"), query_rows or LEAST_ROWS, most, n_bins)
    else:
        blocks = F.greatest(F.ceil(F.col("asked") / most), F.least(F.ceil(F.col("asked") / LEAST_ROWS), F.lit(n_blocks))).cast("int")
    cells = lists.groupBy("bin").agg(F.max("parts").alias("parts")).join(per_bin, "bin").select("bin", "parts", blocks.alias("blocks"))
    # numbers of the cells of a bin begin at "first"
    so_far = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)         # a row for each bin
    cells = written(cells.withColumn("first", F.coalesce(F.sum(F.col("parts") * F.col("blocks")).over(so_far), F.lit(0)).cast("int")), "cells")
    cell = (F.col("first") + F.col("part") * F.col("blocks") + F.col("block")).alias("cell")
    nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in (*schema.fields, T.StructField("lists", T.ArrayType(T.IntegerType())))}
    left = queries.select("query_id", F.col("qv").cast(kind).alias("vector"), F.explode(bins(F.col("probes"))).alias("to")).select(
        "query_id", "vector", "to.bin", "to.lists").join(bounded(cells), "bin").select(
        "*", F.pmod(F.xxhash64("query_id", "vector"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = items.withColumn("vector", F.col("vector").cast(kind)).join(bounded(lists.select("list_id", "bin")), "list_id").join(bounded(cells), "bin").select(
        "*", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    number = F.pmod(F.col("bin") * 31 + F.col("part"), F.lit(0x7FFFFFFF)).cast("int").alias("part")
    rows = left.select(cell, F.lit(0).alias("side"), number, "query_id", nothing["id"], "vector", "lists", F.lit(None).cast("int").alias("list_id")).unionAll(
        right.select(cell, F.lit(1).alias("side"), number, nothing["query_id"], "id", "vector", nothing["lists"], "list_id"))

    def meet(batches):
        return stream_hits(batches, k, metric, ITEM_BYTES // row_bytes)

    known = cells.agg(F.sum("parts").alias("parts"), F.sum(F.col("parts") * F.col("blocks")).alias("cells")).first()
    # a task for each cell: by hashes of few cells some tasks would get several
    n_tasks = max(1, min(known["cells"] or 0, MAX_TASKS))
    rows = rows.repartitionById(n_tasks, F.col("cell")).sortWithinPartitions("cell", "side", F.asc_nulls_last("id"))
    return merged(rows.mapInArrow(meet, schema), k, known["parts"] or 0)


def _vector_type(*kinds) -> str:
    """Single precision where both sides have it, which is half as many bytes to move."""
    return "array<float>" if all(isinstance(kind.elementType, T.FloatType) for kind in kinds) else "array<double>"


def stream_hits(batches, k: int, metric: str, rows: int):
    """Hits of the cells of a task, whose rows are in order: of each cell the queries first, then the items by their ids."""
    current, cell, chunk, held = None, None, [], 0
    for batch in batches:
        number, side = (batch.column(i).to_numpy() for i in (0, 1))
        at = 0
        while at < len(number):
            # the rows of one side of a cell that follow each other
            more = np.flatnonzero((number[at:] != number[at]) | (side[at:] != side[at]))
            end = at + int(more[0]) if len(more) else len(number)
            if (number[at], side[at]) != current:
                if current is not None and number[at] != current[0]:
                    yield from _finished(cell, chunk)
                    cell, chunk, held = None, [], 0
                elif chunk:
                    cell, chunk, held = Cell(pa.Table.from_batches(chunk), k, metric), [], 0
                current = (number[at], side[at])
            chunk.append(batch.slice(at, end - at))
            held += end - at
            if side[at] and cell is not None and held >= rows:
                cell.offer(pa.Table.from_batches(chunk))
                chunk, held = [], 0
            elif side[at] and cell is None:
                chunk, held = [], 0             # items that nobody asks for
            at = end
    yield from _finished(cell, chunk)


def _finished(cell, chunk: list):
    if cell is not None:
        if chunk:
            cell.offer(pa.Table.from_batches(chunk))
        yield from cell.hits()


def cell_hits(asked: pa.Table, held: pa.Table, k: int, metric: str, rows: int = RUN_ROWS) -> pa.Table:
    """``query_id, id, distance, part``: the k best of a cell for each of its queries, ``rows`` of which are compared at a time."""
    schema = pa.schema([("query_id", asked.column("query_id").type), ("id", held.column("id").type), ("distance", pa.float64()), ("part", pa.int32())])
    if not asked.num_rows or not held.num_rows:
        return schema.empty_table()
    cell = Cell(asked.rename_columns(["vector" if name == "qv" else name for name in asked.column_names]), k, metric, rows)
    cell.offer(held.sort_by("id"))
    return pa.Table.from_batches(cell.hits(), schema)


class Cell:
    """The queries of a cell and the k best of the items that it was offered, which come in the order of their ids.

    Only a run of queries, and the items offered to them at once, are ever widened
    to doubles. Items are known by their place, so that of all that were offered ids alone are held.
    """

    def __init__(self, asked: pa.Table, k: int, metric: str, rows: int = RUN_ROWS):
        self.metric, self.k = metric, k
        self.width = pc.max(pc.list_value_length(asked.column("vector"))).as_py()
        self.part = asked.column("part")[0].as_py() & 0x7FFFFFFF
        self.runs = [asked.slice(at, rows).select(["query_id", "vector", "lists"]) for at in range(0, asked.num_rows, rows)]
        self.tops = [TopK(run.num_rows, k, numbers=True) for run in self.runs]
        self.ids, self.seen = [], 0

    def offer(self, held: pa.Table) -> None:
        ids, x = held.column("id").combine_chunks(), stored_matrix(held.column("vector"), self.width)
        own_lists = list(by_list(held.column("list_id").to_numpy()))
        for run, top in zip(self.runs, self.tops):
            _offer_run(run, top, x, self.seen, own_lists, self.width, self.metric)
        self.ids.append(ids)
        self.seen += len(ids)

    def hits(self):
        """Batches ``(query_id, id, distance, part)`` of what is held."""
        if not self.ids:
            return
        ids = pa.chunked_array(self.ids)
        for run, top in zip(self.runs, self.tops):
            q, item, d = top.entries()
            query_id = run.column("query_id").combine_chunks()
            for at in range(0, len(q), EMIT_ROWS):
                some = slice(at, at + EMIT_ROWS)
                yield pa.RecordBatch.from_arrays([
                    query_id.take(pa.array(q[some])), ids.take(pa.array(item[some])).combine_chunks(), pa.array(d[some]),
                    pa.array(np.full(len(q[some]), self.part, dtype=np.int32))], names=["query_id", "id", "distance", "part"])


def _offer_run(asked: pa.Table, top: TopK, x: np.ndarray, first: int, own_lists: list, width: int, metric: str) -> None:
    """Offer each query of a run the items of its lists, which are numbered from ``first``."""
    block = QueryBlock(matrix(asked.column("vector"), width), metric)
    lists = asked.column("lists").combine_chunks()
    who = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    asking = {value: np.sort(who[at]) for value, at in by_list(lists.flatten().to_numpy(zero_copy_only=False))}
    nobody = np.zeros(0, dtype=np.int64)
    for group in _groups([(asking.get(value, nobody), rows) for value, rows in own_lists], max(GROUP_ROWS, GROUP_FACTOR * top.k)):
        rows = np.concatenate([own for _, own in group])
        anyone = np.unique(np.concatenate([some for some, _ in group]))
        wanted = sum(len(some) * len(own) for some, own in group)
        if len(group) > 1 and wanted * GROUP_SHARE > len(anyone) * len(rows):
            asks = np.zeros((len(block), len(group)), dtype=bool)
            for i, (some, _) in enumerate(group):
                asks[some, i] = True
            block.offer(top, anyone, x[rows], first + rows, np.repeat(np.arange(len(group)), [len(own) for _, own in group]), asks)
            continue
        for some, own in group:
            if len(some):
                block.offer(top, some, x[own] if len(own) < len(x) else x, first + own)


def _groups(lists: list, rows: int):
    """Lists ``(queries, items)`` in runs of about ``rows`` items."""
    run, held = [], 0
    for some, own in lists:
        if run and held + len(own) > rows:
            yield run
            run, held = [], 0
        run.append((some, own))
        held += len(own)
    if run:
        yield run


def _bins(lists: DataFrame):
    """A function from the lists of a query to the bins that hold them, each with those of the lists that are there."""
    table = sorted(tuple(r) for r in lists.select("list_id", "bin").collect())        # a row for each list, as of the centroids
    shared = lists.sparkSession.sparkContext.broadcast(tuple(np.array([r[i] for r in table], dtype=np.int64) for i in (0, 1)))
    kind = T.ArrayType(T.StructType([T.StructField("bin", T.IntegerType()), T.StructField("lists", T.ArrayType(T.IntegerType()))]))

    @F.arrow_udf(kind)
    def bins(probes: pa.Array) -> pa.Array:
        known, numbers = shared.value
        value = probes.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(probes)), probes.value_lengths().to_numpy(zero_copy_only=False))
        at = np.searchsorted(known, value)
        there = known[np.minimum(at, len(known) - 1)] == value if len(known) else np.zeros(len(value), dtype=bool)
        value, row, own = value[there], row[there], numbers[at[there]]
        order = np.lexsort((value, own, row))
        value, row, own = value[order], row[order], own[order]
        first = np.ones(len(row), dtype=bool)
        first[1:] = (row[1:] != row[:-1]) | (own[1:] != own[:-1])
        start = np.append(np.flatnonzero(first), len(row)).astype(np.int32)
        inner = pa.ListArray.from_arrays(pa.array(start), pa.array(value, pa.int32()))
        pairs = pa.StructArray.from_arrays([pa.array(own[first], pa.int32()), inner], ["bin", "lists"])
        ends = np.searchsorted(row[first], np.arange(len(probes) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pairs)

    return bins.asNondeterministic()


def merged(hits: DataFrame, k: int, n_cells: int) -> DataFrame:
    """The k best of each query out of the hits of its cells, numbered from 1."""
    spread = -(-n_cells // FAN)
    while spread > 1:
        window = Window.partitionBy("query_id", "part").orderBy("distance", "id")
        hits = hits.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(spread)).cast("int"))
        hits = hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).drop("rank")
        spread = -(-spread // FAN)
    window = Window.partitionBy("query_id").orderBy("distance", "id")
    ranked = hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "distance")
