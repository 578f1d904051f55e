"""Search of query sets beyond one block: cells in one job."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from vecspark.functions.blocks import exact_distance
from vecspark.operators import search, spread

ROWS, DIM, K = 700, 8, 5


@pytest.fixture(scope="module")
def items(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(ROWS, DIM)), 2)
    x[::3] = x[0]                                   # a third are copies of one vector
    rows = [(f"i{i:04d}", row.tolist(), -1 if i % 50 == 0 else 0 if i % 3 == 0 else int(i % 7)) for i, row in enumerate(x)]
    return spark.createDataFrame([*rows, ("none", None, 1)], "id string, vector array<double>, list_id int").cache()


def queries_of(spark, n):
    return spark.range(n).select(F.col("id").alias("query_id"), F.transform(F.sequence(F.lit(1), F.lit(DIM)), lambda j: F.round(
        F.sin(F.col("id") * j) + F.cos(F.col("id") + j), 2)).alias("qv"))


def expected(items, queries, k, metric, probing=False):
    held = sorted((r.id, r.vector, r.list_id) for r in items.collect() if r.vector is not None)
    x = np.array([v for _, v, _ in held])
    found = set()
    for q in queries.collect():
        d = exact_distance(np.repeat([q.qv], len(x), axis=0), x, metric)
        rows = [(a, i) for a, (i, _, l) in zip(d.tolist(), held) if not probing or l < 0 or l in q.probes]
        found |= {(q.query_id, n + 1, i, a) for n, (a, i) in enumerate(sorted(rows)[:k])}
    return found


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("bounds", [(1000, 1000), (40, 90), (1, 300)])
def test_cells_do_not_change_hits(spark, items, metric, bounds):
    queries = queries_of(spark, 90)
    rows = spread.spread_search(queries, items, K, metric, *bounds).collect()
    assert {tuple(r) for r in rows} == expected(items, queries, K, metric) and len(rows) == 90 * K


@pytest.mark.parametrize("bounds", [(1000, 1000), (20, 30)])
def test_lists(spark, items, bounds):
    probes = F.array(*[((F.col("query_id") * m) % 7).cast("int") for m in (0, 1, 3)])
    queries = queries_of(spark, 120).withColumn("probes", F.array_distinct(probes))
    rows = spread.spread_search(queries, items, K, "euclidean", *bounds).collect()
    assert {tuple(r) for r in rows} == expected(items, queries, K, "euclidean", probing=True)


def test_merge_rounds(spark, items, monkeypatch):
    monkeypatch.setattr(spread, "FAN", 2)
    queries = queries_of(spark, 30)
    assert {tuple(r) for r in spread.spread_search(queries, items, K, "euclidean", 10, 25).collect()} == expected(items, queries, K, "euclidean")


def test_odd_sides(spark, items):
    queries = queries_of(spark, 5)
    nothing = spread.spread_search(queries.limit(0), items, K)
    assert nothing.count() == 0 and nothing.columns == ["query_id", "rank", "id", "distance"]
    assert spread.spread_search(queries.withColumn("qv", F.lit(None).cast("array<double>")), items, K).count() == 0
    assert spread.spread_search(queries, items.limit(0), K).count() == 0
    twice = spread.spread_search(queries.where("query_id = 3").unionAll(queries.where("query_id = 4")), items, K, query_rows=1, item_rows=50)
    assert twice.groupBy("query_id").count().where("count <> 5").isEmpty()


def test_many_queries_stay_off_the_driver(spark, items, monkeypatch):
    """Fifty thousand queries: same hits as block by block, and no query is fetched."""
    queries = queries_of(spark, 50_000).where("query_id % 2 = 0")
    some = queries.where("query_id % 5000 = 0")
    fetched = []
    whole = type(queries).toArrow
    monkeypatch.setattr(type(queries), "toArrow", lambda self: fetched.append(self.columns) or whole(self))
    hits = search.search(queries, items, 3, payload=("list_id",)).cache()
    assert hits.count() == 75_000 and not fetched
    assert {tuple(r)[:4] for r in hits.where("query_id % 5000 = 0").collect()} == expected(items, some, 3, "euclidean")


def cells_seen(monkeypatch):
    """The frames of cells that searches write from here on."""
    seen, whole = [], spread.written
    monkeypatch.setattr(spread, "written", lambda df, purpose: seen.append((purpose, out := whole(df, purpose))) or out)
    return lambda purpose: [df for name, df in seen if name == purpose]


def test_small_bounds_do_not_multiply_copies(spark, items, monkeypatch):
    """However few rows a caller wants in a cell, each side is copied a bounded number of times."""
    seen = cells_seen(monkeypatch)
    queries = queries_of(spark, 90)
    assert spread.spread_search(queries, items, K, "euclidean", 1, 1).count() == 90 * K
    (cell,) = seen("cells")[0].collect()
    assert cell.parts == cell.blocks == spread.PIECES


def test_a_query_goes_once_to_the_lists_of_a_bin(spark, items, monkeypatch):
    """Forty lists, all probed: a query is sent to one bin, not to each list, and hits stay the same."""
    seen = cells_seen(monkeypatch)
    items = items.withColumn("list_id", F.when(F.col("list_id") < 0, F.col("list_id")).otherwise(F.pmod(F.hash("id"), F.lit(40))))
    queries = queries_of(spark, 60).withColumn("probes", F.sequence(F.lit(0), (F.col("query_id") % 40).cast("int")))
    rows = spread.spread_search(queries, items, K).collect()
    assert {tuple(r) for r in rows} == expected(items, queries, K, "euclidean", probing=True)
    assert seen("postings")[0].count() == 60


def test_cells_are_dealt_to_tasks_of_their_own(spark, items, monkeypatch):
    """Cells of few bytes are much work: they do not share a few tasks."""
    seen = []
    monkeypatch.setattr(spread, "merged", lambda hits, k, n: seen.append(hits) or hits)
    spread.spread_search(queries_of(spark, 300), items, K, query_rows=40, item_rows=40)
    per_task = seen[0].select("part", F.spark_partition_id().alias("task")).distinct().groupBy("task").count()
    assert per_task.count() > 20


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_a_cell_compares_its_queries_in_runs(metric):
    """Only a run of queries is ever held as doubles; how long runs are changes nothing."""
    rng = np.random.default_rng(3)
    n, width = 24_000, 64

    def side(key, vector, rows, **more):
        flat = pa.array(np.round(rng.normal(size=rows * width), 1).astype(np.float32))
        vectors = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), flat)
        return pa.table({key: pa.array([f"{i}" for i in range(rows)]), vector: vectors, **more})

    asked = side("query_id", "qv", n, lists=pa.array([[-1, i % 3] for i in range(n)], pa.list_(pa.int32())), bin=pa.array([4] * n), part=pa.array([1] * n))
    held = side("id", "vector", 60, list_id=pa.array([i % 4 - 1 for i in range(60)]))
    tracemalloc.start()
    hits = spread.cell_hits(asked, held, 3, metric, rows=1000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * width * 8 and hits.num_rows == 3 * n
    assert hits.combine_chunks().equals(spread.cell_hits(asked, held, 3, metric, rows=n).combine_chunks())


def test_hits_are_not_multiplied_by_parts(spark, items, monkeypatch):
    """With many queries there are blocks enough for all cores: items stay in one piece, and a query sends k hits, not k for each part."""
    seen = []
    whole = spread.merged
    monkeypatch.setattr(spread, "LEAST_ROWS", 16)
    monkeypatch.setattr(spread, "merged", lambda hits, k, n: seen.append((hits, n)) or whole(hits, k, n))
    queries = queries_of(spark, 400)
    rows = spread.spread_search(queries, items, 60).collect()
    assert {tuple(r) for r in rows} == expected(items, queries, 60, "euclidean")
    (hits, parts), = seen
    assert parts == 1 and hits.count() == 400 * 60 and hits.rdd.getNumPartitions() >= 8


def test_shape_moves_few_bytes():
    """Few queries leave the items in few copies; many hits a query leave it in one place; memory bounds both sides."""
    assert spread.shape(600_000, 600_000, 0, 256, 100, 20_000, 24) == (1, 30)
    pieces, blocks = spread.shape(20_000, 50_000_000, 0, 256, 10, 100_000, 24)
    assert blocks == 1 and pieces >= 48
    pieces, blocks = spread.shape(600_000, 160_000, 0, 256, 10, 100_000, 24)
    assert pieces * blocks >= 24 and pieces <= 3
    assert spread.shape(100, 100, 3.0, 256, 10, 1000, 24) == (1, 1)
    assert spread.shape(100, 0, 0, 256, 10, 1000, 24) == (1, 1)


@pytest.mark.parametrize("rows", [1, 40, 10_000])
@pytest.mark.parametrize("cut", [1, 7, 1000])
def test_items_stream_past_the_queries_of_a_cell(rows, cut):
    """However batches are cut, and with cells that have one side alone: the hits of each cell at once."""
    rng = np.random.default_rng(6)
    schema = pa.schema([("cell", pa.int32()), ("side", pa.int32()), ("part", pa.int32()), ("query_id", pa.int64()), ("id", pa.string()),
                        ("vector", pa.list_(pa.float32())), ("lists", pa.list_(pa.int32())), ("list_id", pa.int32())])
    made, asked, held = [], {}, {}
    for cell, (n, m) in enumerate([(5, 0), (30, 90), (0, 20), (12, 60)]):
        asked[cell] = [(cell, 0, cell, 100 * cell + i, None, np.round(rng.normal(size=4), 1).tolist(), [-1, i % 2], None) for i in range(n)]
        held[cell] = [(cell, 1, cell, None, f"i{i:03d}", np.round(rng.normal(size=4), 1).tolist(), None, i % 3 - 1) for i in range(m)]
        made += asked[cell] + held[cell]
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in made], schema)
    found = list(spread.stream_hits(table.to_batches(max_chunksize=cut), 4, "euclidean", rows))
    found = {(r["query_id"], r["id"], r["distance"], r["part"]) for r in pa.Table.from_batches(found).to_pylist()}
    expected_hits = set()
    for cell in (1, 3):
        for q in asked[cell]:
            own = [h for h in held[cell] if h[7] in q[6]]
            d = exact_distance(np.repeat([np.float32(q[5]).astype(float)], len(own), axis=0), np.float32([h[5] for h in own]).astype(float), "euclidean")
            expected_hits |= {(q[3], i, a, cell) for a, i in sorted((a, h[4]) for a, h in zip(d.tolist(), own))[:4]}
    assert found == expected_hits
