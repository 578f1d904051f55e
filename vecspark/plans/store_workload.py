"""Registered queries over stored collections, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import distance, embed
from ..functions.filters import compile_filter
from ..operators import evaluate, search
from ..streaming.streams import upsert_stream
from .collection import VectorStore
from .text_store import TextStore
from .workload import (DIGITS, FILTERS, K, KEY, TEXT_DIM, _collection, _faulty_items, _read, _stream_of, _upsert_batch, document_rows,
                       embedding_items, embedding_queries, tagged_items)
from .workspace import scratch_path, written

LISTS = 16
WANTED = 60          # more than many a filter leaves in the nearest lists


def _strict(spark):
    """An empty collection of known dimension."""
    return VectorStore(spark, scratch_path(spark, "store")).create("strict", KEY, {"type": "ivfflat", "dimension": 64})


def _error_counts(rows):
    return rows.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("n"))


def stream_two_sources(spark, sf):
    """Two streams with their own checkpoints into one collection: every row is stored."""
    collection = _collection(spark, sf, load=False)
    for parity in (0, 1):
        rows = embedding_items(spark, sf).where(F.col("id").cast("long") % 2 == parity)
        stream = _stream_of(spark, rows, f"stream-{parity}")
        upsert_stream(stream, collection, scratch_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return collection.items().select("id", F.round(F.col("vector")[0].cast("double"), DIGITS).alias("x0"))


def stream_rejects(spark, sf):
    """A stream with faulty rows: what it stored, and every fault it set aside."""
    collection, rejects = _strict(spark), scratch_path(spark, "rejects")
    stream = _stream_of(spark, _faulty_items(spark, sf).drop("row"), "faulty")
    upsert_stream(stream, collection, scratch_path(spark, "checkpoint"), available_now=True, mode="split", rejects=rejects).awaitTermination()
    return _error_counts(spark.read.parquet(rejects)).union(collection.num_vectors().select(F.lit("stored"), "num_vectors"))


def collection_split(spark, sf):
    """A batch in which every faulty row comes twice: each one is reported, good rows are stored once."""
    collection = _strict(spark)
    rows = _faulty_items(spark, sf).drop("row")
    bad = collection.upsert(rows.unionAll(rows), mode="split", auto_train=False)
    return _error_counts(bad).union(collection.num_vectors().select(F.lit("stored"), "num_vectors"))


def greedy_filtered(spark, sf):
    """Greedy search with a filter returns as many rows as match, up to k."""
    collection = _collection(spark, sf)
    collection.train(n_lists=LISTS, max_iters=10)
    hits = collection.query(embedding_queries(spark, sf), top_k=WANTED, filters={"label": 4}, greedy=True, include=("distance",))
    return hits.groupBy("query_id").agg(F.count("*").alias("n"))


def collection_filtered_recall(spark, sf):
    """Per filter: queries answered in full, and whether recall reaches the gates at all, fixed and automatic probes."""
    collection = _collection(spark, sf)
    collection.train(n_lists=LISTS, max_iters=20)
    queries, items = embedding_queries(spark, sf), tagged_items(spark, sf)
    out = None
    for name in ("eq", "in", "or"):
        kept = items.where(compile_filter(FILTERS[name], F.col("metadata")))
        exact = written(search.search(queries, kept, K, distance.EUCLIDEAN), "exact")
        for probes, gate in ((LISTS, 1.0), (LISTS * 3 // 4, 0.85), (None, 0.85)):
            found = collection.query(queries, top_k=K, n_probes=probes, filters=FILTERS[name], include=("distance",))
            # written one after the other: the shuffles of one search are gone before the next
            row = written(evaluate.mean_recall(found, exact).select(
                F.lit(name).alias("filter"), F.lit(probes or -1).alias("n_probes"), (F.col("recall") >= gate).alias("reached")), "recall")
            out = row if out is None else out.union(row)
    return out


def filter_large_in(spark, sf):
    """A list of a thousand numbers and strings."""
    wanted = list(range(0, 2000, 2)) + [f"s{i}" for i in range(200)] + [0.5, True]
    events = _read(spark, sf, "events").withColumn("metadata", F.parse_json("props"))
    return events.where(compile_filter({"k": {"$in": wanted}}, F.col("metadata"))).select("event_id")


def collection_get(spark, sf):
    """Rows of a collection by a table of ids, in its order."""
    wanted = _read(spark, sf, "events").select(F.col("event_id").alias("pos"), F.col("event_id").cast("string").alias("id"))
    found = _collection(spark, sf).get(wanted)
    return found.select("pos", "id", F.try_variant_get("metadata", "$.label", "int").alias("label"), F.size("vector").alias("dim"))


def collection_delete(spark, sf):
    """Ids that stay after a delete, seen through a handle opened by name."""
    collection = _collection(spark, sf)
    collection.delete(_read(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("id")).distinct())
    return collection.store.load("vectors", KEY).list_ids()


def collection_list_ids_filtered(spark, sf):
    return _collection(spark, sf).list_ids(FILTERS["or"])


def open_or_create(spark, sf):
    """The first call creates, the second opens what is there."""
    store = VectorStore(spark, scratch_path(spark, "store"))
    rows = tagged_items(spark, sf)
    for parity in (0, 1):
        store.open_or_create("both", KEY).upsert(rows.where(F.col("id").cast("long") % 2 == parity), auto_train=False)
    return store.load("both", KEY).num_vectors()


def list_collections(spark, sf):
    """One collection per language, one of them dropped: what the catalog lists."""
    store = VectorStore(spark, scratch_path(spark, "store"))
    names = sorted(r.lang for r in _read(spark, sf, "documents").select("lang").distinct().collect())
    for name in names:
        store.create(name, KEY)
    store.drop(names[0], KEY)
    return store.list().select("index_name")


def upsert_after_train(spark, sf):
    """Rows upserted after training are put into lists: one probe finds each row by its own vector."""
    collection = _collection(spark, sf)
    collection.train(n_lists=LISTS, max_iters=10)
    collection.upsert(_upsert_batch(spark, sf), order=F.col("seq"), auto_train=False)
    own = collection.items().select(F.col("id").alias("query_id"), F.col("vector").alias("qv"))
    hits = collection.query(own, top_k=1, n_probes=1, include=("distance",))
    return hits.select("query_id", F.round("distance", DIGITS).alias("distance"))


def store_mmr(spark, sf):
    """Diversified hits of texts: as many as asked for, each once."""
    store = VectorStore(spark, scratch_path(spark, "store"))
    texts = TextStore.from_documents(store, "texts", KEY, document_rows(spark, sf), embed.hashing_embedder(TEXT_DIM))
    questions = _read(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = texts.max_marginal_relevance_search(questions, k=3, filters={"lang": "en"})
    return hits.groupBy("query_id").agg(F.countDistinct("id").alias("n"), F.max("mmr_rank").cast("int").alias("last_rank"))


def registry() -> dict:
    return {f.__name__: f for f in (
        stream_two_sources, stream_rejects, collection_split, greedy_filtered, collection_filtered_recall, filter_large_in, collection_get,
        collection_delete, collection_list_ids_filtered, open_or_create, list_collections, upsert_after_train, store_mmr)}


_FAULTS = """faults(label, error) AS (VALUES (0, 'missing required ''id'' field'), (1, '''id'' cannot be blank'),
  (2, 'vector cannot be empty'), (3, 'vector dimension must be 64'), (4, 'vector elements must be finite numbers'),
  (5, 'missing required ''vector'' field'), (6, 'metadata must be an object or null'))"""


def _faults(times: int) -> str:
    return f"""WITH {_FAULTS} SELECT error, count(*) * {times} AS n FROM embeddings JOIN faults USING (label) GROUP BY error
        UNION ALL SELECT 'stored', count(*) FROM embeddings WHERE label NOT IN (SELECT label FROM faults)"""


def statements() -> dict[str, str]:
    return {
        "stream_two_sources": "SELECT vec_id::VARCHAR AS id, round(embedding[1]::DOUBLE, 6) AS x0 FROM embeddings",
        "stream_rejects": _faults(1),
        "collection_split": _faults(2),
        "greedy_filtered": f"""SELECT vec_id AS query_id, least({WANTED}, (SELECT count(*) FROM embeddings WHERE label = 4)) AS n FROM embeddings""",
        "collection_filtered_recall": f"""SELECT f AS filter, p::INTEGER AS n_probes, true AS reached
            FROM (SELECT unnest(['eq', 'in', 'or']) AS f), (SELECT unnest([{LISTS}, {LISTS * 3 // 4}, -1]) AS p)""",
        "filter_large_in": "SELECT event_id FROM events WHERE (props ->> 'k')::BIGINT BETWEEN 0 AND 1998 AND (props ->> 'k')::BIGINT % 2 = 0",
        "collection_get": """SELECT event_id AS pos, event_id::VARCHAR AS id, label::INTEGER AS label, len(embedding)::INTEGER AS dim
            FROM events JOIN embeddings ON vec_id = event_id""",
        "collection_delete": "SELECT vec_id::VARCHAR AS id FROM embeddings WHERE vec_id NOT IN (SELECT conv_id FROM conversations)",
        "collection_list_ids_filtered": """SELECT vec_id::VARCHAR AS id FROM embeddings
            WHERE label = 0 OR (label % 2 = 1 AND label % 3 <> 1)""",
        "open_or_create": "SELECT count(*) AS num_vectors FROM embeddings",
        "list_collections": "SELECT DISTINCT lang AS index_name FROM documents WHERE lang > (SELECT min(lang) FROM documents)",
        "upsert_after_train": """SELECT vec_id::VARCHAR AS query_id, 0.0::DOUBLE AS distance FROM embeddings
            UNION ALL SELECT 'n' || vec_id, 0.0 FROM embeddings WHERE label % 2 <> 0""",
        "store_mmr": "SELECT item_id AS query_id, 3::BIGINT AS n, 3::INTEGER AS last_rank FROM benchmark",
    }
