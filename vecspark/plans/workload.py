"""The registered queries: each operator over the given tables, whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import contents, distance, embed, protect
from ..functions.filters import compile_filter
from ..operators import evaluate, merge, mmr, pq, search, train, validate
from ..sources import items as item_source
from ..streaming.streams import query_stream, upsert_stream
from .collection import Collection, VectorStore
from .text_store import TextStore
from .workspace import scratch_path, spread_small

K = 10
PQ_DIM = 8
TEXT_DIM = 64
DIGITS = 6
KEY = bytes(range(32))


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.withColumn(column, F.round(column, DIGITS))
    return df


def embedding_items(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector"), "label")


def embedding_queries(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))


def tagged_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items with nested metadata made from the label."""
    label = F.col("label")
    metadata = F.struct(
        label, (label / 4).alias("weight"),
        F.when(label % 2 == 0, F.lit("even")).otherwise("odd").alias("parity"),
        F.struct(F.concat(F.lit("o"), (label % 3).cast("string")).alias("name"), (label % 3).alias("level")).alias("owner"),
        F.array(F.concat(F.lit("t"), (label % 2).cast("string")), F.concat(F.lit("u"), label.cast("string"))).alias("tags"))
    return embedding_items(spark, sf).withColumn("metadata", F.parse_json(F.to_json(metadata))).drop("label")


FILTERS = {
    "eq": {"parity": "even", "label": 4},
    "in": {"label": {"$in": [1, 3, 5]}},
    "range": {"weight": {"$gte": 0.5, "$lt": 1.5}},
    "or": {"$or": [{"label": 0}, {"parity": "odd", "owner.level": {"$ne": 1}}]},
    "nested": {"owner.name": "o2"},
    "array": {"tags": "t1", "label": {"$not": {"$gt": 5}}},
    "all": {"tags": {"$all": ["t0", "u6"]}},
    "nor": {"$nor": [{"label": {"$lte": 3}}, {"tags": {"$size": 3}}, {"missing": {"$exists": True}}]},
    "nin": {"label": {"$nin": [2, 7]}, "missing": {"$ne": 1}},
}


# -- exact search ---------------------------------------------------------------

def knn(metric: str):
    def run(spark, sf):
        hits = search.search(embedding_queries(spark, sf), embedding_items(spark, sf), K, metric)
        return _rounded(hits, "distance")
    return run


def knn_filtered(name: str):
    def run(spark, sf):
        items = tagged_items(spark, sf).where(compile_filter(FILTERS[name], F.col("metadata")))
        return _rounded(search.search(embedding_queries(spark, sf), items, K, distance.EUCLIDEAN), "distance")
    return run


def knn_nested(spark, sf):
    hits = search.search(embedding_queries(spark, sf), embedding_items(spark, sf), K, distance.COSINE)
    return search.nest_hits(hits).select(
        "query_id", F.size("hits").alias("n_hits"),
        F.array_join(F.transform("hits", lambda h: h["id"]), ",").alias("hit_ids"))


def knn_payload(spark, sf):
    """Include projection: metadata and vector come with the hits."""
    hits = search.search(embedding_queries(spark, sf), tagged_items(spark, sf), 3, distance.EUCLIDEAN,
                         payload=("metadata", "vector"))
    kept = search.only_included(hits, ("metadata", "vector", "unknown"))
    return kept.select("query_id", "rank", "id", F.try_variant_get("metadata", "$.owner.name", "string").alias("owner"),
                       F.round(F.col("vector")[0].cast("double"), DIGITS).alias("x0"), F.size("vector").alias("dim"))


def scores(metric: str, score_metric: str | None):
    def run(spark, sf):
        hits = search.search(embedding_queries(spark, sf), embedding_items(spark, sf), K, metric)
        score = distance.similarity_score(score_metric, F.col("distance"))
        return _rounded(hits.select("query_id", "rank", "id", score.alias("score")), "score")
    return run


# -- metadata filters -----------------------------------------------------------

EVENT_FILTER = {"$or": [{"k": {"$lt": 10}}, {"k": {"$in": [69, 89]}}], "k": {"$nin": [3, 5]}}


def filter_events_json(spark, sf):
    events = _read(spark, sf, "events").withColumn("metadata", F.parse_json("props"))
    return events.where(compile_filter(EVENT_FILTER, F.col("metadata"))).select(
        "event_id", "event_type", F.try_variant_get("metadata", "$.k", "bigint").alias("k"))


def filter_candidate_counts(spark, sf):
    return evaluate.candidate_counts(tagged_items(spark, sf), FILTERS)


# -- keyed table operations -------------------------------------------------------

def get_by_ids(spark, sf):
    """Every event id is asked for; those that are no vector id give no row."""
    wanted = _read(spark, sf, "events").select(F.col("event_id").alias("pos"), F.col("event_id").cast("string").alias("id"))
    found = merge.get_by_ids(embedding_items(spark, sf), wanted)
    return found.select("pos", "id", "label", F.round(F.col("vector")[0].cast("double"), DIGITS).alias("x0"))


def delete_by_ids(spark, sf):
    gone = _read(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("id")).distinct()
    return merge.delete_by_ids(embedding_items(spark, sf), gone).select("id", "label")


def _upsert_batch(spark, sf) -> DataFrame:
    """Every even label twice (the later version counts) and a new id for every odd one."""
    base = embedding_items(spark, sf)
    negated = F.transform("vector", lambda x: -x)
    doubled = F.transform("vector", lambda x: (x * 2).cast("float"))
    even = F.col("label") % 2 == 0
    one = base.where(even).select("id", doubled.alias("vector"), "label", F.lit(1).alias("seq"))
    two = base.where(even).select("id", negated.alias("vector"), "label", F.lit(2).alias("seq"))
    new = base.where(~even).select(F.concat(F.lit("n"), "id").alias("id"), negated.alias("vector"), "label",
                                   F.lit(1).alias("seq"))
    return one.unionByName(two).unionByName(new)


def upsert_merge(spark, sf):
    base = embedding_items(spark, sf).withColumn("seq", F.lit(0))
    merged = merge.upsert_merge(base, _upsert_batch(spark, sf), order=F.col("seq"))
    return merged.select("id", "label", "seq", F.round(F.col("vector")[0].cast("double"), DIGITS).alias("x0"))


def latest_per_id(spark, sf):
    events = _read(spark, sf, "events").withColumn("id", F.col("user_id").cast("string"))
    return merge.latest_per_id(events, F.struct("ts", "event_id")).select("id", "event_id", "event_type")


def list_ids(spark, sf):
    return merge.list_ids(embedding_items(spark, sf)).orderBy("id")


def num_vectors(spark, sf):
    return merge.num_vectors(embedding_items(spark, sf))


def id_difference(spark, sf):
    documents = _read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"))
    labelled = _read(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return merge.id_difference(documents, labelled)


def id_intersection(spark, sf):
    documents = _read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"))
    return merge.id_intersection(documents, embedding_items(spark, sf))


# -- validation -------------------------------------------------------------------

def _faulty_items(spark, sf) -> DataFrame:
    """Faults by label: missing id, blank id, empty vector, wrong size, NaN, null vector, odd metadata."""
    label = F.col("label")
    vector = (F.when(label == 2, F.array().cast("array<float>"))
              .when(label == 3, F.slice("vector", 1, 63))
              .when(label == 4, F.transform("vector", lambda x: F.when(x > 0, F.lit(float("nan"))).otherwise(x)))
              .when(label == 5, F.lit(None)).otherwise(F.col("vector")))
    return embedding_items(spark, sf).select(
        F.col("id").cast("bigint").alias("row"),
        F.when(label == 0, F.lit(None)).when(label == 1, F.lit("  ")).otherwise(F.col("id")).alias("id"),
        vector.alias("vector"), F.parse_json(F.when(label == 6, F.lit("7")).otherwise('{"a": 1}')).alias("metadata"))


def validate_items(spark, sf):
    checked = validate.with_errors(_faulty_items(spark, sf), dimension=64)
    return checked.select("row", F.size("errors").alias("n_errors"), F.array_join("errors", "; ").alias("errors"))


def validate_split(spark, sf):
    good, bad = validate.split_valid(_faulty_items(spark, sf), dimension=64)
    return good.select("row", F.lit("good").alias("side")).unionByName(bad.select("row", F.lit("bad").alias("side")))


# -- scalar functions ---------------------------------------------------------------

def l2_normalize(spark, sf):
    scaled = F.transform(distance.to_double(F.col("vector")), lambda x: x * F.col("label"))
    unit = embedding_items(spark, sf).select("id", distance.l2_normalize(scaled).alias("v"))
    return _rounded(unit.select("id", F.posexplode("v").alias("pos", "x")), "x")


def _label_means(spark, sf) -> DataFrame:
    items = embedding_items(spark, sf).withColumn("list_id", F.col("label"))
    means = train.centroid_means(items)
    return means.withColumn("centroid", F.transform("centroid", lambda x: F.round(x, DIGITS)))


def similarity_to_label(spark, sf):
    """Each vector against its label's mean, in every metric."""
    joined = embedding_items(spark, sf).join(
        _label_means(spark, sf).withColumnRenamed("list_id", "label"), "label")
    a, b = F.col("vector"), F.col("centroid")
    return _rounded(joined.select(
        "id", distance.cosine_similarity(a, b).alias("cos_sim"), distance.cosine_distance(a, b).alias("cos_dist"),
        distance.euclidean(a, b).alias("euclid"), distance.squared_euclidean(a, b).alias("sq_euclid")),
        "cos_sim", "cos_dist", "euclid", "sq_euclid")


# -- inverted lists -----------------------------------------------------------------

def _lists(spark, sf):
    return train.centroid_array(_label_means(spark, sf))


def _assigned(spark, sf, centroids) -> DataFrame:
    return train.assign_lists(embedding_items(spark, sf), centroids, distance.EUCLIDEAN)


def centroid_update(spark, sf):
    return _label_means(spark, sf).select("list_id", F.posexplode("centroid").alias("pos", "x"))


def ivf_assign(spark, sf):
    return _assigned(spark, sf, _lists(spark, sf)).select("id", "list_id")


def list_sizes(spark, sf):
    return train.list_sizes(_assigned(spark, sf, _lists(spark, sf)))


def ivf_probe_lists(spark, sf):
    probed = search.probe_lists(embedding_queries(spark, sf), _lists(spark, sf), distance.EUCLIDEAN, 3)
    return probed.select("query_id", F.posexplode("probes").alias("pos", "list_id"))


def _ivf_hits(spark, sf, n_probes):
    centroids = _lists(spark, sf)
    probed = search.probe_lists(embedding_queries(spark, sf), centroids, distance.EUCLIDEAN, n_probes)
    return search.search(probed, _assigned(spark, sf, centroids), K, distance.EUCLIDEAN)


def ivf_search(n_probes: int):
    def run(spark, sf):
        return _rounded(_ivf_hits(spark, sf, n_probes), "distance")
    return run


def greedy_search(spark, sf):
    centroids = _lists(spark, sf)
    assigned = _assigned(spark, sf, centroids)
    sizes = train.size_array(assigned, len(centroids))
    probed = search.probe_lists(embedding_queries(spark, sf), centroids, distance.EUCLIDEAN, sizes=sizes, k=60)
    return _rounded(search.search(probed, assigned, K, distance.EUCLIDEAN), "distance")


def kmeans_train(spark, sf):
    """Trained lists cover every row, and one more step moves no centroid."""
    items = embedding_items(spark, sf)
    centroids = train.train_lists(items, distance.EUCLIDEAN, items.count())
    assigned = train.assign_lists(items, centroids, distance.EUCLIDEAN)
    found = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "list_id int, trained array<double>")
    moved = train.centroid_means(assigned).join(found, "list_id").join(train.list_sizes(assigned), "list_id")
    shift = F.max(distance.euclidean(F.col("centroid"), F.col("trained")))
    return moved.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_lists"), (shift < 1e-3).alias("converged"))


def auto_probe_calibration(spark, sf):
    """Recall by probe count, every vector as a query."""
    centroids = _lists(spark, sf)
    assigned = _assigned(spark, sf, centroids)
    queries = assigned.select(F.col("id").alias("query_id"), F.col("vector").alias("qv"))
    return _rounded(train.calibrate_probes(assigned, queries, centroids, distance.EUCLIDEAN, k=20), "recall")


# -- product quantisation -------------------------------------------------------------

def _books(spark, sf):
    """Codebooks from the label means: one code per label in each sub-space."""
    means = _lists(spark, sf)
    return means.reshape(len(means), PQ_DIM, -1).transpose(1, 0, 2).copy()


def pq_encode(spark, sf):
    coded = pq.pq_encode(embedding_items(spark, sf), _books(spark, sf), distance.EUCLIDEAN)
    return coded.select("id", F.posexplode("codes").alias("sub", "code"))


def pq_search(rerank: int | None):
    def run(spark, sf):
        books = _books(spark, sf)
        coded = pq.pq_encode(embedding_items(spark, sf), books, distance.EUCLIDEAN)
        return _rounded(pq.pq_search(embedding_queries(spark, sf), coded, books, K, distance.EUCLIDEAN, rerank=rerank),
                        "distance")
    return run


def pq_train(spark, sf):
    """Codes in use after training: all of them, as far as there are different rows."""
    items = embedding_items(spark, sf)
    books = pq.train_codebooks(items, distance.EUCLIDEAN, items.count(), 64, PQ_DIM, 4)
    coded = pq.pq_encode(items, books, distance.EUCLIDEAN)
    return coded.select(F.posexplode("codes").alias("sub", "code")).groupBy("sub").agg(
        F.count("*").alias("n_rows"), F.count_distinct("code").alias("n_codes"))


# -- evaluation -----------------------------------------------------------------------

def recall_at_k(spark, sf):
    exact = search.search(embedding_queries(spark, sf), embedding_items(spark, sf), K, distance.EUCLIDEAN)
    return _rounded(evaluate.recall_per_query(_ivf_hits(spark, sf, 3), exact), "recall")


def mean_recall(spark, sf):
    exact = search.search(embedding_queries(spark, sf), embedding_items(spark, sf), K, distance.EUCLIDEAN)
    return _rounded(evaluate.mean_recall(_ivf_hits(spark, sf, 3), exact, strict=True), "recall")


def recall_filtered(spark, sf):
    """Per filter: three-list search of the matching rows against exact search of them."""
    centroids = _lists(spark, sf)
    queries = embedding_queries(spark, sf)
    probed = search.probe_lists(queries, centroids, distance.EUCLIDEAN, 3)
    items = train.assign_lists(tagged_items(spark, sf), centroids, distance.EUCLIDEAN)
    parts = []
    for name in ("eq", "in", "range", "nested"):
        rows = items.where(compile_filter(FILTERS[name], F.col("metadata")))
        found = evaluate.hit_ids(search.search(probed, rows, K, distance.EUCLIDEAN)).withColumnRenamed("ids", "found")
        truth = evaluate.hit_ids(search.search(queries, rows, K, distance.EUCLIDEAN)).withColumnRenamed("ids", "expected")
        both = queries.select("query_id").join(found, "query_id", "left").join(truth, "query_id", "left")
        none = F.array().cast("array<string>")
        parts.append(both.select(F.lit(name).alias("filter_name"), "query_id",
                                 F.coalesce("found", none).alias("found"), F.coalesce("expected", none).alias("expected")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return _rounded(evaluate.filtered_summary(union), "recall", "mean_returned", "mean_expected")


# -- text -----------------------------------------------------------------------------

def document_rows(spark, sf) -> DataFrame:
    return _read(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("page_content"),
        F.parse_json(F.to_json(F.struct("lang", "source", "n_chars"))).alias("metadata"))


def _embedded_documents(spark, sf, filters=None) -> DataFrame:
    embedder = embed.ordered_embedder(TEXT_DIM)
    rows = document_rows(spark, sf).where(compile_filter(filters, F.col("metadata")))
    return spread_small(rows).withColumn("vector", embedder(F.col("page_content")))


def _text_queries(spark, sf) -> DataFrame:
    embedder = embed.ordered_embedder(TEXT_DIM)
    texts = _read(spark, sf, "benchmark")
    return texts.select(F.col("item_id").alias("query_id"), embedder(F.col("text")).alias("qv"))


def text_embed(spark, sf):
    return _embedded_documents(spark, sf).select("id", F.posexplode("vector").alias("pos", "x"))


def text_embed_function(spark, sf):
    """A user function as the embedder: text length, count of 'e', count of spaces."""
    def load():
        return lambda batch: [[float(len(t)), float(t.count("e")), float(t.count(" "))] for t in batch]
    embedder = embed.function_embedder(load, element="double")
    rows = spread_small(document_rows(spark, sf)).select("id", embedder("page_content").alias("v"))
    return rows.select("id", *[F.col("v")[i].alias(f"x{i}") for i in range(3)])


def text_search(spark, sf):
    hits = search.search(_text_queries(spark, sf), _embedded_documents(spark, sf), 4, distance.COSINE,
                         payload=("metadata",), stored=document_rows(spark, sf))
    return _rounded(hits, "distance").select(
        "query_id", "rank", "id", "distance", F.try_variant_get("metadata", "$.lang", "string").alias("lang"))


def text_search_score(spark, sf):
    rows = _embedded_documents(spark, sf, {"lang": {"$in": ["en", "fr"]}})
    hits = search.search(_text_queries(spark, sf), rows, 4, distance.COSINE)
    score = distance.similarity_score(distance.COSINE, F.col("distance"))
    return _rounded(hits.select("query_id", "rank", "id", score.alias("score")), "score")


def mmr_search(spark, sf):
    hits = search.search(embedding_queries(spark, sf), embedding_items(spark, sf), 6, distance.COSINE, payload=("vector",))
    scored = hits.withColumn("score", distance.similarity_score(distance.COSINE, F.col("distance")))
    picked = mmr.mmr_select(scored.select("query_id", "rank", "id", "score", "vector"), 3)
    return _rounded(picked.select("query_id", "mmr_rank", "id", "score"), "score")


def pack_unpack_documents(spark, sf):
    rows = document_rows(spark, sf)
    packed = rows.select("id", contents.pack_document(F.col("metadata"), F.col("page_content")).alias("metadata"))
    m = F.col("metadata")
    rest = contents.unpack_metadata(m)
    return packed.select(
        "id", contents.unpack_text(m).alias("page_content"), F.try_variant_get(rest, "$.lang", "string").alias("lang"),
        F.try_variant_get(rest, "$.n_chars", "bigint").alias("n_chars"),
        F.try_variant_get(rest, "$._content", "string").isNull().alias("text_key_gone"))


def contents_base64(spark, sf):
    rows = document_rows(spark, sf).withColumn("encoded", contents.encode_contents(F.col("page_content").cast("binary")))
    back = contents.decode_contents(F.col("encoded")).cast("string")
    return rows.select("id", "encoded", (back == F.col("page_content")).alias("same"))


def seal_roundtrip(spark, sf):
    key = protect.key_column(spark, KEY)
    rows = document_rows(spark, sf)
    sealed = rows.select("id", "page_content", protect.seal(F.col("page_content"), key, F.col("id")).alias("sealed"))
    opened = protect.unseal(F.col("sealed"), key, F.col("id")).cast("string")
    hidden = F.col("sealed") != F.col("page_content").cast("binary")
    return sealed.select("id", opened.alias("page_content"), hidden.alias("hidden"))


# -- sources and sinks ------------------------------------------------------------------

def items_json_roundtrip(spark, sf):
    path = scratch_path(spark, "items-json")
    rows = document_rows(spark, sf).withColumnRenamed("page_content", "contents") \
        .withColumn("vector", F.array(F.col("id").cast("double"), F.lit(0.5)))
    item_source.write_items_json(item_source.item_rows(rows), path)
    back = item_source.read_items_json(spark, path)
    return back.select("id", F.col("contents").cast("string").alias("contents"), F.col("vector")[0].alias("x0"),
                       F.try_variant_get("metadata", "$.source", "string").alias("source"))


def ingest_arrays(spark, sf):
    """Parallel arrays of ten ids and vectors per row, as item rows."""
    bundles = embedding_items(spark, sf).groupBy((F.col("id").cast("bigint") / 10).cast("bigint").alias("bundle")).agg(
        F.collect_list(F.struct("id", "vector")).alias("rows"))
    arrays = bundles.select(F.col("rows.id").alias("ids"), F.col("rows.vector").alias("vectors"))
    rows = item_source.from_arrays(arrays)
    return rows.select("id", F.round(F.col("vector")[0].cast("double"), DIGITS).alias("x0"),
                       F.col("contents").isNull().alias("no_contents"))


# -- collections --------------------------------------------------------------------------

def _collection(spark, sf, metric=distance.EUCLIDEAN, kind="ivfflat", load=True, **options) -> Collection:
    store = VectorStore(spark, scratch_path(spark, "store"))
    collection = store.create("vectors", KEY, {"type": kind, "pq_dim": PQ_DIM, "pq_bits": 4}, metric,
                              metadata_columns={"label": "bigint"}, **options)
    if load:
        collection.upsert(tagged_items(spark, sf), auto_train=False)
    return collection


def collection_describe(spark, sf):
    collection = _collection(spark, sf)
    about = collection.describe().select("index_name", "index_type", "is_trained", "index_config.dimension", "index_config.metric")
    return about.withColumn("num_vectors", F.lit(collection.num_vectors().first()["num_vectors"]))


def collection_changes(spark, sf):
    """Load, upsert over it, delete by ids, fold; then what is stored."""
    collection = _collection(spark, sf)
    collection.upsert(_upsert_batch(spark, sf), order=F.col("seq"), auto_train=False)
    collection.delete(_read(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("id")).distinct())
    before = collection.items()
    collection.compact()
    after = collection.items().select("id", F.round(F.col("vector")[0].cast("double"), DIGITS).alias("x0"))
    return after.join(before.select("id", F.size("vector").alias("dim")), "id")


def collection_query_untrained(spark, sf):
    hits = _collection(spark, sf).query(embedding_queries(spark, sf), top_k=K, filters=FILTERS["in"])
    return _rounded(hits, "distance").select(
        "query_id", "rank", "id", "distance", F.try_variant_get("metadata", "$.label", "int").alias("label"))


def collection_query_trained(spark, sf):
    """Trained, every list probed: the same hits as exact search."""
    collection = _collection(spark, sf)
    collection.train(n_lists=16, max_iters=10)
    hits = collection.query(embedding_queries(spark, sf), top_k=K, n_probes=16, include=("distance",))
    return _rounded(hits, "distance")


def collection_recall_gates(spark, sf):
    """Automatic probes at k = 100 reach the recall contract after training."""
    collection = _collection(spark, sf)
    collection.train(max_iters=20)
    queries = embedding_queries(spark, sf)
    exact = search.search(queries, embedding_items(spark, sf), 100, distance.EUCLIDEAN)
    found = collection.query(queries, top_k=100, include=("distance",))
    return evaluate.mean_recall(found, exact).select((F.col("recall") >= 0.88).alias("auto_probes_reach_gate"))


def collection_query_contents(spark, sf):
    """Text store from documents; texts as queries, with score and metadata."""
    store = VectorStore(spark, scratch_path(spark, "store"))
    texts = TextStore.from_documents(store, "texts", KEY, document_rows(spark, sf), embed.hashing_embedder(TEXT_DIM))
    queries = _read(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = texts.similarity_search_with_score(queries, filters={"lang": "en"})
    return _rounded(hits, "score").select("query_id", "rank", "id", F.length("page_content").alias("n_text"), "score")


# -- streams ----------------------------------------------------------------------------------

def _stream_of(spark, rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a file stream of several micro-batches."""
    path = scratch_path(spark, purpose)
    rows.repartition(4).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


def stream_upsert(spark, sf):
    collection = _collection(spark, sf, load=False)
    stream = _stream_of(spark, embedding_items(spark, sf), "stream")
    upsert_stream(stream, collection, scratch_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return collection.items().select("id", F.round(F.col("vector")[0].cast("double"), DIGITS).alias("x0"))


def stream_query(spark, sf):
    collection = _collection(spark, sf)
    target = scratch_path(spark, "stream-hits")
    stream = _stream_of(spark, embedding_queries(spark, sf), "stream")
    query_stream(stream, collection, target, scratch_path(spark, "checkpoint"), available_now=True,
                 top_k=K, include=("distance",)).awaitTermination()
    return _rounded(spark.read.parquet(target).drop("batch_id"), "distance")


def registry() -> dict:
    out = {
        "knn_euclidean": knn(distance.EUCLIDEAN),
        "knn_sqeuclidean": knn(distance.SQUARED_EUCLIDEAN),
        "knn_cosine": knn(distance.COSINE),
        "knn_nested": knn_nested,
        "knn_payload": knn_payload,
        "score_cosine": scores(distance.COSINE, distance.COSINE),
        "score_euclidean": scores(distance.EUCLIDEAN, distance.EUCLIDEAN),
        "score_sqeuclidean": scores(distance.SQUARED_EUCLIDEAN, distance.SQUARED_EUCLIDEAN),
        "score_other": scores(distance.EUCLIDEAN, None),
        "ivf_probe_search": ivf_search(3),
        "ivf_full_probe": ivf_search(10),
        "pq_search": pq_search(None),
        "pq_search_rerank": pq_search(2),
    }
    out.update({f"knn_filtered_{name}": knn_filtered(name) for name in FILTERS})
    for function in (
        filter_events_json, filter_candidate_counts, get_by_ids, delete_by_ids, upsert_merge, latest_per_id, list_ids,
        num_vectors, id_difference, id_intersection, validate_items, validate_split, l2_normalize, similarity_to_label,
        centroid_update, ivf_assign, list_sizes, ivf_probe_lists, greedy_search, kmeans_train, auto_probe_calibration,
        pq_encode, pq_train, recall_at_k, mean_recall, recall_filtered, text_embed, text_embed_function, text_search, text_search_score,
        mmr_search, pack_unpack_documents, contents_base64, seal_roundtrip, items_json_roundtrip, ingest_arrays,
        collection_describe, collection_changes, collection_query_untrained, collection_query_trained,
        collection_recall_gates, collection_query_contents, stream_upsert, stream_query,
    ):
        out[function.__name__] = function
    return out
