"""Registered queries over sources, field rules, checks and trained collections, with their SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..functions import distance, embed
from ..functions.filters import compile_filter
from ..operators import evaluate, pq, search, spread, train
from ..sources import items as item_source
from . import oracle
from .collection import VectorStore, normalize_config
from .text_store import TextStore
from .workload import (DIGITS, FILTERS, K, KEY, PQ_DIM, TEXT_DIM, _assigned, _books, _collection, _label_means, _lists, _read, _rounded, document_rows,
                       embedding_items, embedding_queries, tagged_items)
from .workspace import scratch_path, written

CELL = {"query_rows": 128, "item_rows": 256}     # so that the given tables make many cells
SPLIT = 1.013                                    # times the mean size, which no list has exactly
ROUNDS = 2                                       # Lloyd rounds that SQL repeats


# -- many queries in one job ------------------------------------------------------

def knn_many(spark, sf):
    """Exact search, query blocks against item parts in one job."""
    return _rounded(spread.spread_search(embedding_queries(spark, sf), embedding_items(spark, sf), K, **CELL), "distance")


def ivf_many(spark, sf):
    """Queries joined with the lists that they probe, hot lists cut into parts."""
    centroids = _lists(spark, sf)
    probed = search.probe_lists(embedding_queries(spark, sf), centroids, distance.EUCLIDEAN, 3)
    return _rounded(spread.spread_search(probed, _assigned(spark, sf, centroids), K, query_rows=128, item_rows=32), "distance")


def greedy_filtered_lists(spark, sf):
    """Lists that greedy probing reads for 40 rows that meet a filter; sizes are counted only as far as needed."""
    centroids = _lists(spark, sf)
    rows = _assigned(spark, sf, centroids).join(tagged_items(spark, sf).select("id", "metadata"), "id").where(compile_filter(FILTERS["or"], F.col("metadata")))
    queries = embedding_queries(spark, sf)
    sizes = train.greedy_sizes(queries, centroids, distance.EUCLIDEAN, rows, 40)
    probed = search.probe_lists(queries, centroids, distance.EUCLIDEAN, sizes=sizes, k=40)
    return probed.select("query_id", F.posexplode("probes").alias("pos", "list_id"))


# -- sources ----------------------------------------------------------------------

def fixture_source(spark, sf):
    """A recall fixture of the vectors, written as one JSON object and read back by position."""
    path = scratch_path(spark, "fixture")
    rows = tagged_items(spark, sf).select(F.col("id").cast("long").alias("n"), "vector", "metadata")
    arrays = rows.agg(F.array_sort(F.collect_list(F.struct("n", F.to_json("metadata").alias("metadata"), "vector"))).alias("rows"))
    body = F.concat(F.lit('{"vectors": '), F.to_json(F.col("rows.vector")), F.lit(', "metadata": ['),
                    F.array_join("rows.metadata", ","), F.lit("]}"))
    arrays.select(body).write.text(path)
    items = item_source.read_recall_fixture(spark, path)["items"]
    return items.select("id", F.round(F.col("vector")[0].cast("float").cast("double"), DIGITS).alias("x0"),
                        F.try_variant_get("metadata", "$.parity", "string").alias("parity"))


def _texts(spark, sf):
    return _read(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("id"), "text")


def _text_store(spark, sf, **options):
    store = VectorStore(spark, scratch_path(spark, "store"))
    return TextStore.from_texts(store, "texts", KEY, _texts(spark, sf), embed.hashing_embedder(TEXT_DIM), **options)


def from_texts(spark, sf):
    """A store from texts with one metadata object for all."""
    items = _text_store(spark, sf, metadata={"kind": "passage", "level": 3}).collection.items()
    return items.select("id", F.col("contents").cast("string").alias("page_content"), F.size("vector").alias("dim"),
                        F.try_variant_get("metadata", "$.kind", "string").alias("kind"), F.try_variant_get("metadata", "$.level", "int").alias("level"))


def generated_ids(spark, sf):
    """Texts without ids: each gets its own, by which it is found again."""
    store = VectorStore(spark, scratch_path(spark, "store"))
    texts = TextStore.open(store, "texts", KEY, embed.hashing_embedder(TEXT_DIM))
    ids = texts.add_texts(_read(spark, sf, "benchmark").select("text"))
    wanted = ids.distinct().select(F.monotonically_increasing_id().alias("pos"), "id")
    return texts.get(wanted).groupBy("page_content").agg(F.count_distinct("id").alias("n"))


def arrays_mismatch(spark, sf):
    """Bundles of parallel arrays, every third short of a vector: what the length check says."""
    bundle = (F.col("id").cast("bigint") / 10).cast("bigint").alias("bundle")
    bundles = embedding_items(spark, sf).groupBy(bundle).agg(F.collect_list("id").alias("ids"), F.collect_list("vector").alias("vectors"))
    vectors = F.when(F.col("bundle") % 3 == 0, F.slice("vectors", 1, F.size("vectors") - 1)).otherwise(F.col("vectors"))
    return bundles.withColumn("vectors", vectors).select("bundle", item_source.length_error("ids", "vectors").alias("error"))


def _gappy(spark, sf):
    """Items of which some lack a vector, contents or metadata."""
    label = F.col("label")
    return item_source.item_rows(tagged_items(spark, sf).join(embedding_items(spark, sf).select("id", "label"), "id").select(
        "id", F.when(label % 2 == 0, F.col("vector")).alias("vector"), F.when(label % 3 == 0, F.concat(F.lit("c"), "id")).alias("contents"),
        F.when(label % 5 != 0, F.col("metadata")).alias("metadata")))


def absent_fields(spark, sf):
    """Null fields are not written: the keys of each JSON record."""
    path = scratch_path(spark, "items-json")
    item_source.write_items_json(_gappy(spark, sf), path)
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", "$.id").alias("id"), F.array_join(F.array_sort(F.json_object_keys("value")), ",").alias("fields"))


def null_fields(spark, sf):
    """Absent fields are null when read."""
    path = scratch_path(spark, "items-json")
    item_source.write_items_json(_gappy(spark, sf), path)
    back = item_source.read_items_json(spark, path)
    return back.select("id", F.col("vector").isNull().alias("no_vector"), F.col("contents").cast("string").alias("contents"),
                       F.col("metadata").isNull().alias("no_metadata"))


# -- checks of calls ---------------------------------------------------------------

def _accepted(call) -> str:
    try:
        call()
    except (ValueError, PermissionError) as error:
        return type(error).__name__
    return "accepted"


def bad_config(spark, sf):
    """A configuration from every nation (a table of fixed size), good or bad: what creating it says."""
    store = VectorStore(spark, scratch_path(spark, "store"))
    metrics = (distance.EUCLIDEAN, distance.SQUARED_EUCLIDEAN, distance.COSINE, "manhattan", None)
    rows = []
    for n in _read(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").collect():
        number = n.n_nationkey
        name, key = (" " if number % 7 == 3 else n.n_name), bytes(31 if number % 5 == 1 else 32)
        config = {"type": "ivfflat", "dimension": number - 4}
        rows.append((number, _accepted(lambda: store.create(name, key, config, metrics[n.n_regionkey]))))
    return spark.createDataFrame(rows, "n_nationkey int, outcome string")


def config_spellings(spark, sf):
    """Both spellings of the quantiser's settings, and their defaults, for every nation."""
    rows = []
    for n in _read(spark, sf, "nation").select("n_nationkey").collect():
        number = n.n_nationkey
        given = ({"pq_dim": number + 1}, {"pqDim": number + 1}, {"pqBits": 4}, {"pq_bits": 5, "pqDim": None}, {"pq_dim": 2, "pqDim": 9})[number % 5]
        out = normalize_config({"type": "ivfpq", **given})
        rows.append((number, out["pq_dim"], out["pq_bits"]))
    return spark.createDataFrame(rows, "n_nationkey int, pq_dim int, pq_bits int")


def wrong_key(spark, sf):
    """A collection sealed with the key of the first nation, opened with that of each."""
    def key_of(name: str) -> bytes:
        return hashlib.sha256(name.encode()).digest()

    store = VectorStore(spark, scratch_path(spark, "store"))
    nations = _read(spark, sf, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey").collect()
    store.create("sealed", key_of(nations[0].n_name)).upsert(tagged_items(spark, sf), auto_train=False)
    return spark.createDataFrame(
        [(n.n_nationkey, _accepted(lambda: store.load("sealed", key_of(n.n_name)).num_vectors())) for n in nations], "n_nationkey int, outcome string")


def get_include(spark, sf):
    """Only the columns asked for come back; unknown names are ignored."""
    wanted = _read(spark, sf, "events").select(F.col("event_id").alias("pos"), F.col("event_id").cast("string").alias("id"))
    collection = _collection(spark, sf)
    found = collection.get(wanted, include=("metadata", "nonsense"))
    columns = ",".join(found.columns)
    return found.select("pos", "id", F.lit(columns).alias("columns"), F.try_variant_get("metadata", "$.label", "int").alias("label"))


def get_documents(spark, sf):
    """Documents by a table of ids, unpacked, in its order."""
    wanted = _read(spark, sf, "events").select(F.col("event_id").alias("pos"), (F.col("event_id") % 97).cast("string").alias("id"))
    return _text_store(spark, sf).get(wanted).select("pos", "id", "page_content")


def delete_documents(spark, sf):
    """No ids and an empty list delete nothing; then those of a table go."""
    texts = _text_store(spark, sf)
    texts.delete()
    texts.delete([])
    texts.delete(_read(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id")))
    return texts.list_ids()


# -- training ------------------------------------------------------------------------

def retrain_rule(spark, sf):
    """Four upserts under a rule of 100 rows and doubling: when training happened, and on how many rows."""
    collection = _collection(spark, sf, load=False, min_train_rows=100, retrain_multiplier=2.0)
    items, rows = tagged_items(spark, sf), []
    labels = F.try_variant_get("metadata", "$.label", "int")
    for step, (low, high) in enumerate(((0, 1), (1, 4), (4, 6), (6, 100))):
        collection.upsert(items.where(labels.between(low, high - 1)))
        state = collection.state()
        rows.append((step, state["is_trained"], state["n_at_train"]))
    return spark.createDataFrame(rows, "step int, is_trained boolean, n_at_train long")


def split_lists(spark, sf):
    """Lists somewhat larger than the mean are split: which rows were written anew, and the lists of all others."""
    collection = _trained(spark, sf)
    collection.split_lists(factor=SPLIT)
    state = collection.state()
    anew = collection._stored(state, state["segments"][-1:]).select("id", F.lit(True).alias("anew"))
    rows = collection._stored(state).select("id", "list_id").join(anew, "id", "left")
    return rows.select("id", F.coalesce("anew", F.lit(False)).alias("anew"), F.when(F.col("anew").isNull(), F.col("list_id")).alias("list_id"))


def _trained(spark, sf):
    """A collection with lists fitted in a few rounds from the label means."""
    collection = _collection(spark, sf)
    collection.train(initial=_label_means(spark, sf), max_iters=ROUNDS, tolerance=0.0)
    return collection


def train_cost(spark, sf):
    """Size and cost of every list after training from given centroids."""
    collection = _trained(spark, sf)
    state = collection.state()
    lists = spark.read.parquet(f"{state['folder']}/centroids/{state['centroids']}")
    rows = collection._stored(state).join(lists, "list_id")
    return _rounded(rows.groupBy("list_id").agg(F.count("*").alias("n"), F.sum(distance.squared_euclidean(
        F.col("vector"), F.col("centroid"))).alias("cost")), "cost")


def pq_train_error(spark, sf):
    """Rows and squared error of every sub-space that a collection keeps, after rounds from the label means."""
    collection = _collection(spark, sf, kind="ivfpq")
    books = _books(spark, sf)
    collection.train(initial=_label_means(spark, sf), initial_codes=pq.codebook_frame(spark, books), max_iters=ROUNDS, tolerance=0.0)
    return _rounded(collection.codebook_errors(), "error")


def collection_recall(spark, sf):
    """Recall of a trained collection by the number of probed lists, with and without a filter."""
    collection, queries = _trained(spark, sf), embedding_queries(spark, sf)
    out = None
    for name in ("all", "in", "or"):
        filters = None if name == "all" else FILTERS[name]
        exact = search.search(queries, tagged_items(spark, sf).where(compile_filter(filters, F.col("metadata"))), K, distance.EUCLIDEAN)
        for probes in (1, 3, 6):
            found = collection.query(queries, top_k=K, n_probes=probes, filters=filters, include=("distance",))
            row = evaluate.mean_recall(found, exact).select(F.lit(name).alias("filter"), F.lit(probes).alias("n_probes"), F.round("recall", 4).alias("recall"))
            out = row if out is None else out.union(row)
    return out


def auto_probes(spark, sf):
    """The recall curve of the trained lists over all vectors, and where automatic probing stops on it."""
    collection = _trained(spark, sf)
    state = collection.state()
    stored, centroids = collection._stored(state), collection._centroids(state)
    queries = stored.select(F.col("id").alias("query_id"), F.col("vector").alias("qv"))
    curve = _rounded(train.calibrate_probes(stored, queries, centroids, distance.EUCLIDEAN, k=20), "recall")
    return curve.withColumn("chosen", F.col("n_probes") == train.auto_probe_count(curve))


def _reach_curve(collection, spark, k):
    """Recall and lists by reach, every vector a query."""
    state = collection.state()
    stored = collection._stored(state)
    queries = stored.select(F.col("id").alias("query_id"), F.col("vector").alias("qv"))
    return train.calibrate_reach(stored, queries, collection._centroids(state), collection._radii(state), distance.EUCLIDEAN, k)


def adaptive_curve(spark, sf):
    """Recall at 20 and lists read by the reach of adaptive probes, and where they stop on it."""
    curve = _rounded(_reach_curve(_trained(spark, sf), spark, 20), "recall", "lists")
    return curve.withColumn("chosen", F.col("step") == train.auto_reach(curve))


def adaptive_recall(spark, sf):
    """Calibrated on all vectors, automatic probes: recall at 100, 10 and 1, and the lists that a query reads on average."""
    collection, queries = _collection(spark, sf), embedding_queries(spark, sf)
    collection.train(initial=_label_means(spark, sf), max_iters=ROUNDS, tolerance=0.0, calibration=queries)
    state = collection.state()
    lists = search.probe_lists(queries, collection._centroids(state), distance.EUCLIDEAN, radii=collection._radii(state), reach=state["reach"]) \
        .agg(F.round(F.avg(F.size("probes")), 4).alias("lists"))
    out = None
    for k in (100, 10, 1):
        exact = search.search(queries, tagged_items(spark, sf), k, distance.EUCLIDEAN)
        found = collection.query(queries, top_k=k, include=("distance",))
        # written one after the other: the shuffles of one recall are gone before the next
        row = written(evaluate.mean_recall(found, exact).select(F.lit(k).alias("k"), F.round("recall", 4).alias("recall")), "recall")
        out = row if out is None else out.union(row)
    return out.join(F.broadcast(lists))      # one row


def store_mmr_ids(spark, sf):
    """Diversified hits of texts: the ids picked, with their scores."""
    store = VectorStore(spark, scratch_path(spark, "store"))
    texts = TextStore.from_documents(store, "texts", KEY, document_rows(spark, sf), embed.hashing_embedder(TEXT_DIM))
    questions = _read(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = texts.max_marginal_relevance_search(questions, k=3, filters={"lang": "en"})
    return _rounded(hits.select("query_id", "mmr_rank", "id", "score"), "score")


def registry() -> dict:
    return {f.__name__: f for f in (
        knn_many, ivf_many, greedy_filtered_lists, fixture_source, from_texts, generated_ids, arrays_mismatch, absent_fields, null_fields, bad_config, config_spellings,
        wrong_key, get_include, get_documents, delete_documents, retrain_rule, split_lists, train_cost, pq_train_error, collection_recall, auto_probes, adaptive_curve,
        adaptive_recall, store_mmr_ids)}


_LABELS = "SELECT vec_id::VARCHAR AS id, label FROM embeddings"


def _rounds() -> str:
    """Lloyd rounds from the label means: ``means0`` to ``meansN``, and the lists of the last."""
    parts = [oracle._EMB, oracle._MEANS, "means0 AS (SELECT list_id, c FROM means)"]
    for n in range(ROUNDS + 1):
        parts.append(f"""assigned{n} AS (SELECT id, arg_min(list_id, (d, list_id)) AS list_id
            FROM (SELECT id, list_id, list_distance(v, c) AS d FROM items, means{n}) GROUP BY id)""")
        if n < ROUNDS:
            parts.append(f"""cells{n} AS (SELECT list_id, (generate_subscripts(v, 1))::INTEGER AS pos, unnest(v) AS x FROM items JOIN assigned{n} USING (id)),
                sums{n} AS (SELECT list_id, pos, avg(x) AS x FROM cells{n} GROUP BY list_id, pos),
                means{n + 1} AS (SELECT list_id, list(x ORDER BY pos) AS c FROM sums{n} GROUP BY list_id)""")
    return ", ".join(parts)


def _code_rounds() -> str:
    """Lloyd rounds in every sub-space from the parts of the label means, and the codes of the last books."""
    parts = [f"""{oracle._PQ.split("codes AS (")[0]} books0 AS (SELECT sub, code, b FROM books)"""]
    for n in range(ROUNDS + 1):
        parts.append(f"""codes{n} AS (SELECT id, sub, arg_min(code, (list_distance(p, b), code)) AS code FROM parts JOIN books{n} USING (sub) GROUP BY id, sub)""")
        if n < ROUNDS:
            parts.append(f"""code_cells{n} AS (SELECT sub, code, generate_subscripts(p, 1) AS pos, unnest(p) AS x FROM parts JOIN codes{n} USING (id, sub)),
                books{n + 1} AS (SELECT sub, code, list(x ORDER BY pos) AS b FROM (SELECT sub, code, pos, avg(x) AS x FROM code_cells{n} GROUP BY ALL) GROUP BY sub, code)""")
    return ", ".join(parts)


def _recall() -> str:
    rows = []
    for name in ("all", "in", "or"):
        where = "true" if name == "all" else oracle._FILTERS[name]
        for probes in (1, 3, 6):
            pairs = f"""SELECT query_id, id, list_distance(qv, v) AS distance FROM queries JOIN lists USING (query_id) JOIN assigned{ROUNDS} USING (list_id)
                JOIN items USING (id) WHERE n <= {probes} AND ({where})"""
            rows.append(f"""SELECT '{name}' AS filter, {probes}::INTEGER AS n_probes, round(avg(share), 4) AS recall FROM (
                SELECT e.query_id, count(f.id) / count(*) AS share FROM ({oracle._knn('euclidean', 10, where)}) e
                LEFT JOIN ({oracle._top(pairs, 10)}) f ON f.query_id = e.query_id AND f.id = e.id GROUP BY e.query_id)""")
    ranks = f"""lists AS (SELECT query_id, list_id, row_number() OVER (PARTITION BY query_id ORDER BY list_distance(qv, c), list_id) AS n
        FROM queries, means{ROUNDS})"""
    return f"WITH {_rounds()}, {ranks} " + " UNION ALL ".join(rows)


def _reaches(k: int) -> str:
    """Lists by steps beyond the nearest, and the curve of recall at ``k``."""
    return f"""{_rounds()}, gaps AS (SELECT list_id, list_distance(v, c) AS g FROM assigned{ROUNDS} JOIN items USING (id) JOIN means{ROUNDS} USING (list_id)),
        radii AS (SELECT list_id, coalesce(nullif(avg(g), 0), (SELECT avg(g) FROM gaps)) AS r FROM means{ROUNDS} LEFT JOIN gaps USING (list_id) GROUP BY list_id),
        away AS (SELECT query_id, list_id, list_distance(qv, c) AS d FROM queries, means{ROUNDS}),
        home AS (SELECT query_id, min(d) AS d0, arg_min(r, (d, list_id)) AS r FROM away JOIN radii USING (list_id) GROUP BY query_id),
        steps AS (SELECT query_id, list_id, ceil({search.REACH_STEPS} * (d - d0) / r)::INTEGER AS step FROM away JOIN home USING (query_id)),
        truth AS (SELECT * FROM ({oracle._knn('euclidean', k + 1)}) WHERE id <> query_id::VARCHAR),
        hit AS (SELECT step, count(*) AS found FROM truth JOIN assigned{ROUNDS} USING (id) JOIN steps USING (query_id, list_id) GROUP BY step),
        asked AS (SELECT step, count(*) AS n FROM steps GROUP BY step),
        curve AS (SELECT step, (sum(coalesce(found, 0)) OVER (ORDER BY step))::DOUBLE / (SELECT sum(found) FROM hit)::DOUBLE AS recall,
          (sum(n) OVER (ORDER BY step))::DOUBLE / (SELECT count(*) FROM queries) AS lists FROM asked LEFT JOIN hit USING (step)),
        reach AS (SELECT min(step) AS reach FROM curve WHERE recall >= {train.TARGET_RECALL})"""


def _adaptive_recall() -> str:
    rows = []
    for k in (100, 10, 1):
        pairs = f"""SELECT query_id, id, list_distance(qv, v) AS distance FROM queries JOIN steps USING (query_id) JOIN assigned{ROUNDS} USING (list_id)
            JOIN items USING (id) WHERE step <= (SELECT reach FROM reach)"""
        rows.append(f"""SELECT {k}::INTEGER AS k, round(avg(share), 4) AS recall, (SELECT round(count(*)::DOUBLE / (SELECT count(*) FROM queries), 4) FROM steps
            WHERE step <= (SELECT reach FROM reach)) AS lists FROM (SELECT e.query_id, count(f.id) / count(*) AS share
            FROM ({oracle._knn('euclidean', k)}) e LEFT JOIN ({oracle._top(pairs, k)}) f ON f.query_id = e.query_id AND f.id = e.id GROUP BY e.query_id)""")
    return f"WITH {_reaches(100)} " + " UNION ALL ".join(rows)


def statements() -> dict[str, str]:
    known = oracle.statements()
    return {
        "knn_many": known["knn_euclidean"],
        "ivf_many": known["ivf_probe_search"],
        "greedy_filtered_lists": f"""WITH {oracle._EMB}, {oracle._MEANS}, {oracle._ASSIGNED}, {oracle._LIST_RANK},
            sizes AS (SELECT list_id, count(*) AS s FROM assigned JOIN items USING (id) WHERE {oracle._FILTERS['or']} GROUP BY list_id),
            filled AS (SELECT query_id, list_id, n, sum(coalesce(s, 0)) OVER (PARTITION BY query_id ORDER BY n) - coalesce(s, 0) AS before
              FROM list_rank LEFT JOIN sizes USING (list_id))
            SELECT query_id, (n - 1)::INTEGER AS pos, list_id::INTEGER AS list_id FROM filled WHERE before < 40""",
        "fixture_source": """SELECT vec_id::VARCHAR AS id, round(embedding[1]::DOUBLE, 6) AS x0,
            CASE WHEN label % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM embeddings""",
        "from_texts": f"""SELECT item_id::VARCHAR AS id, text AS page_content, {TEXT_DIM}::INTEGER AS dim, 'passage' AS kind, 3::INTEGER AS level FROM benchmark""",
        "generated_ids": "SELECT text AS page_content, count(*) AS n FROM benchmark GROUP BY text",
        "arrays_mismatch": """SELECT vec_id // 10 AS bundle, CASE WHEN (vec_id // 10) % 3 = 0 THEN
            'array length mismatch: ' || count(*) || ' ids but ' || (count(*) - 1) || ' vectors' END AS error FROM embeddings GROUP BY vec_id // 10""",
        "absent_fields": f"""SELECT id, CASE WHEN label % 3 = 0 THEN 'contents,' ELSE '' END || 'id' || CASE WHEN label % 5 <> 0 THEN ',metadata' ELSE '' END
            || CASE WHEN label % 2 = 0 THEN ',vector' ELSE '' END AS fields FROM ({_LABELS})""",
        "null_fields": f"""SELECT id, label % 2 <> 0 AS no_vector, CASE WHEN label % 3 = 0 THEN 'c' || id END AS contents,
            label % 5 = 0 AS no_metadata FROM ({_LABELS})""",
        "bad_config": """SELECT n_nationkey::INTEGER AS n_nationkey, CASE WHEN n_nationkey % 7 = 3 OR n_nationkey % 5 = 1 OR n_nationkey < 4
            OR n_regionkey = 3 THEN 'ValueError' ELSE 'accepted' END AS outcome FROM nation""",
        "config_spellings": f"""SELECT n_nationkey::INTEGER AS n_nationkey, (CASE n_nationkey % 5 WHEN 0 THEN n_nationkey + 1 WHEN 1 THEN n_nationkey + 1
            WHEN 4 THEN 2 ELSE 32 END)::INTEGER AS pq_dim, (CASE n_nationkey % 5 WHEN 2 THEN 4 WHEN 3 THEN 5 ELSE 8 END)::INTEGER AS pq_bits FROM nation""",
        "wrong_key": """SELECT n_nationkey::INTEGER AS n_nationkey, CASE WHEN n_nationkey = (SELECT min(n_nationkey) FROM nation)
            THEN 'accepted' ELSE 'PermissionError' END AS outcome FROM nation""",
        "get_include": """SELECT event_id AS pos, event_id::VARCHAR AS id, 'pos,id,metadata' AS columns, label::INTEGER AS label
            FROM events JOIN embeddings ON vec_id = event_id""",
        "get_documents": """SELECT event_id AS pos, item_id::VARCHAR AS id, text AS page_content FROM events JOIN benchmark ON item_id = event_id % 97""",
        "delete_documents": "SELECT item_id::VARCHAR AS id FROM benchmark WHERE item_id NOT IN (SELECT n_nationkey FROM nation)",
        "retrain_rule": """WITH RECURSIVE n AS (SELECT s::INTEGER AS step, (SELECT count(*) FROM embeddings WHERE label < h) AS n
              FROM (VALUES (0, 1), (1, 4), (2, 6), (3, 100)) t(s, h)),
            r AS (SELECT -1 AS step, CAST(NULL AS BIGINT) AS n_at_train
              UNION ALL SELECT n.step, CASE WHEN (n_at_train IS NULL AND n >= 100) OR n >= 2 * n_at_train THEN n ELSE n_at_train END
              FROM r JOIN n ON n.step = r.step + 1)
            SELECT step::INTEGER AS step, n_at_train IS NOT NULL AS is_trained, n_at_train FROM r WHERE step >= 0""",
        "split_lists": f"""WITH {_rounds()}, sizes AS (SELECT list_id, count(*) > {SPLIT} * (SELECT count(*) FROM items) / (SELECT count(*) FROM means0) AS anew
              FROM assigned{ROUNDS} GROUP BY list_id)
            SELECT id, anew, CASE WHEN NOT anew THEN list_id::INTEGER END AS list_id FROM assigned{ROUNDS} JOIN sizes USING (list_id)""",
        "train_cost": f"""WITH {_rounds()} SELECT list_id::INTEGER AS list_id, count(*) AS n, round(sum(list_distance(v, c) * list_distance(v, c)), 6) AS cost
            FROM assigned{ROUNDS} JOIN items USING (id) JOIN means{ROUNDS} USING (list_id) GROUP BY list_id""",
        "pq_train_error": f"""{_code_rounds()} SELECT sub::INTEGER AS sub, count(*) AS n, round(sum(list_distance(p, b) * list_distance(p, b)), 6) AS error
            FROM parts JOIN codes{ROUNDS} USING (id, sub) JOIN books{ROUNDS} USING (sub, code) GROUP BY sub""",
        "collection_recall": _recall(),
        "auto_probes": f"""WITH {_rounds()}, list_rank AS (SELECT query_id, list_id, row_number() OVER (PARTITION BY query_id ORDER BY list_distance(qv, c), list_id) AS n
              FROM queries, means{ROUNDS}), hits AS ({oracle._knn('euclidean', 21)}),
            near AS (SELECT r.n AS n_probes FROM hits h JOIN assigned{ROUNDS} a ON a.id = h.id
              JOIN list_rank r ON r.query_id = h.query_id AND r.list_id = a.list_id WHERE h.id <> h.query_id::VARCHAR),
            curve AS (SELECT n_probes, round((sum(count(*)) OVER (ORDER BY n_probes))::DOUBLE / (sum(count(*)) OVER ())::DOUBLE, 6) AS recall FROM near GROUP BY n_probes)
            SELECT n_probes::INTEGER AS n_probes, recall, n_probes = (SELECT min(n_probes) FROM curve WHERE recall >= 0.92) AS chosen FROM curve""",
        "adaptive_curve": f"""WITH {_reaches(20)} SELECT step, round(recall, 6) AS recall, round(lists, 6) AS lists,
            step = (SELECT reach FROM reach) AS chosen FROM curve""",
        "adaptive_recall": _adaptive_recall(),
        "store_mmr_ids": _mmr(),
    }


def _mmr() -> str:
    """Three picks out of six hits of the English documents, by the hashed vectors."""
    vectors = "list_cosine_similarity(c.v, {0}.v)"
    return f"""WITH {oracle._TEXT}, hits AS ({oracle._top("FROM text_pairs WHERE lang = 'en'", 6)}),
cand AS (SELECT query_id, rank, h.id, greatest(0.0, 1 - distance / 2) AS score, v FROM hits h JOIN vectors ON key = h.id AND kind = 'd'),
one AS (SELECT * FROM cand WHERE rank = 1),
two AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.query_id ORDER BY
    0.5 * c.score - 0.5 * greatest(0.0, {vectors.format('o')}) DESC, c.rank) AS n
  FROM cand c JOIN one o USING (query_id) WHERE c.rank <> o.rank) WHERE n = 1),
three AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.query_id ORDER BY
    0.5 * c.score - 0.5 * greatest(0.0, {vectors.format('o')}, {vectors.format('t')}) DESC, c.rank) AS n
  FROM cand c JOIN one o USING (query_id) JOIN two t USING (query_id) WHERE c.rank NOT IN (o.rank, t.rank)) WHERE n = 1)
SELECT query_id, 1 AS mmr_rank, id, round(score, 6) AS score FROM one
UNION ALL SELECT query_id, 2, id, round(score, 6) FROM two UNION ALL SELECT query_id, 3, id, round(score, 6) FROM three"""
