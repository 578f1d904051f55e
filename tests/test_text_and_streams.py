"""Text stores, sources, sealing and streams."""

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecspark.functions import contents, embed, protect
from vecspark.plans.collection import VectorStore
from vecspark.plans.text_store import TextStore
from vecspark.plans.workspace import scratch_path
from vecspark.sources import items as item_source
from vecspark.streaming.streams import query_id, query_stream, upsert_stream

KEY = bytes(range(32))
DOCS = [
    ("1", "the cat sat on the mat", {"language": "en", "type": "pet"}),
    ("2", "the dog sat on the log", {"language": "en", "type": "pet"}),
    ("3", "le chat est sur le tapis", {"language": "fr", "type": "pet"}),
    ("4", "stocks fell sharply on monday", {"language": "en", "type": "news"}),
    ("5", "the cat sat on the mat", {"language": "en", "type": "copy"}),
]


def documents(spark):
    return spark.createDataFrame([(i, t, json.dumps(m)) for i, t, m in DOCS], "id string, page_content string, metadata string")


@pytest.fixture
def texts(spark):
    store = VectorStore(spark, scratch_path(spark, "store"))
    return TextStore.from_documents(store, "t", KEY, documents(spark), embed.hashing_embedder(32))


def test_search_score_filter(texts):
    hits = texts.similarity_search_with_score("the cat sat on the mat", k=3).orderBy("rank").collect()
    assert [h["id"] for h in hits[:2]] == ["1", "5"] and hits[0]["score"] == pytest.approx(1.0)
    assert all(0.0 <= h["score"] <= 1.0 for h in hits)
    assert hits[0]["page_content"] == DOCS[0][1] and json.loads(hits[0]["metadata"].toJson()) == DOCS[0][2]
    french = texts.similarity_search("cat", filters={"language": "fr"}).collect()
    assert [h["id"] for h in french] == ["3"]
    assert texts.similarity_search("cat").count() == 4        # default k


def test_by_vector_get_delete_list(spark, texts):
    vector = spark.range(1).select(embed.hashing_embedder(32)(F.lit(DOCS[3][1])).alias("v")).first()["v"]
    assert texts.similarity_search_by_vector_with_score(vector, k=1).first()["id"] == "4"
    assert [r["id"] for r in texts.get(["4", "x", "1"]).collect()] == ["4", "1"]
    assert texts.list_ids({"type": "pet"}).count() == 3
    texts.delete([])
    texts.delete(None)
    assert texts.list_ids().count() == 5
    texts.delete(["4", "x"])
    assert texts.list_ids().count() == 4 and texts.get(["4"]).count() == 0


def test_mmr_prefers_variety(texts):
    plain = [r["id"] for r in texts.similarity_search("the cat sat on the mat", k=2).orderBy("rank").collect()]
    varied = [r["id"] for r in texts.max_marginal_relevance_search("the cat sat on the mat", k=2, fetch_k=5, weight=0.3)
              .orderBy("mmr_rank").collect()]
    assert plain == ["1", "5"] and varied[0] == "1" and varied[1] != "5"
    assert texts.max_marginal_relevance_search("x", k=0).count() == 0


def test_generated_ids_and_shared_metadata(spark, texts):
    added = texts.add_texts(spark.createDataFrame([("same",), ("same",)], "text string"), metadata={"batch": 1})
    ids = [r["id"] for r in added.collect()]
    assert len(set(ids)) == 2
    assert {json.loads(r["metadata"].toJson())["batch"] for r in texts.get(ids).collect()} == {1}
    assert texts.add_texts(spark.createDataFrame([], "text string")).count() == 0
    reopened = TextStore.open(texts.collection.store, "t", KEY, embed.hashing_embedder(32))
    assert reopened.list_ids().count() == 7


def test_given_vectors_are_kept(spark, texts):
    row = spark.createDataFrame([("v", "text", [1.0] * 32)], "id string, page_content string, vector array<double>")
    texts.add_vectors(row)
    assert texts.collection.get(["v"]).first()["vector"] == [1.0] * 32


def test_user_embedder(spark):
    def load():
        return lambda batch: [[float(len(t)), float(t.count("a"))] for t in batch]
    embedder = embed.function_embedder(load)
    df = spark.createDataFrame([("abca",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(embedder("t")).collect()] == [[4.0, 2.0], None, [0.0, 0.0]]
    assert embed.detect_dimension(spark, embedder) == 2
    store = VectorStore(spark, scratch_path(spark, "store"))
    c = store.open_or_create("u", KEY, embedder, metric="euclidean")
    assert c.config["dimension"] == 2
    c.upsert(spark.createDataFrame([("1", "aaa"), ("2", "bbbbbb")], "id string, contents string"))
    assert c.query(contents="aaaa", top_k=1).first()["id"] == "1"


def test_hashing_embedder_whatever_the_partitions(spark):
    embedder = embed.hashing_embedder(16)
    df = spark.createDataFrame([(i, t) for i, t, _ in DOCS] + [("e", ""), ("n", None)], "id string, t string")
    one = {r["id"]: r["v"] for r in df.coalesce(1).select("id", embedder(F.col("t")).alias("v")).collect()}
    many = {r["id"]: r["v"] for r in df.repartition(5).select("id", embedder(F.col("t")).alias("v")).collect()}
    assert one == many and one["n"] is None and one["1"] == one["5"] != one["2"]
    assert np.linalg.norm(one["e"]) == pytest.approx(1.0, abs=1e-5)


def test_pack_and_unpack(spark):
    df = spark.createDataFrame([('{"a": [1, {"b": null}], "_content": "old"}', 'q"uo\\te\n'), (None, None)], "m string, t string")
    packed = df.select(contents.pack_document(F.parse_json("m"), F.col("t")).alias("m"))
    got = packed.select(contents.unpack_text(F.col("m")).alias("t"), F.to_json(contents.unpack_metadata(F.col("m"))).alias("m")).collect()
    assert (got[0]["t"], json.loads(got[0]["m"])) == ('q"uo\\te\n', {"a": [1, {"b": None}]})
    assert (got[1]["t"], json.loads(got[1]["m"])) == ("", {})


def test_seal(spark):
    key, other = protect.key_column(spark, KEY), protect.key_column(spark, bytes(32))
    df = spark.createDataFrame([("a", "secret"), ("b", None)], "id string, t string")
    sealed = df.select("id", "t", protect.seal(F.col("t"), key, F.col("id")).alias("s"))
    opened = sealed.select("id", protect.unseal(F.col("s"), key, F.col("id")).cast("string").alias("t"))
    assert sorted(tuple(r) for r in opened.collect()) == [("a", "secret"), ("b", None)]
    with pytest.raises(Exception):
        sealed.select(protect.unseal(F.col("s"), other, F.col("id"))).collect()
    with pytest.raises(Exception):
        sealed.select(protect.unseal(F.col("s"), key, F.lit("moved"))).collect()
    assert protect.key_from_hex(protect.key_to_hex(KEY)) == KEY
    with pytest.raises(ValueError):
        protect.check_key(b"x")


def test_json_items(spark):
    path = scratch_path(spark, "json")
    rows = spark.createDataFrame([("1", [1.5], bytearray(b"\x00\x01"), '{"k": [1]}'), ("2", None, None, None)],
                                 "id string, vector array<double>, contents binary, metadata string")
    item_source.write_items_json(item_source.item_rows(rows), path)
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert json.loads(lines[0]) == {"id": "1", "vector": [1.5], "contents": "AAE=", "metadata": {"k": [1]}}
    assert json.loads(lines[1]) == {"id": "2"}
    back = item_source.read_items_json(spark, path, binary_contents=True).orderBy("id").collect()
    assert bytes(back[0]["contents"]) == b"\x00\x01" and back[1]["vector"] is None


def test_recall_fixture(spark, tmp_path):
    whole = {
        "vectors": [[0.0, 1.0], [1.0, 0.0], [1.0, 1.0]], "queries": [[0.0, 0.9]],
        "metadata": [{"number": 0}, {"number": 1}, {"number": 0}], "metadata_queries": [{"number": 0}],
        "metadata_query_names": ["zero"], "untrained_neighbors": [[0, 2, 1]], "trained_neighbors": [[0, 2, 1]],
        "untrained_metadata_matches": [[0, 2]], "trained_metadata_matches": [[0, 2]],
        "untrained_metadata_neighbors": [[[0, 1, -1]]], "trained_metadata_neighbors": [[[0, 1, -1]]],
        "untrained_recall": 1.0, "trained_recall": 0.9, "num_untrained_vectors": 2, "num_trained_vectors": 3}
    path = tmp_path / "fixture.json"
    path.write_text(json.dumps(whole))
    frames = item_source.read_recall_fixture(spark, str(path))
    store = VectorStore(spark, scratch_path(spark, "store"))
    c = store.create("f", KEY)
    c.upsert(frames["items"])
    f = frames["filters"].first()
    hits = c.query(frames["queries"], top_k=3, filters=json.loads(f["filter"]), include=()).orderBy("rank").collect()
    assert [int(h["id"]) for h in hits] == [f["untrained_metadata_matches"][p] for p in f["untrained_metadata_neighbors"][0] if p >= 0]
    plain = c.query(frames["queries"], top_k=3, include=()).orderBy("rank").collect()
    assert [int(h["id"]) for h in plain] == frames["neighbors"].first()["untrained"]
    assert frames["figures"].first()["trained_recall"] == 0.9


def test_streams(spark):
    store = VectorStore(spark, scratch_path(spark, "store"))
    c = store.create("s", KEY)
    rows = spark.range(40).select(F.col("id").cast("string").alias("id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    path, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
    rows.repartition(4).write.parquet(path)

    def run():
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
        upsert_stream(stream, c, checkpoint, available_now=True).awaitTermination()

    run()
    assert c.num_vectors().first()["num_vectors"] == 40
    version = c.state()["version"]
    run()                                                  # nothing new
    assert c.state()["version"] == version
    c.upsert(rows, applied=(query_id(spark, checkpoint), 3))      # a repeated batch is skipped
    assert c.state()["version"] == version
    other = rows.select(F.concat("id", F.lit("b")).alias("id"), "vector")
    opath = scratch_path(spark, "in")
    other.union(other.limit(1).withColumn("id", F.lit(""))).write.parquet(opath)
    stream, rejects = spark.readStream.schema(rows.schema).parquet(opath), scratch_path(spark, "rejects")
    with pytest.raises(ValueError, match="rejects"):
        upsert_stream(stream, c, scratch_path(spark, "cp"), mode="split")
    upsert_stream(stream, c, scratch_path(spark, "cp"), available_now=True, mode="split", rejects=rejects).awaitTermination()
    assert c.num_vectors().first()["num_vectors"] == 80 and spark.read.parquet(rejects).count() == 1
    c.delete(other.select("id"))
    rows.where("id = '7'").withColumn("vector", F.array(F.lit(-5.0), F.lit(1.0))).write.mode("append").parquet(path)
    run()
    assert c.get(["7"]).first()["vector"] == [-5.0, 1.0] and c.num_vectors().first()["num_vectors"] == 40

    target = scratch_path(spark, "hits")
    queries = rows.select(F.col("id").cast("long").alias("query_id"), F.col("vector").alias("qv"))
    qpath = scratch_path(spark, "q")
    queries.write.parquet(qpath)
    stream = spark.readStream.schema(queries.schema).parquet(qpath)
    query_stream(stream, c, target, scratch_path(spark, "cp"), available_now=True, top_k=1, include=("distance",)).awaitTermination()
    best = {r["query_id"]: r["id"] for r in spark.read.parquet(target).collect()}
    assert best[12] == "12" and len(best) == 40


def test_ordered_embedder_tells_the_order_of_words(spark):
    """Places of words and the whole text count: the same words in another order, or in other case, give another vector."""
    embedder = embed.ordered_embedder(16)
    texts = ["a b c d", "d c b a", "A b c d", "a b c d", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(3)
    v = [r["v"] for r in rows.select("id", embedder(F.col("t")).alias("v")).orderBy("id").collect()]
    assert v[0] == v[3] and v[0] != v[1] and v[0] != v[2] and v[4] is None
    assert all(abs(sum(x * x for x in one) - 1) < 1e-4 for one in v if one is not None)


def test_embedders_add_up_bounded_runs_of_words(spark, monkeypatch):
    """Each run is within the bound or one text; runs of one batch give the vectors of rows alone."""
    rows = [(0, "a b"), (1, "c d " * 80_000), (2, None), (3, "e f g " * 60_000), (4, ""), (5, "h")]
    texts = spark.createDataFrame(rows, "id int, text string")
    for embedder in (embed.hashing_embedder(16), embed.ordered_embedder(16)):
        one, many = (t.select("id", embedder(F.col("text")).alias("v")).orderBy("id").collect() for t in (texts.coalesce(1), texts.repartition(6, "id")))
        assert one == many
    words = pa.array([[], [1, 2, 3], [4], [], [5] * 9, [6, 7], []], pa.list_(pa.int64())).slice(1)
    monkeypatch.setattr(embed, "RUN_WORDS", 4)
    assert list(embed._runs(words)) == [(0, 3), (3, 1), (4, 2)]
