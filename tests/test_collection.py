"""Collections end to end, after the reference's integration flows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.operators import search as search_module
from vecspark.operators import train
from vecspark.operators.evaluate import mean_recall
from vecspark.operators.search import search
from vecspark.plans.catalog import VersionConflict
from vecspark.plans.collection import CollectionExists, NoSuchCollection, VectorStore, normalize_config
from vecspark.plans.workspace import scratch_path

KEY = bytes(range(32))


@pytest.fixture
def store(spark):
    return VectorStore(spark, scratch_path(spark, "store"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, vector array<double>, metadata string")


def vectors(n, dim=8, seed=1):
    return np.random.default_rng(seed).normal(size=(n, dim))


def filled(spark, store, name="c", n=60, **options):
    c = store.create(name, KEY, **options)
    rows = [(str(i), v.tolist(), json.dumps({"number": i % 5, "owner": {"name": f"o{i % 3}"}}))
            for i, v in enumerate(vectors(n))]
    c.upsert(frame(spark, rows), auto_train=False)
    return c, rows


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


# -- catalog ------------------------------------------------------------------

def test_create_list_describe_drop(spark, store):
    assert store.list().collect() == []
    store.create("a", KEY, {"type": "ivfpq", "dimension": 128})
    store.create("b", KEY, metric="cosine")
    assert sorted(r["index_name"] for r in store.list().collect()) == ["a", "b"]
    row = store.describe("a").first()
    assert (row["index_type"], row["is_trained"], row["index_config"]["pq_dim"], row["index_config"]["pq_bits"]) == ("ivfpq", False, 32, 8)
    with pytest.raises(CollectionExists):
        store.create("a", KEY)
    assert store.drop("a", KEY) is True
    assert [r["index_name"] for r in store.list().collect()] == ["b"]
    with pytest.raises(NoSuchCollection):
        store.load("a", KEY)
    with pytest.raises(NoSuchCollection):
        store.drop("a", KEY)
    assert store.drop("a", KEY, if_exists=True) is False
    store.create("a", KEY)       # the name is free again
    assert store.load("a", KEY).index_type == "ivfflat"
    assert store.open_or_create("a", KEY).name == "a"


@pytest.mark.parametrize("call", [
    dict(name="", key=KEY), dict(name="x", key=b"short"), dict(name="x", key=KEY, metric="manhattan"),
    dict(name="x", key=KEY, config={"dimension": -1}), dict(name="x", key=KEY, config={"type": "hnsw"}),
    dict(name="x", key=KEY, config={"type": "ivfpq", "dimension": 10, "pq_dim": 3}),
])
def test_bad_configuration(store, call):
    with pytest.raises(ValueError):
        store.create(**call)


def test_config_spellings():
    assert normalize_config({"type": "ivfpq", "pqDim": 4, "pqBits": 6}) == normalize_config({"type": "ivfpq", "pq_dim": 4, "pq_bits": 6})
    assert normalize_config(None)["type"] == "ivfflat"
    assert normalize_config({"dimension": 0})["dimension"] is None


def test_wrong_key(spark, store):
    filled(spark, store)
    with pytest.raises(PermissionError):
        store.load("c", bytes(32))


# -- rows -----------------------------------------------------------------------

@pytest.mark.parametrize("seal", [True, False])
def test_get_keeps_order_and_skips_unknown(spark, store, seal):
    c, rows = filled(spark, store, seal=seal)
    got = c.get(["7", "nope", "3"]).collect()
    assert [r["id"] for r in got] == ["7", "3"]
    assert got[0]["vector"] == rows[7][1]
    assert json.loads(got[1]["metadata"].toJson()) == json.loads(rows[3][2])
    assert c.get(["1"], include=("metadata", "bogus")).columns == ["pos", "id", "metadata"]


def test_contents_round_trip(spark, store):
    c = store.create("c", KEY)
    text = spark.createDataFrame([("t", [1.0], "hällo")], "id string, vector array<double>, contents string")
    data = spark.createDataFrame([("b", [2.0], bytearray(b"\x00\xff"))], "id string, vector array<double>, contents binary")
    c.upsert(text)
    c.upsert(data)
    got = {r["id"]: (bytes(r["contents"]), r["is_text"]) for r in c.get(["t", "b"]).collect()}
    assert got == {"t": ("hällo".encode(), True), "b": (b"\x00\xff", False)}


def test_large_metadata_round_trip(spark, store):
    big = {"long": "x" * 1000, "deep": {"a": {"b": {"c": [1, 2, {"d": None}]}}}, "objects": [{"i": i} for i in range(100)]}
    c = store.create("c", KEY)
    c.upsert(frame(spark, [("1", [0.5, 0.5], json.dumps(big))]))
    assert json.loads(c.get(["1"]).first()["metadata"].toJson()) == big


def test_upsert_replaces_whole_rows_and_last_of_a_batch_counts(spark, store):
    c, _ = filled(spark, store)
    c.upsert(frame(spark, [("3", [9.0] * 8, None), ("3", [1.0] * 8, '{"x": 1}'), ("new", [2.0] * 8, None)]).coalesce(1))
    got = {r["id"]: r for r in c.get(["3", "new"]).collect()}
    assert got["3"]["vector"] == [1.0] * 8 and json.loads(got["3"]["metadata"].toJson()) == {"x": 1}
    assert got["new"]["metadata"] is None
    assert c.num_vectors().first()["num_vectors"] == 61
    again = frame(spark, [("3", [1.0] * 8, '{"x": 1}')])
    c.upsert(again)
    c.upsert(again)
    assert c.num_vectors().first()["num_vectors"] == 61


def test_delete_then_absent_everywhere_and_back_again(spark, store):
    c, rows = filled(spark, store)
    c.delete(["1", "2", "unknown"])
    assert c.get(["1", "2"]).count() == 0
    assert "1" not in ids(c.list_ids()) and len(ids(c.list_ids())) == 58
    assert "1" not in ids(c.query([rows[1][1]], top_k=60, include=()))
    c.upsert(frame(spark, [rows[1]]))
    assert ids(c.get(["1", "2"])) == ["1"]
    c.compact()
    assert len(ids(c.list_ids())) == 59
    c.delete([])
    assert len(ids(c.list_ids())) == 59


def test_empty_collection(spark, store):
    c = store.create("c", KEY, {"dimension": 4})
    assert c.list_ids().count() == 0 and c.num_vectors().first()["num_vectors"] == 0
    assert c.query([[1.0, 2.0, 3.0, 4.0]]).count() == 0
    c.upsert(frame(spark, []))
    assert c.list_ids().count() == 0
    with pytest.raises(ValueError):
        c.train()


def test_bad_rows_stop_or_split(spark, store):
    c, _ = filled(spark, store)
    bad = frame(spark, [("ok", [1.0] * 8, None), ("short", [1.0] * 7, None), ("nan", [float("nan")] * 8, None)])
    with pytest.raises(ValueError, match="Invalid item"):
        c.upsert(bad)
    assert c.num_vectors().first()["num_vectors"] == 60
    rejected = c.upsert(bad, mode="split")
    assert ids(rejected) == ["nan", "short"]
    assert ids(c.get(["ok", "short", "nan"])) == ["ok"]


def test_parallel_arrays(spark, store):
    c = store.create("c", KEY)
    pair = spark.createDataFrame([(["a", "b"], [[1.0, 0.0], [0.0, 1.0]])], "ids array<string>, vectors array<array<double>>")
    c.upsert_arrays(pair)
    assert ids(c.list_ids()) == ["a", "b"]
    uneven = spark.createDataFrame([(["a", "b"], [[1.0, 0.0]])], "ids array<string>, vectors array<array<double>>")
    with pytest.raises(Exception, match="length mismatch"):
        c.upsert_arrays(uneven)


def test_two_writers_both_survive(spark, store):
    c, _ = filled(spark, store)
    stale = c.state()
    c.upsert(frame(spark, [("w1", [1.0] * 8, None)]))
    segment = c._write_segment(c._coded(frame_items(spark, [("w2", [2.0] * 8)]), stale), stale)
    extent = c._extent(f"{stale['folder']}/items/seg={segment}")
    assert c._note_removals(frame_items(spark, [("w2", [2.0] * 8)]).select("id"), extent, stale) is None
    with pytest.raises(VersionConflict):      # w1 came meanwhile and might have been w2: the upsert starts over
        c._commit_rows(stale, segment, extent, None, None)
    c.upsert(frame(spark, [("w2", [2.0] * 8, None)]))
    assert ids(c.get(["w1", "w2"])) == ["w1", "w2"]
    with pytest.raises(VersionConflict):
        c.catalog.commit(stale)      # a version is committed once


def frame_items(spark, rows):
    from vecspark.sources.items import item_rows
    return item_rows(spark.createDataFrame(rows, "id string, vector array<double>"))


def contents_of(c):
    return sorted((r["id"], r["vector"][0]) for r in c.items().select("id", "vector").collect())


def test_fold_keeps_the_large_segment_and_every_change(spark, store, monkeypatch):
    import vecspark.plans.collection as module
    c, _ = filled(spark, store)
    for i in range(4):
        c.upsert(frame(spark, [("5", [float(i)] * 8, None), (f"n{i}", [float(i)] * 8, None)]))
        c.delete([f"{10 + i}", f"n{i - 1}"])
    before, state = contents_of(c), c.state()
    assert ("5", 3.0) in before and ("n3", 3.0) in before and ("n2", 2.0) not in before
    c.fold()
    after = c.state()
    assert contents_of(c) == before
    assert after["segments"][0] == state["segments"][0] and len(after["segments"]) == 2 and len(after["removals"]) == 1
    c.upsert(frame(spark, [("10", [7.0] * 8, None)]))
    assert ("10", 7.0) in contents_of(c)
    monkeypatch.setattr(module, "MAX_SEGMENTS", 2)
    c.delete(["10"])
    assert contents_of(c) == before and len(c.state()["removals"]) == 1
    monkeypatch.setattr(module, "MAX_REMOVALS", 1)
    c.delete(["20", "21"])
    assert len(contents_of(c)) == len(before) - 2      # beyond the bound removals are shuffled, nothing is rewritten
    c.compact()
    assert len(c.state()["segments"]) == 1 and c.state()["removals"] == [] and len(contents_of(c)) == len(before) - 2


def test_new_ids_leave_old_rows_alone(spark, store):
    c, _ = filled(spark, store)
    first = c.state()["segments"]
    for i in range(3):
        c.upsert(frame(spark, [(f"new{i}-{j}", [float(j)] * 8, None) for j in range(5)]))
    c.delete(["unknown"])
    state = c.state()
    assert state["removals"] == [] and state["segments"][0] == first[0] and len(state["segments"]) == 4


def test_every_bad_row_is_reported_before_ids_are_made_one(spark, store):
    c, _ = filled(spark, store)
    bad = [("", [1.0] * 8, None), ("", [2.0] * 8, None), ("d", [float("nan")] * 8, None), ("d", [3.0] * 8, None)]
    rejects = scratch_path(spark, "rejects")
    found = c.upsert(frame(spark, bad), mode="split", rejects=rejects)
    assert found.count() == spark.read.parquet(rejects).count() == 3
    assert c.get(["d"]).first()["vector"] == [3.0] * 8
    with pytest.raises(ValueError, match="finite"):
        c.upsert(frame(spark, bad[2:]))


def test_half_a_record_hides_nothing(spark, store):
    c, _ = filled(spark, store)
    state = c.state()
    files = c.catalog._files()
    path = c.catalog._path(f"{c.catalog._record_folder('c')}/{state['version'] + 1:012d}.json")
    files.create(path, False).close()
    assert c.state() == state and [r["index_name"] for r in c.catalog.table().collect()] == ["c"]
    with pytest.raises(VersionConflict):
        c.catalog.commit(state)


def test_greedy_fills_up_from_the_rows_that_match(spark, store):
    c = store.create("g", KEY)
    rows = [(str(i), [float(i % 30), float(i // 30)], f'{{"rare": {i % 20 == 0}}}'.lower()) for i in range(600)]
    c.upsert(spark.createDataFrame(rows, "id string, vector array<double>, metadata string").withColumn("metadata", F.parse_json("metadata")),
             auto_train=False)
    c.train(n_lists=25)
    hits = c.query([[3.0, 3.0], [29.0, 1.0]], top_k=12, filters={"rare": True}, greedy=True)
    assert {r["n"] for r in hits.groupBy("query_id").agg(F.count("*").alias("n")).collect()} == {12}


def test_many_removals_look_for_what_exists(spark, store):
    c, _ = filled(spark, store)
    c.delete(["1", "2", "u1", "u2"])
    assert c.state()["removals"][0]["n"] == 2
    c.upsert(frame(spark, [("3", [0.0] * 8, None), ("x", [0.0] * 8, None)]))
    assert c.state()["removals"][1]["n"] == 1 and len(contents_of(c)) == 59


def test_changes_during_training_survive(spark, store, monkeypatch):
    c, rows = filled(spark, store)
    real = c._replace

    def late(*args, **kwargs):
        monkeypatch.undo()
        c.upsert(frame(spark, [("3", [5.0] * 8, None), ("late", [6.0] * 8, None)]), auto_train=False)
        c.delete(["4", "late2"])
        real(*args, **kwargs)

    monkeypatch.setattr(c, "_replace", late)
    c.train(n_lists=4, max_iters=3)
    got = dict(contents_of(c))
    assert c.is_trained and got["3"] == 5.0 and got["late"] == 6.0 and "4" not in got and len(got) == 60
    assert c._stored(c.state()).where("list_id < 0").count() == 0
    hits = c.query([[6.0] * 8], top_k=1, n_probes=1, include=("distance",)).first()
    assert hits["id"] == "late"


def test_vacuum_keeps_what_is_used(spark, store):
    c, _ = filled(spark, store)
    c.delete(["1"])
    c.compact()
    assert c.vacuum() == 0
    assert c.vacuum(older_than_seconds=0) == 2
    assert len(ids(c.list_ids())) == 59


# -- search -------------------------------------------------------------------------

def expected(rows, query, k, keep=lambda m: True):
    found = [(float(np.linalg.norm(np.array(v) - query)), i) for i, v, m in rows if keep(json.loads(m))]
    return [i for _, i in sorted(found)[:k]]


@pytest.mark.parametrize("seal", [True, False])
def test_filter_is_part_of_the_query(spark, store, seal):
    c, rows = filled(spark, store, seal=seal, metadata_columns={"number": "bigint", "owner.name": "string"})
    query = vectors(1, seed=9)[0]
    for filters, keep in (
        ({"number": 0}, lambda m: m["number"] == 0),
        ({"number": {"$gte": 3}, "owner.name": "o1"}, lambda m: m["number"] >= 3 and m["owner"]["name"] == "o1"),
        ({"$or": [{"number": 1}, {"owner.name": {"$in": ["o2"]}}]}, lambda m: m["number"] == 1 or m["owner"]["name"] == "o2"),
        ({"number": 77}, lambda m: False),
    ):
        hits = c.query([query.tolist()], top_k=7, filters=filters).orderBy("rank").collect()
        assert [h["id"] for h in hits] == expected(rows, query, 7, keep)
    assert ids(c.list_ids({"number": 2})) == sorted(i for i, _, m in rows if json.loads(m)["number"] == 2)


def test_query_forms(spark, store):
    c, rows = filled(spark, store)
    one = c.query(rows[4][1], top_k=1)
    assert one.columns == ["query_id", "rank", "id", "distance", "metadata"] and one.first()["id"] == "4"
    many = c.query([rows[4][1], rows[5][1]], top_k=1, include=("vector",)).orderBy("query_id").collect()
    assert [r["id"] for r in many] == ["4", "5"] and many[0]["vector"] == rows[4][1]
    for bad in (dict(), dict(queries=[]), dict(queries=[[]]), dict(queries=[1.0, 2.0]), dict(contents="text")):
        with pytest.raises(ValueError):
            c.query(**bad)
    with pytest.raises(ValueError):
        c.query(rows[0][1], top_k=0)


@pytest.mark.parametrize("kind,metric", [
    ("ivf", "euclidean"), ("ivfflat", "cosine"), ("ivfpq", "squared_euclidean"), ("ivfpq", "cosine")])
def test_trained_with_all_lists_is_exact(spark, store, metric, kind):
    c = store.create("c", KEY, {"type": kind, "pq_dim": 4, "pq_bits": 4}, metric)
    data = vectors(300, 16)
    data[::50] = 0.0
    items = [(str(i), v.tolist(), None) for i, v in enumerate(data)]
    c.upsert(frame(spark, items[:250]), auto_train=False)
    queries = vectors(5, 16, seed=3).tolist()
    before = c.query(queries, top_k=10, include=("distance",))
    assert before.count() == 50
    c.train(n_lists=6, max_iters=5)
    c.upsert(frame(spark, items[250:]), auto_train=False)      # searchable at once
    assert c.is_trained and c.num_vectors().first()["num_vectors"] == 300
    found = c.query(queries, top_k=300 if kind == "ivfpq" else 10, n_probes=6, include=("distance",))
    q = spark.createDataFrame(list(enumerate(queries)), "query_id long, qv array<double>")
    exact = search(q, c.items().select("id", "vector"), 10, metric)
    same = [tuple(r) for r in found.where("rank <= 10").orderBy("query_id", "rank").collect()]
    assert same == [tuple(r) for r in exact.orderBy("query_id", "rank").collect()]
    auto = c.query(queries, top_k=10, include=())
    assert mean_recall(auto, exact).first()["recall"] > 0.5
    assert c.query(queries, top_k=10, greedy=True).count() == 50


def test_automatic_training(spark, store):
    c = store.create("c", KEY, min_train_rows=50, retrain_multiplier=2.0)
    data = vectors(140)
    rows = [(str(i), v.tolist(), None) for i, v in enumerate(data)]
    c.upsert(frame(spark, rows[:40]))
    assert not c.is_trained
    c.upsert(frame(spark, rows[:60]))
    assert c.is_trained and c.state()["n_at_train"] == 60
    c.upsert(frame(spark, rows[60:100]))
    assert c.state()["n_at_train"] == 60
    c.upsert(frame(spark, rows[100:]))
    assert c.state()["n_at_train"] == 140


def test_key_is_in_no_plan(spark, store, capsys):
    c, rows = filled(spark, store)
    c.query(rows[0][1], filters={"number": 1}).explain(True)
    text = capsys.readouterr().out.lower()
    assert KEY.hex() not in text and "000102030405" not in text


def numbered(spark, low, high, width=4):
    return spark.range(low, high).select(F.format_string("k%06d", "id").alias("id"), F.array([F.col("id").cast("double")] * width).alias("vector"))


def test_get_and_payload_read_only_files_with_hits(spark):
    c = VectorStore(spark, scratch_path(spark, "store")).create("many", KEY, {"type": "ivfflat"})
    for i in range(6):
        c.upsert(numbered(spark, 100 * i, 100 * i + 100), auto_train=False)
    state = c.state()
    assert [(s["lo"], s["hi"]) for s in state["segments"]][2] == ("k000200", "k000299")
    one = c._near(state, spark.createDataFrame([("k000250",), ("k000251x",)], "id string"))
    every = c._stored(state).inputFiles()
    assert 0 < len(one.inputFiles()) < len(every) and all(state["segments"][2]["name"] in f for f in one.inputFiles())
    assert c._near(state, spark.createDataFrame([("zzz",)], "id string")).count() == 0
    assert c._near(state, spark.createDataFrame([], "id string")).count() == 0
    assert [r.id for r in c.get(["k000599", "nothing", "k000000"]).collect()] == ["k000599", "k000000"]
    hits = c.query([[5.0] * 4, [505.0] * 4], top_k=2, include=("distance", "vector")).collect()
    assert {(h.query_id, h.id, tuple(h.vector)) for h in hits if h.rank == 1} == {(0, "k000005", (5.0,) * 4), (1, "k000505", (505.0,) * 4)}


def test_upsert_reads_only_segments_within_its_bounds(spark, monkeypatch):
    c = VectorStore(spark, scratch_path(spark, "store")).create("many", KEY, {"type": "ivfflat"})
    for i in range(5):
        c.upsert(numbered(spark, 100 * i, 100 * i + 100), auto_train=False)
    read, whole = [], type(c)._stored
    monkeypatch.setattr(type(c), "_stored", lambda self, state, segments=None, files=None: read.append(segments) or whole(self, state, segments, files))
    c.upsert(numbered(spark, 1000, 1100), auto_train=False)
    assert read == [] and len(c.state()["removals"]) == 0
    c.upsert(numbered(spark, 250, 260), auto_train=False)
    assert [[s["lo"] for s in segments] for segments in read] == [["k000200"]]
    c.delete(["k000300", "k000001", "unknown"])
    c.delete(["x"])
    c.compact()
    ids = {r.id for r in c.list_ids().collect()}
    assert ids == {f"k{i:06d}" for i in [*range(500), *range(1000, 1100)]} - {"k000300", "k000001"}
    assert (c.state()["segments"][0]["lo"], c.state()["segments"][0]["hi"]) == ("k000000", "k001099")


def test_automatic_probes_follow_the_given_calibration(spark, store):
    c = store.create("c", KEY)
    data = vectors(300, 16)
    c.upsert(frame(spark, [(f"k{i}", v.tolist(), None) for i, v in enumerate(data)]), auto_train=False)
    own = spark.createDataFrame([(f"k{i}", data[i].tolist()) for i in range(40)], "query_id string, qv array<double>")
    c.train(n_lists=8, max_iters=5, calibration=own, calibration_k=5)
    state = c.state()
    assert "calibration_rows=40 calibration=given calibration_k=5" in state["training"] and state["reach"] is not None
    found = c.query(own, top_k=6, include=("distance",))
    exact = search(own, c.items().select("id", "vector"), 6, "euclidean")
    assert mean_recall(found, exact).first()["recall"] >= 0.9
    c.train(n_lists=8, max_iters=5, calibration=own.limit(0))      # nothing to learn from: the nearest list
    assert c.state()["reach"] is None and c.query(own, top_k=6).count() > 0
    numbers = spark.createDataFrame([(i, data[i].tolist()) for i in range(10)], "query_id long, qv array<double>")
    c.train(n_lists=1, calibration=numbers)
    assert c.query(own, top_k=6).count() == 240


@pytest.mark.parametrize("few", [True, False])
def test_quantised_search_reads_vectors_and_payload_once(spark, monkeypatch, few):
    c = VectorStore(spark, scratch_path(spark, "store")).create("q", KEY, {"type": "ivfpq", "pq_dim": 4, "pq_bits": 4})
    data = vectors(400, 8)
    rows = [(f"k{i:04d}", v.tolist(), f'{{"n": {i}}}') for i, v in enumerate(data)]
    c.upsert(frame(spark, rows[:200]), auto_train=False)
    c.train(n_lists=4, max_iters=5)
    c.upsert(frame(spark, rows[200:]), auto_train=False)
    c.delete(["k0000", "k0250"])
    if not few:
        monkeypatch.setattr(search_module, "MAX_QUERY_BYTES", 0)
    near, looked = type(c)._near, []
    monkeypatch.setattr(type(c), "_near", lambda self, state, ids, lists=None: looked.append(lists) or near(self, state, ids, lists))
    queries = [data[0].tolist(), data[250].tolist(), data[399].tolist()]
    hits = c.query(queries, top_k=5, n_probes=2, include=("distance", "metadata", "vector")).collect()
    assert len(looked) == 1 and 2 <= len(looked[0]) <= 4
    assert len(hits) == 15 and not {h.id for h in hits} & {"k0000", "k0250"}
    for h in hits:
        at = int(h.id[1:])
        assert h.vector == pytest.approx(data[at].tolist()) and h.metadata.toPython() == {"n": at}
        assert h.distance == pytest.approx(float(np.linalg.norm(data[at] - np.array(queries[h.query_id]))), abs=1e-5)
    assert [h.rank for h in sorted(hits, key=lambda h: (h.query_id, h.distance, h.id))] == [1, 2, 3, 4, 5] * 3
    assert next(h.id for h in hits if h.query_id == 2 and h.rank == 1) == "k0399"


def test_near_looks_only_into_the_lists_it_is_told(spark):
    c = VectorStore(spark, scratch_path(spark, "store")).create("l", KEY, {"type": "ivfflat"})
    c.upsert(numbered(spark, 0, 200), auto_train=False)
    c.train(n_lists=4, max_iters=5)
    state = c.state()
    stored = c._stored(state)
    ids = stored.select("id")
    one = stored.first().list_id
    assert {r.list_id for r in c._near(state, ids, [one]).select("list_id").distinct().collect()} == {one}
    assert c._near(state, ids, [one]).count() == stored.where(F.col("list_id") == one).count()
    assert c._near(state, ids, [99]).count() == 0


def bunch(spark, centre, low, high, width=8, seed=0):
    data = np.random.default_rng(seed + low).normal(size=(high - low, width)) * 0.3 + centre
    return frame(spark, [(f"k{low + i:05d}", v.tolist(), None) for i, v in enumerate(data)])


@pytest.mark.parametrize("kind", ["ivfflat", "ivfpq"])
def test_split_rewrites_only_lists_that_have_grown(spark, store, kind):
    c = store.create("s", KEY, {"type": kind, "pq_dim": 4, "pq_bits": 4})
    for i in range(4):
        c.upsert(bunch(spark, 5.0 * i, 100 * i, 100 * i + 100), auto_train=False)
    with pytest.raises(ValueError):
        c.split_lists()
    start = spark.createDataFrame([(i, [5.0 * i] * 8) for i in range(4)], "list_id int, centroid array<double>")
    c.train(initial=start)
    assert c.split_lists() == 0
    c.upsert(bunch(spark, 0.5, 1000, 1600), auto_train=False)
    c.upsert(bunch(spark, -0.5, 2000, 2600), auto_train=False)
    c.delete(["k00000", "k01000", "k00300"])
    before = {r.id: tuple(r.vector) for r in c.items().collect()}
    files = set(c._stored(c.state()).inputFiles())
    sizes = train.size_array(c._stored(c.state()), 4)
    assert sizes.tolist() == [1298, 100, 100, 99] and list(train.grown_lists(sizes, 0.2)) == [0]
    new = c.split_lists()
    state = c.state()
    assert new >= 2 and state["n_lists"] == 4 + new and state["n_at_train"] == 1597
    assert {r.id: tuple(r.vector) for r in c.items().collect()} == before
    kept = {f for f in files if "list_id=0" not in f}
    live = c._stored(state)
    assert kept <= set(live.inputFiles()) and live.groupBy("id").count().where("count > 1").count() == 0
    after = train.size_array(live, state["n_lists"])
    assert after.sum() == 1597 and after.max() < 1298 and after[1:4].tolist() == [100, 100, 99]
    # rows are in the list that is nearest, so that one probe finds a stored row
    own = live.where("list_id >= 0").select(F.col("id").alias("query_id"), F.col("vector").cast("array<double>").alias("qv"))
    if kind == "ivfflat":
        found = c.query(own, top_k=1, n_probes=1, include=())
        assert found.where("id = query_id").count() == 1597
    else:
        assert live.where("codes is null").count() == 0
    # later writes know the new lists, removals reach split rows, and folding drops what was left out
    c.upsert(bunch(spark, 0.5, 1000, 1100, seed=7), auto_train=False)
    c.delete(["k01200"])
    assert c.num_vectors().first()["num_vectors"] == 1597 and c.get(["k01200", "k01000"]).count() == 1
    c.compact()
    assert c.num_vectors().first()["num_vectors"] == 1597 and not any(s.get("gone") for s in c.state()["segments"])
    assert c._stored(c.state()).groupBy("id").count().where("count > 1").count() == 0


def test_split_of_copies_and_lost_race(spark, store, monkeypatch):
    c = store.create("s", KEY)
    c.upsert(bunch(spark, 0.0, 0, 50).union(bunch(spark, 9.0, 50, 100)), auto_train=False)
    start = spark.createDataFrame([(0, [0.0] * 8), (1, [9.0] * 8)], "list_id int, centroid array<double>")
    c.train(initial=start)
    copies = spark.range(200, 900).select(F.format_string("k%05d", "id").alias("id"), F.array([F.lit(9.0)] * 8).alias("vector"))
    c.upsert(copies, auto_train=False)
    c.split_lists()                                            # copies cannot be told apart, the others can
    assert c.num_vectors().first()["num_vectors"] == 800
    c.upsert(bunch(spark, 0.0, 3000, 3900), auto_train=False)
    calibrated = type(c)._calibrated

    def overtaken(self, *args):
        monkeypatch.undo()
        c.delete(["k00001"])
        return calibrated(self, *args)

    monkeypatch.setattr(type(c), "_calibrated", overtaken)
    with pytest.raises(VersionConflict):
        c.split_lists()
    assert c.num_vectors().first()["num_vectors"] == 1699 and c.split_lists() > 0
    assert c.num_vectors().first()["num_vectors"] == 1699
