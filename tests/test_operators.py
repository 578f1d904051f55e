"""Operators on small hostile frames: block paths, skew, validation, ordering, recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.functions import distance
from vecspark.operators import evaluate, merge, mmr, pq, search, train, validate


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def items(spark):
    data = np.random.default_rng(2).normal(size=(400, 8))
    data[::3] = data[0]           # a third of all rows are copies
    frame = [(f"i{n}", v.tolist(), n % 4) for n, v in enumerate(data)]
    return spark.createDataFrame(frame, "id string, vector array<double>, list_id int").repartition(5).persist()


@pytest.fixture(scope="module")
def queries(spark):
    data = np.random.default_rng(6).normal(size=(23, 8))
    return spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(data)], "query_id long, qv array<double>").persist()


def by_columns(queries, items, k, metric):
    """The same search with Column expressions over all pairs, as a check."""
    pairs = queries.crossJoin(items.select("id", "vector"))
    d = distance.distance(metric, F.col("qv"), F.col("vector"))
    return search.rank_hits(pairs.select("query_id", "id", d.alias("distance")), k)


@pytest.mark.parametrize("metric", distance.METRICS)
def test_block_scan_equals_column_form(queries, items, metric):
    found = search.search(queries, items, 12, metric)
    assert rows(found, "query_id", "rank") == rows(by_columns(queries, items, 12, metric), "query_id", "rank")


def test_query_sets_beyond_one_block(queries, items, monkeypatch):
    whole = rows(search.search(queries, items, 5, "euclidean", ("list_id",)), "query_id", "rank")
    monkeypatch.setattr(search, "MAX_QUERY_ROWS", 7)
    assert rows(search.search(queries, items, 5, "euclidean", ("list_id",)), "query_id", "rank") == whole
    monkeypatch.setattr(search, "MAX_HITS", 10)
    assert rows(search.search(queries, items, 5, "euclidean", ("list_id",)), "query_id", "rank") == whole


def test_probes_beyond_one_block(queries, items, monkeypatch):
    centroids = np.random.default_rng(1).normal(size=(4, 8))
    probed = search.probe_lists(queries, centroids, "euclidean", 2)
    whole = rows(search.search(probed, items, 5), "query_id", "rank")
    monkeypatch.setattr(search, "MAX_POSTINGS", 9)
    monkeypatch.setattr(search, "NAMED_LISTS", 1)
    assert rows(search.search(probed, items, 5), "query_id", "rank") == whole


def test_spread_and_gathered_scans_agree(spark, queries, items, monkeypatch):
    expected = rows(search.search(queries, items, 5), "query_id", "rank")
    monkeypatch.setattr(search, "MAX_TASK_HITS", 1)
    assert rows(search.search(queries, items.repartition(64), 5), "query_id", "rank") == expected


def test_unlisted_rows_are_always_searched(queries, items):
    probed = queries.withColumn("probes", F.array(F.lit(2)))
    loose = items.withColumn("list_id", F.when(F.col("id") == "i1", -1).otherwise(F.col("list_id")))
    found = search.search(probed, loose, 400)
    assert found.where("id = 'i1'").count() == queries.count()
    assert found.where("id = 'i5'").count() == 0


def test_query_ids_of_any_type(spark, items):
    q = spark.createDataFrame([("a", [0.0] * 8)], "query_id string, qv array<double>")
    assert search.search(q, items, 1).schema["query_id"].dataType.simpleString() == "string"


def test_a_query_without_a_vector_has_no_hits(spark, items):
    q = spark.createDataFrame([(1, None), (2, [0.0] * 8)], "query_id long, qv array<double>")
    probed = search.probe_lists(q, np.zeros((4, 8)), "euclidean", 4)
    for frame in (q, probed, q.where("query_id = 1")):
        assert {r["query_id"] for r in search.search(frame, items, 2).collect()} <= {2}


def test_dimension_mismatch_stops(spark, items):
    q = spark.createDataFrame([(1, [0.0] * 7)], "query_id long, qv array<double>")
    with pytest.raises(Exception, match="dimension mismatch"):
        search.search(q, items, 1).collect()
    with pytest.raises(ValueError):
        search.search(q, items, 1, "manhattan")


def test_unrolled_and_lambda_forms_agree(items):
    a, b = F.col("vector"), F.reverse("vector")
    for form in (distance.euclidean, distance.squared_euclidean, distance.cosine_distance, distance.cosine_similarity):
        assert items.where(form(a, b) != form(a, b, 8)).count() == 0


def test_scores_and_zero_vectors(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0]), ([2.0, 0.0], [5.0, 0.0])],
                               "a array<double>, b array<double>")
    got = df.select(distance.cosine_distance(F.col("a"), F.col("b")), F.get(distance.l2_normalize(F.col("a")), F.lit(0))).collect()
    assert [tuple(r) for r in got] == [(1.0, 0.0), (2.0, 1.0), (0.0, 1.0)]
    one = spark.range(1)
    d = F.lit(3.0)
    score = [one.select(distance.similarity_score(m, d)).first()[0] for m in ("cosine", "euclidean", "squared_euclidean", None)]
    assert score == pytest.approx([0.0, np.exp(-3), np.exp(-np.sqrt(3)), 0.25])
    assert one.select(distance.similarity_score("euclidean", F.lit(None))).first()[0] == 1.0
    with pytest.raises(Exception, match="same length"):
        df.select(distance.euclidean(F.col("a"), F.array(F.lit(1.0)))).collect()


@pytest.mark.parametrize("large", [1 << 40, 0])
@pytest.mark.parametrize("few", [1 << 20, 0])
def test_latest_row_with_a_hot_id(spark, monkeypatch, large, few):
    monkeypatch.setattr(merge, "LARGE_BATCH", large)
    monkeypatch.setattr(merge, "bounded", lambda side: F.broadcast(side) if few else side)
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.col("id").alias("v"))
    last = merge.latest_per_id(df)
    assert last.count() == 2001
    assert last.where("id = 'hot'").first()["v"] == 2997
    nameless = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "id string, v int").coalesce(1)
    assert sorted((r["id"] or "", r["v"]) for r in merge.latest_per_id(nameless).collect()) == [("", 1), ("", 2), ("a", 4)]


def test_ids_beyond_the_broadcast_bound(spark, items, monkeypatch):
    gone = items.where("list_id = 1").select("id")
    expected = rows(merge.delete_by_ids(items, gone).select("id"), "id")
    monkeypatch.setattr(merge, "bounded", lambda side: side)
    assert rows(merge.delete_by_ids(items, gone).select("id"), "id") == expected


def test_validation_messages(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 2.0]), (None, [1.0, 2.0]), (" ", [1.0, 2.0]), ("e", []), ("n", [1.0, float("nan")]),
         ("i", [float("inf"), 0.0]), ("w", [1.0]), ("v", None), ("x", [None, 1.0])], "id string, vector array<double>")
    got = {r["id"]: r["errors"] for r in validate.with_errors(df, 2).collect()}
    assert got["a"] == [] and got[None] == ["missing required 'id' field"] and got[" "] == ["'id' cannot be blank"]
    assert got["e"] == ["vector cannot be empty"] and got["w"] == ["vector dimension must be 2"]
    assert got["n"] == got["i"] == got["x"] == ["vector elements must be finite numbers"]
    assert got["v"] == ["missing required 'vector' field"]
    with pytest.raises(Exception, match="Invalid item \\(id: w\\)"):
        validate.require_valid(df.where("id = 'w'"), 2).collect()
    good, bad = validate.split_valid(df, 2)
    assert (good.count(), bad.count()) == (1, 8)


def test_recall_rules(spark):
    df = spark.createDataFrame(
        [("f", 1, [], []), ("f", 2, ["a"], []), ("f", 3, ["a", "b"], ["b", "c"]), ("f", 4, [], ["a"])],
        "filter_name string, query_id int, found array<string>, expected array<string>")
    row = evaluate.filtered_summary(df).first()
    assert (row["recall"], row["mean_returned"], row["mean_expected"]) == ((1 + 0 + 0.5 + 0) / 4, 0.75, 0.75)
    wide = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(101)), lambda x: x.cast("string")).alias("found"))
    with pytest.raises(Exception, match="more than 100"):
        wide.select(evaluate.filtered_recall(F.col("found"), F.array(F.lit("1")))).collect()
    with pytest.raises(Exception, match="shapes"):
        wide.select(evaluate.recall(F.col("found"), F.array(F.lit("1")))).collect()
    mapped = spark.range(1).select(evaluate.truth_from_positions(
        F.array(F.lit(2), F.lit(-1), F.lit(0), F.lit(9)), F.array(F.lit("x"), F.lit("y"), F.lit("z"))))
    assert mapped.first()[0] == ["z", "x"]


def test_recall_of_unequal_shapes(spark):
    truth = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "c")], "query_id long, id string")
    hits = spark.createDataFrame([(1, "a"), (1, "x"), (2, "c")], "query_id long, id string")
    assert {r.query_id: r.recall for r in evaluate.recall_per_query(hits, truth).collect()} == {1: 0.5, 2: 0.5}
    with pytest.raises(Exception, match="shapes"):
        evaluate.mean_recall(hits, truth, strict=True).collect()
    full = hits.union(spark.createDataFrame([(2, "z")], hits.schema))
    assert evaluate.mean_recall(full, truth, strict=True).first()["recall"] == 0.5


def test_mmr_against_the_plain_loop(spark):
    rng = np.random.default_rng(8)
    frame, expected = [], {}
    for q in range(6):
        vectors, score = rng.normal(size=(9, 4)), np.sort(rng.random(9))[::-1]
        vectors[3] = vectors[2]
        score[1] = score[0]
        frame += [(q, i + 1, f"{q}-{i}", float(score[i]), vectors[i].tolist()) for i in range(9)]
        picked = [int(np.argmax(score))]
        while len(picked) < 5:
            best, best_value = None, -np.inf
            for i in range(9):
                if i in picked:
                    continue
                near = max(0.0, max(float(vectors[i] @ vectors[j] / np.linalg.norm(vectors[i]) / np.linalg.norm(vectors[j])) for j in picked))
                value = 0.3 * score[i] - 0.7 * near
                if value > best_value:
                    best, best_value = i, value
            picked.append(best)
        expected[q] = [f"{q}-{i}" for i in picked]
    hits = spark.createDataFrame(frame, "query_id int, rank int, id string, score double, vector array<double>")
    got = {q: [] for q in expected}
    for r in mmr.mmr_select(hits, 5, 0.3).orderBy("query_id", "mmr_rank").collect():
        got[r["query_id"]].append(r["id"])
    assert got == expected
    assert mmr.mmr_select(hits, 0).count() == 0
    assert mmr.mmr_select(hits, 50).count() == 54


def test_retrain_rule():
    assert not train.needs_training(99, None, 2.0, 100) and train.needs_training(100, None, 2.0, 100)
    assert not train.needs_training(199, 100, 2.0, 1) and train.needs_training(200, 100, 2.0, 1)
    assert train.auto_list_count(0) == 1 and train.auto_list_count(10_000) == 100
    assert train.auto_list_count(10 ** 12) == 10 ** 6 and train.auto_list_count(10 ** 12, 1024) == train.MAX_CENTROID_BYTES // 8192


def test_cosine_training_leaves_zero_vectors_out(spark):
    data = [(str(i), [0.0, 0.0] if i % 4 == 0 else [1.0, float(i)]) for i in range(40)] + [("none", None)]
    df = spark.createDataFrame(data, "id string, vector array<double>")
    centroids = train.train_lists(df, "cosine", 40, n_lists=3)
    got = {r["id"]: r["list_id"] for r in train.assign_lists(df, centroids, "cosine").collect()}
    assert got["none"] == -1 and got["0"] == -1 and got["1"] >= 0


def test_codebooks_shrink_the_error(spark):
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(8, 6))
    data = [(str(i), (centers[i % 8] + 0.01 * rng.normal(size=6)).tolist()) for i in range(400)]
    df = spark.createDataFrame(data, "id string, vector array<double>")
    books = pq.train_codebooks(df, "euclidean", 400, 6, 3, 4)
    assert books.shape == (3, 16, 2)
    coded = pq.pq_encode(df, books, "euclidean").toPandas()
    rebuilt = np.stack([np.concatenate([books[s, c] for s, c in enumerate(row)]) for row in coded["codes"]])
    assert np.abs(rebuilt - np.stack(coded["vector"])).max() < 0.5
    assert np.array_equal(pq.codebook_array(pq.codebook_frame(spark, books)), books)
    with pytest.raises(ValueError):
        pq.check_pq(64, 7, 8)


def test_codes_without_rows_split_the_greatest_error(spark):
    """Copies of one row leave a single code to start from; splits reach every different row."""
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(16, 4)) * 10
    data = [(f"c{i:04d}", [0.0, 0.0, 0.0, 0.0]) for i in range(300)]
    data += [(f"r{i}", (centers[i % 16] + 0.001 * rng.normal(size=4)).tolist()) for i in range(160)]
    df = spark.createDataFrame(data, "id string, vector array<double>")
    start = np.zeros((2, 16, 2))
    books = pq.train_codebooks(df, "euclidean", len(data), 4, 2, 4, rounds=40, initial=start)
    errors = pq.codebook_errors(df, books, "euclidean").toPandas()
    assert errors.groupby("sub")["code"].nunique().tolist() == [16, 16]
    assert errors.groupby("sub")["n"].sum().tolist() == [460, 460]
    rows = np.array([v for _, v in data]).reshape(-1, 2, 2)
    for s in range(2):
        exact = ((rows[:, s][:, None] - books[s][None]) ** 2).sum(axis=2).min(axis=1).sum()
        assert abs(errors[errors["sub"] == s]["error"].sum() - exact) < 1e-6
    one = pq.train_codebooks(df.limit(0), "euclidean", 0, 4, 2, 4)
    assert one.shape == (2, 0, 2)
    few = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0]), ("c", [3.0, 4.0])], "id string, vector array<double>")
    books = pq.train_codebooks(few, "euclidean", 3, 2, 1, 2)
    assert pq.codebook_errors(few, books, "euclidean").agg(F.count("*").alias("codes"), F.sum("error").alias("e")).first().asDict() == {"codes": 2, "e": 0.0}


def clustered(n_lists=12, each=60, width=16, scale=0.5, seed=5):
    """Lists of very different spread, and their centroids."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n_lists, width)) * scale
    spread = np.linspace(0.1, 1.0, n_lists)
    rows = np.concatenate([c + rng.normal(size=(each, width)) * s for c, s in zip(centres, spread)])
    return rows, centres


def test_list_steps_equal_brute_force(spark):
    rows, centres = clustered()
    items = spark.createDataFrame([(str(i), r.tolist()) for i, r in enumerate(rows)], "id string, vector array<double>")
    assigned = train.assign_lists(items, centres, "euclidean")
    radii = train.list_radii(assigned, centres, "euclidean")
    away = np.sqrt(((rows[:, None] - centres[None]) ** 2).sum(axis=2))
    nearest = away.argmin(axis=1)
    for j in range(len(centres)):
        assert radii[j] == pytest.approx(away[nearest == j, j].mean())
    queries = items.limit(50).selectExpr("cast(id as long) query_id", "vector qv").union(spark.sql("select 999L, cast(null as array<double>)"))
    steps = {(r.query_id, r.list_id): r.step for r in search.list_steps(queries, centres, "euclidean", radii).collect()}
    assert len(steps) == 50 * len(centres)
    for (q, j), step in steps.items():
        off = 1024 * (away[q, j] - away[q].min()) / radii[nearest[q]]
        assert step == min(np.ceil(off), 1 << 16) or abs(off - round(off)) < 1e-6
    probes = search.probe_lists(queries, centres, "euclidean", radii=radii, reach=900).collect()
    assert len(probes) == 50
    for row in probes:
        assert set(row.probes) == {j for j in range(len(centres)) if steps[row.query_id, j] <= 900} and row.probes[0] == nearest[row.query_id]


def test_radii_without_spread_and_steps_beyond_numbers(spark):
    centres = np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]])
    rows = [("a", [0.0, 0.0], 0), ("b", [10.0, 2.0], 1), ("c", [10.0, -2.0], 1), ("d", None, -1)]
    assigned = spark.createDataFrame(rows, "id string, vector array<double>, list_id int")
    assert train.list_radii(assigned, centres, "euclidean").tolist() == pytest.approx([4 / 3, 2.0, 4 / 3])
    assert train.list_radii(assigned.where("id = 'a'"), centres, "euclidean").tolist() == [1.0, 1.0, 1.0]
    assert train.list_radii(assigned.limit(0), centres, "euclidean").tolist() == [1.0, 1.0, 1.0]
    far = search.steps_off(np.array([[1.0, 1e300, np.inf], [np.inf, np.inf, np.inf]]), np.array([1e-9, 1.0]))
    assert far.tolist() == [[0, 1 << 16, 1 << 16], [0, 0, 0]]


def test_adaptive_probes_reach_the_target_with_fewer_lists(spark):
    rows, centres = clustered(n_lists=24, each=80)
    items = spark.createDataFrame([(str(i), r.tolist()) for i, r in enumerate(rows)], "id string, vector array<double>")
    assigned = train.assign_lists(items, centres, "euclidean").cache()
    radii = train.list_radii(assigned, centres, "euclidean")
    queries = assigned.selectExpr("cast(id as long) query_id", "vector qv")
    curve = train.calibrate_reach(assigned, queries, centres, radii, "euclidean", 20).orderBy("step").collect()
    reach = train.auto_reach(spark.createDataFrame(curve), 0.92)
    at = next(r for r in curve if r.step == reach)
    probed = search.probe_lists(queries, centres, "euclidean", radii=radii, reach=reach)
    found = search.search(probed, assigned, 21, "euclidean").where("id <> cast(query_id as string)")
    exact = search.search(queries, assigned, 21, "euclidean").where("id <> cast(query_id as string)")
    recall = found.join(exact, ["query_id", "id"]).count() / exact.count()
    assert recall == pytest.approx(at.recall) and recall >= 0.92
    lists = probed.agg(F.avg(F.size("probes"))).first()[0]
    assert lists == pytest.approx(at.lists)
    fixed = train.auto_probe_count(train.calibrate_probes(assigned, queries, centres, "euclidean", 20), 0.92)
    assert lists < fixed and lists < len(centres) / 2
    assert train.auto_reach(spark.createDataFrame(curve).where("false")) is None


@pytest.mark.parametrize("share,k", [(1.0, 20), (0.3, 50), (0.01, 5), (0.0, 5), (1.0, 10_000)])
def test_greedy_sizes_lead_to_the_same_probes_as_a_full_count(spark, share, k):
    data, centres = clustered(n_lists=40, each=30, scale=2.0)
    items = spark.createDataFrame([(str(i), r.tolist()) for i, r in enumerate(data)], "id string, vector array<double>")
    rows = train.assign_lists(items, centres, "euclidean").where(F.pmod(F.xxhash64("id"), F.lit(1000)) < int(1000 * share))
    near = [(i, data[i].tolist()) for i in (3, 4, 5, 700)] + [(999, None)]
    queries = spark.createDataFrame(near, "query_id long, qv array<double>")
    whole = train.size_array(rows, len(centres))
    counted = train.greedy_sizes(queries, centres, "euclidean", rows, k)
    assert ((counted == whole) | (counted == 0)).all()
    if share == 1.0 and k == 20:
        assert (counted > 0).sum() <= 2 * train.GREEDY_LISTS       # two neighbourhoods, the first round
    probes = [
        {r.query_id: r.probes for r in search.probe_lists(queries, centres, "euclidean", sizes=s, k=k).collect()} for s in (whole, counted)]
    assert probes[0] == probes[1] and len(probes[0]) == 4
    assert not train.greedy_sizes(queries.limit(0), centres, "euclidean", rows, k).any()


def test_many_lists_are_fitted_in_two_levels(spark):
    """Six far groups of four near ones: every row finds its own small group, rows beside one coarse list alone too."""
    rng = np.random.default_rng(5)
    far = rng.normal(0, 100, (6, 5))
    middles = (far[:, None, :] + rng.normal(0, 10, (6, 4, 5))).reshape(-1, 5)
    x = np.repeat(middles, 12, axis=0) + rng.normal(0, 0.01, (288, 5))
    df = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(x)], "id string, vector array<double>")
    for metric in ("euclidean", "cosine"):
        near = train.train_lists(df, metric, 288, n_lists=36, max_iters=30, flat_lists=16)
        assert 24 < len(near) <= 36 and np.isfinite(near).all()
    coarse = far + 1.0
    parts = train.fit_parts(df, coarse, 24, "euclidean", 40, 1e-6)
    assert len(parts) == 24
    # each part is the mean of the rows of its coarse list that are nearest to it
    own = np.argmin(((x[:, None] - coarse[None]) ** 2).sum(2), axis=1)
    first = np.searchsorted(np.argmin(((parts[:, None] - coarse[None]) ** 2).sum(2), axis=1), np.arange(7))
    for c in range(6):
        rows, mine = x[own == c], parts[first[c]:first[c + 1]]
        at = np.argmin(((rows[:, None] - mine[None]) ** 2).sum(2), axis=1)
        for i in np.unique(at):
            assert np.allclose(mine[i], rows[at == i].mean(axis=0))
    copies = spark.createDataFrame([(str(i), [1.0, 2.0]) for i in range(30)], "id string, vector array<double>")
    assert (train.fit_parts(copies, np.array([[1.0, 2.0], [5.0, 5.0]]), 9, "euclidean", 3, 1e-6) == [[1.0, 2.0], [5.0, 5.0]]).all()
