"""The block kernels against brute force, on hostile inputs."""

import numpy as np
import pyarrow as pa
import pytest

from vecspark.functions import blocks
from vecspark.functions.distance import COSINE, EUCLIDEAN, METRICS


def brute(queries, x, ids, k, metric):
    out = []
    for q in queries:
        d = blocks.exact_distance(np.broadcast_to(q, x.shape), x, metric)
        out.append(sorted(zip(d.tolist(), ids))[:k])
    return out


def kernel(queries, x, ids, k, metric, batch):
    block, top = blocks.QueryBlock(queries, metric), blocks.TopK(len(queries), k)
    for at in range(0, len(x), batch):
        block.offer(top, np.arange(len(queries)), x[at:at + batch], pa.array(ids[at:at + batch]))
    return [list(zip(top.d[i, :top.n[i]].tolist(), top.id[i, :top.n[i]])) for i in range(len(queries))]


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("batch", [7, 100, 1000])
def test_random(metric, batch):
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(600, 16)), rng.normal(size=(20, 16))
    ids = [str(i) for i in rng.permutation(600)]
    assert kernel(q, x, ids, 10, metric, batch) == brute(q, x, ids, 10, metric)


@pytest.mark.parametrize("metric", METRICS)
def test_a_third_are_copies_and_ties_go_by_id(metric):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8))
    x[::3] = x[0]
    q = np.vstack([x[0], x[0] + 1e-9, rng.normal(size=(3, 8)), np.zeros(8)])
    ids = [f"id{i}" for i in rng.permutation(900)]
    assert kernel(q, x, ids, 25, metric, 128) == brute(q, x, ids, 25, metric)


@pytest.mark.parametrize("metric", METRICS)
def test_distances_far_below_the_norms(metric):
    """Near-equal vectors of large norm: the product form alone has no digits left."""
    rng = np.random.default_rng(5)
    x = 1e6 + 1e-6 * rng.normal(size=(300, 8))
    q = x[:5] + 1e-7
    ids = [str(i) for i in range(300)]
    assert kernel(q, x, ids, 5, metric, 64) == brute(q, x, ids, 5, metric)


def test_fewer_items_than_k_and_tiny_values():
    x = np.array([[1e-10, 0.0], [0.0, 0.0], [1e-10, 1e-10]])
    ids = ["a", "b", "c"]
    assert kernel(x, x, ids, 10, EUCLIDEAN, 2) == brute(x, x, ids, 10, EUCLIDEAN)
    assert kernel(x, x, ids, 10, COSINE, 2) == brute(x, x, ids, 10, COSINE)


def test_matrix_checks_every_row():
    with pytest.raises(ValueError):
        blocks.matrix(pa.array([[1.0, 2.0], [1.0]]))
    with pytest.raises(ValueError):
        blocks.matrix(pa.array([[1.0], [1.0, 2.0, 3.0]]), 2)
    with pytest.raises(ValueError):
        blocks.matrix(pa.array([[1.0, 2.0], None]), 2)


def test_nearest_rows_lowest_id_wins():
    small = np.array([[1.0, 0.0], [0.0, 1.0], [1.0, 0.0]])
    top = blocks.nearest_rows(np.array([[1.0, 0.1], [0.0, 2.0]]), small, 2, EUCLIDEAN)
    assert top.id.tolist() == [[0, 2], [1, 0]]


@pytest.mark.parametrize("metric", METRICS)
def test_many_items_at_once_are_offered_in_parts(metric, monkeypatch):
    """Items beyond one part, ids as text or as numbers: the hits of brute force, and what is full rules out the rest."""
    monkeypatch.setattr(blocks, "ITEM_ROWS", 50)
    monkeypatch.setattr(blocks, "ITEM_FACTOR", 4)
    rng = np.random.default_rng(8)
    x, q = np.round(rng.normal(size=(620, 4)), 1), np.round(rng.normal(size=(15, 4)), 1)
    ids = [f"{i:04d}" for i in rng.permutation(620)]
    assert kernel(q, x, ids, 10, metric, 620) == brute(q, x, ids, 10, metric)
    numbers, top = np.array([int(i) for i in ids]), blocks.TopK(len(q), 10, numbers=True)
    blocks.QueryBlock(q, metric).offer(top, np.arange(len(q)), x, numbers)
    assert [list(zip(d, i)) for d, i in zip(top.d.tolist(), top.id.tolist())] == brute(q, x, [int(i) for i in ids], 10, metric)


@pytest.mark.parametrize("metric", METRICS)
def test_lists_together_give_the_hits_of_each_alone(metric):
    """Items of several lists at once, copies in different lists among them: only pairs that are asked for."""
    rng = np.random.default_rng(9)
    x, q = np.round(rng.normal(size=(900, 4)), 1), rng.normal(size=(12, 4))
    x[::2] = x[0]
    lists, ids, asks = rng.integers(0, 6, 900), np.arange(900), rng.random((12, 6)) < 0.6
    asks[0] = False
    block, top = blocks.QueryBlock(q, metric), blocks.TopK(len(q), 8, numbers=True)
    block.offer(top, np.arange(len(q)), x, ids, lists, asks)
    for i, one in enumerate(q):
        own = asks[i][lists]
        expected = brute([one], x[own], ids[own].tolist(), 8, metric)[0] if own.any() else []
        assert list(zip(top.d[i, :top.n[i]].tolist(), top.id[i, :top.n[i]].tolist())) == expected


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("pairs", [3, 1 << 16])
def test_full_queries_gather_pairs_of_several_products(metric, pairs, monkeypatch):
    """Products of a few queries and items, some dense with copies, some of lists that are not asked for: the hits of brute force."""
    for name, value in {"ITEM_ROWS": 100, "ITEM_FACTOR": 1, "TILE": (4, 16), "PAIRS": pairs, "EXACT_ROWS": 5}.items():
        monkeypatch.setattr(blocks, name, value)
    rng = np.random.default_rng(11)
    x, q = np.round(rng.normal(size=(900, 8)), 1), np.round(rng.normal(size=(11, 8)), 1)
    x[300:500] = x[7]
    ids, lists, asks = np.arange(900), rng.integers(0, 5, 900), rng.random((11, 5)) < 0.6
    for own in (None, asks):
        block, top = blocks.QueryBlock(q, metric), blocks.TopK(len(q), 9, numbers=True)
        block.offer(top, np.arange(len(q)), x, ids, None if own is None else lists, own)
        for i, one in enumerate(q):
            some = np.ones(900, dtype=bool) if own is None else own[i][lists]
            expected = brute([one], x[some], ids[some].tolist(), 9, metric)[0]
            assert list(zip(top.d[i, :top.n[i]].tolist(), top.id[i, :top.n[i]].tolist())) == expected[:9]
