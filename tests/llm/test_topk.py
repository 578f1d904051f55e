import math
import random

import pytest
from vecspark.llm import topk


def brute(queries, vectors, k):
    def whole(v):
        return [math.floor(64 * float(x)) for x in v]

    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    rows = [(i, whole(v)) for i, v in vectors if i is not None and fine(v)]
    out = []
    for q, v in [(i, whole(v)) for i, v in queries if i is not None and fine(v)]:
        scored = [(-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in rows if i != q and len(w) == len(v)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard", [3, 50])
def test_matches_brute_force(spark, shard):
    rng = random.Random(4)
    common = [rng.uniform(-1, 1) for _ in range(6)]
    vectors = [(i, common if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    vectors += [(200, None), (201, [float("nan")] * 6), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("inf")] * 6), (None, common),
                (204, [0.5, 0.5]), (205, [1.0, -1.0]), (206, []), (207, []), (208, [1e9] * 6), (209, [1e15] * 6), (210, [-1e9] * 6)]
    queries = [v for v in vectors if v[0] is None or v[0] % 20 == 0 or v[0] > 199]
    schema = "id long, vector array<double>, score string, `rank` int, dim string"
    frame = lambda rows: spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema).repartition(4)
    got = topk.exact_top_k(frame(queries), frame(vectors), k=7, query_rows=4, shard_rows=shard)
    assert sorted(tuple(r) for r in got.collect()) == brute(queries, vectors, 7)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, vector array<float>")
    some = spark.createDataFrame([(1, [1.0])], "id long, vector array<float>")
    assert topk.exact_top_k(none, some).count() == topk.exact_top_k(some, none).count() == topk.exact_top_k(some, some).count() == 0
