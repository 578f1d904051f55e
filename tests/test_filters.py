"""Filter documents row by row."""

import json

import pytest
from pyspark.sql import functions as F

from vecspark.functions.filters import compile_filter, compile_filters, promote, pushed_filter

ROWS = [
    {"number": 0, "lang": "en", "tags": ["a", "b"], "owner": {"name": "x", "pets": 2}, "flag": True},
    {"number": 1, "lang": "fr", "tags": [], "owner": {"name": "y"}, "flag": False},
    {"number": "0", "lang": None, "tags": [1, 2.5]},
    {"number": 2.5, "lang": ["en", "de"], "deep": {"a": {"b": {"c": [1, {"d": 2}]}}}},
    {},
    {"number": 9007199254740993, "a.b": 1, "it's": "q"},
]

CASES = [
    ({}, {0, 1, 2, 3, 4, 5, 6}),
    (None, {0, 1, 2, 3, 4, 5, 6}),
    ({"number": 0}, {0}),
    ({"number": "0"}, {2}),
    ({"number": 2.5}, {3}),
    ({"number": 9007199254740993}, {5}),
    ({"number": 9007199254740992}, set()),
    ({"number": {"$gte": 1}}, {1, 3, 5}),
    ({"number": {"$gt": 0, "$lt": 2.6}}, {1, 3}),
    ({"number": {"$ne": 0}}, {1, 2, 3, 4, 5, 6}),
    ({"number": {"$in": [0, 2.5, "zz"]}}, {0, 3}),
    ({"number": {"$in": []}}, set()),
    ({"number": {"$nin": [0, 1]}}, {2, 3, 4, 5, 6}),
    ({"flag": True}, {0}),
    ({"flag": False}, {1}),
    ({"flag": 1}, set()),
    ({"lang": "en"}, {0, 3}),
    ({"lang": None}, {2, 4, 5, 6}),
    ({"lang": {"$exists": True}}, {0, 1, 2, 3}),
    ({"lang": {"$exists": False}}, {4, 5, 6}),
    ({"lang": {"$gt": "em"}}, {0, 1, 3}),
    ({"tags": "a"}, {0}),
    ({"tags": 2.5}, {2}),
    ({"tags": ["a", "b"]}, {0}),
    ({"tags": {"$all": ["b", "a"]}}, {0}),
    ({"tags": {"$size": 0}}, {1}),
    ({"tags": {"$size": 2}}, {0, 2}),
    ({"tags": {"$gt": 1}}, {2}),
    ({"owner.name": "x"}, {0}),
    ({"owner": {"name": "y"}}, {1}),
    ({"owner.name": {"$not": {"$eq": "x"}}}, {1, 2, 3, 4, 5, 6}),
    ({"deep.a.b.c": 1}, {3}),
    ({"it's": "q"}, {5}),
    ({"$and": [{"lang": "en"}, {"number": {"$lt": 1}}]}, {0}),
    ({"$or": [{"number": 1}, {"tags": 1}]}, {1, 2}),
    ({"$nor": [{"number": 1}, {"tags": 1}]}, {0, 3, 4, 5, 6}),
    ({"lang": "en", "number": 0}, {0}),
    ({"tags": {"$all": ["a"]}}, {0}),
    ({"tags": {"$all": ["a", "b", "c"]}}, set()),
    ({"lang": {"$all": ["en", "de"]}}, {3}),
    ({"tags": {"$all": [1, 2.5]}}, {2}),
    ({"lang": {"$all": [None]}}, {2, 4, 5, 6}),
    ({"tags": {"$all": []}}, set()),
    ({"number": {"$gt": float("-inf"), "$lt": float("inf")}}, {0, 1, 3, 5}),
    ({"number": {"$gte": -1, "$nin": [1, -1]}}, {0, 3, 5}),
    ({"lang": {"$in": ["' OR true --", "\\'", "x -> r.p0", "\n", ""]}}, set()),
    ({"lang": {"$in": [f"w{i}" for i in range(3000)] + ["fr"]}}, {1}),
]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, json.dumps(r)) for i, r in enumerate(ROWS)] + [(6, None)]
    return spark.createDataFrame(data, "n int, j string").select("n", F.parse_json("j").alias("m")).persist()


@pytest.mark.parametrize("filters,expected", CASES, ids=[json.dumps(c[0]) for c in CASES])
def test_filter(rows, filters, expected):
    kept = {r["n"] for r in rows.where(compile_filter(filters, F.col("m"))).collect()}
    assert kept == expected


@pytest.mark.parametrize("filters", [{"x": {"$near": 1}}, {"$where": "1"}, {"x": {"$in": 3}}, ["x"]])
def test_unknown_forms_raise(rows, filters):
    with pytest.raises(ValueError):
        compile_filter(filters, F.col("m"))


@pytest.mark.parametrize("filters,expected", CASES, ids=[json.dumps(c[0]) for c in CASES])
def test_pushed_part_keeps_every_match(rows, filters, expected):
    typed = rows.withColumn("p0", promote(F.col("m"), "number", "bigint")).withColumn("p1", promote(F.col("m"), "lang", "string"))
    promoted = {"number": (F.col("p0"), "bigint"), "lang": (F.col("p1"), "string")}
    kept = {r["n"] for r in typed.where(pushed_filter(filters, promoted)).collect()}
    assert kept >= expected


def test_values_with_quotes_and_controls(spark):
    odd = ["'", '"', "\\", "\\'", "a\nb", "é\u2028", "${x}", "", "' OR '1'='1"]
    rows = spark.createDataFrame([(i, json.dumps({"v": v, v or "empty": 1})) for i, v in enumerate(odd)], "n int, j string").select("n", F.parse_json("j").alias("m"))
    for i, v in enumerate(odd):
        assert [r.n for r in rows.where(compile_filter({"v": v}, F.col("m"))).collect()] == [i]


def test_many_filters_at_once(rows):
    """One array gives what each filter alone gives, and reads each facet of a path once."""
    filters = [c[0] for c in CASES]
    got = rows.select("n", compile_filters(filters, F.col("m")).alias("met"))
    for row in got.collect():
        assert [row.n in expected for _, expected in CASES] == row.met
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("['number'], StringType") <= 1 and plan.count("['number'], DoubleType") <= 1
