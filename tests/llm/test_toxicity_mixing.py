import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from vecspark.llm import mixing, queries, toxicity


def auc(positive, negative):
    p, n = np.array(positive)[:, None], np.array(negative)[None, :]
    return (p > n).mean() + 0.5 * (p == n).mean()


def test_held_out_toxicity(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = queries.op9_toxicity(spark, sf_dir).where("held_out").join(queries.table(spark, sf_dir, "labels"), "doc_id").collect()
    toxic, clean = ([r for r in rows if r.toxic == t] for t in (1, 0))
    assert auc([r.score for r in toxic], [r.score for r in clean]) > 0.9
    assert np.mean([r.predicted for r in toxic]) > 0.85 and np.mean([r.predicted for r in clean]) < 0.03


def test_fit_corrects_for_toxic_rows_among_the_unlabelled():
    rng = random.Random(2)
    rows = [np.unique([rng.randrange(100, 160) for _ in range(20)] + ([1, 2] if i % 4 == 0 else [])) for i in range(2000)]
    model = toxicity.fit([r for r in rows[:1000] if 1 in r], rows[1000:], prior=0.25)
    assert set(model.marks.tolist()) == {1, 2} and model.bias < 0 < model.bias + model.weights.sum()


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (6, 1), (7, None), (None, 1), (8, 0), (9, 1), (12, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd_docs, labels, F.lit(True), positives=5, unlabelled=5)
    got = toxicity.score(odd_docs, model)
    assert got.count() == odd_docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert got.where("predicted <> cast(score >= 0.5 as int)").count() == 0
    assert got.select("row.*").columns == [c for c in odd_docs.columns if c != "text"]
    untaught = toxicity.train(odd_docs, labels.limit(0), F.lit(True))
    assert {r.predicted for r in toxicity.score(odd_docs, untaught).collect()} == {0}
    assert toxicity.score(no_docs, toxicity.train(no_docs, labels, F.lit(True))).count() == 0
    assert toxicity.LinearModel(np.zeros(0, np.int64), np.zeros(0), -1.0).scores(pa.array([None, ""])).tolist() == [1 / (1 + np.e)] * 2


def corpus(spark, sizes):
    rows = [(i, "x" * (1 + i % 9), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


@pytest.mark.parametrize("sizes, weights, frame", [
    ({"a": 900, "b": 300, "c": 100, None: 50}, None, 1000),
    ({"a": 700, "b": 700, "c": 700}, {"a": 5.0, "b": 2.0, "c": 1.0}, 64),
    ({f"s{i}": 40 + 7 * i for i in range(12)}, None, 97)])
def test_every_source_is_less_than_one_block_off(spark, sizes, weights, frame):
    docs = corpus(spark, sizes)
    given = spark.createDataFrame(list(weights.items()), "source string, weight double") if weights else None
    rows = mixing.schedule(docs, weights=given, block_chars=10, frame=frame, bucket_rows=37).select("row.source", "block", "release", "deadline", "slot", "start").collect()
    assert len(rows) == docs.count()
    slots, last = {}, defaultdict(int)
    for r in rows:
        assert r.release <= r.slot < r.deadline and r.start // 10 == r.block
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        last[r.source] = max(last[r.source], r.slot)
    units = mixing.units_of(docs.groupBy(mixing._group(F.col("source")).alias("task")).agg(F.sum(F.length("text")).alias("size")), given)
    frame_row = {t.task: (t.share, t.slots) for t in mixing.frame_slots(mixing.shares(units.withColumn("lane", F.lit("")), frame)).collect()}
    share = {s: Fraction(*frame_row["null" if s is None else "=" + s]) for s in sizes}
    assert sum(share.values()) == 1
    count = defaultdict(int)
    for slot in range(min(last.values()) + 1):
        if slot in slots:
            count[slots[slot][0]] = slots[slot][1] + 1
        for source, part in share.items():
            assert abs(count[source] - part * (slot + 1)) < 1 or slot not in slots


@pytest.mark.parametrize("most, groups, slack", [(2000, 1, 1), (100, 16, 2)])
def test_a_thousand_weighted_sources(spark, most, groups, slack):
    """Each keeps its own weight: less than a block off in its lane, and its part of a group's block beyond."""
    docs = spark.range(1000).select(F.concat(F.lit("s"), "id").alias("source"), F.when(F.col("id") < 20, 200).otherwise(6).alias("n"))
    docs = docs.select("source", F.explode(F.sequence(F.lit(1), "n")).alias("i")).select(
        F.monotonically_increasing_id().alias("doc_id"), F.lit("x" * 10).alias("text"), "source")
    weights = spark.range(1000).select(F.concat(F.lit("s"), "id").alias("source"), F.when(F.col("id") == 19, 500.0).when(F.col("id") < 19, 50.0).otherwise(1.0).alias("weight"))
    rows = mixing.schedule(docs, weights=weights, block_chars=10, frame=1000, most=most, groups=groups).select("row.source", "block", "release", "deadline", "slot").collect()
    assert len(rows) == 20 * 200 + 980 * 6 and len({r.slot for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)
    total = 500 + 19 * 50 + 980
    slots = defaultdict(list)
    for r in rows:
        slots[r.source].append(r.slot)
    ends = min(max(s) for s in slots.values())
    for source, own in slots.items():
        weight = 500 if source == "s19" else 50 if int(source[1:]) < 19 else 1
        got = sum(s <= ends for s in own)
        # shares are whole slots of a frame of 16 for each member
        assert abs(got - weight / total * (ends + 1)) < slack + ends / 16000 + 0.02 * got, source


def test_layout_keeps_every_row(spark, odd_docs, no_docs, tmp_path):
    out = str(tmp_path / "mix")
    mixing.mixed(odd_docs, block_chars=50, most=1).write.parquet(out)
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r[:1]) + (r.text or "",)
    back = spark.read.parquet(out)
    assert back.columns == odd_docs.columns
    assert sorted(back.collect(), key=key) == sorted(odd_docs.collect(), key=key)
    assert mixing.schedule(no_docs).count() == 0
