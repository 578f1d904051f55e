import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from vecspark.llm import mixing, near_dedup, pii, queries, toxicity


def test_stages(spark, tmp_path):
    """Each stage against what its operator says of the same rows."""
    sf_dir = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf_dir, "documents")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, results[-1], sf_dir).write.parquet(path)
        results.append(spark.read.parquet(path))
    assert all(r.columns == docs.columns for r in results[:-1])
    clean, single, private, mix, pieces = results[1:]

    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"), F.lit(True))
    kept = toxicity.score(docs, model).where("predicted = 0").select("row.doc_id")
    assert 0 < clean.count() < docs.count() and clean.select("doc_id").exceptAll(kept).isEmpty() and kept.exceptAll(clean.select("doc_id")).isEmpty()

    groups = near_dedup.near_duplicates(clean)
    assert single.count() == groups.where("kept").count() == groups.select("component_id").distinct().count() < clean.count()
    assert near_dedup.near_duplicates(single).where("not kept").isEmpty()

    assert private.count() == single.count()
    assert pii.find(private).agg(F.sum(F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone"))).first()[0] == 0
    assert private.where("text like '%[EMAIL]%'").count() == pii.find(single).where("n_email > 0").count() > 0

    assert mix.exceptAll(private).isEmpty() and private.exceptAll(mix).isEmpty()
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert whole.count() == mix.count() and whole.where("n <> t").isEmpty()


@pytest.mark.parametrize("rows", [0, 3])
def test_stages_take_few_rows(spark, rows, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf_dir, "documents").limit(rows)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() <= rows or name == "packing"


def test_stages_take_odd_rows(spark, odd_docs, tmp_path):
    """Nulls in every column, very long and repeated rows, columns with names that stages use."""
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == before.columns or name == "packing"
        if name == "mixing":
            assert docs.exceptAll(before).isEmpty() and before.exceptAll(docs).isEmpty()
            assert docs.where("text is null").count() > 0
    assert docs.select("doc_id").distinct().exceptAll(before.select("doc_id").distinct()).isEmpty()


def worst_deviation(spark, docs, mix, path):
    """How far any source is from its part of the sequences, in tokens, until one of them ends."""
    mix(docs).write.parquet(path)
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) > 3
    pieces = corpus_pipeline.pack(spark, back, "").join(docs.select("doc_id", "source"), "doc_id").orderBy("sequence_id", "offset").collect()
    total, seen, worst, left = {}, {}, 0.0, {}
    for p in pieces:
        total[p.source] = total.get(p.source, 0) + p.length
    left = dict(total)
    everything = sum(total.values())
    for p in pieces:
        seen[p.source] = seen.get(p.source, 0) + p.length
        left[p.source] -= p.length
        done = sum(seen.values())
        worst = max(worst, *[abs(seen.get(s, 0) - n / everything * done) for s, n in total.items()])
        if not left[p.source]:
            break
    return worst


def test_the_mix_reaches_the_sequences(spark, tmp_path):
    """Over several files: less than two blocks and a buffer off; a stage that leaves the order as it was fails."""
    sizes = {"a": 600, "b": 600, "c": 600}                   # equal weights, so that all end together
    rows = [(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(250)), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    blocks = mixing.mixed
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = worst_deviation(spark, docs, lambda d: blocks(d, block_chars=20_000), str(tmp_path / "mixed"))
        same = worst_deviation(spark, docs, lambda d: d, str(tmp_path / "same"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    bound = 2 * 20_000 + corpus_pipeline.MIX_TOKENS                   # a token has a character at least
    assert mixed < bound < same, (mixed, bound, same)
