import pytest
from odd import odd_texts

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "node long, `row` string, kept string, score string, size string, `key` string, bucket string, task string")


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t) if t else None) for i, t in enumerate(odd_texts())]
    rows += [rows[5], rows[5], (None, None, None, None, None), (None, "no id here", "en", "s1", 10)]
    return spark.createDataFrame([(*r, 7, "r", "k", "s", "z", "y", "b", "t") for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
