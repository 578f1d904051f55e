import hashlib
import re

import numpy as np
from odd import odd_texts
from pyspark.sql import functions as F
from vecspark.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
EXTRA = ["a<P>b c", "x <S> y", "tail <M>", " lead", "tail  ", "\t\n", "é ü 日本 語", "a\x0bb\x0cc\rd", "a\x1cb\x85c", "x" * 7, "x" * 8 + " ", " " * 17, "< P >< <S"]


def expected(doc_id, text, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    return len(units), form, len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"


def test_marks_against_the_pattern():
    rng = np.random.default_rng(1)
    letters = np.array(list(" \t\n\x0b\x0c\r\x08\x0e\x1f!aé日😀\x00\x7f"))
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 40, 300)] + [t or "" for t in odd_texts()]
    data = [t.encode() for t in texts]
    at = np.cumsum([0, *map(len, data)])
    ends, starts = fim.marked(np.frombuffer(b"".join(data), np.uint8), at)
    first = ends.rank(at)
    for i, text in enumerate(texts):
        units = UNIT.findall(text)
        assert first[i + 1] - first[i] == len(units)
        places = ends.select(first[i] + np.arange(1, len(units) + 1)) + 1 - at[i]
        assert places.tolist() == np.cumsum([len(u.encode()) for u in units], dtype=int).tolist()
        assert starts.rank(at[i + 1:i + 2])[0] - starts.rank(at[i:i + 1])[0] == len(text)


def test_every_row_is_cut_and_restored(spark, odd_docs):
    more = spark.createDataFrame([(100 + 7 * i, t) for i, t in enumerate(EXTRA * 6)], "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    for rate, spm in ((50, 80), (100, 50)):
        rows = fim.fill_in_middle(docs, rate=rate, spm_rate=spm).withColumn("again", fim.restored())
        got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows.collect()), key=repr)
        assert got == sorted(((r.doc_id, r.text or "", *expected(r.doc_id, r.text, rate, spm)) for r in docs.collect()), key=repr)
        assert rows.where(~F.col("again").eqNullSafe(F.col("text"))).isEmpty()


def test_empty_table(no_docs):
    assert fim.fill_in_middle(no_docs).count() == 0
