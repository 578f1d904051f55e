import random
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from odd import odd_texts
from vecspark.llm import near_dedup, words
from vecspark.llm.components import components


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if len(w) >= width:
        return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}
    return {tuple(w)} if w else set()


def brute(rows, width, top, under):
    """Component id per position by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * under >= top * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(rows))], [len(s) for s in sets]


def family(rng, copies, edits, size=80):
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(size)] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(own))
    return out


def test_words_and_shingles_match_python():
    texts = pa.array([*odd_texts(), "A b\x0bC", "x" * (3 << 20), "é É a\x1cb " * 200_000])
    for part in (texts, texts.slice(3, 6), texts.slice(0, 0)):
        for width in (1, 3, 5):
            keys, ends = words.shingle_sets(part, width)
            assert np.diff(ends).tolist() == [len(shingles(t, width)) for t in part.to_pylist()]
    same, ends = words.shingle_sets(pa.array(["The cat sat on", "the CAT sat  on\n"]), 3)
    assert same[:2].tolist() == same[2:].tolist()


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(5)
    n, pairs = 900, 40
    for similarity in (0.5, 0.85, 0.95):
        both = round(2 * n * similarity / (1 + similarity))
        sets = []
        for _ in range(pairs):
            x = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
            sets += [x[:n], x[-n:]]
        held = near_dedup.sketches(np.concatenate(sets), np.arange(2 * pairs + 1) * n)
        assert abs((held[::2] == held[1::2]).mean() - similarity) < 0.03
        size = np.full(pairs, float(n))
        assert near_dedup.may_reach(held[::2], held[1::2], size, size, 0.85).mean() == (similarity > 0.6)
    one, parts = sets[0], np.array_split(sets[0], 3)
    whole = near_dedup.sketches(one, np.array([0, n]))
    merged = np.max([near_dedup.sketches(p, np.array([0, len(p)])) for p in parts], axis=0)
    assert (whole == merged).all()


def test_components_of_a_long_path(spark):
    links = [*pairwise(random.Random(1).sample(range(60), 60)), (100, 101), (101, 100), (7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(60)}, 100: 100, 101: 100}


@pytest.mark.parametrize("small_bucket", [64, 2])
def test_groups_match_brute_force(spark, monkeypatch, small_bucket):
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small_bucket)
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 16)
    rng = random.Random(3)
    texts = [t for edits in (1, 4, 9) for t in family(rng, 45, edits)] + [" ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(30)) for _ in range(30)]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs, 3, 0.85).select("row.doc_id", "n_shingles", "component_id", "kept").collect()}
    component, sizes = brute(rows, 3, 85, 100)
    assert [got[d].component_id for d, _ in rows] == component
    assert [got[d].n_shingles for d, _ in rows] == sizes
    assert {d for d, _ in rows if got[d].kept} == set(component)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = near_dedup.near_duplicates(odd_docs).select("row.doc_id", "text", "n_shingles", "component_id", "kept").collect()
    component, _ = brute(rows, 5, 4, 5)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2] is None, r[2] or 0)
    assert sorted(((r.doc_id, r.text, r.component_id) for r in got), key=key) == sorted(
        ((d, t, c) for (d, t), c in zip(rows, component)), key=key)
    sets = [r for r in got if r.n_shingles]
    assert sum(r.kept for r in sets) == len({r.component_id for r in sets if r.component_id is not None}) + 1     # and the one without id
    assert all(r.kept for r in got if not r.n_shingles)


def test_empty_table(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0
