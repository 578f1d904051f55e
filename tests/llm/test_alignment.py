import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from odd import odd_texts
from tokenizers import Tokenizer
from vecspark.llm import alignment
from vecspark.llm.tokens import BYTE_NAMES

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EXTRA = ["a ▁ b", "</s><s> x", "\n\nx\n y", "tab\tand  two   blanks ", "日本語 😀 é", "x\x00y", " lead", "\r\n", "1234567 89", "ﬁ ½ ①"]


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def tokens_of(library, text):
    """``(id, bytes)`` of both sides by the libraries alone; none if they do not spell the text."""
    a, b = library
    names = {chr(c): x for x, c in BYTE_NAMES.items()}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids if text else [], b.encode(text) if text else []
    left = [(i, bytes(names.get(c, ord(c)) for c in a.id_to_token(i))) for i in ids_a]
    right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    whole = (" " + text).encode()
    if not text or b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return [], []
    return left, right


def brute(library, texts):
    out, counts = [], Counter()
    for text in texts:
        left, right = tokens_of(library, text or "")
        spans = []
        for side in (left, right):
            at, own = 0, []
            for i, raw in side:
                own.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(own)
        links, j = [], 0
        for i, s, e in spans[0]:
            while j < len(spans[1]) and spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, before = [], 0
        places = [iter(s) for s in spans]
        for end in ends:
            parts = []
            for own in places:
                ids, at = [], before
                while at < end:
                    i, _, at = next(own)
                    ids.append(str(i))
                parts.append(",".join(ids))
            groups.append("|".join(parts))
            before = end
        counts.update(links)
        out.append((len(left), len(right), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(a, b, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest) for a, b, g, links, digest in out]


@pytest.fixture(scope="module")
def docs(spark, odd_docs):
    return odd_docs.unionByName(spark.createDataFrame([(200 + i, t) for i, t in enumerate(EXTRA * 2)], "doc_id long, text string"), allowMissingColumns=True).cache()


@pytest.mark.parametrize("pairs", [1 << 20, 16, 0])
def test_against_the_libraries(docs, library, pairs):
    rows = docs.select("doc_id", "text").collect()
    expected = sorted(zip([r.doc_id for r in rows], brute(library, [r.text for r in rows])), key=repr)
    got = [(r.doc_id, tuple(r)[1:]) for r in alignment.align(docs, BYTE, PIECE, pairs).collect()]
    assert sorted(got, key=repr) == expected


def test_given_documents(spark, sf_dir, library):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = table.select("doc_id", "text").collect()
    expected = dict(zip([r.doc_id for r in rows], brute(library, [r.text for r in rows])))
    for row in alignment.align(table, BYTE, PIECE, 1000).collect():
        assert tuple(row)[1:] == expected[row.doc_id]


def test_piece_units_give_the_librarys_ids(library):
    encoder = alignment.PieceEncoder(PIECE)
    assert encoder.apart
    for text in [t for t in [*odd_texts(), *EXTRA] if t] + [f"{c}a1{c} x{c}{c}y {c}\n{c}" for c in map(chr, [*range(0x250), *range(0x2000, 0x2070), 0x3042, 0x1F600])]:
        ids = encoder.ids(text)
        assert ids is None if "▁" in text else ids == alignment.id_bytes(library[1].encode(text)), text[:20]


def test_empty_table(no_docs):
    assert alignment.align(no_docs, BYTE, PIECE).count() == 0


def test_links_are_looked_up_in_bounded_runs():
    links = pa.array([[1] * n for n in (3, 0, 2, 9, 0, 1, 4)], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), links], names=["node", "links"]).slice(1)
    runs = list(alignment.link_slices(batch, most=5))
    assert [r.num_rows for r in runs] == [2, 1, 3]
    assert pa.Table.from_batches(runs).equals(pa.Table.from_batches([batch]))


def test_links_are_written_in_bounded_runs(spark, library):
    """A row holds few links however long its text; what is known of a document stands in its first row alone."""
    texts = ["wort " * 2000 + "ende", "", None, "a b", "x" * 3000]
    docs = spark.createDataFrame([(i % 2 or None, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = alignment.links_of(docs, BYTE, PIECE).collect()
    assert max(len(r.links) for r in rows) <= 256 and len(rows) > 8 + len(texts)
    firsts = [r for r in rows if r.first]
    assert [r.n_links for r in firsts] == [sum(len(r.links) for r in rows if r.node == f.node) for f in firsts] and len(firsts) == len(texts)
    assert all(r.doc_id is r.n_links is r.groups_sha256 is None for r in rows if not r.first)
    got = [tuple(r)[1:] for r in alignment.align(docs, BYTE, PIECE, 16).collect()]
    assert sorted(got) == sorted(brute(library, texts))


def test_runs_cut_rows_and_keep_empty_ones():
    links = pa.array([[1, 2, 3], [], [4, 5]], pa.list_(pa.int64()))
    first, row, runs = alignment.in_runs(links, most=2)
    assert (first.to_pylist(), row.to_pylist(), runs.to_pylist()) == ([0, None, 1, 2], [0, 0, 1, 2], [[1, 2], [3], [], [4, 5]])
