import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from odd import odd_texts
from tokenizers import Tokenizer
from vecspark.llm import packing, token_counts, token_files, tokens
from vecspark.plans.workspace import scratch_path

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
CHARACTERS = [chr(c) for c in [*range(0x00, 0x250), *range(0x2000, 0x20C0), 0x300, 0x3C3, 0x3042, 0x1F600]]


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


def ids(library, path, text):
    return library[path].encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(struct.pack(f"<{len(values)}I", *values))


def test_pieces_give_the_librarys_ids(library):
    texts = [t for t in odd_texts() if t] + [f"{c}a1{c} x{c}{c}y {c}" for c in CHARACTERS]
    word = tokens.UnitEncoder(WORD, False, tokens.id_bytes, b"".join)
    count = tokens.UnitEncoder(BYTE, True, len, sum, frequent={" the": 1})
    for text in texts:
        assert word.encode(text) == tokens.id_bytes(ids(library, WORD, text)), text[:20]
        assert count.encode(text) == len(ids(library, BYTE, text)), text[:20]


def test_remembered_keeps_what_is_used():
    held = tokens.Remembered(most=2)
    for key in "abc":
        held.put(key, key)
    assert held.get_all(["a", "c", "z"]) == (["a", "c", None], [2])
    assert "a" in held.young


def test_files_round_trip(spark, odd_docs, library):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(odd_docs, path, WORD, row_group_bytes=1 << 20, page_rows=5)
    rows = token_files.read_tokens(spark, path, ("ids",)).collect()
    digests = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.with_crc32(token_files.read_tokens(spark, path)).collect()}
    assert len(rows) == odd_docs.count()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([r.doc_id for r in rows], key=lambda x: (x is not None, x))
    start, expected = 0, sorted(ids(library, WORD, r.text) + [1] for r in odd_docs.collect())
    assert sorted(list(r.ids) for r in rows) == expected
    for row in rows:
        assert (row.start, row.n_tokens) == (start, len(row.ids))
        assert digests[row.doc_id, row.start] == crc(row.ids)
        start += row.n_tokens


def test_file_format(spark, odd_docs, tmp_path):
    token_files.write_tokens(odd_docs, str(tmp_path / "t"), WORD)
    files = [pq.ParquetFile(p).metadata for p in (tmp_path / "t").glob("*.parquet")]
    columns = [f.row_group(0).column(i) for f in files if f.num_row_groups for i in range(f.num_columns)]
    assert columns and all(c.has_offset_index for c in columns)
    assert {"DELTA_BINARY_PACKED"} == {e for c in columns if c.path_in_schema == "start" for e in c.encodings}
    assert all("RLE_DICTIONARY" in c.encodings for c in columns if c.path_in_schema.startswith("ids"))


def test_counts(odd_docs, library):
    rows = token_counts.count_tokens(odd_docs, BYTE).collect()
    expected = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), len(ids(library, BYTE, r.text))) for r in odd_docs.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == expected
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)


@pytest.mark.parametrize("tiers", [(2048, 1024, 512, 256), (64, 16)])
def test_packing(odd_docs, library, tiers):
    pieces = packing.pack_documents(odd_docs, WORD, tiers=tiers, step_tokens=4096, with_ids=True).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == p.length and crc(p.ids) == p.ids_crc32 and p.length > 0
        sequences[p.sequence_id].append(p)
        documents[p.doc_id].append(p)
    padded = 0
    steps = defaultdict(int)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        size = sum(p.length for p in own)
        assert size == own[0].context <= tiers[0] and len({(p.context, p.step_group) for p in own}) == 1
        padded += size & (size - 1) != 0
        steps[own[0].step_group, size] += size
    assert not padded and max(steps.values()) <= 4096
    assert len({g for g, _ in steps}) == len(steps)
    expected = sorted(x for r in odd_docs.collect() for x in ids(library, WORD, r.text) + [1])
    assert sorted(x for p in pieces for x in p.ids) == expected
    for row in odd_docs.where("doc_id not in (5)").where("doc_id is not null").collect():
        own = sorted(documents[row.doc_id], key=lambda p: p.start)
        assert [x for p in own for x in p.ids] == ids(library, WORD, row.text) + [1]
        assert {p.doc_tokens for p in own} == {len(ids(library, WORD, row.text)) + 1}


def test_empty_table(spark, no_docs):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(no_docs, path, WORD)
    assert token_files.with_crc32(token_files.read_tokens(spark, path)).count() == 0
    assert packing.pack_documents(no_docs, WORD).count() == 0
    assert token_counts.count_tokens(no_docs, BYTE).count() == 0
