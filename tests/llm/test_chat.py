import hashlib
from collections import defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from odd import odd_texts
from pyspark.sql import functions as F
from vecspark.llm import chat, queries

BYTE = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["</s>[INST] ok [/INST]", "[\\INST]", "<\\\\s>", "[", "[ROLE] x [TEXT] y [/ROLE]", " ", "<", "<|endoftext|>", "[SYS][/SYS]<s>", "\\", "é[/INST"]
SCHEMA = "conv_id long, turn int, role string, text string, node long, path string"


def rows_of():
    rows = []
    for i, text in enumerate([*odd_texts(), *TRICKY, *[t + t for t in TRICKY]]):
        rows += [(i, 0, "system", "be brief"), (i, 1, "user", text), (i, 2, "assistant", text), (i, 3, text and text[:40], "named")]
    for i in range(100, 160):                       # shared beginnings, copies, prefixes of one another
        rows += [(i, t, "user" if t % 2 == 0 else "assistant", f"turn {t} {i % 3 if t > 2 else ''}") for t in range(i % 7 + 1)]
    rows += [(None, 1, "user", "no id"), (None, None, None, None), (7, 1, "user", "again"), (7, 1, "user", "again"), (9000, 5, "assistant", "")]
    return [(*r, 1, "p") for r in rows]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(3)


def by_conversation():
    grouped = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows_of():
        grouped[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in grouped.items()}


@pytest.mark.parametrize("limits", [(1 << 16, 1 << 12), (60, 4)])
def test_read_back(spark, rows, limits):
    sequences = chat.format_conversations(rows, BYTE, *limits).cache()
    got = {r.conv_id: tuple(r)[1:] for r in chat.conversations(sequences, BYTE).collect()}
    expected = by_conversation()
    assert set(got) == set(expected)
    for conv_id, turns in expected.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        formatted = "".join("".join(chat.segments(*t)) for t in turns)
        assert got[conv_id] == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                                hashlib.sha256(loss.encode()).hexdigest(), len(formatted)), conv_id


def test_tree(spark, rows):
    """Shared turns stand once; positions and ancestors are those of each conversation alone."""
    coder, turns_by = chat.Coder(BYTE), by_conversation()
    small = rows.where("conv_id between 100 and 159").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        (sequence,) = chat.format_conversations(small, BYTE).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    paths = {tuple(turns_by[c][:n + 1]) for c in range(100, 160) for n in range(len(turns_by[c]))}
    assert len(sequence.nodes) == len(paths)
    assert len(sequence.token_ids) == sum(len(coder.ids(x)) // 4 for p in paths for x in chat.segments(*p[-1]))
    assert any(len(n.attend) > 1 for n in sequence.nodes)
    for member in sequence.conversations:
        leaf, chain = sequence.nodes[member.leaf], []
        at = member.leaf
        while at >= 0:
            chain.append(at)
            at = sequence.nodes[at].parent
        seen = [i for r in leaf.attend for i in range(r.start, r.end)] + list(range(leaf.start, leaf.end))
        assert seen == [i for n in reversed(chain) for i in range(sequence.nodes[n].start, sequence.nodes[n].end)]
        assert [sequence.position_ids[i] for i in seen] == list(range(len(seen)))
        assert all(a.end < b.start for a, b in zip(leaf.attend, leaf.attend[1:]))


def test_hot_first_turn_is_split(spark):
    rows = spark.range(3000).select(F.col("id").alias("conv_id"), F.explode(F.expr(
        "array(named_struct('turn', 0, 'role', 'system', 'text', 'same for all'), named_struct('turn', 1, 'role', 'user', 'text', concat('q', id % 1500)))")).alias("t"))
    rows = rows.select("conv_id", "t.*")
    sequences = chat.format_conversations(rows, BYTE, sequence_conversations=500).cache()
    tasks = sequences.select(F.spark_partition_id().alias("task"), F.size("conversations").alias("n")).groupBy("task").agg(F.sum("n").alias("n")).collect()
    assert sum(t.n for t in tasks) == 3000 and max(t.n for t in tasks) < 1000
    assert sequences.where("size(conversations) > 500").isEmpty()


def test_escape_round_trip():
    for text in [t for t in odd_texts() if t] + TRICKY:
        assert chat.unescape(chat.escape(text)) == text
        assert chat.turns_of("".join(chat.segments(text[:50], text)) * 2) == [(text[:50], text)] * 2
    with pytest.raises(ValueError):
        chat.turns_of("[INST] open")


def test_empty_table(spark, rows):
    assert chat.conversations(chat.format_conversations(rows.limit(0), BYTE), BYTE).count() == 0


def test_a_row_group_holds_few_sequences(spark, rows):
    """However well sequences compress, a reader unpacks a bounded number of them at a time."""
    from vecspark.llm.components import kept_table
    from vecspark.plans.workspace import scratch_path

    sequences = chat.format_conversations(rows, BYTE, 60, 1).coalesce(1)
    sequences = kept_table(sequences, "chat", compression="zstd", **chat.FILE_OPTIONS)
    assert max(groups_of(sequences)) <= 16 and sum(groups_of(sequences)) == sequences.count() > 32
    spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn int, role string, text string").write.parquet(
        f"{(folder := scratch_path(spark, 'tables'))}/conversations.parquet")
    kept = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "kept_table", lambda df, purpose, **options: kept.append(options) or kept_table(df, purpose, **options))
        assert queries.op12_chat(spark, folder).count() == 2
    assert chat.FILE_OPTIONS.items() <= kept[0].items()


def groups_of(table):
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in table.inputFiles()]
    return [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
