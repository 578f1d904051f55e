"""Conversations as prefix trees of token segments.

Every turn becomes marks of its role around its text. Control strings inside
texts and role names get a backslash after their first character, so that marks
are always marks and every text can be read back.

Conversations are dealt by range of their path, the hashes of their turns in
order, so that those which share initial turns are neighbours; a shared turn or
a group of copies of any size is split between tasks at its later turns or its
ids. A task walks its sorted conversations as a depth-first traversal of the
tree and writes bounded sequences. Inside a sequence a turn that several
conversations share stands once. A turn is a node with its range of tokens and
its parent; it may attend to itself and to the ranges of its ancestors, of which
neighbouring ones are merged. Position ids go on from the parent's last token,
so they are those of the conversation on its own. The loss mask covers the
tokens of assistant texts. A sequence that is full ends, and the next begins
with the path it hangs on; only a longer conversation makes a longer sequence.

The turns of a conversation are ordered by turn, then role, then text, nulls
first; repeated rows are turns of their own. A null text or role is empty. Rows
without a conversation id form one conversation with a null id. One conversation
is held by one task, as a document is. Other columns are ignored, and an empty
table has no sequences.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import kept_table
from .tokens import BYTE_NAMES, UnitEncoder, id_bytes
from .worker import kept

# The marks of each role, and of any other role around its name.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
LOSS_ROLE = "assistant"

SEQUENCE_TOKENS = 1 << 16
SEQUENCE_CONVERSATIONS = 1 << 12

# A reader unpacks a row group at a time, however well its sequences compress.
FILE_OPTIONS = {"parquet.block.row.count.limit": 16}

_CONTROL = re.compile(r"([\[<])(\\*)(/?(?:SYS|INST|ROLE)\]|TEXT\]|/?s>)")
_ESCAPED = re.compile(r"([\[<])\\(\\*(?:/?(?:SYS|INST|ROLE)\]|TEXT\]|/?s>))")
_TURN = re.compile(r"\[SYS\] (.*?) \[/SYS\]|\[INST\] (.*?) \[/INST\]|<s>(.*?)</s>|\[ROLE\] (.*?) \[TEXT\] (.*?) \[/ROLE\]", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def segments(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text of a turn, the escaped text, and what stands behind."""
    if role in MARKS:
        return MARKS[role][0], escape(text), MARKS[role][1]
    return OTHER[0] + escape(role) + OTHER[1], escape(text), OTHER[2]


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of every turn of a formatted conversation."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn begins at character {at}")
        at = m.end()
        system, user, assistant, role, text = m.groups()
        if role is not None:
            found.append((unescape(role), unescape(text)))
        else:
            own = next(i for i, x in enumerate((system, user, assistant)) if x is not None)
            found.append((("system", "user", "assistant")[own], unescape((system, user, assistant)[own])))
    if at != len(formatted):
        raise ValueError(f"no turn begins at character {at}")
    return found


class Coder:
    """Ids of segments by a byte-level tokenizer, and bytes of ids."""

    def __init__(self, path: str):
        self.units = UnitEncoder(path, True, id_bytes, b"".join)
        self.units.library.encode_special_tokens = True
        names = {chr(c): b for b, c in BYTE_NAMES.items()}
        vocab = self.units.library.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes[i] = piece.encode() if piece in self.units.special else b"".join(
                bytes([names[c]]) if c in names else c.encode("latin-1") for c in piece)

    def ids(self, text: str) -> bytes:
        return self.units.encode(text)

    def text(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode()


class Sequence:
    """One sequence while it is written: nodes in depth-first order."""

    def __init__(self):
        self.ids, self.positions, self.loss, self.nodes, self.conversations, self.size = [], [], [], [], [], 0

    def add(self, coded: tuple, parent: int) -> int:
        """Append a turn below node ``parent`` (-1: none) and return its number."""
        size = sum(len(x) // 4 for x in coded)
        above = self.nodes[parent] if parent >= 0 else None
        first = above["position"] + above["end"] - above["start"] if above else 0
        attend = [dict(x) for x in above["attend"]] if above else []
        if above:                                       # the parent's own range joins its ancestors'
            if attend and attend[-1]["end"] == above["start"]:
                attend[-1]["end"] = above["end"]
            else:
                attend.append({"start": above["start"], "end": above["end"]})
        self.nodes.append({"start": self.size, "end": self.size + size, "parent": parent, "position": first, "attend": attend})
        self.ids += coded
        self.positions.append(np.arange(first, first + size, dtype=np.int32))
        self.size += size
        return len(self.nodes) - 1


NODE = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("parent", T.IntegerType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("attend", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
_NODES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("parent", pa.int32()), ("position", pa.int32()),
                             ("attend", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))


def format_conversations(rows: DataFrame, tokenizer: str, sequence_tokens: int = SEQUENCE_TOKENS,
                         sequence_conversations: int = SEQUENCE_CONVERSATIONS) -> DataFrame:
    """Sequences of ``rows`` (conv_id, turn, role, text).

    ``token_ids, position_ids, loss_mask`` run over the tokens; ``nodes`` holds
    start, end, parent, first position and the ancestor ranges of every turn;
    ``conversations`` the ids with their last node.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])).alias("path"),
                         F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    # written first: the ranges are found from the paths alone
    whole = kept_table(whole, "conversations", compression="zstd")
    dealt = whole.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").select("conv_id", "turns")
    id_type = whole.schema["conv_id"].dataType
    member = T.StructType([T.StructField("conv_id", id_type), T.StructField("leaf", T.IntegerType())])
    schema = T.StructType([
        T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("position_ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss_mask", T.ArrayType(T.BooleanType())), T.StructField("nodes", T.ArrayType(NODE)),
        T.StructField("conversations", T.ArrayType(member))])

    def written(s: Sequence, member_type) -> pa.RecordBatch:
        def one(values, kind):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

        mask = np.concatenate([np.full(len(x) // 4, i % 3 == 1 and s.loss[i // 3]) for i, x in enumerate(s.ids)])
        return pa.RecordBatch.from_arrays([
            one(np.frombuffer(b"".join(s.ids), "<i4"), pa.int32()), one(np.concatenate(s.positions), pa.int32()), one(mask, pa.bool_()),
            pa.array([s.nodes], _NODES), pa.array([s.conversations], pa.list_(member_type))], names=schema.names)

    def run(batches):
        coder = kept(f"chat {tokenizer}", lambda: Coder(tokenizer))
        sequence, path, coded = Sequence(), [], []       # path: (role, text) and node of the last conversation's turns
        for batch in batches:
            member_type = pa.struct([("conv_id", batch.schema.field(0).type), ("leaf", pa.int32())])
            for conv_id, turns in zip(batch.column(0).to_pylist(), batch.column(1)):
                turns = [(t["role"], t["text"]) for t in turns.as_py()]
                shared = 0
                while shared < min(len(path), len(turns)) and path[shared][0] == turns[shared]:
                    shared += 1
                coded = coded[:shared] + [tuple(map(coder.ids, segments(*t))) for t in turns[shared:]]
                added = sum(len(x) for c in coded[shared:] for x in c) // 4
                if sequence.conversations and (sequence.size + added > sequence_tokens or len(sequence.conversations) >= sequence_conversations):
                    yield written(sequence, member_type)
                    sequence, shared = Sequence(), 0
                path = path[:shared]
                for own, ids in zip(turns[shared:], coded[shared:]):
                    path.append((own, sequence.add(ids, path[-1][1] if path else -1)))
                    sequence.loss.append(own[0] == LOSS_ROLE)
                sequence.conversations.append({"conv_id": conv_id, "leaf": path[-1][1]})
        if sequence.conversations:
            yield written(sequence, member_type)

    return dealt.mapInArrow(run, schema)


def conversations(sequences: DataFrame, tokenizer: str) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` read back from sequences."""
    member = sequences.schema["conversations"].dataType.elementType
    schema = T.StructType([
        T.StructField("conv_id", member["conv_id"].dataType), T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def read(coder: Coder, ids: np.ndarray, mask: np.ndarray, nodes: list, leaf: int) -> tuple:
        own = nodes[leaf]
        ranges = [*[(x["start"], x["end"]) for x in own["attend"]], (own["start"], own["end"])]
        path = np.concatenate([ids[a:b] for a, b in ranges])
        marked = np.concatenate([mask[a:b] for a, b in ranges]).astype(np.int8)
        formatted = coder.text(path)
        edges = np.flatnonzero(np.diff(marked, prepend=0, append=0)).reshape(-1, 2)
        loss = "".join(unescape(coder.text(path[a:b])) for a, b in edges.tolist())
        turns = turns_of(formatted)
        return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                hashlib.sha256(loss.encode()).hexdigest(), len(formatted))

    def run(batches):
        coder = kept(f"chat {tokenizer}", lambda: Coder(tokenizer))
        for batch in batches:
            for i in range(batch.num_rows):
                ids, mask = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (0, 1))
                nodes, members = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                leaves = {m["leaf"]: None for m in members}
                for leaf in leaves:
                    leaves[leaf] = read(coder, ids, mask, nodes, leaf)
                rows = [leaves[m["leaf"]] for m in members]
                yield pa.RecordBatch.from_arrays([
                    batch.column(3)[i].values.field(0), *[pa.array([r[c] for r in rows], kind) for c, kind in enumerate(
                        (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]], names=schema.names)

    return sequences.select("token_ids", "loss_mask", "nodes", "conversations").mapInArrow(run, schema)
