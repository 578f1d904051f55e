"""Packing documents into sequences of several context sizes, without padding but at the very end.

Each task packs the documents it reads, a buffer of them at a time, so nothing
is shuffled and the order of the input (a mix of sources, say) stays local. A
document is cut into full windows of the largest size; what is left of it goes
to the tier of the smallest context size that holds it. Tiers are packed from
the largest down: the longest rest opens a window, the gap is filled with the
longest rests of this and shorter tiers that fit, and the last gap by cutting a
rest in two. A window is thus full. Rests that fill no window wait for the next
buffer; at the end of a task they become sequences of powers of two, each full
again, so a task pads nothing.

Full windows of one tier are grouped into steps of equal tokens
(``step_tokens``); only the last step of a tier in a task may hold less.

Long texts are cut into windows like others, and ids of documents are held only
until they are packed. Other columns are ignored under any name.
Null texts are empty documents and hold ``end_id`` alone. Rows with one id are
packed one by one. An empty table has no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, strings
from .tokens import id_bytes, ids_of

TIERS = (2048, 1024, 512, 256)      # context sizes, powers of two, largest first
STEP_TOKENS = 1 << 16
BUFFER_TOKENS = 1 << 22
END_ID = 1
TASK_BITS = 33                      # sequences of one task have numbers below 2 ** TASK_BITS


class Packer:
    """Packs rests ``(length, document, start)`` of one task; ``emit`` gets every closed sequence."""

    def __init__(self, tiers: tuple[int, ...], emit):
        self.tiers, self.emit = tiers, emit
        self.rests: list[tuple[int, int, int]] = []      # ascending by length
        self.held = 0

    def add(self, document: int, length: int) -> None:
        top, start = self.tiers[0], 0
        while length - start >= top:
            self.emit(top, [(document, start, top)])
            start += top
        if length > start:
            insort(self.rests, (length - start, document, start))
            self.held += length - start

    def fill(self, size: int) -> None:
        """Close one window of ``size`` tokens; at least as many are held."""
        pieces, gap = [], size
        while gap:
            at = bisect_right(self.rests, gap, key=lambda r: r[0]) - 1
            if at >= 0:
                length, document, start = self.rests.pop(at)
            else:                       # every rest is longer than the gap: cut the shortest
                length, document, start = self.rests.pop(0)
                insort(self.rests, (length - gap, document, start + gap))
                length = gap
            pieces.append((document, start, length))
            gap -= length
        self.held -= size
        self.emit(size, pieces)

    def pack(self) -> None:
        """Close the windows that the rests can fill, tier by tier."""
        for size, below in zip(self.tiers, [*self.tiers[1:], 0]):
            while self.held >= size and self.rests and self.rests[-1][0] > below:
                self.fill(size)

    def finish(self) -> None:
        """Close everything: full windows first, then powers of two."""
        self.pack()
        size = self.tiers[0]
        while size:
            while self.held >= size:
                self.fill(size)
            size //= 2


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS,
    buffer_tokens: int = BUFFER_TOKENS,
    with_ids: bool = False,
    order: tuple = (),
) -> DataFrame:
    """One row per piece of a document.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: the
    piece ``[start, start + length)`` of the document's ids and its place in the
    sequence. ``context`` is the sequence's size, ``step_group`` its step,
    ``ids`` (on request) the piece's ids. ``order`` (columns) is the order in
    which documents are packed and sequences numbered; without it they are taken
    as they are read.
    """
    if any(t < 1 or t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers must be different powers of two, largest first")
    longs = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_group")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]
                          + [T.StructField(n, T.LongType()) for n in longs]
                          + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))
    end = id_bytes([end_id])

    def run(batches):
        ids: dict[int, bytes] = {}         # of documents that are not packed whole yet
        names: dict[int, object] = {}
        pending: dict[int, int] = {}
        columns: list[list] = [[] for _ in range(len(longs) + 1 + with_ids)]
        state = {"base": None, "next": 0}
        steps: dict[int, list] = {}
        groups = {"next": 0}
        id_type = pa.int64()

        def emit(size: int, pieces: list) -> None:
            number = state["base"] + state["next"]
            state["next"] += 1
            group = steps.get(size)
            if group is None or group[1] + size > step_tokens:
                group = steps[size] = [state["base"] + groups["next"], 0]
                groups["next"] += 1
            group[1] += size
            offset = 0
            for document, start, length in pieces:
                raw = ids[document]
                part = raw[4 * start:4 * (start + length)]
                row = (names[document], start, length, zlib.crc32(part), len(raw) // 4, number, offset, size, group[0])
                for column, value in zip(columns, row):
                    column.append(value)
                if with_ids:
                    columns[-1].append(np.frombuffer(part, dtype="<i4"))
                offset += length
                pending[document] -= length
                if not pending[document]:
                    del ids[document], names[document], pending[document]

        def rows():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:len(longs) + 1]],
                 *([pa.array(columns[-1], pa.list_(pa.int32()))] if with_ids else [])],
                names=["doc_id", *longs, *(["ids"] if with_ids else [])])
            for column in columns:
                column.clear()
            return batch

        packer, document, buffered = Packer(tiers, emit), 0, 0
        for batch in batches:
            for part in slices(batch):
                if state["base"] is None and part.num_rows:
                    state["base"] = part.column(2)[0].as_py() << TASK_BITS
                id_type = part.column(0).type
                for name, text in zip(part.column(0).to_pylist(), strings(part)):
                    raw = ids_of(text, tokenizer) + end
                    ids[document], names[document], pending[document] = raw, name, len(raw) // 4
                    packer.add(document, len(raw) // 4)
                    buffered += len(raw) // 4
                    document += 1
                if buffered >= buffer_tokens:
                    packer.pack()
                    buffered = 0
                if len(columns[0]) >= 10_000:
                    yield rows()
        packer.finish()
        if columns[0]:
            yield rows()

    rows = docs.select("doc_id", "text", *[c.alias(f"_order{i}") for i, c in enumerate(order)])
    if order:
        places = [f"_order{i}" for i in range(len(order))]
        rows = rows.repartitionByRange(*places).sortWithinPartitions(*places)
    return rows.select("doc_id", "text", F.spark_partition_id().alias("_task")).mapInArrow(run, schema)


def written_order(docs: DataFrame) -> tuple:
    """File and row of each row of ``docs``, as a mixing job has written them; nothing for rows that are not read from files."""
    place = (docs.metadataColumn("_metadata")["file_name"], docs.metadataColumn("_metadata")["row_index"])
    try:
        docs.select(*place).schema
    except AnalysisException:
        return ()
    return place
