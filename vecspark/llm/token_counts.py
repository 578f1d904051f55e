"""Token counts of whole texts by two tiers of known pieces, without any shuffle.

The first tier is a compact table of the most frequent pieces of a sample of
about ``SAMPLE_ROWS`` rows, which a hash picks from all files and Spark counts, with their token counts, at most
``FREQUENT_PIECES`` pieces of at most ``LONGEST`` characters, broadcast. Pieces
it lacks are encoded by the library and remembered in the worker's cache. The
sample only decides what is looked up fast, never a result.

Null texts are empty: no bytes, no tokens, not over the limit. Rows are counted
one by one, so copies, ties and rows with one id all stay. Only ``doc_id`` and
``text`` are read. Long texts are encoded whole, piece by piece.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, strings
from .tokens import LONGEST, PIECES_DROPPED, PIECES_SPACED, UnitEncoder
from .worker import forget, kept

SAMPLE_ROWS = 2_000
FREQUENT_PIECES = 1 << 16
LIMIT = 1024

def frequent_pieces(docs: DataFrame, spaced: bool, rows: int = SAMPLE_ROWS, most: int = FREQUENT_PIECES) -> list[str]:
    """The most frequent pieces of about ``rows`` documents that a hash of text and id picks from all files."""
    pattern = PIECES_SPACED if spaced else PIECES_DROPPED
    each = max(1, docs.count() // max(rows, 1))

    def count(batches):
        seen = Counter()
        for batch in batches:
            for part in slices(batch):
                for text in strings(part):
                    seen.update(p for p in pattern.findall(text if spaced else text.lower()) if len(p) <= LONGEST)
                if len(seen) > 8 * most:
                    yield counted(seen)
                    seen.clear()
        yield counted(seen)

    def counted(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["piece", "n"])

    picked = docs.where(F.length("text") > 0).where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(each)) == 0)
    found = picked.select("text").mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return [r.piece for r in found.orderBy(F.desc("n"), "piece").limit(most).select("piece").collect()]


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    spaced: bool = True,
    limit: int = LIMIT,
    sample_rows: int = SAMPLE_ROWS,
    frequent: int = FREQUENT_PIECES,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``spaced`` tells how the tokenizer cuts words, see ``tokens.UnitEncoder``.
    """
    pieces = frequent_pieces(docs, spaced, sample_rows, frequent)
    pieces = [p for p in pieces if p.strip()]      # "\n" parts them below
    lengths = bytes(UnitEncoder(tokenizer, spaced, len, sum).values(pieces))      # LONGEST characters, under 256 tokens
    shared, version = docs.sparkSession.sparkContext.broadcast(("\n".join(pieces), lengths)), uuid.uuid4().hex
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def encoder() -> UnitEncoder:
        joined, counts = shared.value
        forget("counts ")
        return UnitEncoder(tokenizer, spaced, len, sum, dict(zip(joined.split("\n"), counts)))

    def count(batches):
        tokens = kept(f"counts {version}", encoder)
        for batch in batches:
            for rows in slices(batch):
                texts = strings(rows)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([tokens.encode(t) for t in texts], pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select("doc_id", "text").mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
