"""Token ids of documents as Parquet files in ascending ``doc_id`` order.

One row per document: ``part, doc_id, start, n_tokens, ids``. ``ids`` is a list
column with dictionary pages (a vocabulary fits one dictionary, so an id costs
at most 16 bits before compression); the integer columns are delta encoded,
since they ascend. Row groups and pages have given sizes and the writer adds
page indexes, so a reader that wants a few documents, or only the lengths,
reads a few pages. Files are written by Spark alone, hence to any store.

``start`` in a file counts from the file's first id; ``read_tokens`` adds what
earlier parts hold.

Null texts are empty; every document ends with ``end_id``, so no row is lost.
Rows with one ``doc_id`` are ordered by their text's hash; null ids come first.
An empty table makes files without rows. Columns other than ``doc_id`` and
``text`` are ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, strings
from .tokens import id_bytes, ids_of

ROW_GROUP_BYTES = 32 << 20
PAGE_ROWS = 2_000
END_ID = 1


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
    compression: str = "zstd",
) -> None:
    """Encode ``docs`` (``doc_id, text``) and write the files below ``path``.

    Texts are range partitioned by id before they are encoded, so the costly
    step runs once, in the task that writes, and a lost task is simply repeated.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ])
    out = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids", pa.list_(pa.field("element", pa.int32(), nullable=False)))])
    end = id_bytes([end_id])

    def encode(batches):
        start = 0
        for batch in batches:
            for rows in slices(batch):
                ids = [ids_of(t, tokenizer) + end for t in strings(rows)]
                counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
                ends = np.cumsum(counts)
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), dtype="<i4")), type=out.field("ids").type)
                columns = [rows.column(0), rows.column(1), pa.array(start + ends - counts), pa.array(counts), lists]
                start += int(ends[-1])
                fields = pa.schema([out.field(0), pa.field("doc_id", columns[1].type), *[out.field(i) for i in (2, 3, 4)]])
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_order"))
        .repartitionByRange("doc_id", "_order")
        .sortWithinPartitions("doc_id", "_order")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    writer = ordered.mapInArrow(encode, schema).write.option("compression", compression)
    for option, value in {
        "parquet.block.size": row_group_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "true",
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "start", "n_tokens")},
    }.items():
        writer = writer.option(option, value)
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """``doc_id, start, n_tokens`` and the given columns; ``start`` counts the ids of all documents before.

    Only the columns asked for are read. What earlier parts hold is one number
    per part, broadcast; parts are as many as the files.
    """
    rows = spark.read.parquet(path)
    ends = rows.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(ends), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", *columns)


def with_crc32(rows: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``, the unsigned crc32 of the ids as little-endian 32-bit integers."""
    kept = [f for f in rows.schema.fields if f.name != "ids"]
    schema = T.StructType([*kept, T.StructField("ids_crc32", T.LongType())])

    def digest(batches):
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            lists = batch.column(at)
            values = memoryview(lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]) * 4
            crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(crc, pa.int64())], names=[*names, "ids_crc32"])

    return rows.mapInArrow(digest, schema)
