"""Structured Streaming: upserts into a collection, and searches against one."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.collection import Collection


def query_id(stream_session, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint; it stays over restarts."""
    record = stream_session.read.text(f"{checkpoint}/metadata").first()
    return json.loads(record["value"])["id"]


def upsert_stream(stream: DataFrame, collection: Collection, checkpoint: str,
                  available_now: bool = False, order=None, mode: str = "fail", rejects: str | None = None) -> StreamingQuery:
    """Upsert every micro-batch.

    The collection remembers the last batch of each query, known by the id in
    its checkpoint, so a batch that is repeated after a failure is stored once
    and streams never take each other's batches for their own. With
    ``mode="split"`` bad rows go to ``rejects/query=.../batch=...``.
    """
    if mode == "split" and rejects is None:
        raise ValueError("mode 'split' needs a folder for rejects")

    def write(batch: DataFrame, batch_id: int) -> None:
        name = query_id(batch.sparkSession, checkpoint)
        folder = f"{rejects}/query={name}/batch={batch_id}" if rejects is not None else None
        collection.upsert(batch, mode=mode, order=order, applied=(name, batch_id), rejects=folder)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def query_stream(stream: DataFrame, collection: Collection, target: str, checkpoint: str,
                 available_now: bool = False, **query_options) -> StreamingQuery:
    """Search every micro-batch of queries ``(query_id, qv)``; hits go to ``target/batch_id=...``."""
    def answer(batch: DataFrame, batch_id: int) -> None:
        hits = collection.query(batch, **query_options)
        hits.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
