"""Documents on top of a collection: add, search, score, diversify, get, delete.

A document is ``(id, page_content, metadata)``. Its text is the item's
contents, so that metadata filters never read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import COSINE, similarity_score
from ..operators import mmr
from ..sources.items import to_variant
from .collection import Collection, VectorStore
from .workspace import scratch_path

DEFAULT_K = 4
FETCH_FACTOR = 2


class TextStore:
    def __init__(self, collection: Collection):
        if collection.embedder is None:
            raise ValueError("a text store needs a collection with an embedder")
        self.collection = collection
        self.spark = collection.spark

    # -- building -------------------------------------------------------------

    @classmethod
    def open(cls, store: VectorStore, name: str, key: bytes, embedder, metric: str = COSINE, **options) -> "TextStore":
        """Open the collection, or create it with the embedder's dimension."""
        return cls(store.open_or_create(name, key, embedder, metric=metric, **options))

    @classmethod
    def from_texts(cls, store, name, key, texts: DataFrame, embedder, metadata: dict | None = None, **options):
        """``texts`` has ``text`` and optional ``id, metadata``; ``metadata`` applies to rows without their own."""
        built = cls.open(store, name, key, embedder, **options)
        built.add_texts(texts, metadata)
        return built

    @classmethod
    def from_documents(cls, store, name, key, documents: DataFrame, embedder, **options):
        built = cls.open(store, name, key, embedder, **options)
        built.add_documents(documents)
        return built

    # -- writing --------------------------------------------------------------

    def add_texts(self, texts: DataFrame, metadata: dict | None = None) -> DataFrame:
        """Embed and upsert; returns the ids. Rows without an ``id`` column get a generated one."""
        return self._add(texts.withColumnRenamed("text", "page_content"), metadata)

    def add_documents(self, documents: DataFrame) -> DataFrame:
        """Documents ``(page_content[, id, metadata])``; a given ``vector`` column is taken as it is."""
        return self._add(documents, None)

    add_vectors = add_documents

    def _add(self, documents: DataFrame, shared: dict | None) -> DataFrame:
        spark = self.spark
        own = to_variant(F.col("metadata"), documents.schema["metadata"].dataType) \
            if "metadata" in documents.columns else F.parse_json(F.lit(None).cast("string"))
        common = F.parse_json(F.lit(_json(shared or {})))
        ids = F.col("id").cast("string") if "id" in documents.columns else F.uuid()
        given = [F.col("vector")] if "vector" in documents.columns else []
        rows = documents.select(ids.alias("id"), *given, F.col("page_content").alias("contents"),
                                F.coalesce(own, common).alias("metadata"))
        batch = self.collection.write_batch(rows)
        if batch is None:
            return spark.createDataFrame([], "id string")
        # generated ids are read back from what was stored, never computed twice
        return spark.read.schema("id string").parquet(batch).select("id")

    def delete(self, ids=None) -> None:
        if ids is not None and not (isinstance(ids, (list, tuple)) and not ids):
            self.collection.delete(ids)

    # -- reading --------------------------------------------------------------

    def get(self, ids) -> DataFrame:
        """``(pos, id, page_content, metadata)`` in request order."""
        found = self.collection.get(ids, include=("contents", "metadata"))
        return found.select("pos", "id", _text(), "metadata").orderBy("pos")

    def list_ids(self, filters: dict | None = None) -> DataFrame:
        return self.collection.list_ids(filters)

    def similarity_search(self, queries, k: int = DEFAULT_K, filters: dict | None = None) -> DataFrame:
        """``(query_id, rank, id, page_content, metadata)`` for a text or a frame ``(query_id, text)``."""
        return self.similarity_search_with_score(queries, k, filters).drop("score")

    def similarity_search_with_score(self, queries, k: int = DEFAULT_K, filters: dict | None = None) -> DataFrame:
        hits = self.collection.query(contents=queries, top_k=k, filters=filters,
                                     include=("distance", "metadata", "contents"))
        return self._scored(hits)

    def similarity_search_by_vector_with_score(self, queries, k: int = DEFAULT_K, filters: dict | None = None) -> DataFrame:
        hits = self.collection.query(queries, top_k=k, filters=filters, include=("distance", "metadata", "contents"))
        return self._scored(hits)

    def _scored(self, hits: DataFrame, extra=()) -> DataFrame:
        score = similarity_score(self.collection.state()["metric"], F.col("distance"))
        return hits.select("query_id", "rank", "id", _text(), "metadata", score.alias("score"), *extra)

    def max_marginal_relevance_search(self, queries, k: int = DEFAULT_K, fetch_k: int | None = None,
                                      weight: float = mmr.DEFAULT_LAMBDA, filters: dict | None = None) -> DataFrame:
        """``(query_id, mmr_rank, id, page_content, metadata, score)``; stored vectors tell the similarity."""
        fetch = fetch_k if fetch_k is not None else FETCH_FACTOR * k
        hits = self.collection.query(contents=queries, top_k=max(fetch, 1), filters=filters, include=("distance", "vector"))
        score = similarity_score(self.collection.state()["metric"], F.col("distance"))
        picked = mmr.mmr_select(hits.select("query_id", "rank", "id", score.alias("score"), "vector"), k, weight)
        # the picks are written, so that the search runs once; their payload is fetched for them alone
        spark, path = hits.sparkSession, scratch_path(hits.sparkSession, "mmr")
        picked = picked.select("query_id", "mmr_rank", "id", "score")
        picked.write.parquet(path)
        payload = self.collection.payload(spark.read.schema(picked.schema).parquet(path), ("contents", "metadata"))
        return payload.select("query_id", "mmr_rank", "id", _text(), "metadata", "score")


def _text():
    return F.coalesce(F.col("contents").cast("string"), F.lit("")).alias("page_content")


def _json(value: dict) -> str:
    import json
    return json.dumps(value)
