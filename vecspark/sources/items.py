"""Sources and sinks of item rows ``(id, vector, contents, is_text, metadata)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.contents import decode_contents, encode_contents


def to_variant(column: Column, kind: T.DataType) -> Column:
    """Metadata in any common shape as VARIANT: JSON text, struct, map or VARIANT."""
    if isinstance(kind, T.VariantType):
        return column
    if isinstance(kind, T.StringType):
        return F.parse_json(column)
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.parse_json(F.to_json(column))
    if isinstance(kind, T.NullType):
        return F.parse_json(column.cast("string"))
    raise ValueError(f"metadata cannot be read from {kind.simpleString()}")


def item_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Any frame with ``id`` and optional ``vector, contents, metadata`` as item rows.

    ``keep`` names further columns to carry along.
    """
    if "id" not in df.columns:
        raise ValueError("items need an 'id' column")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    vector = F.col("vector") if "vector" in kinds else F.lit(None).cast("array<float>")
    if "vector" in kinds and not (isinstance(kinds["vector"], T.ArrayType)
                                  and isinstance(kinds["vector"].elementType, (T.FloatType, T.DoubleType))):
        vector = vector.cast("array<double>")
    contents, is_text = F.lit(None).cast("binary"), F.lit(None).cast("boolean")
    if "contents" in kinds and not isinstance(kinds["contents"], T.NullType):
        text = isinstance(kinds["contents"], T.StringType)
        contents = F.col("contents").cast("binary")
        is_text = F.col("is_text") if "is_text" in kinds else F.when(F.col("contents").isNotNull(), F.lit(text))
    metadata = to_variant(F.col("metadata"), kinds["metadata"]) if "metadata" in kinds \
        else F.parse_json(F.lit(None).cast("string"))
    return df.select(F.col("id").cast("string").alias("id"), vector.alias("vector"), contents.alias("contents"),
                     is_text.alias("is_text"), metadata.alias("metadata"), *keep)


def length_error(ids: str, vectors: str) -> Column:
    """What is wrong with a pair of parallel arrays; null when their lengths agree."""
    message = F.concat(F.lit("array length mismatch: "), F.size(ids).cast("string"), F.lit(" ids but "),
                       F.size(vectors).cast("string"), F.lit(" vectors"))
    return F.when(F.size(ids) != F.size(vectors), message)


def from_arrays(df: DataFrame, ids: str = "ids", vectors: str = "vectors") -> DataFrame:
    """Parallel arrays per row to item rows; the job fails when their lengths differ."""
    error = length_error(ids, vectors)
    checked = F.when(error.isNotNull(), F.raise_error(error).cast("boolean")).otherwise(F.lit(True))
    pairs = F.arrays_zip(F.col(ids).alias("id"), F.col(vectors).alias("vector"))
    return item_rows(df.where(checked).select(F.inline(pairs).alias("id", "vector")))


def read_items_json(spark: SparkSession, path: str, binary_contents: bool = False, element: str = "double") -> DataFrame:
    """JSON lines ``{id, vector, contents, metadata}``; an absent field is null."""
    raw = spark.read.schema(f"id string, vector array<{element}>, contents string, metadata variant").json(path)
    if binary_contents:
        raw = raw.withColumn("contents", decode_contents(F.col("contents")))
    return item_rows(raw)


def write_items_json(items: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, one item each; null fields are left out, bytes are written as base64."""
    text = F.when(F.col("is_text"), F.col("contents").cast("string")).otherwise(encode_contents(F.col("contents")))
    items.select("id", "vector", text.alias("contents"), "metadata").write.mode(mode).json(path)


def read_recall_fixture(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A fixture file of parallel arrays as frames keyed by position.

    ``items``: id (position as text), vector, metadata. ``queries``: query_id,
    qv. ``neighbors``: query_id, untrained, trained. ``filters``: filter_id,
    name, filter JSON, and per filter the matches and neighbour positions.
    """
    schema = """
        vectors array<array<double>>, queries array<array<double>>, metadata array<variant>,
        metadata_queries array<variant>, metadata_query_names array<string>,
        untrained_neighbors array<array<int>>, trained_neighbors array<array<int>>,
        untrained_metadata_matches array<array<int>>, trained_metadata_matches array<array<int>>,
        untrained_metadata_neighbors array<array<array<int>>>, trained_metadata_neighbors array<array<array<int>>>,
        untrained_recall double, trained_recall double, num_untrained_vectors int, num_trained_vectors int
    """
    whole = spark.read.schema(schema).option("multiLine", True).json(path)
    items = whole.select(F.posexplode(F.arrays_zip("vectors", "metadata")).alias("pos", "x")).select(
        F.col("pos").cast("string").alias("id"), F.col("x.vectors").alias("vector"), F.col("x.metadata").alias("metadata"))
    queries = whole.select(F.posexplode("queries").alias("query_id", "qv"))
    neighbors = whole.select(F.posexplode(F.arrays_zip("untrained_neighbors", "trained_neighbors")).alias("query_id", "x")) \
        .select("query_id", F.col("x.untrained_neighbors").alias("untrained"), F.col("x.trained_neighbors").alias("trained"))
    parts = ["metadata_queries", "metadata_query_names", "untrained_metadata_matches", "trained_metadata_matches",
             "untrained_metadata_neighbors", "trained_metadata_neighbors"]
    filters = whole.select(F.posexplode(F.arrays_zip(*parts)).alias("filter_id", "x")).select(
        "filter_id", F.col("x.metadata_query_names").alias("filter_name"),
        F.to_json("x.metadata_queries").alias("filter"), *[F.col(f"x.{p}").alias(p) for p in parts[2:]])
    figures = whole.select("untrained_recall", "trained_recall", "num_untrained_vectors", "num_trained_vectors")
    return {"items": items, "queries": queries, "neighbors": neighbors, "filters": filters, "figures": figures}
