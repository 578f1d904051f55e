"""Row checks for items, as one errors column computed in the same pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def item_errors(df: DataFrame, dimension: int | None = None, vector_required: bool = True) -> Column:
    """Array of messages, empty for a good row; expects ``id``, ``vector``, ``metadata``."""
    def note(condition: Column, message: str) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), F.lit(message))

    vector = F.col("vector")
    real = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    checks = [
        note(F.col("id").isNull(), "missing required 'id' field"),
        note(F.trim(F.col("id")) == "", "'id' cannot be blank"),
        note(F.size(vector) == 0, "vector cannot be empty"),
        note(real, "vector elements must be finite numbers"),
    ]
    if vector_required:
        checks.append(note(vector.isNull(), "missing required 'vector' field"))
    if dimension:
        wrong = (F.size(vector) > 0) & (F.size(vector) != dimension)
        checks.append(note(wrong, f"vector dimension must be {dimension}"))
    if "metadata" in df.columns and isinstance(df.schema["metadata"].dataType, T.VariantType):
        shape = F.schema_of_variant(F.col("metadata"))
        scalar = ~(shape.startswith("OBJECT") | (shape == "VOID"))
        checks.append(note(scalar, "metadata must be an object or null"))
    return F.array_compact(F.array(*checks))


def with_errors(df: DataFrame, dimension: int | None = None, vector_required: bool = True) -> DataFrame:
    return df.withColumn("errors", item_errors(df, dimension, vector_required))


def require_valid(df: DataFrame, dimension: int | None = None, vector_required: bool = True) -> DataFrame:
    """The same rows; the job that reads them fails at a bad one, naming its id and faults."""
    message = F.concat(
        F.lit("Invalid item (id: "), F.coalesce(F.col("id"), F.lit("null")), F.lit("): "),
        F.array_join("errors", "; "))
    checked = with_errors(df, dimension, vector_required)
    good = F.when(F.size("errors") > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return checked.where(good).drop("errors")


def split_valid(df: DataFrame, dimension: int | None = None, vector_required: bool = True):
    """(good rows, bad rows with their ``errors``)."""
    checked = with_errors(df, dimension, vector_required)
    good = checked.where(F.size("errors") == 0).drop("errors")
    return good, checked.where(F.size("errors") > 0)
