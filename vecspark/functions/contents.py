"""Coding of contents and of documents that carry their text in metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_KEY = "_content"    # fixed value: the metadata key that holds a document's text


def encode_contents(contents: Column) -> Column:
    """Bytes as base64 text on one line, for JSON files."""
    return F.translate(F.base64(contents), "\r\n", "")


def decode_contents(text: Column) -> Column:
    return F.unbase64(text)


def pack_document(metadata: Column, text: Column) -> Column:
    """Metadata (null counts as ``{}``) with the text under the text key."""
    fields = F.coalesce(F.try_variant_get(metadata, "$", "map<string,variant>"), _no_fields())
    kept = F.map_filter(fields, lambda k, _: k != TEXT_KEY)
    entry = F.map_from_arrays(F.array(F.lit(TEXT_KEY)), F.array(F.parse_json(_json_text(text))))
    return F.to_variant_object(F.map_concat(kept, entry))


def unpack_text(metadata: Column) -> Column:
    return F.coalesce(F.try_variant_get(metadata, f"$.{TEXT_KEY}", "string"), F.lit(""))


def unpack_metadata(metadata: Column) -> Column:
    """Metadata without the text key."""
    fields = F.coalesce(F.try_variant_get(metadata, "$", "map<string,variant>"), _no_fields())
    return F.to_variant_object(F.map_filter(fields, lambda k, _: k != TEXT_KEY))


def _no_fields() -> Column:
    return F.from_json(F.lit("{}"), "map<string,variant>")


def _json_text(text: Column) -> Column:
    """A string as a JSON string literal."""
    wrapped = F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("t")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)
