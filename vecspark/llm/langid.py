"""Language by compression: the language whose texts help most to compress a text.

Each learned language has a zstandard dictionary of raw content: whole training
texts of ordinary length in order of their ids' hash, up to
``DICTIONARY_BYTES``, from a bounded sample of ``SAMPLE_ROWS`` rows per language.
Dictionaries and texts are brought to lower-case words first. A text is cut into
blocks of ``BLOCK_BYTES``, every block is compressed with every dictionary, and
the language with the smallest total wins. The share that the best language would
have if every saved byte doubled its odds ``SHARPNESS`` times is the score.
When the second best needs less than ``MARGIN`` more, the margin is narrow and
the row is marked ``rejected``; its best language is still given.

Texts that are null or have no letter are ``und`` with score 0 and rejected, as
is everything when nothing could be learned. Ties go to the language with
more training rows, then to the first in order. Training rows with a null id,
language or text teach nothing; rows of one id and language count as one. Any
number of languages is learned: dictionaries are a table, of which ``GROUP``
at a time go to the tasks; with more, every group is a pass over the texts, and
each text keeps what it needs of the passes: its two smallest totals and the sum
behind the score. Copies and rows with one id are predicted one by one. Long
texts are cut into blocks; other columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import bounded
from .arrow import slices, strings
from .components import kept_table

DICTIONARY_BYTES = 64 << 10
SAMPLE_ROWS = 256
SAMPLE_CHARS = (200, 8 << 10)      # of a text of ordinary length
GROUP = 128                        # dictionaries that a task holds
BLOCK_BYTES = 8 << 10
LEVEL = 6
SHARPNESS = 0.5
MARGIN = 0.005
UNDETERMINED = "und"
MANY = 100_000                     # language names that are broadcast

_WORD = re.compile(r"[^\W\d_]+")


def learn(docs: DataFrame, allowed: Column, dictionary_bytes: int = DICTIONARY_BYTES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``place, lang, content``: raw content per language from rows of ``docs (doc_id, text, lang)`` for which ``allowed`` holds.

    ``place`` counts from 0, languages with the most rows first.
    """
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & allowed)
    counts = known.groupBy("lang").agg(F.count("*").alias("count"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # written first, so that the window's limit runs before rows are dealt by language
    ids = kept_table(known.select("doc_id", "lang").distinct(), "language-ids")
    chosen = ids.withColumn("order", F.row_number().over(order)).where(F.col("order") <= sample_rows)
    length = F.length("text")
    texts = known.select("doc_id", "lang", "text").where(length > 0).join(bounded(chosen), ["doc_id", "lang"])
    # one row for each id, however often it comes
    shown = F.left("text", F.lit(dictionary_bytes))
    one = texts.groupBy("lang", "order").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), (~length.between(*SAMPLE_CHARS)).alias("odd"), shown.alias("text"))).alias("t"))
    parts = one.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("t.odd", "order", "t.text"))).alias("texts"))     # sample_rows at most
    joined = parts.join(counts, "lang").select("lang", "count", F.left(F.array_join("texts.text", "\n"), F.lit(4 * dictionary_bytes)).alias("text"))

    def content(batches):
        for batch in batches:
            raw = [words_only(t)[:dictionary_bytes] for t in strings(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["lang", "count", "content"])

    named = joined.mapInArrow(content, T.StructType([T.StructField("lang", T.StringType()), T.StructField("count", T.LongType()),
                                                     T.StructField("content", T.BinaryType())]))
    place = F.row_number().over(Window.orderBy(F.desc("count"), "lang")) - 1       # a row for each language
    names = kept_table(named, "languages")
    places = names.select("lang", "count").select("lang", place.cast("long").alias("place"))
    return kept_table(names.join(bounded(places), "lang").select("place", "lang", "content"), "dictionaries")


def words_only(text: str) -> bytes:
    """The words of a text, runs of letters in lower case, parted by spaces."""
    return " ".join(_WORD.findall(text.lower())).encode()


class Compressor:
    """Compressed sizes of texts under every language's dictionary."""

    def __init__(self, contents: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.names = list(contents)
        self.codecs = []
        for content in contents.values():
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=level)
            self.codecs.append(zstandard.ZstdCompressor(
                level=level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: bytes, block: int = BLOCK_BYTES) -> list[int]:
        blocks = [text[i:i + block] for i in range(0, len(text), block)]
        return [sum(len(codec.compress(b)) for b in blocks) for codec in self.codecs]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _state(sizes: np.ndarray, first: int) -> tuple:
    """Of one group's sizes: best place, best and second size, and the odds of all against the best."""
    best = int(np.argmin(sizes))
    others = np.delete(sizes, best)
    return first + best, float(sizes[best]), float(others.min()) if len(others) else None, _odds(sizes, sizes[best])


def _odds(sizes: np.ndarray, best: float) -> float:
    return float(np.exp2(SHARPNESS * np.maximum(best - sizes, -200.0)).sum())


def identify(docs: DataFrame, learned: DataFrame, margin: float = MARGIN, group: int = GROUP) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs``."""
    spark, number = docs.sparkSession, learned.count()
    rows = docs.select("doc_id", "text")
    if number > group:              # read once for each group
        rows = kept_table(rows.withColumn("node", F.monotonically_increasing_id()), "language-texts", compression="zstd")
    else:
        rows = rows.withColumn("node", F.lit(0).cast("long"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("node", T.LongType()), T.StructField("place", T.LongType()),
                           T.StructField("best", T.DoubleType()), T.StructField("second", T.DoubleType()), T.StructField("odds", T.DoubleType())])

    def measured(first: int) -> DataFrame:
        own = learned.where(F.col("place").between(first, first + group - 1)).orderBy("place").toArrow()      # group x dictionary bytes at most
        shared = spark.sparkContext.broadcast(dict(zip(own.column("lang").to_pylist(), own.column("content").to_pylist())))

        def run(batches):
            codec = Compressor(shared.value)
            for batch in batches:
                for part in slices(batch):
                    found = [_state(np.array(codec.sizes(words_only(t)), dtype=float), first) if codec.names and has_letter(t) else (None,) * 4
                             for t in strings(part)]
                    yield pa.RecordBatch.from_arrays([
                        part.column(0), part.column(2), pa.array([f[0] for f in found], pa.int64()),
                        *[pa.array([f[i] for f in found], pa.float64()) for i in (1, 2, 3)]], names=schema.names)

        return rows.mapInArrow(run, schema)

    if number <= group:
        scored = measured(0)
    else:
        parts = measured(0)
        for first in range(group, number, group):
            parts = parts.unionAll(measured(first))
        scored = _over_groups(parts)
    first = (F.col("second") - F.col("best")) < F.greatest(F.lit(1.0), margin * F.col("best"))
    names = F.broadcast(learned.select("place", "lang")) if number <= MANY else learned.select("place", "lang")
    named = scored.join(names, "place", "left")
    none = F.col("place").isNull()
    return named.select(
        "doc_id", F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang_pred"), F.when(none, 0.0).otherwise(1.0 / F.col("odds")).alias("score"),
        F.when(none, True).otherwise(F.coalesce(first, F.lit(False))).alias("rejected"))


def _over_groups(parts: DataFrame) -> DataFrame:
    """One row for each text: the groups' bests compared, their odds brought to the best of all."""
    grouped = parts.groupBy("node").agg(
        F.first("doc_id").alias("doc_id"), F.min(F.when(F.col("place").isNotNull(), F.struct("best", "place"))).alias("top"),
        F.collect_list(F.when(F.col("place").isNotNull(), F.struct("best", "place", "second", "odds"))).alias("all"))      # a row for each group
    top = F.col("top.best")
    others = F.concat(F.transform(F.filter("all", lambda x: x["place"] != F.col("top.place")), lambda x: x["best"]),
                      F.transform(F.filter("all", lambda x: x["place"] == F.col("top.place")), lambda x: x["second"]))
    odds = F.aggregate("all", F.lit(0.0), lambda total, x: total + x["odds"] * F.pow(F.lit(2.0), SHARPNESS * F.greatest(top - x["best"], F.lit(-200.0))))
    return grouped.select("doc_id", F.col("top.place").alias("place"), top.alias("best"), F.array_min(others).alias("second"), odds.alias("odds"))
