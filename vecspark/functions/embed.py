"""Text embedding: user functions, and a deterministic hashing embedder.

An embedder is called with a text column and returns a vector column. It runs
where the row is; embedding never shuffles. The functions are marked
nondeterministic so that the optimizer never repeats the call in a filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the formula of ``ordered_embedder``.
POSITION_WEIGHT = 0.5
PRESENCE_WEIGHT = 0.3
NOISE_SCALE = 0.2
SPREAD = 7
LCG_FACTOR, LCG_STEP, LCG_MODULUS = 9301, 49297, 233280
RUN_WORDS = 1 << 18     # words added up at a time
DECIMALS = 6      # rounded, so that a text has one vector on every partitioning


def function_embedder(load: Callable[[], Callable[[list[str]], list]], element: str = "float"):
    """Embedder from user code.

    ``load()`` runs once per Python task and returns the function that maps a
    list of texts to a list of vectors. A null text gets a null vector.
    """
    @F.pandas_udf(f"array<{element}>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            known = texts.dropna()
            vectors = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            if len(known):
                for at, vector in zip(known.index, model(list(known))):
                    vectors[at] = vector
            yield vectors

    return embed.asNondeterministic()


def word_hash(text: Column) -> Column:
    """First 32 bits of the MD5 of a string."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _runs(lists: pa.Array):
    """``(first row, rows)`` of runs of about ``RUN_WORDS`` words; a longer text is a run of its own."""
    ends, at = lists.offsets.to_numpy().astype(np.int64), 0
    while at < len(lists):
        n = max(1, int(np.searchsorted(ends, ends[at] + RUN_WORDS, side="right")) - 1 - at)
        yield at, n
        at += n


def _vectors(runs: list[np.ndarray], dim: int) -> pa.Array:
    flat = np.round(np.concatenate([np.zeros((0, dim)), *runs]), DECIMALS)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * dim), pa.array(flat.ravel()))


def hashing_embedder(dim: int):
    """Signed feature hashing: every word adds or takes one at the place its hash names; unit length.

    Words are cut and hashed in the JVM; the task adds up whole Arrow batches
    of hashed words at once. A text of which nothing is left keeps zeros.
    """
    def summed(hashes: pa.Array) -> np.ndarray:
        n, counts = len(hashes), np.diff(hashes.offsets.to_numpy())
        h = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        cell = np.repeat(np.arange(n), counts) * dim + h % dim
        sign = np.where(h // dim % 2 == 0, 1.0, -1.0)
        v = np.bincount(cell, weights=sign, minlength=n * dim).astype(float).reshape(n, dim)
        length = np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
        return np.divide(v, length, out=v, where=length > 0)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def add_up(hashes: pa.Array) -> pa.Array:
        return _vectors([summed(hashes.slice(at, n)) for at, n in _runs(hashes)], dim)

    add_up = add_up.asNondeterministic()

    def embed(text: Column) -> Column:
        words = F.transform(F.split(F.lower(text), r"\s+"), word_hash)
        return F.when(text.isNotNull(), add_up(F.coalesce(words, F.array().cast("array<bigint>"))))

    return embed


def ordered_embedder(dim: int):
    """Bag of words with position weights, presence marks and noise seeded by the whole text; unit length.

    Words are cut and hashed in the JVM; the task adds up whole Arrow batches
    of hashed words at once.
    """
    def summed(slots: pa.Array, seeds: pa.Array) -> np.ndarray:
        n = len(slots)
        offsets = slots.offsets.to_numpy()
        counts = np.diff(offsets)
        slot = slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(n), counts)
        place = np.arange(len(slot)) - np.repeat(np.cumsum(counts) - counts, counts)
        cell = row * dim + slot
        tf = np.bincount(cell, minlength=n * dim).reshape(n, dim).astype(float)
        pos = np.bincount(cell, weights=POSITION_WEIGHT / (place + 1), minlength=n * dim).reshape(n, dim)
        v = tf.copy()
        v[:, 1:] += pos[:, :-1]
        v[:, 2:] += PRESENCE_WEIGHT * tf[:, :-2]
        seed = seeds.to_numpy(zero_copy_only=False).astype(np.int64)
        length = np.zeros(n)
        for j in range(dim):
            seed = (seed * LCG_FACTOR + LCG_STEP) % LCG_MODULUS
            v[:, j] += (seed / LCG_MODULUS - 0.5) * NOISE_SCALE
            length += v[:, j] * v[:, j]
        length = np.sqrt(length)[:, None]
        return np.divide(v, length, out=v, where=length > 0)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def add_up(slots: pa.Array, seeds: pa.Array) -> pa.Array:
        return _vectors([summed(slots.slice(at, n), seeds.slice(at, n)) for at, n in _runs(slots)], dim)

    add_up = add_up.asNondeterministic()

    def embed(text: Column) -> Column:
        words = F.split(F.lower(text), r"\s+")
        slots = F.transform(words, lambda w: F.pmod(word_hash(w) * SPREAD, F.lit(dim)).cast("int"))
        vector = add_up(F.coalesce(slots, F.array().cast("array<int>")),
                        F.coalesce(F.pmod(word_hash(text), F.lit(LCG_MODULUS)), F.lit(0)).cast("int"))
        return F.when(text.isNotNull(), vector)

    return embed


def detect_dimension(spark: SparkSession, embedder, probe: str = "dimension check") -> int:
    """The length of one embedded probe string."""
    return spark.range(1).select(F.size(embedder(F.lit(probe))).alias("n")).first()["n"]
