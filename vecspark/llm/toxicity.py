"""Toxicity by non-negative positive-unlabelled learning of a linear model.

Only confirmed toxic documents are labels; the corpus as a whole is the
unlabelled text, toxic with a probability ``pi``, the class prior. With it the risk of the negatives is
``R_u(-) - pi * R_p(-)``, kept from falling below zero, and a logistic model is
fitted to ``pi * R_p(+) + max(0, that)`` by numpy on a bounded sample:
``POSITIVES`` confirmed and ``UNLABELLED`` rows, those with the smallest
hash of their ids. Scores cover every row and the whole text.

Features are the words (runs of letters, A-Z as a-z) and their first 4, 5 and 6
bytes, hashed, found once, twice or four times in a document; those that confirmed documents
do not show clearly more often are left out, so that long texts gather no noise.

Null and empty texts, and such without letters, get the score of no evidence.
Without any confirmed row every score is 0. Copies in the sample count once.
Labels with a null id or a null mark confirm nothing. Other columns are carried
along under any name.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices
from .words import GOLD, mix, span_hash, word_spans

POSITIVES, UNLABELLED = 4_000, 8_000      # rows of the fitting sample
BASE_BITS, LEVEL_BITS = 30, 2             # of a feature: its hash, how often it is found
FILTER_BITS = 20                          # of the hash, looked at first
TIMES = (1, 2, 4)
PREFIXES = (4, 5, 6)
MIN_ROWS, MIN_LIFT, MIN_Z = 3, 2.0, 3.0   # of a feature among the confirmed rows
STEPS, RATE, SHRINK = 600, 0.1, 1e-4      # of the fit

_KINDS = np.arange(1, len(PREFIXES) + 2, dtype=np.uint64) * GOLD
_LETTERS = np.ones(256, dtype=bool)       # bytes that break words
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class LinearModel:
    marks: np.ndarray         # ascending features
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of the toxic class per text."""
        total = np.full(len(texts), self.bias)
        rows, marks = features(texts, self.marks)
        np.add.at(total, rows, self.weights[np.searchsorted(self.marks, marks)])
        return 1.0 / (1.0 + np.exp(-np.clip(total, -50, 50)))


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of every feature that a text has, each once; only the ascending ``wanted`` if given.

    A feature is a hash of BASE_BITS bits and, below it, the number of the
    highest of TIMES that is meant: twice holds for a text beside once.
    """
    found = [np.zeros(0, np.int64)]
    if wanted is not None:
        few = np.zeros(1 << FILTER_BITS, dtype=bool)
        few[wanted >> LEVEL_BITS & (len(few) - 1)] = True
    for part, start, end, row in word_spans(texts, _LETTERS):
        for number, size in enumerate((None, *PREFIXES)):
            if size is None:
                s, e, r = start, end, row
            else:
                long = np.flatnonzero(end - start > size)
                s, e, r = start[long], start[long] + size, row[long]
            key = (mix(span_hash(part, s, e) ^ _KINDS[number]) >> np.uint64(64 - BASE_BITS)).astype(np.int64)
            if wanted is not None:
                keep = np.flatnonzero(few[key & (len(few) - 1)])
                key, r = key[keep], r[keep]
            found.append(r << BASE_BITS | key)
    codes, times = np.unique(np.concatenate(found), return_counts=True)
    marks = np.sort(np.concatenate([codes[times >= t] << LEVEL_BITS | level for level, t in enumerate(TIMES)]))
    rows, marks = marks >> (BASE_BITS + LEVEL_BITS), marks & ((1 << (BASE_BITS + LEVEL_BITS)) - 1)
    if wanted is not None:
        keep = np.isin(marks, wanted)
        rows, marks = rows[keep], marks[keep]
    return rows, marks


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
        steps: int = STEPS, rate: float = RATE, shrink: float = SHRINK) -> LinearModel:
    """The model for documents given as arrays of features."""
    none = np.zeros(0, dtype=np.int64)
    if not positive:
        return LinearModel(none, none.astype(float), -50.0)
    bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    n_p, n_u = len(positive), max(len(unlabelled), 1)
    chosen, seen_p = np.unique(np.concatenate(positive), return_counts=True)
    chosen, seen_p = chosen[seen_p >= MIN_ROWS], seen_p[seen_p >= MIN_ROWS]
    seen_u = np.zeros(len(chosen))
    if len(chosen):
        for row in unlabelled:
            at = np.minimum(np.searchsorted(chosen, row), len(chosen) - 1)
            seen_u[at[chosen[at] == row]] += 1
    p, u = seen_p / n_p, seen_u / n_u
    z = (p - u) / np.sqrt(p * (1 - p) / n_p + u * (1 - u) / n_u + 1e-12)
    chosen = chosen[(p >= MIN_LIFT * u) & (z >= MIN_Z)]
    if not len(chosen):
        return LinearModel(none, none.astype(float), bias)

    def sparse(rows):
        marks = []
        for row in rows:
            at = np.minimum(np.searchsorted(chosen, row), len(chosen) - 1)
            marks.append(at[chosen[at] == row])
        return np.repeat(np.arange(len(rows)), [len(m) for m in marks]), np.concatenate([none, *marks])

    (pr, pf), (ur, uf) = sparse(positive), sparse(unlabelled)
    w, b = np.zeros(len(chosen)), bias
    moments = np.zeros((2, len(chosen) + 1))
    for step in range(1, steps + 1):
        fp = b + np.bincount(pr, weights=w[pf], minlength=n_p)
        fu = b + np.bincount(ur, weights=w[uf], minlength=len(unlabelled))
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        plus = -prior * (1 - sp) / n_p                       # of pi * R_p(+)
        negative = np.mean(np.logaddexp(0, fu)) - prior * np.mean(np.logaddexp(0, fp)) if len(fu) else 0.0
        minus_p, minus_u = -prior * sp / n_p, su / n_u       # of R_u(-) - pi * R_p(-)
        if negative >= 0:
            gp, gu = plus + minus_p, minus_u
        else:                                                # step back from a negative risk
            gp, gu = -minus_p, -minus_u
        slope = np.append(np.bincount(pf, weights=gp[pr], minlength=len(w)) + np.bincount(uf, weights=gu[ur], minlength=len(w))
                          + shrink * w, gp.sum() + gu.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.999 * moments[1] + 0.001 * slope * slope
        move = rate * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return LinearModel(chosen, w, float(b))


def _sample(rows: DataFrame, size: int) -> DataFrame:
    return rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, prior: float | None = None,
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> LinearModel:
    """Fit on rows of ``docs (doc_id, text)`` for which ``allowed`` (of ``doc_id``) holds.

    ``labels (doc_id, toxic)``: 1 confirms a document. ``prior`` defaults to the
    share of the confirmed among the labelled.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & allowed).select("doc_id", "toxic")
    if prior is None:
        prior = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    confirmed = marks.where("toxic = 1").select("doc_id").distinct()
    known = docs.where(F.col("doc_id").isNotNull() & allowed).select("doc_id")
    one = _sample(known.join(confirmed, "doc_id", "left_semi"), positives).withColumn("positive", F.lit(True))
    other = _sample(known, unlabelled).withColumn("positive", F.lit(False))      # of all, as the prior is of all
    chosen = one.union(other)                                # at most positives + unlabelled ids

    def extract(batches):
        for batch in batches:
            for part in slices(batch):
                texts = part.column(0)
                rows, marks = features(texts)
                cuts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(texts)))])
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(marks.astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(1), lists], names=["positive", "marks"])

    found = docs.where(F.length("text") > 0).join(F.broadcast(chosen), "doc_id")
    # one row for each id and side, however often it comes: the bound is of rows
    shown = F.struct(F.xxhash64("text").alias("hash"), "text")
    sampled = found.groupBy("doc_id", "positive").agg(F.min(shown).alias("t")).select("t.text", "positive")
    table = sampled.mapInArrow(extract, "positive boolean, marks array<int>").toArrow()
    sides: dict[bool, dict] = {True: {}, False: {}}
    marks = table.column("marks").combine_chunks()
    values, cuts = marks.flatten().to_numpy().view(np.uint32).astype(np.int64), np.concatenate([[0], np.cumsum(marks.value_lengths().to_numpy())])
    for row, positive in enumerate(table.column("positive").to_pylist()):
        own = values[cuts[row]:cuts[row + 1]]
        sides[positive][zlib.crc32(own.tobytes()), len(own)] = own      # copies count once
    ordered = {side: [rows[k] for k in sorted(rows)] for side, rows in sides.items()}
    return fit(ordered[True], ordered[False], prior)


def score(docs: DataFrame, model: LinearModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from the threshold on) behind its columns, as ``row`` (struct)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.marks, model.weights, model.bias))      # features of at least MIN_ROWS rows of the sample
    source = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))
    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        local = LinearModel(*shared.value)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(local.scores(part.column(0)))], names=schema.names)

    return source.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
