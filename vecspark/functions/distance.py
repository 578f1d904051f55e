"""Vector scalar functions as Column expressions.

All arithmetic is in double, added up in element order, so that the Column
forms here and the Arrow-batch forms in ``blocks`` give the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EUCLIDEAN = "euclidean"
SQUARED_EUCLIDEAN = "squared_euclidean"
COSINE = "cosine"
METRICS = (EUCLIDEAN, SQUARED_EUCLIDEAN, COSINE)

# Above this dimension the generated code of an unrolled sum grows past what
# the JIT compiles well, and the lambda form is faster.
UNROLL_MAX_DIM = 64


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {', '.join(METRICS)}")
    return metric


def to_double(vector: Column) -> Column:
    """Cast every element to double."""
    return vector.cast("array<double>")


def _sum_of(a: Column, b: Column, term, dim: int | None) -> Column:
    if dim is not None and dim <= UNROLL_MAX_DIM:
        total = F.lit(0.0)
        for i in range(dim):
            total = total + term(F.get(a, F.lit(i)), F.get(b, F.lit(i)))
        return total
    return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda acc, x: acc + x)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _same_length(a: Column, b: Column, value: Column) -> Column:
    return F.when(
        F.size(a) != F.size(b),
        F.raise_error(F.lit("vectors must have the same length")).cast("double"),
    ).otherwise(value)


def dot(a: Column, b: Column, dim: int | None = None) -> Column:
    a, b = to_double(a), to_double(b)
    return _sum_of(a, b, lambda x, y: x * y, dim)


def norm(a: Column, dim: int | None = None) -> Column:
    return F.sqrt(dot(a, a, dim))


def squared_euclidean(a: Column, b: Column, dim: int | None = None) -> Column:
    x, y = to_double(a), to_double(b)
    return _same_length(a, b, _sum_of(x, y, lambda p, q: (p - q) * (p - q), dim))


def euclidean(a: Column, b: Column, dim: int | None = None) -> Column:
    return F.sqrt(squared_euclidean(a, b, dim))


def cosine_similarity(a: Column, b: Column, dim: int | None = None) -> Column:
    """Dot product over the product of norms; 0 when either norm is 0."""
    value = _bound(norm(a, dim) * norm(b, dim),
                   lambda scale: F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b, dim) / scale))
    return _same_length(a, b, value)


def cosine_distance(a: Column, b: Column, dim: int | None = None) -> Column:
    """0 for the same direction, 1 for orthogonal or zero vectors, 2 for opposite."""
    return 1.0 - cosine_similarity(a, b, dim)


def distance(metric: str, a: Column, b: Column, dim: int | None = None) -> Column:
    check_metric(metric)
    if metric == EUCLIDEAN:
        return euclidean(a, b, dim)
    if metric == SQUARED_EUCLIDEAN:
        return squared_euclidean(a, b, dim)
    return cosine_distance(a, b, dim)


def similarity_score(metric: str | None, dist: Column) -> Column:
    """Map a distance to a score in [0, 1]; a missing distance counts as 0."""
    d = F.coalesce(dist.cast("double"), F.lit(0.0))
    if metric == COSINE:
        return F.greatest(F.lit(0.0), 1.0 - d / 2.0)
    if metric == EUCLIDEAN:
        return F.exp(-d)
    if metric == SQUARED_EUCLIDEAN:
        return F.exp(-F.sqrt(d))
    return 1.0 / (1.0 + d)


def l2_normalize(vector: Column, dim: int | None = None) -> Column:
    """Scale to unit length; a zero vector is returned as it is."""
    v = to_double(vector)
    return _bound(norm(v, dim), lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v))
