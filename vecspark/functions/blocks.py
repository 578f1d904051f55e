"""Numeric helpers that run on Arrow batches inside Spark tasks.

A block of queries (bounded, broadcast) meets item batches as they stream
through a task. A matrix product gives every distance up to a rounding bound;
pairs that could still enter a query's top k within that bound are computed
again exactly, so that the result never depends on the shortcut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .distance import COSINE, EUCLIDEAN

CELLS = 1 << 20      # cells of one distance matrix held at a time
SINGLE_MIN, SINGLE_MAX = 1e-12, 1e30    # squared norms for which single precision is tried
PAIRS = 1 << 16      # pairs computed exactly at a time
EXACT_ROWS = 1 << 9  # of these, copied and turned to columns at once
TILE = (1 << 9, 1 << 11)    # queries with a full top k, and items, of one product
DENSE = 16           # if more than this share of a product may enter, its limits are narrowed first
ITEM_ROWS = 1 << 12  # items offered at a time, or so many times k: what the first leave in a top k rules out most of the next
ITEM_FACTOR = 256
EPS = float(np.finfo(np.float64).eps)


def matrix(column, dim: int | None = None) -> np.ndarray:
    """A list column as a float64 matrix; rows must share one length."""
    return stored_matrix(column, dim).astype(np.float64, copy=False)


def stored_matrix(column, dim: int | None = None) -> np.ndarray:
    """A list column as a matrix of its own numbers; rows must share one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros((0, dim or 0))
    span = pc.min_max(pc.list_value_length(column)).as_py()
    width = dim if dim is not None else span["max"]
    if column.null_count or span["min"] != width or span["max"] != width:
        raise ValueError(f"vector dimension mismatch: expected {width}, got {span['min']}..{span['max']}")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, width)


def exact_distance(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Row-wise distance, added up one dimension after the other."""
    if len(a) > EXACT_ROWS:
        return np.concatenate([exact_distance(a[at:at + EXACT_ROWS], b[at:at + EXACT_ROWS], metric) for at in range(0, len(a), EXACT_ROWS)])
    if metric == COSINE:
        dot, na, nb = _added(a * b), _added(a * a), _added(b * b)
        scale = np.sqrt(na) * np.sqrt(nb)
        sim = np.divide(dot, scale, out=np.zeros_like(dot), where=scale > 0)
        return 1.0 - sim
    gap = a - b
    gap *= gap
    total = _added(gap)
    return np.sqrt(total) if metric == EUCLIDEAN else total


def _added(x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for column in np.ascontiguousarray(x.T):
        total += column
    return total


def pair_distance(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, metric: str) -> np.ndarray:
    """Exact distances of the rows ``i`` of ``a`` from the rows ``j`` of ``b``, a few rows copied at a time."""
    out = np.empty(len(i))
    for at in range(0, len(i), EXACT_ROWS):
        some = slice(at, at + EXACT_ROWS)
        out[some] = exact_distance(a[i[some]], b[j[some]], metric)
    return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    n = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _by_row(row: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Order by row, in a row by distance; equal ones in any order."""
    if not len(row) or row.max() >= 1 << 15:
        return np.lexsort((d, row))
    order = np.argsort(d)
    return order[np.argsort(row.astype(np.int16)[order], kind="stable")]     # short integers are sorted by their digits


def _picked(ids, rows: np.ndarray) -> np.ndarray:
    """Ids of some rows: of numbers as they are, of an Arrow array as objects."""
    return ids[rows] if isinstance(ids, np.ndarray) else np.array(ids.take(pa.array(rows)).to_pylist(), dtype=object)


class TopK:
    """The k best (distance, id) per query row; distance first, then id. ``numbers``: ids are integers, kept as such."""

    def __init__(self, rows: int, k: int, numbers: bool = False):
        self.k = k
        self.n = np.zeros(rows, dtype=np.int64)
        self.d = np.full((rows, k), np.inf)
        self.id = np.zeros((rows, k), dtype=np.int64) if numbers else np.full((rows, k), None, dtype=object)

    def limit(self, rows: np.ndarray) -> np.ndarray:
        return np.where(self.n[rows] == self.k, self.d[rows, -1], np.inf)

    def offer(self, q: np.ndarray, d: np.ndarray, ids: np.ndarray) -> None:
        full = self.n[q] == self.k
        last = self.d[q, -1]
        keep = ~full | (d < last)
        tie = np.nonzero(full & (d == last))[0]
        if tie.size:
            keep[tie] = ids[tie] < self.id[q[tie], -1]
        if not keep.any():
            return
        q, d, ids = q[keep], d[keep], ids[keep]
        rows = np.unique(q)
        held = np.arange(self.k)[None, :] < self.n[rows][:, None]
        q = np.concatenate([np.repeat(rows, self.n[rows]), q])
        d = np.concatenate([self.d[rows][held], d])
        ids = np.concatenate([self.id[rows][held], ids])
        order = _by_row(np.searchsorted(rows, q), d)
        same = (q[order][1:] == q[order][:-1]) & (d[order][1:] == d[order][:-1])
        if same.any():
            place = np.empty(len(ids), dtype=np.int64)
            place[np.argsort(ids, kind="stable")] = np.arange(len(ids))
            order = np.lexsort((place, d, q))
        q, d, ids = q[order], d[order], ids[order]
        start = np.searchsorted(q, rows)
        rank = np.arange(len(q)) - start[np.searchsorted(rows, q)]
        keep = rank < self.k
        q, d, ids, rank = q[keep], d[keep], ids[keep], rank[keep]
        self.d[q, rank] = d
        self.id[q, rank] = ids
        self.n[rows] = np.bincount(np.searchsorted(rows, q), minlength=len(rows))

    def entries(self):
        """(query row, id, distance) of everything held."""
        held = np.arange(self.k)[None, :] < self.n[:, None]
        return np.repeat(np.arange(len(self.n)), self.n), self.id[held], self.d[held]


def _k_copies(x: np.ndarray, ids, k: int) -> np.ndarray:
    """Rows to keep so that each distinct vector stays with its k smallest ids.

    Copies of one vector are at the same distance from any query, so only the
    k smallest ids among them can ever be in a top k.
    """
    raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel()
    _, group = np.unique(raw, return_inverse=True)
    place = np.empty(len(x), dtype=np.int64)
    place[np.argsort(_picked(ids, np.arange(len(x))), kind="stable")] = np.arange(len(x))
    order = np.lexsort((place, group))
    g = group[order]
    rank = np.arange(len(g)) - np.searchsorted(g, g)
    return np.sort(order[rank < k])


def _true_at(mask: np.ndarray) -> np.ndarray:
    """Flat positions of what is true, where that is little: eight cells are looked at together."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64).astype(bool))
    word, at = np.nonzero(flat[:whole].reshape(-1, 8)[words])
    return np.concatenate([8 * words[word] + at, whole + np.flatnonzero(flat[whole:])])


def _rounded_up(bound: np.ndarray, dtype) -> np.ndarray:
    return np.nextafter(bound.astype(dtype), np.inf, dtype=dtype)


class QueryBlock:
    """The query side of a scan: a bounded matrix plus what the metric needs.

    One matrix product of widened rows gives the whole squared distance
    (``[-2q, |q|^2, 1] . [x, 1, |x|^2]``) or cosine distance. It runs in single
    precision while its error bound separates candidates well, else in double.
    """

    def __init__(self, vectors: np.ndarray, metric: str):
        self.v = vectors
        self.metric = metric
        self.single = True
        self.sq, self.left = self._widen(vectors, -1.0 if metric == COSINE else -2.0, True)
        self.left32 = None

    def __len__(self) -> int:
        return len(self.v)

    def _widen(self, x: np.ndarray, factor: float, is_query: bool):
        one = np.ones((len(x), 1))
        if self.metric == COSINE:
            return one[:, 0], np.hstack([factor * unit_rows(x), one])
        sq = np.einsum("ij,ij->i", x, x)
        sides = [sq[:, None], one] if is_query else [one, sq[:, None]]
        return sq, np.hstack([factor * x, *sides])

    def _limits(self, r: np.ndarray, right: np.ndarray, peak: float, top: TopK) -> tuple[np.ndarray, np.ndarray]:
        """What a product may be for a pair to enter, and the bound of its rounding."""
        slack = 2.0 * float(np.finfo(right.dtype).eps) * (right.shape[1] + 8) * (self.sq[r] + peak)
        limit = top.limit(r)
        return limit * limit * (1.0 + 8 * EPS) if self.metric == EUCLIDEAN else limit, slack

    def _candidates(self, r: np.ndarray, right: np.ndarray, left: np.ndarray, peak: float, top: TopK, allowed: np.ndarray | None = None):
        """Mask of pairs that may enter (``allowed`` ones, if given), and whether it is too dense to be worth computing exactly."""
        near = left[r] @ right.T
        if allowed is not None:
            near[~allowed] = np.nan      # never below a limit, and sorted last
        limit, slack = self._limits(r, right, peak, top)
        mask = near <= _rounded_up(limit + slack, near.dtype)[:, None]
        enough = 4 * top.k * len(r)
        if near.shape[1] > top.k and np.count_nonzero(mask) > enough:
            kth = np.partition(near, top.k - 1, axis=1)[:, top.k - 1].astype(float)
            limit = np.fmin(limit, kth + slack + 8 * EPS * np.abs(kth))
            mask = near <= _rounded_up(limit + slack, near.dtype)[:, None]
            return mask, np.count_nonzero(mask) > enough
        return mask, False

    def offer(self, top: TopK, rows: np.ndarray, x: np.ndarray, ids, lists: np.ndarray | None = None, asks: np.ndarray | None = None) -> None:
        """Offer every pair of (query in ``rows``, item in ``x``) to ``top``.

        With ``lists`` of the items only those pairs whose list the query ``asks`` (a row per query of the block) for.
        """
        if not len(rows):
            return
        some = max(ITEM_ROWS, ITEM_FACTOR * top.k)
        for at in range(0, len(x), some):
            self._offer(top, rows, x[at:at + some].astype(np.float64, copy=False), ids[at:at + some], None if lists is None else lists[at:at + some], asks)

    def _offer(self, top: TopK, rows: np.ndarray, x: np.ndarray, ids, lists: np.ndarray | None, asks: np.ndarray | None) -> None:
        full = top.n[rows] == top.k
        if self.single and full.any():
            xsq, right = self._widen(x, 1.0, False)
            peak = float(xsq.max())
            if SINGLE_MIN < max(peak, float(self.sq.max())) < SINGLE_MAX and np.isfinite(self.sq[rows]).all():
                self._offer_full(top, rows[full], x, right.astype(np.float32), peak, ids, lists, asks)
                rows = rows[~full]
        if len(rows):
            self._offer_any(top, rows, x, ids, lists, asks)

    def _offer_full(self, top: TopK, rows: np.ndarray, x: np.ndarray, right: np.ndarray, peak: float, ids, lists: np.ndarray | None, asks: np.ndarray | None) -> None:
        """Offer to queries whose top k is full: few pairs can still enter, so they are gathered from several products.

        Which of them are asked for is seen for these pairs alone.
        """
        if self.left32 is None:
            self.left32 = self.left.astype(np.float32)
        for lo in range(0, len(rows), TILE[0]):
            r = rows[lo:lo + TILE[0]]
            left, limit, found, held = self.left32[r], None, [], 0
            for at in range(0, len(x), TILE[1]):
                part = slice(at, at + TILE[1])
                if limit is None:
                    limit = _rounded_up(np.add(*self._limits(r, right, peak, top)), np.float32)[:, None]
                near = left @ right[part].T
                pairs = _true_at(near <= limit)
                if len(pairs) * DENSE > near.size:
                    self._offer_any(top, r, x[part], ids[part], None if lists is None else lists[part], asks)
                    limit = None
                    continue
                if not len(pairs):
                    continue
                q, i = np.divmod(pairs, near.shape[1])
                found.append((r[q], at + i))
                held += len(q)
                if held >= PAIRS:
                    self._settle(top, found, x, ids, lists, asks)
                    limit, found, held = None, [], 0
            self._settle(top, found, x, ids, lists, asks)

    def _settle(self, top: TopK, found: list, x: np.ndarray, ids, lists: np.ndarray | None, asks: np.ndarray | None) -> None:
        """Offer the pairs ``found`` (rows of the block, of the items) by their exact distances."""
        if not found:
            return
        q, i = (np.concatenate(side) for side in zip(*found))
        if lists is not None:
            asked = asks[q, lists[i]]
            q, i = q[asked], i[asked]
        for at in range(0, len(q), PAIRS):
            some = slice(at, at + PAIRS)
            top.offer(q[some], pair_distance(self.v, q[some], x, i[some], self.metric), _picked(ids, i[some]))

    def _offer_any(self, top: TopK, rows: np.ndarray, x: np.ndarray, ids, lists: np.ndarray | None, asks: np.ndarray | None) -> None:
        xsq, right = self._widen(x, 1.0, False)
        peak = float(xsq.max())
        thinned, right32 = False, None
        single = self.single and SINGLE_MIN < max(peak, float(self.sq.max())) < SINGLE_MAX
        if single:
            right32 = right.astype(np.float32)
            if self.left32 is None:
                self.left32 = self.left.astype(np.float32)
        step = max(1, CELLS // len(x))
        for lo in range(0, len(rows), step):
            r = rows[lo:lo + step]
            allowed = None if lists is None else asks[r][:, lists]
            if not np.isfinite(peak) or not np.isfinite(self.sq[r]).all():
                mask = np.ones((len(r), len(x)), dtype=bool) if allowed is None else allowed     # squares overflow: only the exact form decides
            else:
                dense = True
                if single:
                    mask, dense = self._candidates(r, right32, self.left32, peak, top, allowed)
                if dense:
                    mask, still = self._candidates(r, right, self.left, peak, top, allowed)
                    if single and not still:
                        single = self.single = False
                    dense = still
                if dense and not thinned:
                    # once per batch: fewer copies for this and all later queries
                    kept, thinned = _k_copies(x if lists is None else np.hstack([x, lists[:, None]]), ids, top.k), True
                    mask, x, right = mask[:, kept], x[kept], right[kept]
                    ids = ids[kept] if isinstance(ids, np.ndarray) else ids.take(pa.array(kept))
                    right32 = right32[kept] if right32 is not None else None
                    lists = lists[kept] if lists is not None else None
            qi, xi = np.divmod(_true_at(mask), mask.shape[1])
            for at in range(0, len(qi), PAIRS):
                q, i = qi[at:at + PAIRS], xi[at:at + PAIRS]
                d = pair_distance(self.v, r[q], x, i, self.metric)
                top.offer(r[q], d, _picked(ids, i))


def by_list(lists: np.ndarray):
    """Yield (list id, row positions) for the runs of a list column."""
    order = np.argsort(lists, kind="stable")
    values, start = np.unique(lists[order], return_index=True)
    for value, rows in zip(values, np.split(order, start[1:])):
        yield int(value), rows


def nearest_rows(x: np.ndarray, small: np.ndarray, k: int, metric: str) -> TopK:
    """For each row of ``x`` the k nearest rows of the bounded matrix ``small``."""
    top = TopK(len(x), min(k, len(small)), numbers=True)
    ids = np.arange(len(small))
    QueryBlock(x, metric).offer(top, np.arange(len(x)), small, ids)
    return top
