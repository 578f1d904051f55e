"""Hashes of words and word shingles over Arrow text columns, in numpy.

Words are runs of bytes other than space and the controls 9 to 13, so UTF-8
texts are cut as their code points are. A word's hash is a polynomial over its
bytes modulo 2^64, taken from running sums, then mixed; equal words always have
equal hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .arrow import text_bytes, text_offsets
from .worker import kept

CHUNK = 1 << 20           # bytes hashed at a time
GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


_BASE = 0xD1342543DE82EF95
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * GOLD)
_SEEDS = np.arange(1, 65, dtype=np.uint64) * GOLD       # by place in a shingle
_FOLDED = _CODES.copy()
_FOLDED[65:91] = _CODES[97:123]       # A-Z as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def _cut(data: np.ndarray, ends: np.ndarray, breaks: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of at most CHUNK bytes that end at text ends or, in longer texts, after a break."""
    cuts, at, stop = [], int(ends[0]), int(ends[-1])
    while at < stop:
        to = int(ends[np.searchsorted(ends, at + CHUNK, side="right") - 1])
        if to <= at:
            to = min(at + CHUNK, stop)
            gaps = np.flatnonzero(breaks[data[at:to]])
            end = int(ends[np.searchsorted(ends, at, side="right")])
            to = end if to >= end else at + int(gaps[-1]) + 1 if len(gaps) else _next_gap(data, to, end, breaks)
        cuts.append((at, to))
        at = to
    return cuts


def _next_gap(data: np.ndarray, at: int, end: int, breaks: np.ndarray) -> int:
    """After the first break from ``at`` on: a single word is longer than a chunk."""
    while at < end:
        gaps = np.flatnonzero(breaks[data[at:at + CHUNK]])
        if len(gaps):
            return min(end, at + int(gaps[0]) + 1)
        at += CHUNK
    return end


def word_spans(texts: pa.Array, breaks: np.ndarray = _SPACE):
    """Yield per range ``(bytes, start, end, row)`` of its words; positions within the range's bytes.

    ``breaks`` marks the bytes that are in no word.
    """
    data, ends = text_bytes(texts), text_offsets(texts)
    for at, to in _cut(data, ends, breaks):
        part = data[at:to]
        inside = ~breaks[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        edge[0] = edge[-1] = True
        lo, hi = np.searchsorted(ends, at), np.searchsorted(ends, to, side="right")
        edge[ends[lo:hi] - at] = True
        before = np.concatenate([[False], inside[:-1]])
        after = np.concatenate([inside[1:], [False]])
        start = np.flatnonzero(inside & (~before | edge[:-1]))
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        yield part, start, end, np.searchsorted(ends, at + start, side="right") - 1


def span_hash(part: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hashes of byte spans of one range."""
    codes = (_FOLDED if fold else _CODES)[part]
    size = len(part)
    if size <= CHUNK:
        power, inverse = kept("powers", lambda: _both_powers(CHUNK))
    else:
        power, inverse = _both_powers(size)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * power[:size])])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * GOLD)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, ends)``: the words of row i are ``hashes[ends[i]:ends[i + 1]]``; A-Z count as a-z."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part, start, end, row in word_spans(texts):
        hashes.append(span_hash(part, start, end))
        rows.append(row)
    counts = np.bincount(np.concatenate(rows), minlength=len(texts))
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(counts)])


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, ends)``: row i has the distinct sorted shingles ``keys[ends[i]:ends[i + 1]]``.

    A text with fewer words than ``width`` has its whole word sequence as one
    shingle; one without words (or null) has none.
    """
    words, ends = word_hashes(texts)
    n = len(words)
    keys = np.zeros(n, dtype=np.uint64)
    for i in range(min(width, n)):
        keys[:n - i] = mix(keys[:n - i] + words[i:] + _SEEDS[i])
    counts = np.diff(ends)
    sets = []
    for row in range(len(counts)):
        lo, count = ends[row], counts[row]
        if count >= width:
            own = np.sort(keys[lo:lo + count - width + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif count:
            whole = np.array([count], dtype=np.uint64) * GOLD
            for word in words[lo:lo + count]:
                whole = mix(whole + word)
            sets.append(whole)
        else:
            sets.append(keys[:0])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return np.concatenate([keys[:0], *sets]), np.concatenate([[0], np.cumsum(sizes)])
