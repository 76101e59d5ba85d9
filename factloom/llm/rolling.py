"""Hashes of byte spans, words and shingles by prefix sums: every step is a numpy pass over a whole batch."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = []


def _mixed(seed: int, n: int) -> np.ndarray:
    x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


VALUES = _mixed(7, 256)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEPARATES = np.zeros(256, bool)
SEPARATES[[0x20, 9, 10, 11, 12, 13]] = True
_TURN = _mixed(99, 64)


def powers(n: int) -> list[np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64, for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x, np.uint64)])) for x in (BASE, inverse)]
    return _powers


def sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which span() gives the hash of any part of data."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], the same wherever the same bytes stand."""
    return mix((total[end] - total[start]) * powers(len(total))[1][start] + (end - start).astype(np.uint64) * _TURN[0])


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return data | ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in the rows' bytes, and the first word of each row (with the count as a last entry)."""
    n = len(data)
    inside = (data != 32) & (data - np.uint8(9) > 4)
    begins, last = inside.copy(), inside.copy()
    if n:
        np.greater(inside[1:], inside[:-1], out=begins[1:])
        np.greater(inside[:-1], inside[1:], out=last[:-1])
        # A word ends where its row does.
        edge = offsets[(offsets > 0) & (offsets < n)]
        begins[edge], last[edge - 1] = inside[edge], inside[edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_MASKS = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words by eight bytes at a time: as many passes over the words as the longest has eights."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    left = ends - starts
    out = mix((eights[starts] & _MASKS[np.minimum(left, 8)]) + left.astype(np.uint64) * _TURN[20])
    more = np.flatnonzero(left > 8)
    at = 8
    while len(more):
        rest = left[more] - at
        out[more] = mix((out[more] ^ (eights[starts[more] + at] & _MASKS[np.minimum(rest, 8)])) * _TURN[21] + _TURN[22])
        more, at = more[rest > 8], at + 8
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of k words and the first of each row; a row of fewer words gives the whole row as one."""
    count = np.diff(first)
    many = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(many)])
    out = np.zeros(out_first[-1], np.uint64)
    n = len(hashes)
    if n >= k:
        run = np.full(n - k + 1, np.uint64(k), np.uint64)
        for j in range(k):
            run ^= hashes[j : n - k + 1 + j]
            run *= _TURN[j + 1] | np.uint64(1)
            run ^= run >> np.uint64(31)
        run = mix(run)
        whole = count >= k
        take = np.repeat(np.where(whole, first[:-1], 0) - np.where(whole, out_first[:-1], 0), np.where(whole, many, 0))
        place = np.flatnonzero(np.repeat(whole, many))
        out[place] = run[place + take]
    for c in range(1, k):
        rows = np.flatnonzero(count == c)
        run = np.full(len(rows), np.uint64(c), np.uint64)
        for j in range(c):
            run = (run ^ hashes[first[rows] + j]) * (_TURN[j + 1] | np.uint64(1))
            run ^= run >> np.uint64(31)
        out[out_first[rows]] = mix(run)
    return out, out_first
