"""Indel similarity (insertions and deletions only): as an Arrow UDF, and the search for near words in numpy."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

#: Rows of one side that a cell of ``near_pairs`` holds at most, on average; spellings longer than this many letters meet by bands of length.
CELL_ROWS, EXACT_LETTERS = 30_000, 63
#: Deletions and insertions that a piece of a spelling may hold.
EDITS = 2
#: Hashes made at once, and the most of a cell for which whole words meet with more letters left out.
CHUNK, MOST_KEYS = 4_000_000, 100_000_000
#: Base of the hash of letters and its inverse, modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def indel_ratio(a: str, b: str) -> float:
    """200 x longest common subsequence / both lengths; two empty strings are alike (100)."""
    if not a and not b:
        return 100.0
    # bit-parallel: one machine word per text, one step per character
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask = (1 << len(a)) - 1
    v = mask
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & mask
    return 200.0 * (mask & ~v).bit_count() / (len(a) + len(b))


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else indel_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def ratio(a: Column, b: Column) -> Column:
    """0..100; null if either is null."""
    return pandas_udf(_ratios, "double")(a, b)


def _codes(words: list[str], n: int) -> np.ndarray:
    """[words, n]: the letters of words of n letters."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)


def _keys(codes: np.ndarray, lost: int) -> np.ndarray:
    """[words, ways]: hashes of what is left of the words if ``lost`` letters go."""
    n, w = codes.shape
    v = codes.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(29)
    powers = np.cumprod(np.full(w + 1, _BASE)) * np.uint64(_INVERSE)
    sums = np.zeros((n, w + 1), np.uint64)
    np.cumsum((v + np.uint64(1)) * powers[:w], 1, out=sums[:, 1:])
    out, start, factor = np.zeros((n, math.comb(w, lost)), np.uint64), 0, 1
    for i in _ways(w, lost).T:
        out += np.uint64(factor) * (sums[:, i] - sums[:, start].reshape(n, -1))
        start, factor = i + 1, factor * _INVERSE % 2**64
    out += np.uint64(factor) * (sums[:, -1:] - sums[:, start].reshape(n, -1))
    return out


@cache
def _ways(w: int, lost: int) -> np.ndarray:
    """[ways, lost]: places of letters to leave out, in order."""
    return np.array(list(combinations(range(w), lost)), np.int64).reshape(math.comb(w, lost), lost)


def _equal(a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Distinct (row of a, row of z), as one number, of rows that share a hash."""
    # most hashes stand on one side only: two tables of bits leave them out
    bits = np.uint64(64 - int(np.clip(np.ceil(np.log2(max(a.size, z.size))) + 3, 10, 24)))
    met = np.zeros(1 << (64 - int(bits)), bool)
    met[(z * _BASE >> bits).ravel()] = True
    ai, at = np.nonzero(met[a * _BASE >> bits])
    ak = a[ai, at]
    met[:] = False
    met[ak * _BASE >> bits] = True
    zi, at = np.nonzero(met[z * _BASE >> bits])
    zk = z[zi, at]
    order = np.argsort(zk)
    zi, zk = zi[order], zk[order]
    first, n = zk.searchsorted(ak, "left"), zk.searchsorted(ak, "right")
    n -= first
    out, most = [], 4_000_000
    for part in np.split(np.arange(len(ak)), np.searchsorted(np.cumsum(n), np.arange(most, int(n.sum()), most))):
        k = n[part]
        at = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[part], k)
        out.append(np.unique(np.repeat(ai[part], k) * len(z) + zi[at]))
    return np.unique(np.concatenate(out))


def _common(a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each row of a (63 letters at most) with the same row of z."""
    n = a.shape[1]
    mask = np.uint64((1 << n) - 1)
    v = np.full(len(a), mask)
    for j in range(z.shape[1]):
        same = np.zeros(len(a), np.uint64)
        for i in range(n):
            same |= (a[:, i] == z[:, j]).astype(np.uint64) << np.uint64(i)
        u = v & same
        v = ((v + u) | (v - u)) & mask
    return np.bitwise_count(mask & ~v).astype(np.int64)


def _whole(a: int, n: int, x: int, z: int, m: int, y: int) -> bool:
    """Whether a cell's whole words are few enough to be met with all ways to leave out letters."""
    return max(x, y) <= EDITS or a * math.comb(n, x) + z * math.comb(m, y) <= MOST_KEYS and max(math.comb(n, x), math.comb(m, y)) <= CHUNK // 40


def _met(a: np.ndarray, z: np.ndarray, x: int, y: int) -> Iterator[np.ndarray]:
    """Pairs of rows, as numbers, among which are all that are alike but for x letters of a and y of z."""
    n, m, d = a.shape[1], z.shape[1], x + y
    if _whole(len(a), n, x, len(z), m, y):  # what is left of both is equal
        at, to = (max(1, CHUNK // math.comb(k, lost)) for k, lost in ((n, x), (m, y)))
        for j in range(0, len(z), to):
            keys = _keys(z[j : j + to], y)
            for i in range(0, len(a), at):
                pairs = _equal(_keys(a[i : i + at], x), keys)
                yield (pairs // len(keys) + i) * len(z) + pairs % len(keys) + j
        return
    # z is cut so that one piece has few edits at least, whatever their places
    pieces = d // (EDITS + 1) + 1
    cuts = [i * m // pieces for i in range(pieces + 1)]
    # a piece is shifted by the letters before it that only one has
    for p, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
        edits = EDITS if p < pieces - 1 else d - (EDITS + 1) * (pieces - 1)
        for shift in [0] if p == 0 else range(-y, x + 1):
            for more in [n - m - shift] if p == pieces - 1 else range(-edits, edits + 1):
                lo, hi = start + shift, end + shift + more
                if abs(more) > edits or lo < 0 or hi > n:
                    continue
                gone = (edits - abs(more)) // 2 + max(more, 0), (edits - abs(more)) // 2 + max(-more, 0)
                yield _equal(_keys(a[:, lo:hi], gone[0]), _keys(z[:, start:end], gone[1]))


def near_pairs(a: list[str], z: list[str], threshold: float) -> list[tuple[str, str, float]]:
    """(word of a, word of z, ratio) of the best words of z for each of a, from ``threshold`` on. Words of a have one length, words of z too."""
    n, m = len(a[0]), len(z[0])
    if n > EXACT_LETTERS:
        scored = [[(w, indel_ratio(v, w)) for w in z] for v in a]
        return [(v, w, s) for v, of in zip(a, scored, strict=True) for best in [max(s for _, s in of)] if best >= threshold for w, s in of if s == best]
    least = least_common(n, m, threshold)
    if least > min(n, m):
        return []
    x, y = n - least, m - least
    ac, zc = _codes(a, n), _codes(z, m)
    pieces = (x + y) // (EDITS + 1) + 1
    if len(a) * len(z) <= 20_000 or m // pieces <= 2 * EDITS and not _whole(len(a), n, x, len(z), m, y):
        step = max(1, 4_000_000 // len(z))
        met: Iterable[np.ndarray] = (np.arange(i * len(z), min(i + step, len(a)) * len(z)) for i in range(0, len(a), step))
    else:
        met = _met(ac, zc, x, y)
    best = np.full(len(a), least - 1)
    kept: list[np.ndarray] = []
    for pairs in met:
        for at in range(0, len(pairs), 100_000):
            part = pairs[at : at + 100_000]
            i, j = part // len(z), part % len(z)
            common = _common(ac[i], zc[j])
            np.maximum.at(best, i, common)
            good = common >= np.maximum(best[i], least)
            if good.any():
                kept.append(np.stack([part[good], common[good]]))
    if not kept:
        return []
    pair, at = np.unique(np.concatenate(kept, 1)[0], return_index=True)
    common = np.concatenate(kept, 1)[1][at]
    top = common == best[pair // len(z)]
    return [(a[p // len(z)], z[p % len(z)], s) for p, c in zip(pair[top].tolist(), common[top].tolist(), strict=True) if (s := 200.0 * c / (n + m)) >= threshold]


def least_common(n: int, m: int, threshold: float) -> int:
    """Letters that words of n and m letters must have in common, in order."""
    return max(0, math.ceil(threshold * (n + m) / 200 - 1e-9))
