"""Words of many texts as arrays: one pass over their bytes, no loop over words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidelog.llm.common import mix64, pair64

_STEP = np.uint64(0x9E3779B97F4A7C55)  # odd, so it has an inverse mod 2^64
_BACK = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_BYTE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(977)) | np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_CACHE = [_powers(_STEP, 1 << 16), _powers(_BACK, 1 << 16)]


def _tables(n: int) -> list[np.ndarray]:
    if len(_CACHE[0]) < n:
        size = 1 << (n - 1).bit_length()
        _CACHE[:] = [_powers(_STEP, size), _powers(_BACK, size)]
    return _CACHE


@dataclass
class Words:
    """hash, byte span and text number of every word; first word of each text (one more at the end)."""

    data: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    first: np.ndarray


def words(texts: list[str], fold: bool) -> Words:
    """Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and return.

    ``fold`` lower-cases A-Z.  A word's hash is a polynomial over its bytes mod
    2^64, taken from prefix sums and shifted back to its start, then mixed.
    """
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    if fold:
        data = _FOLD[data]
    blank = _IS_BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, back = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    hashed = mix64((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    ends = np.cumsum(np.array([len(p) + 1 for p in parts], np.int64))
    owner = np.searchsorted(ends, start, "right")
    first = np.searchsorted(owner, np.arange(len(parts) + 1))
    return Words(data, hashed, start, end, owner, first)


def windows(hashed: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours (order matters), by binary composition."""
    out, have, power, size = None, 0, hashed, 1
    left = width
    while left:
        if left & 1:
            if out is None:
                out = power
            else:
                n = min(len(out), len(power) - have)
                out = pair64(out[:n], power[have : have + n]) if n > 0 else out[:0]
            have += size
        left >>= 1
        if left:
            power = pair64(power[: len(power) - size], power[size:]) if len(power) > size else power[:0]
            size *= 2
    return out
