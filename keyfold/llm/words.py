"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than ASCII white space, after lower-casing A-Z.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection: multiply and shift, twice)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes], between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, number of words of each text); ``between``: which bytes part words."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    space = between[data]
    begins = ~space
    begins[1:] &= space[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    runs = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, runs)
    value = np.where(space, np.uint64(0), _LOWER[data].astype(np.uint64) + np.uint64(1))[starts[0]:]
    value *= _powers(int(runs.max()))[place]
    sums = np.add.reduceat(value, starts - starts[0])
    ends = np.cumsum(lengths)
    upto = np.searchsorted(starts, ends)
    return mix(sums), np.diff(np.concatenate(([0], upto)))


def word_places(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(the texts in lower case, a space after each; where each word of ``word_hashes`` begins and ends there)."""
    low = (b" ".join(texts) + b" ").lower()
    space = _SPACE[np.frombuffer(low, dtype=np.uint8)]
    before = np.concatenate(([True], space[:-1]))
    return low, np.flatnonzero(~space & before), np.flatnonzero(space & ~before)


def shingle_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its n-word shingles.

    Fewer than n words: the whole sequence as one; no words: empty.
    """
    words, counts = word_hashes(texts)
    out, at = [], 0
    if len(words) >= n:
        rolled = np.zeros(len(words) - n + 1, dtype=np.uint64)
        factor = _powers(n + 2)
        for i in range(n):
            rolled += words[i:len(words) - n + 1 + i] * factor[i + 1]
        rolled = mix(rolled)
    for count in counts:
        if count >= n:
            out.append(np.unique(rolled[at:at + count - n + 1]))
        elif count:
            short = (words[at:at + count] * _powers(n + 2)[1:count + 1]).sum(dtype=np.uint64) + np.uint64(count)
            out.append(mix(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        at += count
    return out
