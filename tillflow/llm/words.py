"""Words of UTF-8 text by byte class, and hashes of words and of runs of words."""

from __future__ import annotations

import numpy as np

_ODD = 0xD6E8FEB86659FD93
_INVERSE = pow(_ODD, -1, 2**64)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

#: Digits, small letters and every byte of a character beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        _powers = tuple(
            np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, base, np.uint64)))
            for base in (_ODD, _INVERSE)
        )
    return _powers


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of lower-cased rows, and the number of each row's first word."""
    inside = WORD[data]
    row_starts = offsets[:-1][np.diff(offsets) > 0]
    before = np.append(False, inside[:-1])[: len(inside)]
    before[row_starts] = False
    after = np.append(inside[1:], False)[: len(inside)]
    after[offsets[1:][np.diff(offsets) > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _power_tables(len(data))
    total = np.append(np.uint64(0), np.cumsum(_BYTE[data] * power[: len(data)]))
    return mixed((total[ends] - total[starts]) * inverse[starts])


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; the last ``size - 1`` words have none."""
    n = max(len(hashes) - size + 1, 0)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(_ODD) + hashes[k : k + n])
    return out
