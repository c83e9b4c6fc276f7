"""Exact products of whole-number matrices from float32 products modulo small primes.

A residue lies between -p/2 and p/2, so a sum of 1024 products of residues stays below 2**24,
where float32 is exact. Enough primes hold every sum between -bound and bound; mixed-radix
digits (Chinese remaindering) give the signed sums back.
"""

from __future__ import annotations

import numpy as np

#: Components summed in one float32 product: 1024 * 125**2 < 2**24.
DEPTH = 1024
#: From this product of primes on sums are Python integers: a hundred times a sum may pass 64 bits.
WIDE = 1 << 56


def _small_primes() -> list[int]:
    """Primes below 252, largest first; 2 is left out, whose residues have no middle."""
    return [n for n in range(251, 2, -2) if all(n % d for d in range(3, int(n**0.5) + 1, 2))]


def moduli(bound: int) -> list[int]:
    """As many primes as hold every sum from ``-bound`` to ``bound``."""
    out, product = [], 1
    for p in _small_primes():
        if product > 2 * bound + 1:
            return out
        out.append(p)
        product *= p
    if product > 2 * bound + 1:
        return out
    raise ValueError("sums too wide for the product of all small primes")


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """``matrix`` (whole numbers as float64) modulo each prime, from -p/2 to p/2, as float32."""
    out = []
    for p in primes:
        r = np.fmod(matrix, p)  # exact for every whole number of a double
        r[r > p // 2] -= p
        r[r < -(p // 2)] += p
        out.append(r.astype(np.float32))
    return out


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """``A @ B.T`` from the residues of both: int64, or Python integers where the primes hold more."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        x, y = a[k], b[k]
        total = np.zeros((len(x), len(y)), np.int64)
        for at in range(0, x.shape[1], DEPTH):
            total += (x[:, at : at + DEPTH] @ y[:, at : at + DEPTH].T).astype(np.int64)
        # the digit of this prime, after those of the primes before it
        for q, d in zip(primes, digits, strict=False):
            total = (total - d) * pow(q, -1, p) % p
        digits.append(total % p)
    product = 1
    for p in primes:
        product *= p
    wide = product >= WIDE
    out = np.zeros(digits[0].shape, object if wide else np.int64)
    for d, p in zip(reversed(digits), reversed(primes), strict=True):
        out = out * p + (d.astype(object) if wide else d)
    return np.where(out > product // 2, out - product, out)
