"""Sums of doubles that are the same in whatever order, partitions or batches they are added.

A double is cut along fixed powers of two into whole numbers, one for each bin of its exponent.
Whole numbers add up exactly, so the sums of the bins depend on the values alone; they become
one double at the end, from the smallest bin to the largest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a bin, and the powers of 2**WIDTH that begin the first and the last one.
WIDTH, LOW, HIGH = 32, -4, 4
#: ``sum_type`` of the grouped operators for these sums.
EXACT = "exact"


def exact_sum(value: Column) -> Column:
    """An aggregate: the sum of a double column, NULL if there is no value.

    Values below 2**160 count down to their bit of 2**-128; what lies below that is cut off
    each. Values that are larger, NaN or infinite are added as doubles: the last two give the
    same in any order. The result is within a few units of its last place, unless the sums of
    two bins all but cancel out.
    """
    value = value.cast("double")
    odd = F.isnan(value) | (F.abs(value) >= 2.0 ** (WIDTH * (HIGH + 1)))
    plain = F.when(~odd, value)
    bins = [_bin(plain, k) * F.lit(2.0 ** (WIDTH * k)) for k in range(LOW, HIGH + 1)]
    whole = reduce(Column.__add__, bins)
    rest = F.sum(F.when(odd, value))
    return F.when(rest.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest)


def _bin(value: Column, k: int) -> Column:
    """The sum of the bits from 2**(WIDTH k) up to the next bin: whole numbers of 32 bits."""
    if k < HIGH:
        value = value % F.lit(2.0 ** (WIDTH * (k + 1)))  # exact, as is the division by a power of two
    part = value / F.lit(2.0 ** (WIDTH * k))
    return F.sum((part - part % F.lit(1.0)).cast("decimal(10,0)")).cast("double")
