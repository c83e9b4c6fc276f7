"""Running totals per key: the n-th row of a key shows its first n rows added up.

A window over a whole key puts that key into one task, which fails once a key holds
a good part of the rows. So keys with more than ``block`` rows are split:

1. count the rows per key, on the map side first; the split keys are fewer than
   rows / ``block`` (250,000 keys of a trillion rows), and Spark decides by their
   measured size how to join them;
2. cut the order column of split keys into blocks and total each (key, block);
3. add up the totals of all earlier blocks, over those few rows;
4. window each (key, block), starting from the sum of step 3.

Every other key is one block. Step 3 cuts its own order, the block numbers, once
more in the same way. With orders that are unique no window of rows holds more than
``block`` rows then, nor one of totals more than 2**22, however keys are spread. An
order of several columns, as topic partition and offset, is cut by the last one within
each value of the others.

Decimal totals are the same for any ``block``. Doubles differ in the last digits, as
they depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Helper columns.
_SUM, _N, _ROW, _BLOCK, _SPLIT, _KEY, _ABOVE, _PART = (
    f"__running_{c}" for c in ("sum", "n", "row", "block", "split", "key", "above", "part")
)
BLOCK = 1 << 22


def running_stats(
    df: DataFrame,
    key: str,
    measure: str,
    order: str | Sequence[str] = "offset",
    *,
    ties: Sequence[str] = (),
    sum_type: str = "double",
    carry: DataFrame | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``df`` plus ``n``, ``total`` and ``mean`` so far, in ``order`` within each key.

    Columns of ``df`` with these names, in any case, give way to the new ones.
    ``order`` is an integer such as an event number, or several columns of which the
    last is an integer, such as topic partition and offset; ``ties`` settle equal
    values. A value that ``sum_type`` cannot hold counts as NULL. ``carry`` has ``key, total, n`` to start from. Select the
    columns you need first: all of ``df`` is shuffled once by key and block. ``df`` is
    read two or three times, so write it out before if it is costly to compute.
    """
    *lead, last = [order] if isinstance(order, str) else order
    if not isinstance(df.schema[last].dataType, T.IntegralType):
        raise TypeError(f"order column {last} must be an integer")
    parts = [f"{_PART}{i}" for i in range(len(lead))]
    kept = [c for c in df.columns if c.lower() not in ("n", "total", "mean")]
    rows = df.withColumns({_SUM: F.col(measure).try_cast(sum_type), _N: F.lit(1).cast("bigint")})
    split = (
        rows.groupBy(F.col(key).alias(_KEY))
        .agg(F.count(F.lit(1)).alias(_N))
        .filter(F.col(_N) > block)
        .select(_KEY, F.lit(True).alias(_SPLIT))
    )

    def numbered(part: DataFrame, number: Column, of: Sequence[Column]) -> DataFrame:
        marked = part.join(split, F.col(key).eqNullSafe(F.col(_KEY)), "left")
        placed = {p: F.when(F.col(_SPLIT), c) for p, c in zip(parts, of, strict=True)}
        return marked.withColumns(
            {_BLOCK: F.when(F.col(_SPLIT), number).otherwise(0), **placed}
        ).drop(_KEY)

    rows = numbered(rows, _cut(last, block), [F.col(c) for c in lead])
    totals = rows.filter(_SPLIT).groupBy(key, *parts, _BLOCK).agg(_total(_SUM), _total(_N))
    if carry is None:
        starts = _before(totals, key, parts, None)
    else:
        carry = carry.select(key, F.col("total").alias(_SUM), F.col("n").alias(_N))
        carry = numbered(carry, F.lit(0), [F.lit(None).cast(df.schema[c].dataType) for c in lead])
        split_carry = carry.filter(_SPLIT).drop(_BLOCK, _SPLIT, *parts)
        starts = _before(totals, key, parts, split_carry).unionByName(
            carry.filter(F.col(_SPLIT).isNull()).drop(_SPLIT)
        )
    added = _add_up(rows.drop(_SPLIT), [key, *parts, _BLOCK], [*lead, last, *ties], starts, 0)
    return added.select(
        *kept,
        F.col(_N).alias("n"),
        F.col(_SUM).alias("total"),
        (F.col(_SUM).cast("double") / F.col(_N)).alias("mean"),
    )


def _before(
    totals: DataFrame, key: str, parts: list[str], carry: DataFrame | None
) -> DataFrame:
    """Per (key, block): sum and count of the carry and of all earlier blocks."""
    totals = totals.withColumn(_ABOVE, _cut(_BLOCK, BLOCK))
    above = totals.groupBy(key, *parts, _ABOVE).agg(_total(_SUM), _total(_N))
    starts = _add_up(above, [key], [*parts, _ABOVE], carry, -1)
    return _add_up(totals, [key, *parts, _ABOVE], [_BLOCK], starts, -1).drop(_ABOVE)


def _add_up(
    rows: DataFrame, group: list[str], order: list[str], starts: DataFrame | None, last: int
) -> DataFrame:
    """Replace sum and count by those up to ``last``: 0 is this row, -1 the one before.

    A start value joins its group as the row that sorts first: no join, one shuffle.
    """
    rows = rows.withColumn(_ROW, F.lit(True))
    if starts is not None:
        starts = starts.select(*group, _SUM, _N, F.lit(False).alias(_ROW))
        rows = rows.unionByName(starts, allowMissingColumns=True)
    w = (
        Window.partitionBy(*group)
        .orderBy(_ROW, *order)
        .rowsBetween(Window.unboundedPreceding, last)
    )
    total, n = F.sum(_SUM).over(w), F.sum(_N).over(w)
    if last < 0:
        n = F.coalesce(n, F.lit(0))  # a sum of no values stays NULL
    return rows.withColumns({_SUM: total, _N: n}).filter(_ROW).drop(_ROW)


def _cut(order: str, width: int) -> Column:
    return F.expr(f"`{order}` div {width}L")


def _total(col: str) -> Column:
    return F.sum(col).alias(col)
