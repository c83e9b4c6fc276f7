"""Grouped totals, counts, ordered limits and top-k.

Grouped sums are partial on the map side, so a key with a third of all rows costs
one row per map task in the shuffle. They run unchanged on streams in update or
complete mode; without a watermark the state keeps every key it has seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.operators.exact import EXACT, exact_sum


def group_stats(
    df: DataFrame, key: str = "Categorie", measure: str = "Total", sum_type: str = "double"
) -> DataFrame:
    """Per key: ``n`` rows, ``total`` and ``mean`` = total / n.

    Sums of doubles depend on the order of addition in the last digits. Give
    ``sum_type='decimal(18,2)'`` for money totals that do not, or ``'exact'`` for doubles of
    any size (`exact_sum`). A value that the type cannot hold counts as NULL;
    `parse_sale_strict` can reject such records before.
    """
    total = _total(measure, sum_type)
    n = F.count(F.lit(1))
    return df.groupBy(key).agg(
        n.alias("n"), total.alias("total"), (total.cast("double") / n).alias("mean")
    )


def group_totals(
    df: DataFrame, key: str = "Ville", measure: str = "Total", sum_type: str = "double"
) -> DataFrame:
    """Per key: ``total``."""
    return df.groupBy(key).agg(_total(measure, sum_type).alias("total"))


def _total(measure: str, sum_type: str) -> Column:
    if sum_type == EXACT:
        return exact_sum(F.col(measure).try_cast("double"))
    return F.sum(F.col(measure).try_cast(sum_type))


def group_stats_each(
    df: DataFrame, keys: Sequence[str], measure: str = "Total", sum_type: str = "double"
) -> DataFrame:
    """`group_stats` by each key on its own, in one pass over the rows.

    ``by`` names the key column and ``key`` is its value as text.
    """
    total = _total(measure, sum_type)
    n = F.count(F.lit(1))
    # grouping_id has a bit per key, the last key lowest, set where the key is left out.
    ids = {k: (1 << len(keys)) - 1 - (1 << i) for i, k in enumerate(reversed(keys))}
    level = F.grouping_id()
    stats = df.groupingSets([[k] for k in keys], *keys).agg(
        level.alias("level"),
        n.alias("n"),
        total.alias("total"),
        (total.cast("double") / n).alias("mean"),
    )

    def by_level(values: dict[str, Column]) -> Column:
        return F.coalesce(*[F.when(F.col("level") == ids[k], v) for k, v in values.items()])

    return stats.select(
        by_level({k: F.lit(k) for k in keys}).alias("by"),
        by_level({k: F.col(k).cast("string") for k in keys}).alias("key"),
        "n",
        "total",
        "mean",
    )


def row_count(df: DataFrame) -> DataFrame:
    """One row, one column ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def limit_rows(df: DataFrame, order: str | Column | Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in the given order (each task keeps n, no full sort)."""
    return df.orderBy(*(order if isinstance(order, (list, tuple)) else [order])).limit(n)


def top_k(df: DataFrame, key: str = "Ville", total: str = "total", k: int = 5) -> DataFrame:
    """The ``k`` rows with the largest totals, ties by key."""
    return limit_rows(df, [F.desc(total), F.asc(key)], k)
