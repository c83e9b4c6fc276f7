"""Text reports: each returns one ``message`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.messages import alert_text, category_text, city_text, sale_text
from tillflow.operators.filters import filter_threshold


def category_message(stats: DataFrame, key: str = "Categorie") -> DataFrame:
    """From `group_stats` or `running_stats` rows."""
    text = category_text(
        F.col(key), F.col("n"), F.col("total").cast("double"), F.col("mean")
    )
    return stats.select(text.alias("message"))


def city_message(totals: DataFrame, key: str = "Ville") -> DataFrame:
    """From `group_totals` or `running_stats` rows."""
    return totals.select(
        city_text(F.col(key), F.col("total").cast("double")).alias("message")
    )


def big_sale_alert(sales: DataFrame, threshold: float = 1000.0) -> DataFrame:
    big = filter_threshold(sales, "Total", threshold)
    return big.select(
        alert_text(F.col("Produit"), F.col("Total"), F.col("Client")).alias("message")
    )


def sale_message(sales: DataFrame) -> DataFrame:
    return sales.select(
        sale_text(
            F.col("IDVente"), F.col("Produit"), F.col("Total"), F.col("Client")
        ).alias("message")
    )
