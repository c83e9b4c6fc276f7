"""One-line texts. Numbers use ``.`` as decimal mark whatever the JVM locale is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats.
CATEGORY_FORMAT = "📊 %s: %d ventes, CA: %.2f€, Moyenne: %.2f€"
CITY_FORMAT = "🏙️  %s: %.2f€"
ALERT_PREFIX = "🚨 GROSSE VENTE! "
SALE_PREFIX = "✅ Vente "


def category_text(category: Column, n: Column, total: Column, mean: Column) -> Column:
    return F.format_string(CATEGORY_FORMAT, category, n, total, mean)


def city_text(city: Column, total: Column) -> Column:
    return F.format_string(CITY_FORMAT, city, total)


def _product_total_client(product: Column, total: Column, client: Column) -> list[Column]:
    return [product, F.lit(" - "), total.cast("string"), F.lit("€ - "), client]


def alert_text(product: Column, total: Column, client: Column) -> Column:
    return F.concat(F.lit(ALERT_PREFIX), *_product_total_client(product, total, client))


def sale_text(sale_id: Column, product: Column, total: Column, client: Column) -> Column:
    return F.concat(
        F.lit(SALE_PREFIX), sale_id, F.lit(": "), *_product_total_client(product, total, client)
    )
