"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_key_present(df: DataFrame, key: str = "IDVente") -> DataFrame:
    """Rows that have a key. Malformed messages parse to all NULL and go here too."""
    return df.filter(F.col(key).isNotNull())


def filter_header_row(df: DataFrame, key: str = "_c0", header: str = "IDVente") -> DataFrame:
    """Drop header lines read as data. A NULL key compares as unknown and drops too."""
    return df.filter(F.col(key) != header)


def filter_nonempty(df: DataFrame, col: str = "value") -> DataFrame:
    """Drop empty and NULL messages."""
    return df.filter(F.length(col) > 0)


def filter_threshold(df: DataFrame, col: str = "Total", threshold: float = 1000.0) -> DataFrame:
    """Strictly above the threshold. Spark ranks NaN above every number; it is no sale."""
    return df.filter((F.col(col) > threshold) & ~F.isnan(col))
