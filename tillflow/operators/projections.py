"""Column selection, renaming and cast projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.casts import SALE_CLEANING, guarded_cast, lenient_cast
from tillflow.schemas import SALE_EVENT, SALE_FIELDS, SALE_RAW, SALE_RENAMES, SALE_TABLE

# Projection of a parsed sale onto the catalog table: output -> (input, type or None).
SALE_TABLE_PROJECTION = {
    "id": ("IDVente", "bigint"),
    "produit": ("Produit", None),
    "prixUnitaire": ("PrixUnitaire", None),
    "quantite": ("Quantite", None),
    "total": ("Total", None),
    "remise": ("Remise", None),
    "ville": ("Ville", None),
    "client": ("Client", None),
    "moyenPaiement": ("MoyenPaiement", None),
    "dateVente": ("DateVente", "date"),
}

# The same for the twelve text columns of a lenient parse.
TEXT_TABLE_PROJECTION = {
    out: (
        "Quantité" if name == "Quantite" else name,
        None if SALE_TABLE[out].dataType.simpleString() == "string"
        else SALE_TABLE[out].dataType.simpleString(),
    )
    for out, (name, _) in SALE_TABLE_PROJECTION.items()
}
# The twelve columns of a sale, typed.
TEXT_EVENT_PROJECTION = {
    event.name: (
        raw.name,
        None if event.dataType == raw.dataType else event.dataType.simpleString(),
    )
    for raw, event in zip(SALE_RAW, SALE_EVENT, strict=True)
}


def project_columns(df: DataFrame, cols: Sequence[str] = tuple(SALE_TABLE.names)) -> DataFrame:
    return df.select(*cols)


def rename_by_name(df: DataFrame, mapping: Mapping[str, str] = SALE_RENAMES) -> DataFrame:
    """Rename the columns that exist; names absent from ``df`` are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def rename_by_position(df: DataFrame, names: Sequence[str] = SALE_FIELDS) -> DataFrame:
    return df.toDF(*names)


def expand_struct(df: DataFrame, col: str = "data") -> DataFrame:
    """The fields of a struct as columns; a NULL struct gives a row of NULLs."""
    return df.select(f"{col}.*")


def envelope_view(df: DataFrame) -> DataFrame:
    """Topic messages with key and value decoded as text."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
    )


def project_cast(
    df: DataFrame, spec: Mapping[str, tuple[str, str | None]] = SALE_TABLE_PROJECTION
) -> DataFrame:
    """Columns ``out`` = ``in`` cast to a type (None keeps it); bad values become NULL."""
    return df.select(
        *[(F.col(i) if t is None else _cast(df, i, t)).alias(o) for o, (i, t) in spec.items()]
    )


def reject_counts(
    df: DataFrame, spec: Mapping[str, tuple[str, str | None]] = SALE_TABLE_PROJECTION
) -> list[Column]:
    """Aggregates: how many present values of each cast column `project_cast` would lose."""
    return [
        F.count_if(F.col(i).isNotNull() & _cast(df, i, t).isNull()).alias(o)
        for o, (i, t) in spec.items()
        if t is not None
    ]


def cast_rejects(
    df: DataFrame, spec: Mapping[str, tuple[str, str | None]] = SALE_TABLE_PROJECTION
) -> DataFrame:
    """One row: how many present values of each cast column `project_cast` would lose."""
    return df.agg(*reject_counts(df, spec))


def _cast(df: DataFrame, name: str, to: str) -> Column:
    return lenient_cast(F.col(name), df.schema[name].dataType, to)


def clean_cast(
    df: DataFrame, rules: Mapping[str, tuple[str, str]] = SALE_CLEANING
) -> DataFrame:
    """Replace text columns by guarded casts, all in one projection."""
    return df.withColumns({c: guarded_cast(F.col(c), p, t) for c, (p, t) in rules.items()})
