"""Declared record shapes. Nothing in the library infers types from data.

The names, order and types below are fixed values: they are the wire and file
formats of the sales feed and must match it exactly.
"""

from pyspark.sql import types as T

SALE_FIELDS = (
    "IDVente",
    "DateVente",
    "Produit",
    "Categorie",
    "Quantité",
    "PrixUnitaire",
    "Client",
    "Ville",
    "Pays",
    "Remise",
    "MoyenPaiement",
    "Total",
)


def _sale(**typed: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f, typed.get(f, T.StringType())) for f in SALE_FIELDS])


# JSON messages and raw CSV: everything is text. Writers of the feed disagree on
# quoting numbers, and a text schema reads both.
SALE_RAW = _sale()

# Headerless CSV relayed as JSON.
SALE_POSITIONAL = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(12)])

# CSV typed at the scan. The feed declares whole-number prices here; pass
# SALE_CSV_PRICED instead where prices carry decimals, or they read as NULL.
SALE_CSV = _sale(
    **{
        "Quantité": T.IntegerType(),
        "PrixUnitaire": T.IntegerType(),
        "Remise": T.DoubleType(),
        "Total": T.DoubleType(),
    }
)
SALE_CSV_PRICED = _sale(
    **{
        "Quantité": T.IntegerType(),
        "PrixUnitaire": T.DoubleType(),
        "Remise": T.DoubleType(),
        "Total": T.DoubleType(),
    }
)

# A parsed message. The column drops the accent that the JSON key carries.
SALE_EVENT = T.StructType(
    [
        T.StructField("Quantite" if f.name == "Quantité" else f.name, f.dataType)
        for f in SALE_CSV_PRICED
    ]
)

# The catalog table. Rows are inserted by position, so the order matters.
SALE_TABLE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("produit", T.StringType()),
        T.StructField("prixUnitaire", T.DoubleType()),
        T.StructField("quantite", T.IntegerType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("remise", T.DoubleType()),
        T.StructField("ville", T.StringType()),
        T.StructField("client", T.StringType()),
        T.StructField("moyenPaiement", T.StringType()),
        T.StructField("dateVente", T.DateType()),
    ]
)

SALE_RENAMES = {
    "IDVente": "id",
    "DateVente": "dateVente",
    "Produit": "produit",
    "Quantité": "quantite",
    "PrixUnitaire": "prixUnitaire",
    "Client": "client",
    "Ville": "ville",
    "MoyenPaiement": "moyenPaiement",
    "Total": "total",
    "Remise": "remise",
}

TEST_TABLE = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("data", T.StringType())]
)
TEST_ROWS = ((1, "Donnée 1"), (2, "Donnée 2"), (3, "Donnée 3"))

# One message of a topic, as Spark's Kafka source delivers it (less timestampType).
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
