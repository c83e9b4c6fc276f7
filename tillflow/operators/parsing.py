"""JSON messages to sale columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.formats import EXACT_TIMESTAMPS
from tillflow.operators.projections import expand_struct
from tillflow.schemas import SALE_EVENT, SALE_RAW

_BROKEN = "_corrupt_record"
_WHOLE_NUMBER = r"^[+-]?\d+\z"  # "$" would let a final newline pass
_JSON_BLANKS = " \t\r\n"


def parse_json(df: DataFrame, schema: T.StructType = SALE_RAW, col: str = "value") -> DataFrame:
    """Lenient parse: absent fields are NULL, an unreadable message is a row of NULLs."""
    return expand_struct(df.select(_parsed_once(F.col(col), schema)))


def _parsed_once(text: Column, schema: T.StructType, options: dict | None = None) -> Column:
    """``data``: the parsed text, as the single row of a generator.

    Catalyst moves a later filter below a plain projection and copies the parse into
    it for every field the filter reads. It does not move one below a generator.
    Text that does not open an object would parse to NULL by way of a costly
    exception, so it is NULL from the start.
    """
    text = text.cast("string")
    opens = F.ltrim(text, F.lit(_JSON_BLANKS)).startswith("{")
    record = F.from_json(F.when(opens, text), schema, options)
    return F.explode(F.array(record)).alias("data")


def parse_sale_strict(
    df: DataFrame,
    col: str = "value",
    keep: Sequence[str] = (),
    total_type: str = "double",
) -> DataFrame:
    """Typed sale columns, plus ``raw``, ``reason`` (first fault, NULL if none) and ``ok``.

    Every field must be present and a plain value, and the four numbers must convert.
    Columns named in ``keep`` pass through unchanged (an offset, say). A ``Total`` that
    ``total_type`` cannot hold is a fault: it could not be added up.
    """
    schema = T.StructType([*SALE_RAW, T.StructField(_BROKEN, T.StringType())])
    options = {"columnNameOfCorruptRecord": _BROKEN}
    raw = F.col(col).cast("string").alias("raw")
    parsed = df.select(*keep, raw, _parsed_once(F.col(col), schema, options))

    fields, faults = [], [
        F.when(F.col("raw").isNull(), "no message"),
        F.when(F.col("data").isNull() | F.col(f"data.{_BROKEN}").isNotNull(), "malformed JSON"),
    ]
    for source, target in zip(SALE_RAW, SALE_EVENT, strict=True):
        text = F.col(f"data.{source.name}")
        faults.append(F.when(text.isNull(), f"missing field {source.name}"))
        if isinstance(target.dataType, T.StringType):
            fields.append(text.alias(target.name))
            faults.append(F.when(_is_nested(text, source.name), f"not text: {source.name}"))
            continue
        value = text.try_cast(target.dataType)
        if isinstance(target.dataType, T.IntegerType):
            value = F.when(text.rlike(_WHOLE_NUMBER), value)
        fields.append(value.alias(target.name))
        faults.append(F.when(value.isNull(), f"not a number: {source.name}"))
        if source.name == "Total" and total_type != "double":
            faults.append(F.when(value.try_cast(total_type).isNull(), "out of range: Total"))

    typed = parsed.select(*keep, *fields, "raw", F.coalesce(*faults).alias("reason"))
    return typed.withColumn("ok", F.col("reason").isNull())


def _is_nested(text: Column, field: str) -> Column:
    """True if the field held an object or array, which a text schema reads as its JSON.

    Only text that looks like one is parsed a second time to tell it from a string.
    """
    kind = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json("raw"), f"$['{field}']", "variant")
    )
    looks_nested = text.startswith("{") | text.startswith("[")
    return F.when(looks_nested, kind.rlike("^(OBJECT|ARRAY)")).otherwise(False)


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good sales and rejects of `parse_sale_strict`."""
    good = parsed.filter("ok").drop("raw", "reason", "ok")
    return good, parsed.filter("NOT ok")


def reject_envelope(rejects: DataFrame) -> DataFrame:
    """Rejected messages as JSON error records in ``value``."""
    record = F.struct(
        F.lit("Parse error").alias("error"), F.col("reason").alias("message"), F.col("raw")
    )
    return rejects.filter("NOT ok").select(F.to_json(record).alias("value"))


def render_json(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows as JSON text in ``value``; NULL fields are left out."""
    record = F.struct(*(cols or df.columns))
    return df.select(F.to_json(record, EXACT_TIMESTAMPS).alias("value"))


def render_event_json(df: DataFrame) -> DataFrame:
    """Typed sales as JSON: feed key names, numbers unquoted, text escaped."""
    fields = [
        F.col(event.name).alias(source.name)
        for source, event in zip(SALE_RAW, SALE_EVENT, strict=True)
    ]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))
