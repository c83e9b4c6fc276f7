"""Batch flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators.filters import filter_key_present
from tillflow.operators.parsing import parse_json, render_json
from tillflow.operators.projections import clean_cast, project_columns, rename_by_name
from tillflow.schemas import SALE_CSV, SALE_RAW, TEST_ROWS, TEST_TABLE
from tillflow.sinks.files import counted, readback_check, write_csv, write_csv_if_absent
from tillflow.sinks.tables import append_table
from tillflow.sinks.topics import write_topic
from tillflow.sources.files import latest_drop, read_csv_raw, read_csv_typed
from tillflow.sources.tables import create_namespace, create_table, inline_values
from tillflow.sources.topics import Topic, read_topic


def ingest_latest_file(
    spark: SparkSession,
    src_dir: str,
    topic: Topic,
    schema: T.StructType = SALE_CSV,
    glob: str = "*.csv",
    *,
    manifest: str | None = None,
) -> DataFrame:
    """Send the newest complete drop of a folder to a topic as JSON; one row ``path, files, rows``.

    A drop is a file that lies in the folder, or a folder below it whose writer has finished
    (see `latest_drop`); its files are read side by side.
    """
    drop = latest_drop(spark, src_dir, glob, manifest=manifest)
    messages = render_json(read_csv_typed(spark, drop.files, schema))
    rows = counted(messages, lambda df: write_topic(df, topic))
    return spark.createDataFrame([(drop.path, len(drop.files), rows)], "path string, files int, rows bigint")


def clean_sales(raw: DataFrame) -> DataFrame:
    """Raw text sales to the ten typed columns of the table: one map-side projection."""
    return project_columns(clean_cast(rename_by_name(raw)))


def load_sales_table(
    spark: SparkSession,
    csv: str,
    table: str,
    export: str | None = None,
    *,
    provider: str = "parquet",
    location: str | None = None,
    dedupe_key: str | None = None,
) -> DataFrame:
    """Clean a CSV into a catalog table, which is returned; ``export`` copies the raw rows."""
    if "." in table:
        create_namespace(spark, table.rpartition(".")[0])
    create_table(spark, table, provider=provider, location=location)
    raw = read_csv_raw(spark, csv)
    append_table(clean_sales(raw), table, dedupe_key)
    if export is not None:
        write_csv(raw, export)
    return spark.table(table)


def land_topic(
    spark: SparkSession, topic: Topic, out: str, schema: T.StructType = SALE_RAW
) -> DataFrame:
    """Snapshot of a topic's valid sales as Parquet; returns the check of what was written.

    Give each run its own ``out`` to keep earlier snapshots.
    """
    sales = filter_key_present(parse_json(read_topic(spark, topic), schema), schema.names[0])
    return readback_check(spark, sales, out)


def catalog_smoke(
    spark: SparkSession,
    namespace: str,
    out: str,
    *,
    table: str = "test_table",
    rows: DataFrame | None = None,
    provider: str = "parquet",
    location: str | None = None,
) -> DataFrame:
    """Create, fill and read a small table, and save it as CSV where there is none.

    Returns the table's rows with ``exported``: whether the CSV was written now.
    """
    name = f"{namespace}.{table}"
    create_namespace(spark, namespace)
    create_table(spark, name, TEST_TABLE, provider, location=location)
    append_table(inline_values(spark, TEST_ROWS) if rows is None else rows, name)
    filled = spark.table(name)
    wrote = write_csv_if_absent(filled, out)
    return filled.withColumn("exported", F.lit(wrote))
