"""Catalog namespaces and tables. The names may lead to any configured catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schemas import SALE_TABLE, TEST_TABLE

#: Partition columns of a committed table: the stream that wrote a row, or ``BATCH``, and the
#: number of its micro-batch. A number below zero, -n - 1, holds the batches up to n folded
#: together (`tillflow.sinks.tables.fold_batches`).
COMMITS = ("written_by", "written_in")
BATCH = "batch"


def quoted(name: str) -> str:
    """A dotted name with every part in back quotes, unless it has some already."""
    return name if "`" in name else ".".join(f"`{part}`" for part in name.split("."))


def _located(location: str | None) -> str:
    if not location:
        return ""
    return " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(namespace)}{_located(location)}")


def list_namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql("SHOW NAMESPACES" + (f" IN {quoted(catalog)}" if catalog else ""))


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType = SALE_TABLE,
    provider: str = "parquet",
    *,
    location: str | None = None,
    partition_by: Iterable[str] = (),
    committed: bool = False,
) -> None:
    """``committed`` keeps the micro-batches of streams apart, so that a retried one adds nothing.

    It serves formats that are plain files; see `tillflow.sinks.tables.stream_to_table`.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    if committed:
        columns += ", {} STRING, {} BIGINT".format(*COMMITS)
        partition_by = [*partition_by, *COMMITS]
    ddl = f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING {provider}"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    spark.sql(ddl + _located(location))


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables of the namespace; Spark would add the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN {quoted(namespace)}").filter("NOT isTemporary")


def table_fact(spark: SparkSession, name: str, fact: str) -> str:
    """A line of the table's description, such as its ``Location``; empty if there is none."""
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").filter(F.col("col_name") == fact)
    row = facts.first()
    return row.data_type if row else ""


def is_committed(table: DataFrame) -> bool:
    return tuple(table.columns[-2:]) == COMMITS


def commits(spark: SparkSession, name: str) -> dict[str, set[int]]:
    """The batch numbers of each writer of a committed table, from its list of partitions."""
    out: dict[str, set[int]] = {}
    for row in spark.sql(f"SHOW PARTITIONS {quoted(name)}").toLocalIterator():
        spec = dict(part.split("=", 1) for part in row.partition.split("/"))
        out.setdefault(spec[COMMITS[0]], set()).add(int(spec[COMMITS[1]]))
    return out


def folded_to(numbers: Iterable[int]) -> int:
    """The last batch that is folded; -1 if none is."""
    return max((-n - 1 for n in numbers if n < 0), default=-1)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table; of a committed one without the columns that say who wrote them.

    A fold that stopped half-way leaves batches beside their folded rows; they are passed over.
    """
    spark.catalog.refreshTable(quoted(name))  # a stream writes in a session of its own
    table = spark.table(name)
    if not is_committed(table):
        return table
    by, at = (F.col(c) for c in COMMITS)
    for writer, numbers in commits(spark, name).items():
        last = folded_to(numbers)
        stale = [n for n in numbers if 0 <= n <= last or -1 >= n > -last - 1]
        if stale and writer != BATCH:
            table = table.filter(~((by == writer) & at.isin(stale)))
    return table.drop(*COMMITS)


def inline_values(
    spark: SparkSession, rows: Iterable[tuple], schema: T.StructType = TEST_TABLE
) -> DataFrame:
    """Literal rows as a relation."""
    return spark.createDataFrame(list(rows), schema)
