"""A kept copy of a table's key column, laid out so that a batch can ask it without moving it.

The keys lie in files bucketed and sorted by key. A join with them shuffles the batch to the
buckets and reads each bucket where its part of the batch is; the keys of the table stay where
they are, however many there are. The index has a row for each row of the table, so a look at
the files' footers tells whether it is up to date; if some writer left it behind, it is built
anew before it is used.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.sources.tables import quoted, scan_table, table_fact

#: Buckets of an index: a bucket of 10**10 keys in 2048 buckets has 5 million.
BUCKETS = 2048
_KEY = "__index_key"


def index_name(table: str, key: str) -> str:
    return f"{table}__{key}_keys"


def has_index(spark: SparkSession, table: str, key: str) -> bool:
    try:
        return spark.catalog.tableExists(quoted(index_name(table, key)))
    except AnalysisException:
        return False


def build_key_index(spark: SparkSession, table: str, key: str, buckets: int = BUCKETS) -> None:
    """Write the index of ``key`` anew, beside the files of the table. All keys shuffle, this once."""
    rows = scan_table(spark, table).select(key).repartition(buckets, key)
    _write(spark, rows, table, key, buckets, "overwrite")


def _write(spark: SparkSession, rows: DataFrame, table: str, key: str, buckets: int, mode: str) -> None:
    # an underscore keeps the folder out of the table's own listing
    home = f"{table_fact(spark, table, 'Location')}/_keys_{key}"
    writer = rows.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", home).saveAsTable(index_name(table, key))


def _buckets(spark: SparkSession, table: str, key: str) -> int:
    return int(table_fact(spark, index_name(table, key), "Num Buckets"))


def up_to_date(spark: SparkSession, table: str, key: str) -> bool:
    """Whether there are as many rows in both: two counts that read the footers of files only."""
    return scan_table(spark, table).count() == scan_table(spark, index_name(table, key)).count()


def not_in_index(rows: DataFrame, table: str, key: str) -> DataFrame:
    """The ``rows`` whose key the table does not hold."""
    spark = rows.sparkSession
    if not up_to_date(spark, table, key):
        build_key_index(spark, table, key, _buckets(spark, table, key))
    known = spark.table(index_name(table, key)).select(F.col(key).alias(_KEY)).filter(F.col(_KEY).isNotNull())
    return rows.join(known, rows[key] == known[_KEY], "left_anti")


def add_keys(rows: DataFrame, table: str, key: str) -> None:
    """Put the keys of rows that were appended into the index."""
    spark = rows.sparkSession
    n = _buckets(spark, table, key)
    _write(spark, rows.select(key).repartition(n, key), table, key, n, "append")
