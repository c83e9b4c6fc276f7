"""Writers to catalog tables.

A table of plain files has no transactions. A committed one (`create_table`, ``committed``)
keeps each micro-batch of a stream in a partition of its own, which a retry of the batch
replaces whole; batches append to another partition. So a stream adds each row once and
batches may add rows beside it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.sinks.keys import add_keys, has_index, not_in_index
from tillflow.sources.tables import (
    BATCH,
    COMMITS,
    commits,
    folded_to,
    inline_values,
    is_committed,
    quoted,
    scan_table,
    table_fact,
)
from tillflow.streaming.batches import BatchSink, start, write_each_batch, writer_id

# Formats whose tables are plain folders of files.
_FILE_TABLES = {"parquet", "orc", "csv", "json", "avro", "text"}
# Keys of a batch that are sent to every task that reads the table, and their bytes, at most.
_FEW_KEYS, _FEW_BYTES = 1 << 18, 1 << 25
_DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def append_table(
    df: DataFrame, table: str, dedupe_key: str | None = None, *, by_name: bool = False
) -> None:
    """Append by position: names are ignored, and running it twice doubles the rows.

    With ``dedupe_key`` a row is left out if its key is in the table already, and
    equal keys in ``df`` give one row. Rows without a key are always kept. ``by_name``
    matches columns by name instead.

    A few keys are sent to where the table is read. More are joined with all keys of the
    table, which shuffle, unless the table has an index of that key (`build_key_index`): then
    only ``df`` moves, and its new keys go into the index after the table.
    """
    spark = df.sparkSession
    known = scan_table(spark, table)
    if by_name:
        df = df.select(*known.columns)
    if dedupe_key is None:
        _signed(df, table, BATCH, 0).write.insertInto(table)
        return
    if not has_index(spark, table, dedupe_key):
        _signed(_new_keys(df, known, dedupe_key), table, BATCH, 0).write.insertInto(table)
        return
    single, without = _single(df, dedupe_key)
    fresh = not_in_index(single, table, dedupe_key).unionByName(without)
    fresh.persist(StorageLevel.DISK_ONLY)  # once in the table, its keys are known
    try:
        _signed(fresh, table, BATCH, 0).write.insertInto(table)
        add_keys(fresh, table, dedupe_key)
    finally:
        fresh.unpersist()


def _signed(df: DataFrame, table: str, writer: str, number: int) -> DataFrame:
    if not is_committed(df.sparkSession.table(table)):
        return df
    return df.select("*", F.lit(writer), F.lit(number).cast("bigint"))


def _replace(df: DataFrame, table: str) -> None:
    """Write ``df`` in the place of the partitions that it has rows of."""
    conf = df.sparkSession.conf
    before = conf.get(_DYNAMIC)
    conf.set(_DYNAMIC, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        conf.set(_DYNAMIC, before)


def _single(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """One row for each key, and the rows without one.

    ``df`` shrinks to one row per key on the map side before any join, and rows without a key
    stay out of it, so no key can weigh down one join task.
    """
    row = F.struct(*df.columns)
    single = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("row"))
    return single.select("row.*"), df.filter(F.col(key).isNull())


def _new_keys(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    single, without = _single(df, key)
    asked = df.filter(F.col(key).isNotNull()).select(key).distinct()
    size = F.sum(F.octet_length(F.col(key).cast("string")))
    n, bytes_ = asked.limit(_FEW_KEYS + 1).agg(F.count(F.lit(1)), size).first()
    if n <= _FEW_KEYS and (bytes_ or 0) <= _FEW_BYTES:
        asked = F.broadcast(asked)  # the table's keys are then looked up where they are read
    known = table.select(key).join(asked, key, "left_semi").distinct()
    return single.join(known, key, "left_anti").unionByName(without)


def insert_values(spark: SparkSession, table: str, rows: Iterable[tuple]) -> None:
    """Append literal rows."""
    append_table(inline_values(spark, rows, spark.table(table).schema), table)


def table_batches(table: str, dedupe_key: str | None = None) -> BatchSink:
    """A micro-batch sink into a file table, by column name.

    Into a committed table each batch goes once, however often it is tried. Into another one
    a retry appends again, unless ``dedupe_key`` names a unique column.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, me = batch.sparkSession, writer_id(batch)
        spark.catalog.refreshTable(quoted(table))  # others append meanwhile
        whole = spark.table(table)
        if not is_committed(whole):
            append_table(batch, table, dedupe_key, by_name=True)
            return
        rows = batch.select(*whole.columns[:-2])
        if dedupe_key is not None:
            by, at = (F.col(c) for c in COMMITS)
            # what an earlier try of this batch wrote is no reason to leave a row out
            others = whole.filter(~((by == me) & (at == batch_id)))
            rows = _new_keys(rows, others.drop(*COMMITS), dedupe_key)
        _replace(_signed(rows, table, me, batch_id), table)

    return write


def stream_to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    *,
    dedupe_key: str | None = None,
    sole_writer: bool = False,
) -> StreamingQuery:
    """Insert a stream into a table by column name.

    Iceberg and other transactional tables, and committed file tables, get each row exactly
    once. In other tables of plain files Spark's own stream sink would hide the rows that
    others append, so there each micro-batch is appended like a batch: at least once, since a
    retry appends again unless ``dedupe_key`` names a unique column. ``sole_writer`` takes
    Spark's sink, exactly once, for a file table that nothing else ever writes.
    """
    if sole_writer or not is_file_table(df.sparkSession, table):
        return start(df.writeStream, checkpoint, trigger, table=table)
    return write_each_batch(df, table_batches(table, dedupe_key), checkpoint, trigger)


def fold_batches(spark: SparkSession, table: str) -> None:
    """Put the older micro-batches of each stream of a committed table into one partition.

    The newest of a stream stays apart, as it may be tried again. Rows are written first and
    the old partitions dropped then; where that stops half-way, `scan_table` passes over the
    old ones and the next fold drops them. Streams may run meanwhile, another fold may not.
    """
    spark.catalog.refreshTable(quoted(table))
    whole = spark.table(table)
    by, at = (F.col(c) for c in COMMITS)
    for writer, numbers in commits(spark, table).items():
        last = folded_to(numbers)
        fresh = sorted(n for n in numbers if n > last)[:-1]
        if writer == BATCH:
            continue
        if fresh:
            taken = [*fresh, *([-last - 1] if last >= 0 else [])]
            rows = whole.filter((by == writer) & at.isin(taken)).drop(*COMMITS).hint("rebalance")
            last = fresh[-1]
            _replace(_signed(rows, table, writer, -last - 1), table)
        for n in sorted(n for n in numbers if 0 <= n <= last or -1 >= n > -last - 1):
            _drop_partition(spark, table, writer, n)
    spark.catalog.refreshTable(quoted(table))


def _drop_partition(spark: SparkSession, table: str, writer: str, number: int) -> None:
    spec = f"{COMMITS[0]}='{writer}', {COMMITS[1]}={number}"
    spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS PARTITION ({spec})")
    # the files of a table with a location of its own stay; nothing lists them any more
    home = table_fact(spark, table, "Location")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/{COMMITS[0]}={writer}/{COMMITS[1]}={number}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_file_table(spark: SparkSession, table: str) -> bool:
    return table_fact(spark, table, "Provider").lower() in _FILE_TABLES

