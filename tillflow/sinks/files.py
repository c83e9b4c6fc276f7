"""CSV and Parquet writers, and the check that what was written can be read."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.formats import EXACT_TIMESTAMPS
from tillflow.sources.files import path_has_data


def write_parquet(
    df: DataFrame,
    path: str,
    snapshot: str | int | None = None,
    n_files: int | None = None,
    *,
    compact: bool = False,
    partition_by: Sequence[str] = (),
) -> str:
    """Overwrite a Parquet folder and return its path.

    ``snapshot`` names a new folder under ``path`` for this run. By default the
    files follow the partitions of ``df``, without a shuffle. ``compact`` lets AQE
    merge or split them to its advisory size; ``n_files`` fixes their number.
    """
    out = path if snapshot is None else f"{path.rstrip('/')}/output_{snapshot}.parquet"
    if n_files is not None:
        df = df.repartition(n_files)
    elif compact:
        df = df.hint("rebalance")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)
    return out


def write_csv(df: DataFrame, path: str) -> str:
    """Overwrite a CSV folder; each file has a header."""
    df.write.mode("overwrite").options(**EXACT_TIMESTAMPS).csv(path, header=True)
    return path


def write_csv_if_absent(df: DataFrame, path: str) -> bool:
    """Write only where no CSV can be read yet; says whether it wrote."""
    if path_has_data(df.sparkSession, path):
        return False
    write_csv(df, path)
    return True


def counted(df: DataFrame, write: Callable[[DataFrame], object]) -> int:
    """Run ``write`` on ``df`` and return the rows it wrote, counted in the same pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def fingerprint(df: DataFrame) -> list[Column]:
    """Aggregates ``n, content, more_content`` that tell the rows of ``df``, in any order.

    Sums of two 64-bit hashes of whole rows: a row that changes, goes or comes twice changes
    them. Equal tables have equal sums; different ones have with a chance of about 2**-126.
    """
    cells = [_hashable(F.col(_quoted(f.name)), f.dataType) for f in df.schema]

    def total(*more: Column) -> Column:
        return F.coalesce(F.sum(F.xxhash64(*more, *cells).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))

    return [
        F.count(F.lit(1)).alias("n"),
        total(F.lit(0)).alias("content"),
        total(F.lit("again")).alias("more_content"),
    ]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _hashable(col: Column, kind: T.DataType) -> Column:
    """``col`` without maps, whose order is not theirs and which no hash takes."""
    if isinstance(kind, T.MapType):
        entries = F.map_entries(col)
        pairs = T.StructType().add("key", kind.keyType).add("value", kind.valueType)
        return F.array_sort(_hashable(entries, T.ArrayType(pairs)), lambda a, b: _by_key(a, b))
    if isinstance(kind, T.ArrayType) and _has_map(kind):
        return F.transform(col, lambda x: _hashable(x, kind.elementType))
    if isinstance(kind, T.StructType) and _has_map(kind):
        inner = F.struct(*[_hashable(col.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(col.isNotNull(), inner)
    return col


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def readback_check(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to Parquet and read it back.

    One row ``rows_written, rows_read, schema_equal, content_equal``. The rows are counted and
    told by `fingerprint` while they are written, so ``df`` is computed once, and again as they
    are read.
    """
    seen = Observation()
    write_parquet(df.observe(seen, *fingerprint(df)), path)
    back = spark.read.parquet(path)
    same = [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    written = seen.get
    told = F.lit(same)
    for name in ("n", "content", "more_content"):
        told &= F.col(name) == F.lit(written[name])
    return back.agg(*fingerprint(back)).select(
        F.lit(written["n"]).cast("bigint").alias("rows_written"),
        F.col("n").alias("rows_read"),
        F.lit(same).alias("schema_equal"),
        told.alias("content_equal"),
    )
