"""CSV and Parquet files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.formats import EXACT_TIMESTAMPS
from tillflow.schemas import SALE_CSV


def read_csv_typed(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = SALE_CSV, sep: str = ","
) -> DataFrame:
    """CSV with a header and declared types. A bad field is NULL, a short row ends in NULLs.

    Several paths are read side by side; each file has its header.
    """
    path = path if isinstance(path, str) else list(path)
    return spark.read.schema(schema).options(**EXACT_TIMESTAMPS).csv(path, header=True, sep=sep)


def read_csv_raw(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """CSV with a header, every column text, empty fields NULL."""
    path = path if isinstance(path, str) else list(path)
    return spark.read.csv(path, header=True, sep=sep)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _listed(spark: SparkSession, directory: str, glob: str, recursive: bool) -> DataFrame:
    """``path, modificationTime, length`` of the files of a folder; contents are not read."""
    # Tasks are cut by file size, which says nothing here: pack the files by core instead.
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionBytes", "1t")
    return (
        listing.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(directory)
        .select("path", "modificationTime", "length")
    )


def latest_file(
    spark: SparkSession, directory: str, glob: str = "*.csv", recursive: bool = True
) -> DataFrame:
    """One row ``path, modificationTime, length``: the newest file, ties by path.

    Only the listing is read, never the contents. Raises if nothing matches.
    """
    found = _listed(spark, directory, glob, recursive)
    newest = found.orderBy(F.desc("modificationTime"), "path").first()
    if newest is None:
        raise FileNotFoundError(f"no {glob} under {directory}")
    return spark.createDataFrame([newest], found.schema)


@dataclass(frozen=True)
class Drop:
    """Files that were delivered together: their folder, or the file itself if it came alone."""

    path: str
    files: tuple[str, ...]


def latest_drop(
    spark: SparkSession,
    directory: str,
    glob: str = "*.csv",
    *,
    marker: str = "_SUCCESS",
    manifest: str | None = None,
    loose: bool = True,
) -> Drop:
    """The newest complete drop under ``directory``.

    A folder that holds ``marker`` is a drop of all its matching files; the writer leaves the
    marker when it is done. With ``manifest`` a folder is a drop of the files that a file of
    this name lists, a name a line, and complete when all of them are there. A folder that has
    neither is still being written, unless ``loose``: then each file in a folder where nothing
    has ever announced a drop (``directory`` itself) is a drop by itself, as `latest_file` has it.

    The newest is the folder whose youngest file is youngest, ties by path. The listing runs
    as a Spark job and comes to the driver a folder at a time, newest first, until one is
    complete; then the names of its files do.
    """
    found = _listed(spark, directory, glob, True)
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    home = spark._jvm.org.apache.hadoop.fs.Path(directory)
    store = home.getFileSystem(spark._jsc.hadoopConfiguration())
    root = store.makeQualified(home).toString().rstrip("/")
    named = found.withColumn("folder", folder)
    # a file that lies in the directory itself is a group of its own
    group = F.when(F.regexp_replace("folder", "^([a-z0-9]+):/+", "$1:/") == _slashed(root), F.col("path")).otherwise(F.col("folder"))
    groups = named.groupBy(group.alias("drop"), "folder").agg(F.max("modificationTime").alias("at"))
    for row in groups.orderBy(F.desc("at"), "drop").toLocalIterator():
        if row["drop"] != row.folder:
            if loose:
                return Drop(row["drop"], (row["drop"],))
            continue
        files = named.filter(F.col("folder") == row.folder).select("path")
        announced = _announced(spark, store, row.folder, marker, manifest)
        if announced is None:
            continue
        paths = sorted(r.path for r in files.toLocalIterator())
        if announced:
            wanted = {f"{row.folder}/{name}" for name in announced}
            if not wanted <= set(paths):
                continue
            paths = sorted(wanted)
        return Drop(row.folder, tuple(paths))
    raise FileNotFoundError(f"no complete drop of {glob} under {directory}")


def _slashed(uri: str) -> str:
    scheme, _, rest = uri.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if rest else uri


def _announced(spark: SparkSession, store, folder: str, marker: str, manifest: str | None) -> list[str] | None:
    """The names a manifest lists, an empty list for a marker, None for neither."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    if manifest is None:
        return [] if store.exists(path(folder, marker)) else None
    if not store.exists(path(folder, manifest)):
        return None

    def lines() -> Iterator[str]:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(store.open(path(folder, manifest)), "UTF-8"))
        try:
            while (line := reader.readLine()) is not None:
                yield line.strip()
        finally:
            reader.close()

    return [line for line in lines() if line] or None


def path_has_data(spark: SparkSession, path: str) -> bool:
    """Whether a CSV header can be read. A missing path and an empty folder both say no."""
    try:
        spark.read.csv(path, header=True)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
