"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def engine_config(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Spark settings the operators are planned for.

    AQE sizes batch shuffles at run time. A stream keeps the shuffle width of its
    first start, so choose ``shuffle_partitions`` before that.
    """
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def session_config(
    catalog: dict[str, str] | None = None, store: dict[str, str] | None = None
) -> dict[str, str]:
    """Settings of an Iceberg catalog kept by Nessie and of an S3-compatible store.

    ``catalog``: ``name``, ``uri``, ``warehouse`` and optionally ``ref``.
    ``store``: ``endpoint`` and optionally ``access_key`` with ``secret_key``;
    without keys the Hadoop credential chain (environment, instance role) applies.
    """
    conf: dict[str, str] = {}
    if catalog:
        prefix = f"spark.sql.catalog.{catalog['name']}"
        conf |= {
            "spark.sql.extensions": (
                "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions,"
                "org.projectnessie.spark.extensions.NessieSparkSessionExtensions"
            ),
            prefix: "org.apache.iceberg.spark.SparkCatalog",
            f"{prefix}.catalog-impl": "org.apache.iceberg.nessie.NessieCatalog",
            f"{prefix}.uri": catalog["uri"],
            f"{prefix}.ref": catalog.get("ref", "main"),
            f"{prefix}.warehouse": catalog["warehouse"],
        }
    if store:
        conf |= {
            "spark.hadoop.fs.s3a.endpoint": store["endpoint"],
            "spark.hadoop.fs.s3a.path.style.access": "true",
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        }
        if "access_key" in store:
            conf |= {
                "spark.hadoop.fs.s3a.access.key": store["access_key"],
                "spark.hadoop.fs.s3a.secret.key": store["secret_key"],
            }
    return conf


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which every executor can reach.

    Only a session known to be local may go without that setting; it gets a temporary
    folder. What is written there is deleted when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "unknown")
        if master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillflow-")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = getattr(spark, "_jvm", None)  # a remote client has none, and leaves the folder
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path
