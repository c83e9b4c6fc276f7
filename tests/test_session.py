import pytest

from tillflow.session import engine_config, scratch_dir, session_config


def test_catalog_and_store():
    conf = session_config(
        {"name": "lake", "uri": "http://c/api", "warehouse": "s3a://b/w"},
        {"endpoint": "http://s"},
    )
    assert conf["spark.sql.catalog.lake"] == "org.apache.iceberg.spark.SparkCatalog"
    assert conf["spark.sql.catalog.lake.ref"] == "main"
    assert conf["spark.sql.catalog.lake.warehouse"] == "s3a://b/w"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://s"
    assert not any("key" in k for k in conf)


def test_keys_only_when_given():
    store = {"endpoint": "http://s", "access_key": "a", "secret_key": "b"}
    conf = session_config(store=store)
    assert conf["spark.hadoop.fs.s3a.secret.key"] == "b"
    assert session_config() == {}


def test_engine_settings():
    assert engine_config()["spark.sql.adaptive.enabled"] == "true"
    assert "spark.sql.shuffle.partitions" not in engine_config()
    assert engine_config(400)["spark.sql.shuffle.partitions"] == "400"


class FakeConf:
    def __init__(self, **kv):
        self.kv = {k.replace("_", "."): v for k, v in kv.items()}

    def get(self, key, default=None):
        return self.kv.get(key, default)


class FakeSession:
    def __init__(self, **kv):
        self.conf = FakeConf(**kv)


def test_scratch_is_shared_on_a_cluster():
    shared = FakeSession(spark_master="yarn", spark_checkpoint_dir="hdfs:///tmp/c/")
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs:///tmp/c/x-") and first != second
    with pytest.raises(ValueError):
        scratch_dir(FakeSession(spark_master="yarn"), "x")
    assert scratch_dir(FakeSession(spark_master="local[2]"), "x")
