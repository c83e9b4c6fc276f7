"""One pass over a stream for several sinks."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from __spark_entry__ import forget_commit
from tests.test_streams import NOW, SCHEMA, drop_file, some_sales, source
from tillflow.sources.topics import read_topic
from tillflow.streaming.routes import (
    Route,
    copied,
    fan_out_routed,
    routed_batches,
    routed_rows,
    routed_topic,
    rows_route,
    topic_route,
)


def routes_of(df):
    return {
        "all": rows_route(df),
        "hot": Route({"at": F.col("at"), "double": F.col("value") * 2}, F.col("key") == "hot"),
        "topic": topic_route("t", F.to_json(F.struct("key", "at")), F.col("at")),
    }


def test_every_sink_gets_its_rows_once(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    everything = []
    for step in range(3):
        rows = some_sales(30, start=step * 30)
        everything += rows
        drop_file(spark, folder, rows)
    df = source(spark, folder)
    routes = routes_of(df)
    for _ in range(2):  # the second start tries the last batch again
        query = fan_out_routed(df, routes, out, checkpoint, NOW)
        query.awaitTermination()
        assert all(p["numInputRows"] in (0, 30) for p in query.recentProgress)
        whole = routed_rows(spark, out, "all", routes["all"])
        assert sorted(map(tuple, whole.collect()), key=str) == sorted(everything, key=str)
        hot = routed_rows(spark, out, "hot", routes["hot"])
        assert hot.columns == ["at", "double"]
        assert sorted(map(tuple, hot.collect())) == sorted((a, 2 * v) for k, a, v in everything if k == "hot")
        messages = read_topic(spark, routed_topic("t", out, "topic"))
        assert messages.count() == 90
        assert messages.select("partition", "offset").distinct().count() == 90
        assert {int(bytes(r.key)) for r in messages.collect()} == {a for _, a, _ in everything}
        forget_commit(spark, checkpoint)


def test_one_scan_for_all_sinks(spark, tmp_path):
    df = spark.createDataFrame(some_sales(10), SCHEMA)
    df.write.parquet(str(tmp_path / "in"))
    back = spark.read.parquet(str(tmp_path / "in"))
    routes = {n: r for n, r in routes_of(back).items() if n != "topic"}
    plan = copied(back, routes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_folder_belongs_to_one_stream(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    drop_file(spark, folder, some_sales(5))
    df = source(spark, folder)
    routes = {"all": rows_route(df)}
    fan_out_routed(df, routes, out, str(tmp_path / "a"), NOW).awaitTermination()
    with pytest.raises(StreamingQueryException, match="another stream"):
        fan_out_routed(df, routes, out, str(tmp_path / "b"), NOW).awaitTermination()


def test_columns_of_one_name(spark):
    df = spark.createDataFrame(some_sales(3), SCHEMA)
    both = copied(df, {"a": rows_route(df), "b": Route({"at": F.col("key")})})
    assert both.columns == ["sink", "key", "at", "value", "at__b"] and both.count() == 6
    with pytest.raises(ValueError, match="sink"):
        copied(df, {"a": Route({"sink": F.col("key")})})
    with pytest.raises(ValueError, match="64 bits"):
        routed_batches({"a": rows_route(df)}, "nowhere")(df, 1 << 40)
