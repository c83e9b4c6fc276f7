import json
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tillflow.operators.projections import envelope_view
from tillflow.schemas import ENVELOPE
from tillflow.sinks import topics as sink_topics
from tillflow.sinks.topics import kafka_write_options, topic_batches, write_topic
from tillflow.sources.topics import Topic, kafka_read_options, next_ranges, read_topic

KAFKA = Topic.kafka("sales_in", "broker:9092")


def test_kafka_options():
    assert kafka_read_options(KAFKA, streaming=True, fail_on_data_loss=False) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "sales_in",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    batch = kafka_read_options(KAFKA, streaming=False, rows_per_task=1000000)
    assert batch["endingOffsets"] == "latest"
    assert batch["failOnDataLoss"] == "true"
    assert batch["maxRecordsPerPartition"] == "1000000"
    stream = kafka_read_options(KAFKA, streaming=True, max_per_trigger=500, group_id="g")
    assert stream["maxOffsetsPerTrigger"] == "500"
    assert stream["kafka.group.id"] == "g"
    assert kafka_write_options(KAFKA) == {
        "kafka.bootstrap.servers": "broker:9092",
        "topic": "sales_in",
    }


@pytest.fixture
def topic(tmp_path):
    return Topic.files("t", str(tmp_path / uuid.uuid4().hex))


def test_envelope_of_a_folder_topic(spark, topic):
    rows = spark.range(0, 30, 1, 3).selectExpr("CAST(id AS STRING) AS key", "'v' AS value")
    write_topic(rows, topic)
    got = read_topic(spark, topic)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in ENVELOPE]
    by_partition = got.groupBy("partition").agg(F.sort_array(F.collect_list("offset")).alias("o"))
    assert {r.partition: r.o for r in by_partition.collect()} == {
        p: list(range(10)) for p in range(3)
    }
    text = envelope_view(got).first()
    assert text.value == "v" and text.topic == "t"


def test_appends_go_on_after_the_last_offset(spark, topic):
    for _ in range(3):
        write_topic(spark.range(0, 10, 1, 2).selectExpr("'é' AS value"), topic)
    places = read_topic(spark, topic).select("partition", "offset")
    assert places.count() == 30 and places.distinct().count() == 30
    assert places.agg(F.max("offset")).first()[0] == 14


def test_retried_batch_replaces_itself(spark, topic):
    send = topic_batches(topic)
    rows = spark.range(0, 10, 1, 2).selectExpr("CAST(id AS STRING) AS value")
    send(rows, 0)
    send(rows, 1)
    send(rows, 1)
    got = read_topic(spark, topic)
    assert got.count() == 20
    assert got.select("partition", "offset").distinct().count() == 20
    assert got.agg(F.max("offset")).first()[0] == (1 << 33) + 4


def test_late_batches_keep_their_own_offsets(spark, topic):
    rows = spark.range(0, 10, 1, 2).selectExpr("CAST(id AS STRING) AS value")
    send = topic_batches(topic)
    for batch in (0, 1 << 23, 1 << 24, (1 << 30) - 1):
        send(rows, batch)
    places = read_topic(spark, topic).select("partition", "offset")
    assert places.distinct().count() == 40 and places.filter("offset < 0").count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        send(rows, 1 << 30)


def test_kafka_ranges():
    options = kafka_read_options(KAFKA, streaming=False, ranges={1: (None, 50), 0: (7, None), 2: (0, 0)})
    assert "subscribe" not in options
    assert json.loads(options["assign"]) == {"sales_in": [0, 1, 2]}
    assert json.loads(options["startingOffsets"]) == {"sales_in": {"0": 7, "1": -2, "2": 0}}
    assert json.loads(options["endingOffsets"]) == {"sales_in": {"0": -1, "1": 50, "2": 0}}
    assert "endingOffsets" not in kafka_read_options(KAFKA, streaming=True, ranges={0: (3, None)})


@pytest.mark.parametrize("ranges", [{}, {0: (5, 4)}, {0: (-3, None)}, {1: (None, -1)}])
def test_ranges_that_are_none(ranges):
    with pytest.raises(ValueError):
        kafka_read_options(KAFKA, streaming=False, ranges=ranges)


def test_ranges_of_a_folder_topic(spark, topic):
    for step in range(3):
        rows = spark.range(step * 40, step * 40 + 40, 1, 4).selectExpr("CAST(id AS STRING) AS value")
        write_topic(rows, topic)
    everything = {(r.partition, r.offset): bytes(r.value) for r in read_topic(spark, topic).collect()}
    ranges = {0: (2, 12), 1: (None, 5), 2: (11, None), 3: (2, 12)}
    part = read_topic(spark, topic, ranges=ranges)
    inside = lambda p, o: (ranges[p][0] or 0) <= o < (ranges[p][1] or 10**9)
    assert {(r.partition, r.offset): bytes(r.value) for r in part.collect()} == {
        k: v for k, v in everything.items() if inside(*k)
    }
    plan = part._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    assert "LessThan(offset" in pushed and "GreaterThanOrEqual(offset" in pushed


def test_a_read_goes_on_where_one_ended(spark, topic):
    write_topic(spark.range(0, 20, 1, 2).selectExpr("CAST(id AS STRING) AS value"), topic)
    first = read_topic(spark, topic)
    ends = next_ranges(first)
    assert ends == {0: (10, None), 1: (10, None)}
    first = [bytes(r.value) for r in first.collect()]
    write_topic(spark.range(20, 50, 1, 2).selectExpr("CAST(id AS STRING) AS value"), topic)
    rest = [bytes(r.value) for r in read_topic(spark, topic, ranges=ends).collect()]
    assert sorted(first + rest, key=int) == [str(i).encode() for i in range(50)]


def test_streams_of_like_names_take_different_ranges(spark, topic, monkeypatch):
    """Names whose hashes meet: no (partition, offset) is given twice, and a stream keeps its range."""
    monkeypatch.setattr(sink_topics, "first_partition", lambda _: 5 << sink_topics.TASK_BITS)
    taken = []
    for turn in range(2):
        for name in ("one", "two", "three"):
            monkeypatch.setattr(sink_topics, "writer_id", lambda _, name=name: name)
            rows = spark.range(0, 20, 1, 2).selectExpr("CAST(id AS STRING) AS value")
            topic_batches(topic)(rows, turn)
            taken.append(sink_topics._own_range(spark, topic, name) >> sink_topics.TASK_BITS)
    assert taken == [5, 6, 7] * 2
    messages = read_topic(spark, topic)
    assert messages.count() == messages.select("partition", "offset").distinct().count() == 120


def test_one_file_of_a_topic_is_split_over_tasks(spark, tmp_path):
    topic = Topic.files("t", str(tmp_path / "t"))
    several = F.concat(*[F.sha2(F.concat_ws("-", "id", F.lit(i)), 512) for i in range(4)])
    texts = spark.range(40_000, numPartitions=1).select(several.alias("value"))
    write_topic(texts, topic)
    topic_batches(topic)(texts, 0)
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert [pq.ParquetFile(f).metadata.num_row_groups > 1 for f in files] == [True, True]
    assert read_topic(spark, topic).count() == 80_000


def test_envelope_view_gives_every_place(spark, tmp_path):
    rows = [(i, f"p{i}") for i in range(20)] + [(19, "p0"), (None, "none")]
    spark.createDataFrame(rows, "event_id long, props string").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    got = queries()["envelope_view"](spark, str(tmp_path)).collect()
    parts = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r)):
        parts.setdefault((i or 0) % 8, []).append((i, text))
    want = [(None if i is None else str(i), text, p, at) for p, held in parts.items() for at, (i, text) in enumerate(held)]
    order = lambda r: (str(r[0]), *r[1:])
    assert sorted(((x.key, x.value, x.partition, x.offset) for x in got), key=order) == sorted(want, key=order)
    assert all(x.gapless and x.topic == "sales_in" for x in got)
