"""Streams into file tables: retried batches, folds that stop half-way, rejects counted on the way."""

import time

import pytest
from pyspark.errors import StreamingQueryException

from __spark_entry__ import forget_commit
from tests.test_parsing import text
from tests.test_streams import NOW, messages_topic
from tillflow.plans.streams import stream_topic_to_table
from tillflow.schemas import SALE_TABLE, TEST_TABLE
from tillflow.sinks import tables as sinks
from tillflow.sources.tables import commits, create_table, scan_table
from tillflow.streaming.batches import parquet_batches, write_each_batch

ROWS = "id bigint, data string"


def new_table(spark, tmp_path, schema=TEST_TABLE, committed=True):
    name = f"t_{abs(hash(str(tmp_path)))}"
    create_table(spark, name, schema, location=str(tmp_path / "table"), committed=committed)
    return name


def drop(spark, folder, ids):
    rows = spark.createDataFrame([(i, f"d{i}") for i in ids], ROWS)
    rows.coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(folder)


def ids(spark, name):
    return sorted(r.id for r in scan_table(spark, name).collect())


@pytest.mark.parametrize("key", [None, "id"])
def test_a_retried_batch_adds_nothing(spark, tmp_path, key):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "ckpt")
    name = new_table(spark, tmp_path)
    for step in range(3):
        drop(spark, folder, range(step * 5, step * 5 + 5))
    insert = sinks.table_batches(name, key)

    def lost(batch, batch_id):
        insert(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after the write")

    with pytest.raises(StreamingQueryException):
        write_each_batch(source(spark, folder), lost, checkpoint, NOW).awaitTermination()
    assert ids(spark, name) == list(range(10))
    sinks.append_table(spark.createDataFrame([(99, "x")], ROWS), name)
    for _ in range(2):
        query = sinks.stream_to_table(source(spark, folder), name, checkpoint, NOW, dedupe_key=key)
        query.awaitTermination()
        assert ids(spark, name) == [*range(15), 99]
        forget_commit(spark, checkpoint)
    assert scan_table(spark, name).columns == ["id", "data"]


def test_two_streams_and_the_same_batch_numbers(spark, tmp_path):
    folder, name = str(tmp_path / "in"), new_table(spark, tmp_path)
    drop(spark, folder, range(5))
    for step in range(2):
        sinks.stream_to_table(
            source(spark, folder), name, str(tmp_path / f"c{step}"), NOW
        ).awaitTermination()
    assert ids(spark, name) == sorted([*range(5)] * 2)


def test_folds(spark, tmp_path, monkeypatch):
    """Rows stay the same through folds, one of which stops between writing and dropping."""
    folder, checkpoint, name = str(tmp_path / "in"), str(tmp_path / "ckpt"), new_table(spark, tmp_path)

    def go(first, n):
        for i in range(first, first + n):
            drop(spark, folder, [2 * i, 2 * i + 1])
        sinks.stream_to_table(source(spark, folder), name, checkpoint, NOW).awaitTermination()

    def numbers():
        (found,) = (v for k, v in commits(spark, name).items() if k != "batch")
        return sorted(found)

    go(0, 4)
    sinks.fold_batches(spark, name)
    assert numbers() == [-3, 3] and ids(spark, name) == list(range(8))
    go(4, 3)
    with monkeypatch.context() as m:
        m.setattr(sinks, "_drop_partition", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.fold_batches(spark, name)
    assert numbers() == [-6, -3, 3, 4, 5, 6] and ids(spark, name) == list(range(14))
    forget_commit(spark, checkpoint)
    go(7, 1)
    sinks.fold_batches(spark, name)
    sinks.fold_batches(spark, name)
    assert numbers() == [-7, 7] and ids(spark, name) == list(range(16))


def test_a_plain_table_takes_a_batch_twice(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "ckpt")
    name = new_table(spark, tmp_path, committed=False)
    drop(spark, folder, range(3))
    for want in (3, 6):
        sinks.stream_to_table(source(spark, folder), name, checkpoint, NOW).awaitTermination()
        assert len(ids(spark, name)) == want
        forget_commit(spark, checkpoint)


@pytest.mark.parametrize("way", ["in the batch", "deduped", "with the progress"])
def test_rejects_are_counted_while_the_rows_pass(spark, tmp_path, way):
    bad = [text(IDVente="1", Total="much"), text(IDVente="2", **{"Quantité": "x"}), text(IDVente="3")]
    src = messages_topic(spark, tmp_path, [bad, [text(IDVente="4", Total="no"), "junk"]])
    own = way == "with the progress"
    name = new_table(spark, tmp_path, SALE_TABLE, committed=not own)
    query = stream_topic_to_table(
        spark, src, name, str(tmp_path / "ckpt"), trigger=NOW, max_per_trigger=1, sole_writer=own,
        dedupe_key="id" if way == "deduped" else None, rejects=parquet_batches(str(tmp_path / "lost")),
    )
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [3, 2]
    for _ in range(50):  # progress is reported on a thread of its own
        if not own or len(list((tmp_path / "lost").glob("batch_id=*/_SUCCESS"))) == 2:
            break
        time.sleep(0.2)
    lost = spark.read.parquet(str(tmp_path / "lost")).select("batch_id", "total", "quantite")
    assert sorted(map(tuple, lost.collect())) == [(0, 1, 1), (1, 1, 0)]
    assert ids(spark, name) == [1, 2, 3, 4]
