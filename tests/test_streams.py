import random
import shutil
import time
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from __spark_entry__ import forget_commit
from tests.test_parsing import STRICT, text
from tillflow.operators.aggregates import group_stats
from tillflow.operators.parsing import parse_sale_strict, render_json, split_parsed
from tillflow.operators.running import running_stats
from tillflow.plans.streams import echo_topic, live_sales_metrics, relay_topic
from tillflow.sinks.topics import topic_batches, write_topic
from tillflow.sources.topics import Topic, read_topic, stream_topic
from tillflow.streaming.batches import (
    fan_out,
    latest_per_key,
    parquet_batches,
    write_each_batch,
)
from tillflow.streaming import running
from tillflow.streaming.running import RunningTotals, each_batch_of_rows, running_stats_stream

NOW = {"availableNow": True}
MONEY = "decimal(18,2)"
SCHEMA = "key string, at bigint, value decimal(18,2)"


def some_sales(n, start=0):
    rng = random.Random(start)
    return [
        (rng.choice(["hot", "hot", None, f"k{rng.randrange(9)}"]), start + i,
         Decimal(rng.randrange(50000)) / 100)
        for i in range(n)
    ]


def drop_file(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_running_stream_equals_batch_over_restarts(spark, tmp_path):
    folder, out, root = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    everything = []
    for step in range(4):
        rows = some_sales(60, start=step * 60)
        everything += rows
        drop_file(spark, folder, rows)
        if step in (0, 3):  # the last start finds two new files and takes two batches
            running_stats_stream(
                source(spark, folder), "key", "value", "at", out, root,
                sum_type=MONEY, trigger=NOW,
            ).awaitTermination()
    got = spark.read.parquet(out)
    assert [r.batch_id for r in got.select("batch_id").distinct().orderBy("batch_id").collect()] \
        == [0, 1, 2, 3]
    want = running_stats(
        spark.createDataFrame(everything, SCHEMA), "key", "value", "at", sum_type=MONEY
    )
    cols = ["key", "at", "n", F.col("total").cast("double"), "mean"]
    assert rows_of(got.select(*cols)) == rows_of(want.select(*cols))


def test_running_stream_in_a_session_with_sparks_default_state_store(spark, tmp_path):
    folder, out, root = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    provider = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain = spark.newSession()
    plain.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    everything = []
    for step in range(2):
        rows = some_sales(40, start=step * 40)
        everything += rows
        drop_file(spark, folder, rows)
        running_stats_stream(
            source(plain, folder), "key", "value", "at", out, root, sum_type=MONEY, trigger=NOW
        ).awaitTermination()
    assert plain.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    want = running_stats(spark.createDataFrame(everything, SCHEMA), "key", "value", "at", sum_type=MONEY)
    cols = ["key", "at", "n", F.col("total").cast("double"), "mean"]
    assert rows_of(spark.read.parquet(out).select(*cols)) == rows_of(want.select(*cols))


def test_running_stream_retries_a_failed_batch(spark, tmp_path):
    """The sink fails after writing; the state of that batch is not kept and the batch comes again."""
    folder, out, root = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rows = [some_sales(40, start=s * 40) for s in range(3)]
    keep = parquet_batches(out)

    def once(lost_at=None):
        def sink(batch, batch_id):
            keep(batch, batch_id)
            if batch_id == lost_at:
                raise RuntimeError("lost")

        totals = RunningTotals(source(spark, folder), "key", "value", "at", sum_type=MONEY)
        each_batch_of_rows(totals, sink, root, NOW).awaitTermination()

    for r in rows[:2]:
        drop_file(spark, folder, r)
    with pytest.raises(StreamingQueryException):
        once(lost_at=1)
    drop_file(spark, folder, rows[2])
    once()
    forget_commit(spark, root)
    once()
    want = running_stats(
        spark.createDataFrame(sum(rows, []), SCHEMA), "key", "value", "at", sum_type=MONEY
    )
    cols = ["key", "at", "n", F.col("total").cast("double")]
    assert rows_of(spark.read.parquet(out).select(*cols)) == rows_of(want.select(*cols))


@pytest.mark.parametrize("block", [1 << 20, 1])
def test_running_stream_in_blocks_and_packs(spark, tmp_path, monkeypatch, block):
    """Keys of several columns, orders of several columns, nulls, files whose blocks overlap."""
    monkeypatch.setattr(running, "_PACK", 16)
    schema = "by string, key string, part int, at bigint, value decimal(18,2), total string"
    rng = random.Random(block)
    rows = [
        (rng.choice("ab"), rng.choice(["hot", "hot", None, "", "~"]), rng.choice([0, 1, None]), i,
         rng.choice([None, Decimal(rng.randrange(9000)) / 100]), "x")
        for i in range(160)
    ]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for step in range(2):  # two batches of two files each, with every second row
        for half in range(2):
            part = [r for r in rows if r[3] // 80 == step and r[3] % 2 == half]
            drop_file(spark, folder, part, schema)
    rows_in = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(folder)
    running_stats_stream(
        rows_in, ["by", "key"], "value", ["part", "at"], out, str(tmp_path / "ckpt"),
        sum_type=MONEY, trigger=NOW, block=block,
    ).awaitTermination()
    got = spark.read.parquet(out)
    assert got.columns == ["by", "key", "part", "at", "value", "n", "total", "mean", "batch_id"]
    want, state = [], {}
    for r in sorted(rows, key=lambda r: (r[3] // 80, r[2] is not None, r[2] or 0, r[3])):
        total, n = state.get(r[:2], (None, 0))
        if r[4] is not None:
            total = r[4] + (total or 0)
        state[r[:2]] = (total, n + 1)
        want.append((*r[:4], n + 1, total))
    got = got.select("by", "key", "part", "at", "n", "total").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_idle_keys_are_forgotten(spark, tmp_path):
    """Without ``ttl`` every key is kept; with it the state shrinks and a key starts anew."""
    for ttl, state, last in ((None, [3, 4, 5], 3), ("20 seconds", [3, 1, 3], 1)):
        folder, out, root = (str(tmp_path / f"{n}{ttl}") for n in ("in", "out", "ckpt"))
        kept = []
        for step, keys in enumerate((["a", "b", "c"], ["d"], ["a", "e"])):
            rows = [(k, 10 * step + i, Decimal(1)) for i, k in enumerate(keys)] * (1 + (step == 0))
            drop_file(spark, folder, [(k, at + 5 * (i > 2), v) for i, (k, at, v) in enumerate(rows)])
            query = running_stats_stream(
                source(spark, folder), "key", "value", "at", out, root,
                sum_type=MONEY, trigger=NOW, ttl=ttl,
            )
            query.awaitTermination()
            (progress,) = [p for p in query.recentProgress if p["numInputRows"]]
            kept.append(progress["stateOperators"][0]["numRowsTotal"])
            if ttl and step == 0:
                time.sleep(20)
        got = spark.read.parquet(out).filter("key = 'a' AND at >= 20").first()
        assert (got.n, kept) == (last, state)


def test_the_state_sees_blocks_not_sales(spark, tmp_path):
    folder = str(tmp_path / "in")
    drop_file(spark, folder, [("hot", i, Decimal(1)) for i in range(3000)])
    query = running_stats_stream(
        source(spark, folder), "key", "value", "at", str(tmp_path / "out"), str(tmp_path / "ckpt"),
        sum_type=MONEY, trigger=NOW, block=1000,
    )
    query.awaitTermination()
    counted = {}

    def look(blocks, batch_id):
        counted[batch_id] = blocks.count()

    totals = RunningTotals(source(spark, folder), "key", "value", "at", sum_type=MONEY, block=1000)
    write_each_batch(totals.blocks, look, str(tmp_path / "look"), NOW, "update").awaitTermination()
    assert counted == {0: 3}
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.max("n")).first()[0] == 3000


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path):
    folder, topic = str(tmp_path / "in"), Topic.files("t", str(tmp_path / "t"))
    drop_file(spark, folder, some_sales(10))
    for step in range(2):
        rows = source(spark, folder).selectExpr("CAST(at AS STRING) AS value")
        write_each_batch(rows, topic_batches(topic), str(tmp_path / f"t{step}"), NOW).awaitTermination()
    assert read_topic(spark, topic).count() == 20
    assert read_topic(spark, topic).select("partition", "offset").distinct().count() == 20
    sink = parquet_batches(str(tmp_path / "out"))
    write_each_batch(source(spark, folder), sink, str(tmp_path / "a"), NOW).awaitTermination()
    with pytest.raises(StreamingQueryException, match="another stream"):
        write_each_batch(source(spark, folder), sink, str(tmp_path / "b"), NOW).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_a_number_too_large_for_the_totals_is_a_reject(spark, tmp_path):
    src = messages_topic(spark, tmp_path, [[text(Total="1e300"), text(Total="5.0"), text(**{"Quantité": "4\n"})]])
    names = ["category", "rejects"]
    sinks = {n: parquet_batches(str(tmp_path / n)) for n in names}
    for q in live_sales_metrics(
        stream_topic(spark, src), sinks, str(tmp_path / "ckpt"), trigger=NOW, sum_type=MONEY
    ):
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2
    (line,) = spark.read.parquet(str(tmp_path / "category")).collect()
    assert "1 ventes" in line.message


def test_update_mode_stats_equal_batch(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    everything = []
    for step in range(3):
        rows = some_sales(50, start=step * 50)
        everything += rows
        drop_file(spark, folder, rows)
        stats = group_stats(source(spark, folder), "key", "value", MONEY)
        write_each_batch(
            stats, parquet_batches(out), str(tmp_path / "ckpt"), NOW, "update"
        ).awaitTermination()
    got = latest_per_key(spark.read.parquet(out), "key")
    want = group_stats(spark.createDataFrame(everything, SCHEMA), "key", "value", MONEY)
    assert rows_of(got.select(want.columns)) == rows_of(want)


def messages_topic(spark, tmp_path, batches):
    topic = Topic.files("in", str(tmp_path / "topic"))
    for i, values in enumerate(batches):
        rows = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
        topic_batches(topic)(rows, i)
    return topic


def test_relay_resumes_and_adds_nothing(spark, tmp_path):
    values = [text(IDVente=str(i)) for i in range(5)] + ["junk", ""]
    src = messages_topic(spark, tmp_path, [values, values])
    dst = Topic.files("out", str(tmp_path / "out"))
    for want in (10, 10):
        relay_topic(
            spark, src, dst, str(tmp_path / "ckpt"), trigger=NOW, max_per_trigger=1
        ).awaitTermination()
        assert read_topic(spark, dst).count() == want
    write_topic(spark.createDataFrame([(text(),)], "value string"), src)
    relay_topic(spark, src, dst, str(tmp_path / "ckpt"), trigger=NOW).awaitTermination()
    assert read_topic(spark, dst).count() == 11


def test_relay_survives_a_topic_made_anew(spark, tmp_path):
    src = messages_topic(spark, tmp_path, [[text()]])
    dst = Topic.files("out", str(tmp_path / "out"))
    go = lambda: relay_topic(
        spark, src, dst, str(tmp_path / "ckpt"), trigger=NOW
    ).awaitTermination()
    go()
    shutil.rmtree(src.location)
    write_topic(spark.createDataFrame([(text(),), (text(),)], "value string"), src)
    go()
    assert read_topic(spark, dst).count() == 3


@pytest.mark.parametrize("shared", [False, True])
def test_fan_out(spark, tmp_path, shared):
    folder = str(tmp_path / "in")
    for step in range(2):
        drop_file(spark, folder, some_sales(20, start=step * 20))
    topic = Topic.files("t", str(tmp_path / "t"))
    send = topic_batches(topic)
    sinks = {
        "files": parquet_batches(str(tmp_path / "files")),
        "topic": lambda b, i: send(render_json(b), i),
    }
    for _ in range(2):
        queries = fan_out(source(spark, folder), sinks, str(tmp_path / "ckpt"), shared, NOW)
        assert len(queries) == (1 if shared else 2)
        for q in queries:
            q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "files")).count() == 40
    assert read_topic(spark, topic).count() == 40


def test_echo(spark, tmp_path):
    src = messages_topic(spark, tmp_path, [["a", "", None, "b"]])
    out = str(tmp_path / "echo")
    echo_topic(
        stream_topic(spark, src), parquet_batches(out), str(tmp_path / "ckpt"), NOW
    ).awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_live_metrics_per_record_over_batches(spark, tmp_path):
    sales = [
        [text(IDVente=str(b * 10 + i), Categorie="AB"[i % 2], Total=str(1000.0 + i))
         for i in range(4)] + ["junk"]
        for b in range(2)
    ]
    src = messages_topic(spark, tmp_path, sales)
    names = ["category", "city", "alerts", "events", "sales", "rejects"]
    sinks = {n: parquet_batches(str(tmp_path / n)) for n in names}
    for q in live_sales_metrics(
        stream_topic(spark, src, max_per_trigger=1), sinks, str(tmp_path / "ckpt"),
        per_record=True, trigger=NOW,
    ):
        q.awaitTermination()

    def lines(name):
        df = spark.read.parquet(str(tmp_path / name)).drop("batch_id")
        return sorted(r[0] for r in df.collect())

    per_category = {
        "A": [("1", "1000.00", "1000.00"), ("2", "2002.00", "1001.00"),
              ("3", "3002.00", "1000.67"), ("4", "4004.00", "1001.00")],
        "B": [("1", "1001.00", "1001.00"), ("2", "2004.00", "1002.00"),
              ("3", "3005.00", "1001.67"), ("4", "4008.00", "1002.00")],
    }
    assert lines("category") == sorted(
        f"📊 {c}: {n} ventes, CA: {t}€, Moyenne: {m}€"
        for c, rows in per_category.items() for n, t, m in rows
    )
    assert len(lines("city")) == 8 and "🏙️  Lyon: 8012.00€" in lines("city")
    assert lines("alerts") == sorted(
        f"🚨 GROSSE VENTE! Lampe - {1000.0 + i}€ - Ann" for i in (1, 2, 3) for _ in range(2)
    )
    assert len(lines("events")) == 8 and len(lines("rejects")) == 2
    assert "✅ Vente 13: Lampe - 1003.0€ - Ann" in lines("sales")


def test_strict_parse_is_the_same_on_a_stream(spark, tmp_path):
    src = messages_topic(spark, tmp_path, [list(STRICT)])
    parsed = split_parsed(parse_sale_strict(stream_topic(spark, src), keep=["offset"]))[0]
    out = str(tmp_path / "out")
    write_each_batch(parsed, parquet_batches(out), str(tmp_path / "ckpt"), NOW).awaitTermination()
    want = split_parsed(parse_sale_strict(read_topic(spark, src), keep=["offset"]))[0]
    assert rows_of(spark.read.parquet(out).drop("batch_id")) == rows_of(want)


def test_live_metrics_per_micro_batch(spark, tmp_path):
    sales = [[text(Categorie=c, Total="10.5") for c in "AAB"], [text(Categorie="A", Total="1")]]
    src = messages_topic(spark, tmp_path, sales)
    sinks = {n: parquet_batches(str(tmp_path / n)) for n in ("category", "city")}
    (query,) = live_sales_metrics(
        stream_topic(spark, src, max_per_trigger=1), sinks, str(tmp_path / "ckpt"), trigger=NOW
    )
    query.awaitTermination()
    assert all(p["stateOperators"] for p in query.recentProgress if p["numInputRows"])
    got = {
        n: sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / n))
                  .select("batch_id", "message").collect())
        for n in sinks
    }
    assert got["category"] == [
        (0, "📊 A: 2 ventes, CA: 21.00€, Moyenne: 10.50€"),
        (0, "📊 B: 1 ventes, CA: 10.50€, Moyenne: 10.50€"),
        (1, "📊 A: 3 ventes, CA: 22.00€, Moyenne: 7.33€"),
    ]
    assert got["city"] == [(0, "🏙️  Lyon: 31.50€"), (1, "🏙️  Lyon: 32.50€")]
