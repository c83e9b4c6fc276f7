import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.operators import running
from tillflow.operators.aggregates import group_stats
from tillflow.operators.running import running_stats


def brute_force(rows, carry=()):
    """rows: (key, order, part, value)"""
    state = defaultdict(lambda: [Decimal(0), 0]) | {k: [t, n] for k, t, n in carry}
    out = []
    for key, order, part, value in sorted(rows, key=lambda r: (r[1], r[2])):
        entry = state.setdefault(key, [Decimal(0), 0])
        entry[0] += value
        entry[1] += 1
        out.append((key, order, part, entry[1], entry[0]))
    return sorted(out, key=repr)


def run(spark, rows, carry=None, **options):
    df = spark.createDataFrame(rows, "key string, at bigint, part int, value decimal(18,2)")
    if carry is not None:
        carry = spark.createDataFrame(carry, "key string, total decimal(28,2), n bigint")
    got = running_stats(
        df, "key", "value", "at", ties=["part"], sum_type="decimal(18,2)", carry=carry, **options
    )
    assert got.columns == ["key", "at", "part", "value", "n", "total", "mean"]
    got = got.select("key", "at", "part", "n", "total")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def sales(n, start=0, step=1, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # One key has a third of all rows, some rows have none.
        key = rng.choice(["hot", None, f"k{rng.randrange(20)}"])
        rows.append((key, start + i * step, 0, Decimal(rng.randrange(-500, 50000)) / 100))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1 << 20, 40, 7, 1])
@pytest.mark.parametrize("above", [1 << 22, 3])
def test_equals_brute_force(spark, monkeypatch, block, above):
    monkeypatch.setattr(running, "BLOCK", above)
    rows = sales(300)
    assert run(spark, rows, block=block) == brute_force(rows)


@pytest.mark.parametrize("start,step", [(-150, 1), (1 << 40, 1 << 33), (0, 1000)])
def test_any_integer_order(spark, start, step):
    rows = sales(200, start, step)
    assert run(spark, rows, block=16) == brute_force(rows)


def test_topic_partitions_share_offsets(spark):
    rows = [(k, at, part, v) for part in range(3) for k, at, _, v in sales(80, seed=part)]
    assert run(spark, rows, block=8) == brute_force(rows)


@pytest.mark.parametrize("block", [4, 1 << 20])
def test_carry(spark, block):
    rows = sales(100)
    carry = [("hot", Decimal("10.50"), 3), ("k1", Decimal("1.00"), 1), (None, Decimal("2.25"), 7)]
    carry.append(("elsewhere", Decimal("5.00"), 9))
    assert run(spark, rows, carry, block=block) == brute_force(rows, carry)


@pytest.mark.parametrize("block", [2, 1 << 20])
def test_a_sum_of_no_values_is_null(spark, block):
    rows = spark.createDataFrame(
        [("a", i, 0, None) for i in range(6)], "key string, at bigint, part int, value decimal(18,2)"
    )
    got = running_stats(rows, "key", "value", "at", sum_type="decimal(18,2)", block=block)
    assert [r.total for r in got.collect()] == [None] * 6


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_order_of_two_columns(spark, block):
    rows = [(k, at, part, v) for part in range(9) for k, at, _, v in sales(12, seed=part)]
    df = spark.createDataFrame(rows, "key string, at bigint, part int, value decimal(18,2)")
    carry = spark.createDataFrame([("hot", Decimal("3.00"), 2)], "key string, total decimal(28,2), n bigint")
    got = running_stats(df, "key", "value", ("part", "at"), sum_type="decimal(18,2)", block=block, carry=carry)
    want = brute_force([(k, part, at, v) for k, at, part, v in rows], [("hot", Decimal("3.00"), 2)])
    got = got.select("key", "part", "at", "n", "total").collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_partitions_that_share_offsets_stay_apart(spark):
    rows = spark.range(5000).selectExpr(
        "'hot' AS key", "CAST(id DIV 10 AS INT) AS part", "id % 10 AS at", "1.0D AS value"
    )
    got = running_stats(rows, "key", "value", ("part", "at"), block=100)
    sizes = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert got.count() == 5000 and sizes < 2500


def test_last_row_is_the_group_total(spark):
    rows = spark.createDataFrame(
        sales(300), "key string, at bigint, part int, value decimal(18,2)"
    )
    options = {"sum_type": "decimal(18,2)"}
    last = (
        running_stats(rows, "key", "value", "at", block=9, **options)
        .groupBy("key")
        .agg(*[F.max_by(c, "at").alias(c) for c in ("n", "total", "mean")])
    )
    want = group_stats(rows, "key", "value", **options)
    assert sorted(map(repr, last.collect())) == sorted(
        map(repr, want.select(last.columns).collect())
    )


def test_doubles(spark):
    df = spark.createDataFrame([("a", i, 0.1 * i) for i in range(50)], "k string, o int, v double")
    got = running_stats(df, "k", "v", "o", block=6).orderBy("o").collect()
    assert [r.n for r in got] == list(range(1, 51))
    assert got[-1].total == pytest.approx(0.1 * sum(range(50)))


def test_order_must_be_whole_numbers(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)], "k string, o double, v double")
    with pytest.raises(TypeError):
        running_stats(df, "k", "v", "o")


def test_no_shuffle_gathers_the_rows_of_a_key(spark, tmp_path):
    spark.range(100).selectExpr("id AS o", "'hot' AS k", "1.0D AS v").write.parquet(
        str(tmp_path / "t")
    )
    plan = running_stats(spark.read.parquet(str(tmp_path / "t")), "k", "v", "o")
    text = plan._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    shuffles = [i for i, line in enumerate(lines) if " Exchange " in line]
    # The rows themselves are shuffled once, by key and block.
    (first,) = [i for i in shuffles if i < scans[0]]
    assert "__running_block" in lines[first].split("hashpartitioning")[1]
    # All other shuffles carry partial aggregates, or totals per key and block.
    for i in shuffles[1:]:
        below = " ".join(lines[i + 1 : i + 3])
        assert "partial_" in below or "Window" in below or "Union" in below or "HashAgg" in below
    assert "SinglePartition" not in text and "SortMergeJoin" not in text
