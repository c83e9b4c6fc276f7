"""Sums of doubles: the same bits in any order, partitions and batches."""

import math
import random
import struct
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from tests.test_streams import NOW
from tillflow.operators.aggregates import group_stats, group_totals
from tillflow.operators.exact import EXACT, exact_sum
from tillflow.streaming.batches import latest_per_key, parquet_batches, write_each_batch

SCHEMA = "key string, value double"


def bits(x):
    return None if x is None else struct.pack("<d", x)


def values(seed, n=400):
    r = random.Random(seed)
    return [r.choice([1, -1]) * r.random() * 10.0 ** r.randint(-30, 30) for _ in range(n)]


def total(df):
    return df.agg(exact_sum(F.col("value")).alias("t")).first().t


@pytest.mark.parametrize("seed", range(4))
def test_close_to_the_true_sum_and_the_same_in_any_order(spark, seed):
    rows = [("k", v) for v in values(seed)]
    want = math.fsum(v for _, v in rows)
    seen = set()
    for turn in range(4):
        random.Random(turn).shuffle(rows)
        got = total(spark.createDataFrame(rows, SCHEMA).repartition(1 + 3 * turn))
        seen.add(bits(got))
    assert len(seen) == 1
    assert abs(got - want) <= 4 * math.ulp(want)


def test_plain_sums_do_depend_on_order(spark):
    """The reason for all this."""
    rows = [("k", v) for v in [1e16, 1.0, -1e16, 1.0] * 3]
    assert total(spark.createDataFrame(rows, SCHEMA)) == 6.0
    assert reduce(add, [v for _, v in rows]) != 6.0  # `sum` itself compensates


@pytest.mark.parametrize("rows,want", [
    ([], None),
    ([None, None], None),
    ([None, 2.5], 2.5),
    ([-0.0], 0.0),
    ([0.1] * 10, math.fsum([0.1] * 10)),
    ([2.0**159, -(2.0**159), 2.0**-128], 2.0**-128),
    ([2.0**-129], 0.0),
    ([math.inf, 1.0], math.inf),
    ([math.inf, -math.inf], math.nan),
    ([math.nan, 1.0, None], math.nan),
    ([2.0**200, 1.0], 2.0**200),
    ([1e308], 1e308),
])
def test_edges(spark, rows, want):
    got = total(spark.createDataFrame([("k", v) for v in rows], SCHEMA))
    assert got == want or (want != want and got != got)


def test_batch_and_stream_agree_bit_for_bit(spark, tmp_path):
    rows = [(random.Random(i).choice(["hot", "hot", None, "k"]), v) for i, v in enumerate(values(9, 300))]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for step in range(3):
        part = spark.createDataFrame(rows[step::3], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(folder)
    df = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    stats = group_stats(df, "key", "value", EXACT)
    write_each_batch(stats, parquet_batches(out), str(tmp_path / "ckpt"), NOW, "update").awaitTermination()
    want = group_stats(spark.createDataFrame(rows, SCHEMA), "key", "value", EXACT)
    other = group_totals(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5), "key", "value", EXACT)
    as_bits = lambda d: {r.key: bits(r.total) for r in d.collect()}
    assert as_bits(latest_per_key(spark.read.parquet(out), "key")) == as_bits(want) == as_bits(other)
