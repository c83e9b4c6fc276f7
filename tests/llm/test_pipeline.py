"""The pipeline on a small corpus, stage by stage against brute force."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_operators import contained, deduped
from tests.llm.test_simhash import brute
from tillflow.llm import bpe, quality
from tillflow.llm.common import small_batches


def test_run(spark, tmp_path):
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = "\n".join(prose(12) for _ in range(8))
    items = [(i, prose(14)) for i in range(5)]
    docs = []
    for i in range(160):
        text = "\n".join(prose(10) for _ in range(r.randint(4, 10))) if i % 6 else "\n".join(["BUY!! NOW!!"] * 30)
        text += "\n" + passage if i % 7 == 1 else ""
        text += " " + items[i % 5][1] if i % 20 == 3 else ""
        docs.append((i, text))
    docs += [(200 + i, docs[i][1]) for i in range(1, 30)] + [(300, None), (301, "")]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    table = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in docs], columns)
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i % 6 > 0), 0) for i in range(160)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scores = quality.digest(table, quality.train(table, spark.read.parquet(f"{tmp_path}/labels.parquet"))).collect()
    good = {s.doc_id for s in scores if s.predicted}
    assert {i for i in range(160) if i % 6} <= good and not good & {i for i in range(160) if i % 6 == 0}
    left = deduped([(i, t) for i, t in docs if i in good])
    roots = {d: c for d, _, c in brute(left)}
    left = [(d, t) for d, t in left if roots[d] == d]
    dirty = {d for d, *_, bad in contained(left, items) if bad}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(
        (d, tokenizer.encode(t, add_special_tokens=False).ids, hashlib.sha256(t.encode()).hexdigest()) for d, t in left if d not in dirty
    )
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((x.doc_id, list(x.ids), x.decoded_sha256) for x in got) == want
    assert dirty and len(want) < len(good)


def test_stages_return_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert callable(stage)
    assert corpus_pipeline.drop_lines(spark, docs, "").columns == corpus_pipeline.COLUMNS


KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def batch_bound(spark):
    """The session without a bound of its own on the bytes of a batch, as it is again afterwards."""
    was = spark.conf.getAll.get(KEY)
    spark.conf.unset(KEY)
    yield spark.conf
    spark.conf.unset(KEY) if was is None else spark.conf.set(KEY, was)


def test_encoding_takes_one_python_worker_a_task(spark, batch_bound):
    docs = spark.createDataFrame([(1, "two words", "en", "src0", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    for out in (corpus_pipeline.encode(spark, docs, ""), bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1


def test_round_trip_keeps_other_columns(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([("a", "two words", 1), (None, None, 2), ("c", "", None)], "a string, text string, n int")
    got = bpe.round_trip(docs, path)
    assert got.columns == ["a", "n", "ids", "decoded"]
    want = bpe.decoded(bpe.encode(docs, path).drop("text"), path)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert [x.decoded for x in bpe.round_trip(docs.select("text"), path).collect()].count("two words") == 1


def test_stages_hand_small_batches_to_python(spark, batch_bound):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([len(batch)]), pa.array([batch.nbytes])], names=["n", "size"])

    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('words ', 1000) AS text", "'en' AS lang", "'src0' AS source", "6000L AS n_chars")
    corpus_pipeline.encode(spark, docs, "")  # sets the bound
    found = docs.coalesce(1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(x.n for x in found) == 4000 and max(x.size for x in found) < 6_000_000


def test_a_bound_of_the_session_holds(spark, batch_bound):
    batch_bound.set(KEY, "1m")
    small_batches(spark)
    assert batch_bound.get(KEY) == "1m"
