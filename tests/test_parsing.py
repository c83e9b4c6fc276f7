import json

import pytest
from pyspark.sql import functions as F

from tillflow.operators.filters import filter_key_present
from tillflow.operators.parsing import (
    parse_json,
    parse_sale_strict,
    reject_envelope,
    render_event_json,
    render_json,
    split_parsed,
)
from tillflow.schemas import SALE_EVENT, SALE_FIELDS, SALE_RAW

SALE = dict(
    zip(
        SALE_FIELDS,
        ["1", "2024-12-25", "Lampe", "Décoration", "4", "252", "Ann", "Lyon", "France"]
        + ["0.1", "CB", "907.2"],
        strict=True,
    )
)


def text(drop=None, **change):
    return json.dumps({k: v for k, v in (SALE | change).items() if k != drop}, ensure_ascii=False)


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


LENIENT = {
    '{"IDVente":"1","Quantité":"4","Total":"907.2"}': ("1", "4", "907.2"),
    '{"IDVente":2,"Quantité":4,"Total":498.0}': ("2", "4", "498.0"),
    '  {"IDVente":"6"}': ("6", None, None),
    '{"IDVente":"3","Total":{"a":1}}': ("3", None, '{"a":1}'),
    "not json": (None, None, None),
    "": (None, None, None),
    None: (None, None, None),
    '{"x":1}': (None, None, None),
    '[{"IDVente":"7"}]': (None, None, None),
    "12": (None, None, None),
    '{"IDVente":': (None, None, None),
}


@pytest.mark.parametrize("message", LENIENT)
def test_lenient(spark, message):
    parsed = parse_json(frame(spark, message))
    assert parsed.columns == list(SALE_FIELDS)
    row = parsed.first()
    assert (row["IDVente"], row["Quantité"], row["Total"]) == LENIENT[message]
    assert filter_key_present(parsed).count() == (LENIENT[message][0] is not None)


def test_binary_values_decode(spark):
    df = frame(spark, text()).select(F.col("value").cast("binary").alias("value"))
    assert parse_json(df).first()["Categorie"] == "Décoration"


STRICT = {
    text(): None,
    text(**{"Quantité": 4, "Total": 907.2, "PrixUnitaire": 252, "Remise": 0.1}): None,
    text(**{"Quantité": "+4"}): None,
    text(Total="1e3"): None,
    text(Total="NaN"): None,
    text(Client='{"a":1}'): None,
    text(Client="[x"): None,
    text(Client=True): None,
    text(Client=""): None,
    text(drop="Pays"): "missing field Pays",
    text(Pays=None): "missing field Pays",
    text(**{"Quantité": "4.0"}): "not a number: Quantité",
    text(**{"Quantité": " 4"}): "not a number: Quantité",
    text(**{"Quantité": "4000000000"}): "not a number: Quantité",
    text(Total="abc"): "not a number: Total",
    text(Total=""): "not a number: Total",
    text(Total={"a": 1}): "not a number: Total",
    text(Client={"a": 1}): "not text: Client",
    text(Client=[1]): "not text: Client",
    '{"x":1}': "missing field IDVente",
    "not json": "malformed JSON",
    "": "malformed JSON",
    '[{"IDVente":"7"}]': "malformed JSON",
    text()[:-5]: "malformed JSON",
    None: "no message",
}


@pytest.mark.parametrize("message", STRICT)
def test_strict(spark, message):
    row = parse_sale_strict(frame(spark, message)).first()
    assert (row.ok, row.reason, row.raw) == (STRICT[message] is None, STRICT[message], message)


def test_strict_types_and_split(spark):
    df = frame(spark, *STRICT).withColumn("offset", F.monotonically_increasing_id())
    good, rejects = split_parsed(parse_sale_strict(df, keep=["offset"]))
    assert good.columns == ["offset", *SALE_EVENT.names]
    assert [f.dataType for f in good.schema][1:] == [f.dataType for f in SALE_EVENT]
    assert good.count() == sum(r is None for r in STRICT.values())
    assert rejects.count() == sum(r is not None for r in STRICT.values())


def test_reject_record(spark):
    _, rejects = split_parsed(parse_sale_strict(frame(spark, 'say "no"')))
    assert json.loads(reject_envelope(rejects).first().value) == {
        "error": "Parse error",
        "message": "malformed JSON",
        "raw": 'say "no"',
    }


def test_render_leaves_out_nulls_and_escapes(spark):
    df = spark.createDataFrame([('a"b', None, 0.1, 498.0)], "p string, q int, r double, t double")
    assert render_json(df).first().value == '{"p":"a\\"b","r":0.1,"t":498.0}'


def test_parse_of_render_is_identity(spark):
    rows = [tuple(SALE.values()), ('q"\\', None, "é\n", *["x,y"] * 9), (None, *["0"] * 11)]
    df = spark.createDataFrame(rows, SALE_RAW)
    back = parse_json(render_json(df))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_event_json_keys_and_numbers(spark):
    good, _ = split_parsed(parse_sale_strict(frame(spark, text(Produit='Lampe "A"'))))
    value = render_event_json(good).first().value
    assert list(json.loads(value)) == list(SALE_FIELDS)
    assert '"Quantité":4,"PrixUnitaire":252.0' in value
    assert json.loads(value)["Produit"] == 'Lampe "A"'


@pytest.mark.parametrize(
    "flow",
    [
        lambda df: filter_key_present(parse_json(df)),
        lambda df: split_parsed(parse_sale_strict(df))[0],
        lambda df: reject_envelope(split_parsed(parse_sale_strict(df))[1]),
    ],
)
def test_each_message_is_parsed_once(spark, tmp_path, flow):
    frame(spark, text()).write.parquet(str(tmp_path / "m"))
    plan = flow(spark.read.parquet(str(tmp_path / "m")))
    assert plan._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
