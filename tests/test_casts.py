import datetime

import pytest

from tillflow.functions.casts import DECIMAL, ISO_DATE, WHOLE
from tillflow.operators.projections import cast_rejects, clean_cast, project_cast

# token: whole number pattern, decimal pattern, cast of the kept token
TOKENS = {
    "12": (12, 12.0),
    "12.": (None, None),
    ".5": (None, 0.5),
    "3.5": (None, 3.5),
    "-3": (None, None),
    "1e3": (None, None),
    " 12": (None, None),
    "12\n": (12, 12.0),
    "99999999999999999999": (None, 1e20),
    "": (None, None),
    None: (None, None),
}


@pytest.mark.parametrize("token", TOKENS)
def test_numbers(spark, token):
    df = spark.createDataFrame([(token, token)], "whole string, amount string")
    rules = {"whole": (WHOLE, "bigint"), "amount": (DECIMAL, "double")}
    assert tuple(clean_cast(df, rules).first()) == TOKENS[token]


def test_int_out_of_range_is_null(spark):
    df = spark.createDataFrame([("2147483647",), ("2147483648",)], "n string")
    assert [r.n for r in clean_cast(df, {"n": (WHOLE, "int")}).collect()] == [2147483647, None]


def test_dates(spark):
    tokens = ["2024-12-25", "2024-02-29", "2024-02-30", "2024-13-45", "2024-2-8", "hier", None]
    df = spark.createDataFrame([(t,) for t in tokens], "d string")
    got = [r.d for r in clean_cast(df, {"d": (ISO_DATE, "date")}).collect()]
    assert got == [datetime.date(2024, 12, 25), datetime.date(2024, 2, 29)] + [None] * 5


def test_project_cast_and_rejects(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-05"), (" 7 ", "2024-13-01"), ("x", None), ("9" * 20, "")],
        "id string, day string",
    )
    spec = {"key": ("id", "bigint"), "on": ("day", "date"), "day": ("day", None)}
    got = [tuple(r) for r in project_cast(df, spec).collect()]
    assert got == [
        (1, datetime.date(2024, 1, 5), "2024-01-05"),
        (7, None, "2024-13-01"),
        (None, None, None),
        (None, None, ""),
    ]
    assert tuple(cast_rejects(df, spec).first()) == (2, 2)


def test_cleaning_is_one_map_side_projection(spark):
    df = spark.createDataFrame([("1", "2")], "whole string, amount string")
    plan = clean_cast(df, {"whole": (WHOLE, "bigint"), "amount": (DECIMAL, "double")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text
