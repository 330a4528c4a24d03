"""Text parsing against what a pandas reader and cleaner make of the same text."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.functions import parsing


def each(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.v for r in df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()]


def test_trim_removes_every_blank(spark):
    values = [" a ", "\ta\n", "\xa0Книга ", "Книга", "　x y\x85", "\x1fz\x1c", "   ", "", "é", None, " q"]
    assert each(spark, parsing.trimmed, values) == [None if v is None else v.strip() for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from(list(parsing.BLANKS) + list("aЯ0.é界")), max_size=8), min_size=1, max_size=40))
def test_trim_equals_strip(spark, values):
    assert each(spark, parsing.trimmed, values) == [v.strip() for v in values]


@pytest.mark.parametrize("text, value", [
    ("1e3", 1000.0), ("+5", 5.0), ("-.5", -0.5), ("5.", 5.0), ("007", 7.0), ("inf", float("inf")), ("-Infinity", float("-inf")),
    ("0x1A", None), ("0x1p3", None), ("1,5", None), ("1_0", None), ("True", None), ("1d", None), ("2F", None), ("1e", None),
    (".", None), ("", None), ("nan", None), ("12 3", None), (None, None)])
def test_number(spark, text, value):
    assert each(spark, parsing.number, [text]) == [value]


def test_day_and_flag(spark):
    days = ["2024-1-2", "2024-01-02", "2024-02-30", "20240102", "2024-01", "2024-01-02 10:00", "", None]
    assert [str(d) for d in each(spark, parsing.day, days)] == ["2024-01-02"] * 2 + ["None"] * 6
    assert each(spark, parsing.flag, ["1", "0", "TRUE", " False ", "yes", "1.0", None]) == [1, 0, 1, 0, None, None, None]


def test_isbn(spark):
    values = ["978-0-306-40615-7", "9780306406157", "9780306406158", "0306406152", "97803064061577", "INVALID_ISBN", ""]
    assert each(spark, parsing.isbn13_ok, values) == [True, True, False, False, False, False, False]
