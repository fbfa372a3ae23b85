"""Hand-computed cases of casts, cleaning, calendar numbers and the t distribution."""

import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.functions.special import t_two_sided


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r.v for r in df.select("i", expression(F.col("s")).alias("v")).orderBy("i").collect()]


def test_numbers(spark):
    assert values(spark, ["1 234", "t", "NO", "12.5", "-", "N/A", "", None, "5-3", "TRUE"], S.to_int) == [1234, 1, 0, 125, None, None, None, None, None, 1]
    assert values(spark, ["1,5", "2.3456", "x", "NULL", None], S.to_decimal) == [Decimal("1.500"), Decimal("2.346"), None, None, None]


def test_times(spark):
    at = datetime.datetime
    got = values(spark, ["20-01-01", "01/02/2025", "2025-11-20 11:40:30.209324", "01-02-20", "bad", "75-01-02", "1/2/25", "2025/3/4 1:2:3", "nan", None, "31-12-2024"], S.to_timestamp_any)
    assert got == [at(2020, 1, 1), at(2025, 2, 1), at(2025, 11, 20, 11, 40, 30), at(2001, 2, 20), None, at(1975, 1, 2), at(2025, 2, 1), at(2025, 3, 4, 1, 2, 3), None, None, at(2024, 12, 31)]
    assert values(spark, ["2025-01-31 10:00:00"], S.to_report_month) == [datetime.date(2025, 1, 31)]


def test_cleaning(spark):
    assert values(spark, [" a ", "#N/A", "None", "", "nat", None], S.clean_string) == ["a", None, None, None, "nat", None]
    assert values(spark, [" a ", "#N/A", "None", "<NA>", "nat"], S.clean_label_cell) == ["a", "#N/A", None, None, None]
    assert values(spark, ["call 12345678 now\nplease", r"a\nb\\c", " \n ", None, "1234567"], S.clean_free_text) == ["call now please", "a b c", None, None, "1234567"]
    a, b, c = values(spark, [" ab1 ", "AB1", " "], lambda x: S.pseudonymise_key(x, "salt"))
    assert a == b and a.startswith("ENC_") and len(a) == 20 and c is None


def test_yymm(spark):
    rows = spark.createDataFrame([(2501, -1), (2512, 1), (2503, 25), (101, -1)], "m int, n int").select(S.add_months_yymm(F.col("m"), F.col("n")).alias("v")).collect()
    assert [r.v for r in rows] == [2412, 2601, 2704, 12]
    assert spark.range(1).select(S.months_diff(F.lit(2601), F.lit(2411)).alias("v")).first().v == 14


def test_division(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "0"), ("x", "2"), (None, "1")], "a string, b string")
    assert [r.v for r in df.select(S.safe_div(F.col("a"), F.col("b")).alias("v")).collect()] == [0.5, None, None, None]


@pytest.mark.parametrize("t, df, p", [(2.0, 10, 0.0733880), (0.0, 5, 1.0), (1.0, 1, 0.5), (12.706205, 1, 0.05), (1.959964, 1e7, 0.05), (0.1, 3, 0.9266523)])
def test_t_distribution(t, df, p):
    assert t_two_sided(np.array([t]), np.array([df]))[0] == pytest.approx(p, abs=2e-6)
    assert np.isnan(t_two_sided(np.array([np.nan]), np.array([3.0]))[0])
