"""Text, number and calendar expressions against plain Python."""

import re
from datetime import date, datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.constants import WHITE_SPACE
from tallyhouse.functions import calendar as cal
from tallyhouse.functions.numbers import half_even, ratio, to_customer_id, to_price, to_quantity, to_timestamp
from tallyhouse.functions.reports import gather, long_report
from tallyhouse.functions.text import is_blank, is_cancellation, strip, tidy

_text = st.text(st.sampled_from(WHITE_SPACE + "aC7é漢!"), max_size=12)


@settings(max_examples=5, deadline=None)
@given(st.lists(_text, min_size=50, max_size=200))
def test_white_space_rules_are_pythons(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", strip(F.col("t")), tidy(F.col("t")), is_blank(F.col("t"))).collect()
    for i, stripped, tidied, blank in got:
        assert stripped == texts[i].strip()
        assert tidied == re.sub(r"\s+", " ", texts[i].strip())
        assert blank == (texts[i].strip() == "")


def test_white_space_list_is_complete():
    assert set(WHITE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_null_text_stays_null(spark):
    row = spark.range(1).select(
        strip(F.lit(None).cast("string")), tidy(F.lit(None).cast("string")), is_blank(F.lit(None).cast("string"))
    ).first()
    assert list(row) == [None, None, None]


def test_cancellation(spark):
    rows = spark.createDataFrame([("C1",), ("c1",), ("1C",), (" C1",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(is_cancellation(F.col("t"))).collect()] == [True, True, False, False, False, False]


def test_half_even_is_numpys(spark):
    values = [0.125, 0.375, 2.675, 1.005, 1.015, -0.125, 0.5, 521.8447, 1e9 + 0.005]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in rows.select(half_even(F.col("v"), 2)).collect()] == list(np.round(values, 2))


def test_lenient_parsing(spark):
    rows = spark.createDataFrame([("12",), ("x",), ("",), (None,), ("NaN",)], "t string")
    got = rows.select(
        to_quantity(F.col("t")), to_price(F.col("t")).cast("double"), to_timestamp(F.col("t")), to_customer_id(F.col("t"))
    ).collect()
    assert [tuple(r) for r in got[1:]] == [(None, None, None, None)] * 4
    assert (got[0][0], got[0][1], got[0][3]) == (12, 12.0, "12")


def test_customer_id(spark):
    rows = spark.createDataFrame([(12345.0,), (None,), (float("nan"),)], "c double")
    assert [r[0] for r in rows.select(to_customer_id(F.col("c"))).collect()] == ["12345", None, None]
    broken = spark.createDataFrame([(12345.5,)], "c double")
    with pytest.raises(PySparkException, match="fractional customer id"):
        broken.select(to_customer_id(F.col("c"))).collect()


def test_ratio_never_fails(spark):
    rows = spark.createDataFrame([(1, 2), (1, 0), (None, 2), (2, None)], "a int, b int")
    assert [r[0] for r in rows.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0, 0.0]


def test_calendar(spark):
    rows = spark.createDataFrame([(date(2010, 1, 3),)], "d date")
    day = F.col("d")
    assert list(rows.select(
        cal.quarter_name(day), cal.month_name(day), cal.day_name(day), cal.year_month(day), cal.date_key(day),
        cal.is_weekend(day), F.weekofyear(day),
    ).first()) == ["Q1", "January", "Sunday", "2010-01", 20100103, 1, 53]


def test_elapsed_days_are_not_calendar_days(spark):
    rows = spark.createDataFrame(
        [(datetime(2011, 12, 8, 14), datetime(2011, 12, 10, 12, 50))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert rows.select(cal.whole_days(F.col("a"), F.col("b"))).first()[0] == 1


def test_long_report_keeps_order(spark):
    row = gather([
        spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b"),
        spark.sql("SELECT timestamp_ntz '2010-01-05 10:00:00' AS c"),
    ])
    report = long_report(row, [("c", F.col("c")), ("a", F.col("a")), ("b", F.col("b"))], "string")
    assert [tuple(r) for r in report.collect()] == [("c", "2010-01-05 10:00:00"), ("a", "1"), ("b", None)]
