"""Column expressions: the semantics table of SURVEY §2.12 on tiny literal frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_star.functions import (PANDAS_NA_TOKENS, code_label, is_missing, lenient_cast,
                                     null_tokens, sas_days_to_date, strptime_pattern, text_to_date)


def one_col(spark, values, type_name):
    return spark.createDataFrame([(v,) for v in values], f"x {type_name}")


def test_is_missing_by_type(spark):
    d = one_col(spark, [1.0, None, float("nan")], "double")
    assert [r[0] for r in d.select(is_missing(F.col("x"), T.DoubleType())).collect()] == [False, True, True]
    s = one_col(spark, ["a", None, "NaN", " NaN ", "+NaN", "nan", "abc"], "string")
    got = [r[0] for r in s.select(is_missing(F.col("x"), T.StringType())).collect()]
    # Java's number parser reads NaN only in this case, with an optional sign; 'abc' never fails.
    assert got == [False, True, True, True, True, False, False]
    t = one_col(spark, [dt.date(2020, 1, 1), None], "date")
    assert [r[0] for r in t.select(is_missing(F.col("x"), T.DateType())).collect()] == [False, True]


@pytest.mark.parametrize("text,target,want", [
    ("1234", "bigint", 1234), ("1234.0", "bigint", 1234), ("12.7", "int", 12), ("-12.7", "int", -12),
    (" 42 ", "int", 42), ("x", "int", None), ("", "int", None), (None, "int", None),
    ("99999999999", "int", None), ("70000", "smallint", None), ("9223372036854775807", "bigint", 9223372036854775807),
    ("ABC", "varchar(2)", "ABC"), ("1.5", "float", 1.5), ("2.25", "double", 2.25),
])
def test_lenient_cast_from_text(spark, text, target, want):
    df = one_col(spark, [text], "string")
    got = df.select(lenient_cast(F.col("x"), target, T.StringType())).first()[0]
    assert got == want


def test_lenient_cast_from_double(spark):
    df = one_col(spark, [12.9, -12.9, float("nan"), 1e12, None], "double")
    got = [r[0] for r in df.select(lenient_cast(F.col("x"), "int", T.DoubleType())).collect()]
    assert got == [12, -12, None, None, None]


def python_rule(x):
    """The day-count rule written plainly in Python, for comparison (falsy values give None)."""
    if x is None or x == 0:
        return None
    return dt.date(1960, 1, 1) + dt.timedelta(days=math.floor(x))


@pytest.mark.parametrize("x", [20566.0, 0.0, None, -0.5, 20566.7, -1.0, -366.25, 1.0])
def test_sas_days_to_date_matches_rule(spark, x):
    df = one_col(spark, [x], "double")
    assert df.select(sas_days_to_date(F.col("x"))).first()[0] == python_rule(x)


def test_sas_days_edges(spark):
    df = one_col(spark, [float("nan"), 0.0, 1e300], "double")
    assert [r[0] for r in df.select(sas_days_to_date(F.col("x"))).collect()] == [None, None, None]
    assert df.select(sas_days_to_date(F.col("x"), zero_is_null=False)).collect()[1][0] == dt.date(1960, 1, 1)


def test_sas_days_outside_the_calendar_are_null(spark):
    df = one_col(spark, [-2147483648.0, 2147483647.0, -715510.0, 2936549.0, 2936550.0], "double")
    got = [r[0] for r in df.select(sas_days_to_date(F.col("x")).cast("string")).collect()]
    assert got[0] is got[1] is got[4] is None and got[3] == "9999-12-31"


@pytest.mark.parametrize("fmt", ["%Q", "%U %Y", "%z", "%Y %Y", "%"])
def test_unsupported_directives_raise_early(fmt):
    with pytest.raises(ValueError):
        strptime_pattern(fmt)


def python_date(text, fmt):
    try:
        return dt.datetime.strptime(text, fmt).date() if text else None
    except ValueError:
        return None


@pytest.mark.parametrize("fmt,texts", [
    ("%d%m%y", ["050199", "050168", "050169", "311200", "300200", "05019"]),
    ("%m/%d/%Y", ["1/5/2016", "01/05/2016", "13/1/2016", "2/30/2016", "1/5/16", " 1/5/2016", "1/5/2016 "]),
    ("%m%d%Y", ["1152016", "01152016", "D/S", "", "152016", "1312016"]),
    ("%a %d %b %Y", ["Tue 05 Jan 2016", "tue 5 JAN 2016", "Mon 5 Jan 2016", "Xyz 5 Jan 2016", "Tue  5 Jan  2016"]),
    ("%A, %B %d, %y", ["Tuesday, January 5, 16", "Monday, february 29, 00"]),
    ("%Y-%m-%dT%H:%M:%S.%f", ["2016-01-05T23:59:59.123", "2016-01-05T24:00:00.0", "2016-1-5T1:2:3.4"]),
    ("%I %p %d %m %Y", ["12 AM 1 2 2016", "13 AM 1 2 2016"]),
    ("%Y %j", ["2016 366", "2015 366", "2016 1", "2016 060"]),
    ("%d.%m", ["29.02", "28.02"]),
    ("%Y", ["2016", "216", "20160"]),
    ("100%% %d %m %Y", ["100% 5 1 2016", "100%% 5 1 2016"]),
])
def test_text_to_date_reads_as_strptime(spark, fmt, texts):
    df = one_col(spark, texts + [None], "string")
    got = [r[0] for r in df.select(text_to_date(F.col("x"), fmt)).collect()]
    assert got == [python_date(t, fmt) for t in texts] + [None]


def test_text_to_date(spark):
    df = one_col(spark, ["04302016", "", None, "D/S", "13452016"], "string")
    got = [r[0] for r in df.select(text_to_date(F.col("x"), "%m%d%Y")).collect()]
    assert got == [dt.date(2016, 4, 30), None, None, None, None]


def test_code_label_has_no_default(spark):
    df = one_col(spark, [1, 2, 7, None], "int")
    got = [r[0] for r in df.select(code_label(F.col("x"), {1: "Air", 2: "Sea"})).collect()]
    assert got == ["Air", "Sea", None, None]


def test_null_tokens_exact_match(spark):
    assert len(PANDAS_NA_TOKENS) == 19
    df = one_col(spark, ["NA", " NA", "n/a", "", "null", "None", "ok", None, "NaN"], "string")
    got = [r[0] for r in df.select(null_tokens(F.col("x"))).collect()]
    assert got == [None, " NA", None, None, None, None, "ok", None, None]
