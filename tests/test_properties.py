"""Property checks against plain-Python statements of each rule, on random inputs."""

import datetime as dt
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_star.functions import lenient_cast, sas_days_to_date
from arrivals_star.operators.clean import dedupe_by_key
from arrivals_star.operators.dims import pivot_sum
from arrivals_star.operators.profile import missing_profile

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
INT_MIN, INT_MAX = -2**31, 2**31 - 1

decimal_text = st.one_of(
    st.integers(-10**12, 10**12).map(str),
    st.integers(-10**12, 10**12).map(lambda i: f"{i}.0"),
    st.decimals(min_value=-10**11, max_value=10**11, places=3, allow_nan=False).map(str),
    st.sampled_from(["x", "", "1e", "--1", " 7 "]),
)


def expected_int(text):
    try:
        v = Decimal(text.strip())
    except Exception:
        return None
    if not text.strip() or not v.is_finite():
        return None
    i = int(v)  # truncates toward zero
    return i if INT_MIN <= i <= INT_MAX else None


@SETTINGS
@given(st.lists(decimal_text, min_size=1, max_size=40))
def test_lenient_cast_to_int_truncates_or_nulls(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(lenient_cast(F.col("x"), "int", T.StringType())).collect()]
    assert got == [expected_int(t) for t in texts]


def rule(x):
    if x is None or x == 0 or math.isnan(x):
        return None
    return dt.date(1960, 1, 1) + dt.timedelta(days=math.floor(x))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.just(0.0), st.just(float("nan")),
                          st.floats(-100000, 100000, allow_nan=False)), min_size=1, max_size=40))
def test_sas_days_rule(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(sas_days_to_date(F.col("x"))).collect()]
    assert got == [rule(x) for x in xs]


rows = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), min_size=1, max_size=60)


def nulls_first(t):
    return tuple((v is not None, v if v is not None else 0) for v in t)


@SETTINGS
@given(rows)
def test_dedupe_keeps_smallest_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v string")
    got = sorted(map(tuple, dedupe_by_key(df, ["k"], ["o"]).collect()))
    best = {}
    for k, o, v in data:
        if k not in best or nulls_first((o, v)) < nulls_first(best[k]):
            best[k] = (o, v)
    assert got == sorted((k, o, v) for k, (o, v) in best.items())


@SETTINGS
@given(rows)
def test_profile_counts(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v string")
    got = {r.column_name: (r.missing, r.pct_missing) for r in missing_profile(df).collect()}
    n = len(data)
    for i, c in enumerate(["k", "o", "v"]):
        m = sum(1 for r in data if r[i] is None)
        assert got[c] == (m, 100.0 * m / n)


@SETTINGS
@given(rows)
def test_pivot_equals_grouped_sums(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v string")
    out = {r.k: r.asDict() for r in pivot_sum(df, ["k"], "v", "o").collect()}
    values = sorted({v for _, _, v in data}, key=lambda v: (v is not None, v or ""))
    for k in {k for k, _, _ in data}:
        for v in values:
            cells = [o for kk, o, vv in data if kk == k and vv == v and o is not None]
            assert out[k]["null" if v is None else v] == (sum(cells) if cells else None)
