"""Conforming, dimensions and the fact."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from arrivals_star.operators.aggregate import group_mean
from arrivals_star.operators.conform import (cast_columns, drop_columns, normalise_names,
                                             rename_columns, text_to_date_column)
from arrivals_star.operators.dims import (calendar_dim, city_demographics_dim, pivot_sum,
                                          port_dim, temperature_dim, transport_mode_dim, visa_dim)
from arrivals_star.operators.fact import arrivals_fact


def test_drop_and_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, B int, c int")
    assert drop_columns(df, ["a", "zzz"]).columns == ["B", "c"]
    assert rename_columns(df, {"A": "x", "b": "y", "nope": "z"}).columns == ["x", "y", "c"]


def test_cast_unknown_column_raises(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError):
        cast_columns(df, {"b": "int"})
    assert cast_columns(df, {"A": "int"}).dtypes == [("a", "int")]


def test_normalise_names_and_clash(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`k` int, `Black or African-American` int, `Two Words` int")
    assert normalise_names(df, df.columns[1:]).columns == ["k", "black_or_african_american", "two_words"]
    clash = spark.createDataFrame([(1, 2)], "`A-b` int, `a b` int")
    with pytest.raises(ValueError):
        normalise_names(clash, clash.columns)


def test_text_to_date_column(spark):
    df = spark.createDataFrame([("20160430",), ("",)], "d string")
    assert [r.d for r in text_to_date_column(df, "d", "%Y%m%d").collect()] == [dt.date(2016, 4, 30), None]


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 3), None), (dt.date(2016, 4, 30), dt.date(2016, 1, 3))],
                               "arrival_date date, depart_date date")
    cal = {r.date: r for r in calendar_dim(df).collect()}
    assert len(cal) == 3
    jan3 = cal[dt.date(2016, 1, 3)]
    # ISO week 53 of 2015 while the year is 2016; Sunday is weekday 1.
    assert (jan3.day, jan3.week, jan3.month, jan3.year, jan3.weekday, jan3.id) == (3, 53, 1, 2016, 1, 20160103)
    assert cal[None].id == -1


def test_every_fact_date_is_in_calendar(spark):
    from arrivals_star.plans import demo
    stays = demo.stays(spark, "/root/testdata/sf0.001")
    cal = calendar_dim(stays)
    for c in ("arrival_date", "depart_date"):
        missing = stays.filter(F.col(c).isNotNull()).join(cal, stays[c] == cal.date, "left_anti")
        assert missing.count() == 0


def test_visa_and_mode_dims(spark):
    fact = spark.createDataFrame([(1, "B2", 1), (1, "B1", 9), (2, "B2", None), (5, "X", 2), (None, None, 3)],
                                 "visa smallint, visatype string, transport_mode_id smallint")
    visas = sorted(visa_dim(fact).collect(), key=lambda r: (r.visa_cat_id is None, r.visa_cat_id or 0, r.visatype or ""))
    assert [tuple(r) for r in visas] == [(1, "B1", "Business"), (1, "B2", "Business"), (2, "B2", "Pleasure"),
                                         (5, "X", None), (None, None, None)]
    modes = {r.id: r.mode for r in transport_mode_dim(fact).collect()}
    assert modes == {1: "Air", 9: "Other", 2: "Sea", 3: "Land", None: None}


def test_temperature_join_ignores_case_not_blanks(spark):
    temps = spark.createDataFrame([("Paris", "france", "10.5"), ("Nice", "France ", "12"), ("X", None, "1"),
                                   ("Lyon", "FRANCE", "bad")], "City string, Country string, average_temperature string")
    countries = spark.createDataFrame([("1", "France", "0"), ("2", "france", "1")], "Code string, Country string, _c0 string")
    got = sorted(tuple(r) for r in temperature_dim(temps, countries).collect())
    # Two country rows match case-insensitively: each city fans out to both codes.
    assert got == [("Lyon", "1", "FRANCE", None), ("Lyon", "2", "FRANCE", None),
                   ("Paris", "1", "france", 10.5), ("Paris", "2", "france", 10.5)]


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_join_is_left_to_the_optimizer(spark):
    """A lookup table under the session's threshold is broadcast, one over it is not; no job runs."""
    from arrivals_star.plans import demo
    sf = "/root/testdata/sf0.001"
    temps, countries = demo.customer_temperatures(spark, sf), demo.nation_countries(spark, sf)
    assert "BroadcastHashJoin" in plan_text(temperature_dim(temps, countries))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_text(temperature_dim(temps, countries))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_group_mean_ignores_malformed(spark):
    df = spark.createDataFrame([("a", "1.5"), ("a", "x"), ("a", "2.5"), ("b", None)], "k string, v string")
    assert {r.k: r.m for r in group_mean(df, ["k"], "v", "m").collect()} == {"a": 2.0, "b": None}


def test_pivot_sums_equal_unpivoted_totals(spark):
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").withColumn("bal", F.col("c_acctbal").cast("int"))
    p = pivot_sum(c, ["c_nationkey"], "c_mktsegment", "bal")
    seg_cols = [x for x in p.columns if x != "c_nationkey"]
    assert seg_cols == sorted(seg_cols) and all(x == x.lower() for x in seg_cols)
    total = p.select(sum(F.coalesce(F.col(x), F.lit(0)) for x in seg_cols).alias("t")).agg(F.sum("t")).first()[0]
    assert total == c.agg(F.sum("bal")).first()[0]


def test_pivot_null_value_column(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "X y", 2)], "k string, race string, n int")
    assert pivot_sum(df, ["k"], "race", "n").columns == ["k", "null", "x_y"]


def test_city_demographics_dim(spark):
    rows = [("0", "Austin", "Texas", "33.5", "1200.0", None, "2400", "10", "5.0", "2.5", "TX", "White", "100"),
            ("1", "Austin", "Texas", "33.5", "1200.0", None, "2400", "10", "5.0", "2.5", "TX", "Black or African-American", "50.0"),
            ("2", "Austin", "Texas", "33.5", "1200.0", None, "2400", "10", "5.0", "2.5", "TX", "White", "1")]
    cols = ["_c0", "City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
            "Number of Veterans", "Foreign-born", "Average Household Size", "State Code", "Race", "Count"]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    out = city_demographics_dim(df)
    r = out.first()
    assert out.count() == 1
    assert (r.male_population, r.female_population, r.foreign_born, r.median_age) == (1200, None, 5, 33.5)
    assert (r.black_or_african_american, r.white) == (50, 101)
    assert dict(out.dtypes)["white"] == "bigint"


def test_port_dim_drops_index(spark):
    df = spark.createDataFrame([("0", "P1", "A, B", None)], "_c0 string, Code string, City string, State string")
    assert port_dim(df).columns == ["port_id", "city", "state"]


def test_arrivals_fact(spark):
    rows = [(1.0, 2016.0, 4.0, 101.0, 101.0, "NYC", 20566.0, 1.0, "NY", 20570.0, 30.0, 2.0, 1.0, 1986.0,
             "M", "AA", "B2", "x"),
            (2.0, 2016.0, 4.0, 101.0, 101.0, "LAX", 20566.5, None, "CA", 20560.0, 1e12, 3.0, 1.0, None,
             "FF", "UA", "F1", "y"),
            (3.0, 2016.0, 4.0, None, None, None, 0.0, 9.0, None, None, None, None, None, None, None, None, None, "z")]
    names = ["cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr", "depdate",
             "i94bir", "i94visa", "count", "biryear", "gender", "airline", "visatype", "extra"]
    types = ["double"] * 5 + ["string", "double", "double", "string", "double", "double", "double", "double", "double",
                              "string", "string", "string", "string"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, types)))
    f = arrivals_fact(df)
    assert f.columns == ["id", "birth_country_id", "residence_country_id", "port_id", "arrival_date",
                         "transport_mode_id", "arrival_state", "depart_date", "age_in_yrs", "visa", "count",
                         "birth_year", "gender", "airline", "visatype", "extra", "stay_days"]
    got = {r.id: r for r in f.collect()}
    assert got[1].arrival_date == dt.date(2016, 4, 22) and got[1].stay_days == 4
    assert got[2].stay_days == -6 and got[2].age_in_yrs is None and got[2].gender == "FF"
    assert got[3].arrival_date is None and got[3].transport_mode_id == 9
    assert dict(f.dtypes)["visa"] == "smallint"


@pytest.mark.parametrize("n", [3, 200])
def test_pivot_names_do_not_depend_on_the_number_of_values(spark, n):
    df = spark.range(n).select(F.lit("a").alias("k"), (F.col("id") + 1).cast("double").alias("p"), F.lit(1).alias("v"))
    out = pivot_sum(df, ["k"], "p", "v")
    assert out.columns[:3] == ["k", "1.0", "2.0"] and len(out.columns) == n + 1
    assert pivot_sum(df, ["k"], "p", "v", values=[1.0, 2.0, 1e20]).columns == ["k", "1.0", "2.0", "1.0e20"]


def test_calendar_takes_malformed_text_as_the_null_date(spark):
    df = spark.createDataFrame([("2016-01-03", "abc"), (None, "2016-01-04")], "arrival_date string, depart_date string")
    assert {r.date for r in calendar_dim(df).collect()} == {dt.date(2016, 1, 3), dt.date(2016, 1, 4), None}


def test_names_ignore_case_and_unknown_ones_raise(spark):
    from arrivals_star.operators.clean import dedupe_by_key, require_columns
    from arrivals_star.operators.conform import sas_dates_to_dates
    df = spark.createDataFrame([(20566.0, 1), (20566.0, 1)], "arrival_date double, id int")
    assert sas_dates_to_dates(df, ["Arrival_Date"]).dtypes[0] == ("arrival_date", "date")
    assert require_columns(df, ["ID"]).count() == 2 and dedupe_by_key(df, ["ID"]).count() == 1
    for call in (lambda: sas_dates_to_dates(df, ["nope"]), lambda: require_columns(df, ["nope"]),
                 lambda: dedupe_by_key(df, ["nope"]), lambda: dedupe_by_key(df, ["id"], ["nope"])):
        with pytest.raises(ValueError):
            call()


def test_fact_is_one_map_stage(spark, scratch):
    """The fact builder is one projection over the staged table: no shuffle, no Python evaluation."""
    from arrivals_star.plans import demo
    path = scratch("staged_for_plan")
    demo.raw_arrivals(spark, "/root/testdata/sf0.001").write.mode("overwrite").parquet(path)
    plan = plan_text(arrivals_fact(spark.read.parquet(path)))
    assert "Exchange" not in plan
    assert not any(node in plan for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"))


def test_report_aggregates_the_fact_before_joining(spark):
    """stay_report joins the dimensions to the fact reduced to (date, mode, visa) grain."""
    from arrivals_star.operators.aggregate import stay_report
    fact = spark.createDataFrame([(dt.date(2016, 4, 1), 1, 1, "B1", 3), (dt.date(2016, 4, 1), 1, 1, "B1", 5)],
                                 "arrival_date date, transport_mode_id smallint, visa smallint, visatype string, "
                                 "stay_days int")
    cal = calendar_dim(fact.withColumn("depart_date", F.col("arrival_date")))
    plan = plan_text(stay_report(fact, cal, transport_mode_dim(fact), visa_dim(fact)))
    tree = plan.split("== Physical Plan ==")[-1]
    first_join = tree.index("Join")
    pre_aggregate = tree.index("keys=[arrival_date")
    assert first_join < pre_aggregate  # the joins sit above (after) the fact's aggregate
    got = stay_report(fact, cal, transport_mode_dim(fact), visa_dim(fact)).collect()
    assert [(r.year, r.month, r.mode, r.arrivals, r.business_arrivals, r.total_stay_days) for r in got] == \
        [(2016, 4, "Air", 2, 2, 8)]
