"""One-pass dedupe, kept rejects, footer profile, run-time pruning, surrogate keys, hot join keys."""

import datetime as dt
import os

import pytest
from pyspark.sql import Observation, functions as F

from arrivals_star.operators import fact as facts
from arrivals_star.operators.clean import dedupe_by_key, dedupe_repeated_keys
from arrivals_star.operators.conform import cast_columns, cast_with_rejects, rejected_values
from arrivals_star.operators.joins import heavy_hitters, join_ignore_case, join_ignore_case_skewed
from arrivals_star.operators.keys import assign_keys
from arrivals_star.operators.profile import FOOTER_SETTINGS, footer_counts, footer_profile, missing_profile
from arrivals_star.plans import demo, jobs
from arrivals_star.plans.registry import QUERIES, _column_sums, _thousandths
from arrivals_star.sources import read_table
from arrivals_star.sources.sinks import write_parquet

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- dedupe ---

def test_staging_scans_its_input_once(spark, scratch):
    raw = demo.written(demo.sparse_arrivals(spark, SF), scratch("raw"))
    plan = plan_of(jobs.stage_arrivals(raw))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_min" in plan


def test_null_keys_are_rows_of_their_own(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 1, "x"), (None, 1, "y"), (2, 1, "b"), (2, 1, "a"), (2, None, "a"), (3, 3, None)],
                               "k int, j int, v string")
    kept = [(2, 1, "a"), (2, None, "a"), (3, 3, None), (None, 1, "x"), (None, 1, "x"), (None, 1, "y")]
    assert rows(dedupe_by_key(df, ["K", "j"], keep_null_keys=True)) == sorted(kept, key=repr)
    assert rows(dedupe_by_key(df, ["k", "j"])) == sorted([(2, 1, "a"), (2, None, "a"), (3, 3, None), (None, 1, "x")], key=repr)
    only = df.select("k")
    assert rows(dedupe_by_key(only, ["k"], keep_null_keys=True)) == sorted([(None,)] * 3 + [(2,), (3,)], key=repr)


@pytest.mark.parametrize("keep", [False, True])
def test_two_step_dedupe_gives_the_same_rows(spark, keep):
    events = demo.table(spark, SF, "events")
    for df, keys, order in ((events, ["user_id", "event_type"], ["ts"]), (events, ["event_id"], []),
                            (events.withColumn("user_id", F.when(F.col("event_id") % 3 > 0, F.col("user_id"))), ["user_id"], ["value"])):
        assert rows(dedupe_repeated_keys(df, keys, order, keep)) == rows(dedupe_by_key(df, keys, order, keep))


# --- rejects ---

def test_rejects_are_the_values_that_casts_lost(spark):
    df = spark.createDataFrame([(1, "12", 1e12, "x"), (2, "1.9", 5.0, ""), (3, "NaN", float("nan"), None), (4, "", None, "7"), (5, "abc", -1e12, "y z")],
                               "id int, n string, d double, t string")
    obs = Observation()
    got = cast_with_rejects(df, {"N": "int", "d": "int", "t": "smallint"}, observation=obs)
    assert got.drop("rejects").dtypes == cast_columns(df, {"n": "int", "d": "int", "t": "smallint"}).dtypes
    assert rows(got.drop("rejects")) == rows(cast_columns(df, {"n": "int", "d": "int", "t": "smallint"}))
    assert obs.get == {"n": 1, "d": 2, "t": 2}
    assert rows(rejected_values(got, ["ID"])) == [(1, "d", "1.0E12"), (1, "t", "x"), (5, "d", "-1.0E12"), (5, "n", "abc"), (5, "t", "y z")]


def test_final_job_keeps_rejects(spark, scratch):
    base = scratch("rejects")
    raw = demo.write_raw_inputs(spark, SF, base + "/raw")
    odd = demo.odd_arrivals(spark, SF)
    odd.withColumn("visapost", F.lit(None).cast("string")).write.mode("overwrite").parquet(raw.arrivals)
    jobs.run_stage(spark, raw, base + "/stage")
    lost = {}
    kept = jobs.run_final(spark, base + "/stage", base + "/final", keep_rejects=True, reject_counts=lost)
    plain = jobs.run_final(spark, base + "/stage", base + "/plain")
    fact = read_table(spark, kept["fact"])
    assert rows(fact.drop("rejects")) == rows(read_table(spark, plain["fact"]))
    counts = {r["column_name"]: r["count"] for r in rejected_values(fact, ["id"]).groupBy("column_name").count().collect()}
    assert counts == {k: v for k, v in lost.items() if v} and set(counts) == {"birth_year", "depart_date"}
    scan = plan_of(rejected_values(fact, ["id"]))
    assert "ReadSchema: struct<id:bigint,rejects:" in scan


# --- profile from footers ---

def test_footer_profile_reads_no_pages_of_counted_columns(spark, scratch):
    path = scratch("footers")
    df = demo.footer_events(spark, SF)
    write_parquet(df, path)
    assert rows(footer_profile(spark, path)) == rows(missing_profile(df))
    assert [r.column_name for r in footer_profile(spark, path, ["odd", "label", "buyer"]).collect()] == ["odd", "label", "buyer"]
    before = {k: spark.conf.get(k, None) for k in FOOTER_SETTINGS}
    try:
        for k, v in FOOTER_SETTINGS.items():
            spark.conf.set(k, v)
        plan = plan_of(footer_counts(spark, path, ["event_id", "buyer", "price", "day", "odd"]))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "PushedAggregation: [COUNT(*), COUNT(event_id), COUNT(buyer), COUNT(price), COUNT(day), COUNT(odd)]" in plan


def test_staging_takes_a_profile_that_is_there(spark, scratch):
    raw = demo.written(demo.sparse_arrivals(spark, SF), scratch("raw_profile"))
    profile = spark.createDataFrame([("visapost", 1, 100.0), ("l_tax", 1, 95.0), ("cicid", 1, 99.0)], "column_name string, missing bigint, pct_missing double")
    assert set(raw.columns) - set(jobs.stage_arrivals(raw, profile=profile).columns) == {"visapost", "l_tax"}


def test_footer_profile_of_an_empty_table(spark, scratch):
    path = scratch("empty")
    write_parquet(spark.createDataFrame([], "a int, b double"), path)
    assert rows(footer_profile(spark, path)) == [("a", 0, None), ("b", 0, None)]


# --- run-time pruning ---

def test_days_prune_the_fact_at_run_time(spark, scratch):
    base = scratch("months")
    facts.write_fact_by_month(facts.arrivals_fact(jobs.stage_arrivals(demo.raw_arrivals(spark, SF))), base + "/fact")
    fact = read_table(spark, base + "/fact")
    calendar = jobs.calendar_dim(fact)
    write_parquet(calendar, base + "/calendar")
    days = read_table(spark, base + "/calendar").where("weekday = 1 AND id BETWEEN 19950101 AND 19950331")
    out = facts.arrivals_by_day(fact, days)
    assert "dynamicpruning" in plan_of(out)
    got = rows(out)
    want = fact.where("arrival_date BETWEEN '1995-01-01' AND '1995-03-31' AND dayofweek(arrival_date) = 1").groupBy("arrival_date").agg(
        F.count(F.lit(1)), F.sum("stay_days"))
    assert [(d, n, s) for d, _, _, n, s in got] == rows(want) and len(got) > 5
    read = files_read(out)
    assert read and read < len(fact.inputFiles()) / 5


def files_read(df):
    """Number of files the fact's scan read in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "FileSourceScanExec" and "dynamicpruning" in p.toString():
            found.append(p.metrics().get("numFiles").get().value())
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return max(found, default=0)


# --- surrogate keys ---

def test_keys_are_dense_and_stay(spark):
    first = spark.createDataFrame([("b", 1), ("a", 2), ("a", 2), (None, 1), ("a", None)], "x string, y int")
    one = assign_keys(first, ["x", "Y"])
    assert rows(one) == sorted([(None, 1, 1), ("a", None, 2), ("a", 2, 3), ("b", 1, 4)], key=repr)
    second = spark.createDataFrame([("0", 0), ("b", 1), (None, None), (None, 1)], "x string, y int")
    two = assign_keys(second, ["x", "y"], one)
    assert rows(two) == sorted(rows(one) + [(None, None, 5), ("0", 0, 6)], key=repr)
    assert rows(assign_keys(second, ["x", "y"], two)) == rows(two)
    assert rows(assign_keys(first.limit(0), ["x", "y"])) == []


def test_keys_of_many_partitions(spark):
    members = spark.range(0, 20000).select(F.pmod(F.xxhash64("id"), F.lit(9000)).alias("m"))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        one = assign_keys(members.where("m % 2 = 0"), ["m"])
        two = assign_keys(members, ["m"], one)
        got = dict(map(tuple, two.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(got.values()) == list(range(1, len(got) + 1)) and len(got) == members.distinct().count()
    old = dict(map(tuple, one.collect()))
    assert all(got[m] == k for m, k in old.items()) and [m for m, _ in sorted(old.items())] == [m for m, _ in sorted(old.items(), key=lambda x: x[1])]


# --- hot join keys ---

@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_hot_key_is_dealt_over_tasks(spark, no_broadcast):
    n = 30000
    left = spark.range(0, n, 1, 4).select("id", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("key"))
    right = spark.range(0, 1000).select(F.concat(F.lit("K"), F.col("id")).alias("name"), F.col("id").alias("v")).unionAll(
        spark.createDataFrame([("hot", -1), ("Hot", -2)], "name string, v long"))

    def sizes(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    plain = join_ignore_case(left, right, "key", "name")
    dealt = join_ignore_case_skewed(left, right, "key", "name")
    assert rows(dealt) == rows(plain)
    a, b = sizes(plain), sizes(dealt)
    assert a[-1] > 3 * a[len(a) // 2] and b[-1] <= 3 * b[len(b) // 2]
    assert "BroadcastHashJoin" not in plan_of(dealt)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_dealt_join_gives_the_same_rows(spark, how):
    left = spark.createDataFrame([(k, ["A", "a", None, "b", "c ", "A"][k % 6]) for k in range(60)] + [(1, "A")] * 5, "id int, key string")
    right = spark.createDataFrame([("a", 1), ("A", 2), ("B", 3), (None, 4), ("c", 5)], "name string, v int")
    for salts in (None, 1, 7):
        assert rows(join_ignore_case_skewed(left, right, "key", "name", how, share=0.2, salts=salts)) == rows(
            join_ignore_case(left, right, "key", "name", how))
    assert heavy_hitters(left, F.lower("key"), 0.2) == ["a"]
    assert rows(join_ignore_case_skewed(left.limit(0), right, "key", "name", how)) == []
    with pytest.raises(ValueError):
        join_ignore_case_skewed(left, right, "key", "name", "full")


def test_skewed_join_result_can_be_written(spark, tmp_path):
    for name, df in {
            "lineitem": spark.createDataFrame([(k, 1 + k % 7, k % 30) for k in range(90)], "l_orderkey bigint, l_linenumber int, l_suppkey bigint"),
            "nation": spark.createDataFrame([(k, f"NATION_{k}", 0) for k in range(25)], "n_nationkey int, n_name string, n_regionkey int")}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    df = QUERIES["ci_join_skewed"](spark, str(tmp_path))
    df.write.parquet(f"{tmp_path}/out")
    out = df.sparkSession.read.parquet(f"{tmp_path}/out")
    assert out.columns == ["l_orderkey", "l_linenumber", "country", "Code", "Country"]
    found = [tuple(r) for r in out.collect()]
    assert sorted(r[0] for r in found) == list(range(90))
    assert all(r[2].upper() == r[4] == f"NATION_{r[3]}" for r in found)
    # the caller's session still takes names in any case, and its settings hold in the query's session
    assert spark.range(1).select("ID").count() == 1
    assert df.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_column_sums_by_value_equal_those_by_row(spark):
    values = [0.0, -0.0, 0.0005, -0.0005, 0.0025, 0.49999999999999994e-3, -2.4e-3, 1.5, 1.5, 1e16, -1e30, float("nan"),
              float("inf"), None]
    df = spark.createDataFrame([(i % 5, v, None, "xyz"[i % 3], dt.date(1995, 1, 1 + i % 4), float(i)) for i, v in enumerate(values * 3)],
                               "code int, count double, i94bir double, gender string, day date, cicid double")
    by_row, by_value = (_column_sums(df, "t", 1, b) for b in (False, True))
    assert rows(by_value) == rows(by_row) and by_value.count() == 6
    none = _column_sums(df.limit(0), "t", 0, True)
    assert rows(none) == rows(_column_sums(df.limit(0), "t", 0)) and {r.row_count for r in none.collect()} == {0}
    # as round() makes whole numbers of them
    x = df.select(_thousandths(F.col("count")).alias("a"), F.round(F.col("count") * 1000).try_cast("bigint").alias("b"))
    assert x.where("NOT a <=> b").count() == 0
    # the days are hashed once each: hashes stand above the count of their values
    plan = by_value._jdf.queryExecution().optimizedPlan().toString()
    assert all("md5" not in line for line in plan.splitlines() if "Aggregate [day" in line) and "Aggregate [day" in plan


def test_raw_arrivals_join_the_small_tables_first(spark, tmp_path):
    for name, columns in {
            "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
            "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
            "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string"}.items():
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = demo.raw_arrivals(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    top = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "l_orderkey" in top  # the line items, with all their columns, are shuffled once


def test_registered_reports_are_not_empty(spark):
    for name in ("fact_rejects", "rejected_values", "arrivals_by_day", "surrogate_keys", "ci_join_skewed"):
        assert QUERIES[name](spark, SF).count() > 0
