"""Profile and cleaning operators."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from arrivals_star.operators.clean import (clean, dedupe_by_key, dedupe_rows, drop_empty_rows,
                                           drop_sparse_columns, require_columns)
from arrivals_star.operators.profile import missing_profile, sparse_columns


@pytest.fixture()
def gappy(spark):
    rows = [(1, 1.0, "a", None), (2, float("nan"), None, None), (3, None, "NaN", None),
            (4, 4.0, "d", None), (None, None, None, None)]
    return spark.createDataFrame(rows, "k int, v double, s string, e string")


def test_profile_counts_and_percent(gappy):
    got = {r.column_name: (r.missing, r.pct_missing) for r in missing_profile(gappy).collect()}
    assert got == {"k": (1, 20.0), "v": (3, 60.0), "s": (3, 60.0), "e": (5, 100.0)}
    assert [f.dataType.simpleString() for f in missing_profile(gappy).schema.fields] == ["string", "bigint", "double"]


def test_profile_of_empty_table_drops_nothing(spark):
    empty = spark.createDataFrame([], "a int, b string")
    prof = missing_profile(empty).collect()
    assert [(r.missing, r.pct_missing) for r in prof] == [(0, None), (0, None)]
    assert drop_sparse_columns(empty).columns == ["a", "b"]


def test_profile_handles_odd_names(spark):
    df = spark.createDataFrame([(1, None)], "`State Code` int, `a.b` string")
    assert [r.column_name for r in missing_profile(df).collect()] == ["State Code", "a.b"]


def test_sparse_threshold_is_inclusive(spark):
    rows = [(i, i if i == 0 else None, i if i in (0, 1) else None) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, ninety int, eighty int")
    assert sparse_columns(missing_profile(df), 90) == ["ninety"]
    assert drop_sparse_columns(df, 90).columns == ["k", "eighty"]
    assert drop_sparse_columns(df, 90, protected=["NINETY"]).columns == ["k", "ninety", "eighty"]


def test_sparse_drop_does_not_read_protected_columns(spark):
    # Evaluating `boom` raises, so the profile must leave protected columns out of its scan.
    df = spark.range(10).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("half"),
                                F.raise_error(F.lit("protected column was read")).alias("boom"))
    with pytest.raises(Exception, match="protected column was read"):
        missing_profile(df).collect()
    assert drop_sparse_columns(df, 40, protected=["boom"]).columns == ["id", "boom"]
    assert drop_sparse_columns(df, 90, protected=["id", "half", "boom"]).columns == ["id", "half", "boom"]


def test_drop_empty_rows_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(None, None), (float("nan"), None), (1.0, None), (None, "x")], "v double, s string")
    assert drop_empty_rows(df).count() == 2


def test_drop_empty_rows_without_columns_raises(spark):
    df = spark.createDataFrame([(1,)], "a int").drop("a")
    with pytest.raises(ValueError):
        drop_empty_rows(df)


def test_require_columns(gappy):
    assert sorted(r.k for r in require_columns(gappy, ["v", "s"]).collect()) == [1, 4]
    with pytest.raises(ValueError):
        require_columns(gappy, ["nope"])


def test_dedupe_rows_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert dedupe_rows(df).count() == 2


def test_dedupe_by_key_keeps_smallest_by_order_nulls_first(spark):
    rows = [("k", 3, "c"), ("k", None, "z"), ("k", 1, "a"), ("j", 2, "b"), ("j", 2, "a")]
    df = spark.createDataFrame(rows, "key string, o int, v string")
    got = sorted(tuple(r) for r in dedupe_by_key(df, ["key"], ["o"]).collect())
    assert got == [("j", 2, "a"), ("k", None, "z")]
    # The order list decides first; the remaining columns break ties.
    got = sorted(tuple(r) for r in dedupe_by_key(df, ["key"], ["v"]).collect())
    assert got == [("j", 2, "a"), ("k", 1, "a")]
    assert dedupe_by_key(df, ["key"]).columns == ["key", "o", "v"]


def test_dedupe_by_key_is_deterministic_idempotent_and_unique(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    one = dedupe_by_key(ev.repartition(1), ["user_id", "event_type"], ["ts"])
    many = dedupe_by_key(ev.repartition(7, "event_id"), ["user_id", "event_type"], ["ts"])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert one.count() == ev.select("user_id", "event_type").distinct().count()
    again = dedupe_by_key(one, ["user_id", "event_type"], ["ts"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, one.collect()))


def test_dedupe_by_key_hot_key(spark):
    """One key holding most rows still yields one row, the smallest."""
    df = spark.range(0, 20000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                      (F.lit(100000) - F.col("id")).alias("v"))
    out = dedupe_by_key(df, ["k"], ["v"])
    assert out.count() == df.select("k").distinct().count()
    assert out.filter("k = 0").first().v == 100000 - 19998


def test_clean_chain_and_observation(spark):
    rows = [("a", "x", 1, None), ("a", "x", 1, None), ("a", "x", 0, None), ("b", None, 5, None),
            (None, None, None, None), ("c", "y", 2, "n")]
    df = spark.createDataFrame(rows, "city string, race string, cnt int, note string")
    obs = Observation("clean")
    out = clean(df, 90, keys=["city", "race"], observation=obs)
    assert out.columns == ["city", "race", "cnt", "note"]  # note is 83 % missing: kept
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("a", "x", 0, None), ("c", "y", 2, "n")]
    assert obs.get["rows"] == 2
    no_keys = clean(df, 80)
    assert "note" not in no_keys.columns and no_keys.count() == 4


def test_aggregating_operators_reduce_before_the_shuffle(spark):
    """Each aggregating operator plans a partial aggregate below its exchange, so a key holding a
    third of the rows sends one row per task across the network, not a third of the table."""
    import contextlib
    import io

    from arrivals_star.operators.aggregate import group_mean
    from arrivals_star.operators.dims import calendar_dim, pivot_sum

    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("v"),
                                  F.col("id").alias("n"), F.current_date().alias("d"))
    plans = {
        "dedupe_by_key": (dedupe_by_key(df, ["k"], ["n"]), "partial_min"),
        "dedupe_rows": (dedupe_rows(df.select("k", "v")), "HashAggregate"),
        "group_mean": (group_mean(df, ["k"], "v", "m"), "partial_avg"),
        "pivot_sum": (pivot_sum(df, ["k"], "v", "n", values=["1", "2"]), "partial_sum"),
        "calendar_dim": (calendar_dim(df, ["d"]), "HashAggregate"),
    }
    for name, (out, partial) in plans.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
        plan = buf.getvalue()
        below_exchange = plan[plan.index("Exchange hashpartitioning"):]
        assert partial in below_exchange, name
