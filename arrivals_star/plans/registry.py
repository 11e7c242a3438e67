"""Registered queries: one per operator group of the build, each with an equivalent DuckDB SQL.

Every query reads the whole given tables (through ``demo``) and returns a DataFrame; the SQL
twin computes the same rows from the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import PANDAS_NA_TOKENS, sas_days_to_date, text_to_date
from ..operators.aggregate import group_mean, stay_report
from ..operators.clean import (clean, dedupe_by_key, dedupe_repeated_keys, dedupe_rows, drop_empty_rows,
                               drop_sparse_columns, require_columns)
from ..operators.conform import cast_columns, cast_with_rejects, drop_columns, rejected_values, rename_columns
from ..operators.dims import (calendar_dim, city_demographics_dim, pivot_sum, port_dim, temperature_dim,
                              temperature_dim_sql, transport_mode_dim, visa_dim, write_calendar)
from ..operators.fact import arrivals_by_day, arrivals_fact, arrivals_fact_with_rejects, write_fact_by_month
from ..operators.joins import join_ignore_case_skewed
from ..operators.keys import assign_keys
from ..operators.profile import footer_profile, missing_profile
from ..session import case_sensitive_session, scratch_path
from ..sources import (SAS_TRANSPORT, apply_null_tokens, drop_index_column, read_csv, read_quoted_csv, read_small_csv,
                       read_table, register_sas)
from ..sources.sinks import write_csv, write_parquet
from . import demo
from .jobs import (check_schema, run_final, run_stage, stage_arrivals, stage_countries, stage_demographics, stage_ports,
                   stage_temperatures)

Query = Callable[[SparkSession, str], DataFrame]


# ---- profile and cleaning -------------------------------------------------------------------

def q_missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    return missing_profile(demo.gappy_events(spark, sf))


def q_drop_sparse_columns(spark: SparkSession, sf: str) -> DataFrame:
    return drop_sparse_columns(demo.sparse_events(spark, sf), 90.0)


def q_drop_empty_rows(spark: SparkSession, sf: str) -> DataFrame:
    return drop_empty_rows(demo.gappy_events(spark, sf).select("reading", "label"))


def q_require_columns(spark: SparkSession, sf: str) -> DataFrame:
    return require_columns(demo.gappy_events(spark, sf).select("event_id", "reading", "label"),
                           ["reading", "label"])


def q_dedupe_exact(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_rows(demo.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


def q_dedupe_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_by_key(demo.table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])


def q_clean_small_table(spark: SparkSession, sf: str) -> DataFrame:
    return clean(demo.doubled_customers(spark, sf), 90.0, keys=["c_nationkey", "c_mktsegment"])


def q_null_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return apply_null_tokens(demo.token_orders(spark, sf))


# ---- conforming -----------------------------------------------------------------------------

def q_conform_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = drop_columns(demo.text_orders(spark, sf), ["o_orderpriority", "no_such_column"])
    df = rename_columns(df, {"okey": "order_id", "O_CUSTKEY": "customer_id",
                             "o_totalprice": "total_price", "ghost": "nothing"})
    return cast_columns(df, {"order_id": "bigint", "customer_id": "int", "total_price": "int",
                             "price_f": "float", "o_orderstatus": "varchar(1)", "o_orderdate": "date"})


def q_epoch_days(spark: SparkSession, sf: str) -> DataFrame:
    s = demo.sas_orders(spark, sf)
    return s.select("o_orderkey", "day_count", sas_days_to_date(F.col("day_count")).alias("arrival_date"))


def q_parse_date(spark: SparkSession, sf: str) -> DataFrame:
    d = demo.dated_orders(spark, sf)
    return d.select("o_orderkey", "order_text", text_to_date(F.col("order_text"), "%m%d%Y").alias("order_date"),
                    text_to_date(F.col("slash_text"), "%m/%d/%Y").alias("slash_date"),
                    text_to_date(F.col("short_text"), "%d%m%y").alias("short_date"))


def q_date_diff(spark: SparkSession, sf: str) -> DataFrame:
    s = demo.stays(spark, sf)
    return s.select("l_orderkey", "l_linenumber",
                    F.datediff("depart_date", "arrival_date").alias("stay_days"))


# ---- dimensions -----------------------------------------------------------------------------

def q_calendar_dim(spark: SparkSession, sf: str) -> DataFrame:
    return calendar_dim(demo.stays(spark, sf))


def q_calendar_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "time_dim")
    write_calendar(calendar_dim(demo.stays(spark, sf)), path)
    return read_table(spark, path).select("date", "day", "week", "month", "year", "weekday", "id")


def q_visa_dim(spark: SparkSession, sf: str) -> DataFrame:
    return visa_dim(demo.visa_orders(spark, sf))


def q_transport_mode_dim(spark: SparkSession, sf: str) -> DataFrame:
    return transport_mode_dim(demo.mode_lines(spark, sf))


def q_ci_join(spark: SparkSession, sf: str) -> DataFrame:
    return temperature_dim(demo.customer_temperatures(spark, sf), demo.nation_countries(spark, sf))


def q_ci_join_sql(spark: SparkSession, sf: str) -> DataFrame:
    return temperature_dim_sql(spark, demo.customer_temperatures(spark, sf), demo.nation_countries(spark, sf))


def q_group_mean(spark: SparkSession, sf: str) -> DataFrame:
    return group_mean(demo.balance_texts(spark, sf), ["City", "Country"], "AverageTemperature",
                      "average_temperature")


def q_pivot_sum(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_sum(demo.balance_classes(spark, sf), ["c_nationkey"], "class", "balance")


def q_pivot_sum_many(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_sum(demo.order_shares(spark, sf), ["l_returnflag"], "share", "quantity")


def q_port_dim(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ports_csv")
    demo.write_indexed_csv(demo.customer_ports(spark, sf), path)
    return port_dim(read_csv(spark, path, multi_line=True))


def q_port_dim_sparse(spark: SparkSession, sf: str) -> DataFrame:
    # A needed column that is 95 % missing stays: the final table has its declared columns.
    path = scratch_path(spark, "ports_sparse")
    write_csv(stage_ports(demo.empty_ports(spark, sf)), path)
    return check_schema(port_dim(read_csv(spark, path, multi_line=True)), "port")


# ---- fact and report ------------------------------------------------------------------------

def _raw(spark: SparkSession, raw: DataFrame) -> DataFrame:
    # staging profiles its input before it reads the rows: the derived input is written once
    return demo.written(raw, scratch_path(spark, "raw_arrivals"))


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return arrivals_fact(stage_arrivals(_raw(spark, demo.raw_arrivals(spark, sf)), order=demo.ARRIVALS_ORDER))


def q_arrivals_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


def q_star_report(spark: SparkSession, sf: str) -> DataFrame:
    # As the final job does it: the fact is written once, each dimension is built from the
    # written fact and written, and the report reads the written tables, so the fact plan runs
    # once. (The calendar's partitioned layout is exercised by calendar_roundtrip; here it is one
    # folder.)
    base = scratch_path(spark, "star")
    write_parquet(_fact(spark, sf), f"{base}/fact")
    fact = read_table(spark, f"{base}/fact")
    write_parquet(calendar_dim(fact), f"{base}/calendar")
    write_parquet(transport_mode_dim(fact), f"{base}/mode")
    write_parquet(visa_dim(fact), f"{base}/visa")
    return stay_report(fact, read_table(spark, f"{base}/calendar"), read_table(spark, f"{base}/mode"),
                       read_table(spark, f"{base}/visa"))


# ---- staging and the full demographics path -------------------------------------------------

def q_stage_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return stage_arrivals(_raw(spark, demo.sparse_arrivals(spark, sf)))


def q_stage_arrivals_all(spark: SparkSession, sf: str) -> DataFrame:
    return stage_arrivals(_raw(spark, demo.sparse_arrivals(spark, sf)), dedupe=False)


def q_sas_transport_stage(spark: SparkSession, sf: str) -> DataFrame:
    # The format the raw arrivals come in: written as SAS transport files, read back by byte ranges.
    register_sas(spark)
    path = scratch_path(spark, "arrivals_sas")
    demo.sparse_arrivals(spark, sf).write.format(SAS_TRANSPORT).options(**SAS_LENGTHS).mode("append").save(path)
    return stage_arrivals(read_table(spark, path, SAS_TRANSPORT))


SAS_LENGTHS = {"length.i94port": "20", "length.i94addr": "8", "length.gender": "8", "length.airline": "20",
               "length.visatype": "8", "length.visapost": "8"}


def q_dedupe_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    li = demo.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice")
    return dedupe_repeated_keys(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_csv_quoted_breaks(spark: SparkSession, sf: str) -> DataFrame:
    # one file with quoted line breaks, read by as many tasks as it has splits
    path = scratch_path(spark, "breaks_csv")
    demo.write_indexed_csv(demo.customer_ports(spark, sf).coalesce(1), path)
    return drop_index_column(read_quoted_csv(spark, path))


def q_replace_table(spark: SparkSession, sf: str) -> DataFrame:
    # a table is replaced by one computed from itself: the old one is there until the new one is complete
    path = scratch_path(spark, "replaced")
    write_parquet(demo.customer_ports(spark, sf), path)
    write_parquet(read_table(spark, path).where("State IS NOT NULL"), path)
    return read_table(spark, path)


def q_rejected_values(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "conformed")
    write_parquet(cast_with_rejects(demo.text_orders(spark, sf), {"OKEY": "bigint", "o_custkey": "int", "o_totalprice": "smallint"}), path)
    return rejected_values(read_table(spark, path), ["OKEY"])


def q_fact_rejects(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "fact_rejects")
    write_parquet(arrivals_fact_with_rejects(drop_empty_rows(demo.odd_arrivals(spark, sf))), path)
    return rejected_values(read_table(spark, path), ["id"])


def q_footer_profile(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "footers")
    write_parquet(demo.footer_events(spark, sf), path)
    return footer_profile(spark, path)


def q_arrivals_by_day(spark: SparkSession, sf: str) -> DataFrame:
    # the Sundays of 1995: the fact's folders are pruned at run time by the months those days fall in
    base = scratch_path(spark, "fact_by_month")
    write_fact_by_month(_fact(spark, sf), f"{base}/fact")
    fact = read_table(spark, f"{base}/fact")
    write_parquet(calendar_dim(fact), f"{base}/calendar")
    days = read_table(spark, f"{base}/calendar").where("weekday = 1 AND id BETWEEN 19950101 AND 19951231")
    return arrivals_by_day(fact, days)


def q_surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    # two loads: customers with urgent orders, then all customers with orders
    orders = demo.table(spark, sf, "orders")
    first = assign_keys(orders.where("o_orderpriority = '1-URGENT'"), ["o_custkey"])
    return assign_keys(orders, ["o_custkey"], first)


def q_ci_join_skewed(spark: SparkSession, sf: str) -> DataFrame:
    # both keys are returned, and their names differ in case alone: only a session that tells case apart writes them
    own = case_sensitive_session(spark)
    return join_ignore_case_skewed(demo.skewed_countries(own, sf), demo.nation_countries(own, sf), "country", "Country")


def q_stage_temperatures(spark: SparkSession, sf: str) -> DataFrame:
    return stage_temperatures(demo.raw_temperatures(spark, sf))


def q_stage_countries(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "countries_csv")
    demo.write_indexed_csv(demo.raw_countries(spark, sf), path)
    return stage_countries(read_small_csv(spark, path))


def q_stage_ports(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ports_raw_csv")
    demo.write_indexed_csv(demo.raw_ports(spark, sf), path)
    return stage_ports(read_small_csv(spark, path))


def _staged_demographics(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "demographics_raw")
    demo.write_raw_demographics(spark, sf, path)
    return stage_demographics(read_small_csv(spark, path, sep=";"))


def q_stage_demographics(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_demographics(spark, sf)


def q_city_demographics_dim(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "demographics_stage")
    write_csv(_staged_demographics(spark, sf), path)
    return city_demographics_dim(read_csv(spark, path, multi_line=True))


# Staged tables that run_stage writes as CSV; the others are Parquet.
_CSV_STAGED = {"temperatures", "demographics", "ports", "countries"}
# Columns compared as numbers (times 1000, rounded) whose text differs between engines.
_AS_NUMBER = {"average_temperature", "avg_temperature", "median_age", "average_household_size", "Median Age",
              "Female Population", "l_extendedprice", "l_discount", "l_tax", "cicid", "i94cit", "i94res", "arrdate",
              "i94mode", "depdate", "i94bir", "i94visa", "count", "biryear", "i94yr", "i94mon", "admnum"}


# Columns of the arrivals that seldom repeat a value: hashed row by row. Their other columns are codes,
# dates, ages and the like, hashed once per value.
_SELDOM_REPEATED = {"cicid", "id", "admnum", "l_extendedprice"}


def _thousandths(v: Column) -> Column:
    """``round(v * 1000)`` as bigint, halves away from zero: the whole part of a double under 2^52 and
    what is left of it are exact, so no decimal is made per row as ``round`` does."""
    x = v.try_cast("double") * 1000
    size = F.abs(x)
    whole = F.floor(size)
    near = whole + F.when(size - whole >= 0.5, 1).otherwise(0)
    return F.when(size < 2.0 ** 52, F.when(x < 0, -near).otherwise(near)).otherwise(F.round(x).try_cast("bigint"))


def _column_sums(df: DataFrame, table_name: str, observed: int | None, by_value: bool = False) -> DataFrame:
    """One row per column: rows, values that are not null, and a sum over hashes of their texts.

    With ``by_value`` a column's values are counted first, with partial counts in each task that reads
    the one column, and each different value is hashed once and counts as often as it occurs; the
    columns in ``_SELDOM_REPEATED`` are hashed row by row, as all are without it.
    """
    def value(c: str) -> Column:
        return _thousandths(F.col(f"`{c}`")) if c in _AS_NUMBER else F.col(f"`{c}`")

    def part(text: Column) -> Column:
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")

    counted = [c for c in df.columns if by_value and c not in _SELDOM_REPEATED]
    direct = [c for c in df.columns if c not in counted]
    found = []
    if direct:
        sums = []
        for i, c in enumerate(direct):
            text = value(c).cast("string")
            sums += [F.count(text).alias(f"n{i}"), F.sum(part(text)).alias(f"s{i}")]
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("present"), F.col(f"s{i}").alias("checksum"))
                         for i, c in enumerate(direct)])
        found.append(df.agg(F.count(F.lit(1)).alias("row_count"), *sums).select("row_count", F.inline(rows)))
    if counted:
        # a row of none for each column, so that an empty table has its columns too
        none = df.sparkSession.createDataFrame([(c, None, 0) for c in counted], "column_name string, text string, n bigint")
        values = reduce(DataFrame.unionByName, [
            df.groupBy(value(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(c).alias("column_name"), F.col("v").cast("string").alias("text"), "n") for c in counted], none)
        text, n = F.col("text"), F.col("n")
        found.append(values.groupBy("column_name").agg(
            F.sum(n).alias("row_count"), F.sum(F.when(text.isNotNull(), n).otherwise(0)).alias("present"),
            F.sum(part(text) * n).alias("checksum")))
    # observed_rows: the staging job's row count after cleaning (C3), recorded while it wrote.
    return reduce(DataFrame.unionByName, found).select(
        F.lit(table_name).alias("table_name"), "column_name", "row_count", "present", "checksum",
        F.lit(observed).cast("bigint").alias("observed_rows"))


def q_star_schema(spark: SparkSession, sf: str) -> DataFrame:
    # Both jobs end to end (T13, T14): raw inputs derived from the given tables are written, the
    # staging job writes the five staged tables, the final job the fact and six dimensions; the
    # result has each column of each written table, summed up by Spark from the files.
    base = scratch_path(spark, "star_schema")
    raw = demo.write_raw_inputs(spark, sf, f"{base}/raw")
    observed: dict[str, int] = {}
    staged = run_stage(spark, raw, f"{base}/stage", row_counts=observed)
    final = run_final(spark, f"{base}/stage", f"{base}/final")
    tables = [(f"stage_{k}", read_csv(spark, p, multi_line=True) if k in _CSV_STAGED else read_table(spark, p),
               observed[k]) for k, p in staged.items()]
    tables += [(f"final_{k}", read_table(spark, p), None) for k, p in final.items()]
    return reduce(DataFrame.unionByName, [_column_sums(df, name, seen, name in ("stage_arrivals", "final_fact"))
                                          for name, df, seen in tables])


QUERIES: dict[str, Query] = {
    "missing_profile": q_missing_profile,
    "drop_sparse_columns": q_drop_sparse_columns,
    "drop_empty_rows": q_drop_empty_rows,
    "require_columns": q_require_columns,
    "dedupe_exact": q_dedupe_exact,
    "dedupe_by_key": q_dedupe_by_key,
    "clean_small_table": q_clean_small_table,
    "null_tokens": q_null_tokens,
    "conform_columns": q_conform_columns,
    "epoch_days": q_epoch_days,
    "parse_date": q_parse_date,
    "date_diff": q_date_diff,
    "calendar_dim": q_calendar_dim,
    "calendar_roundtrip": q_calendar_roundtrip,
    "visa_dim": q_visa_dim,
    "transport_mode_dim": q_transport_mode_dim,
    "ci_join": q_ci_join,
    "ci_join_sql": q_ci_join_sql,
    "group_mean": q_group_mean,
    "pivot_sum": q_pivot_sum,
    "pivot_sum_many": q_pivot_sum_many,
    "port_dim": q_port_dim,
    "port_dim_sparse": q_port_dim_sparse,
    "arrivals_fact": q_arrivals_fact,
    "star_report": q_star_report,
    "stage_arrivals": q_stage_arrivals,
    "stage_arrivals_all": q_stage_arrivals_all,
    "stage_demographics": q_stage_demographics,
    "stage_temperatures": q_stage_temperatures,
    "stage_countries": q_stage_countries,
    "stage_ports": q_stage_ports,
    "city_demographics_dim": q_city_demographics_dim,
    "star_schema": q_star_schema,
    "sas_transport_stage": q_sas_transport_stage,
    "dedupe_repeated_keys": q_dedupe_repeated_keys,
    "csv_quoted_breaks": q_csv_quoted_breaks,
    "replace_table": q_replace_table,
    "rejected_values": q_rejected_values,
    "fact_rejects": q_fact_rejects,
    "footer_profile": q_footer_profile,
    "arrivals_by_day": q_arrivals_by_day,
    "surrogate_keys": q_surrogate_keys,
    "ci_join_skewed": q_ci_join_skewed,
}


# ---- DuckDB twins ---------------------------------------------------------------------------

def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_NAN_TEXT = "('NaN', '+NaN', '-NaN')"

_GAPPY_EVENTS = """
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'NaN'::DOUBLE ELSE value END AS reading,
       CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 'NaN' ELSE event_type END AS label,
       CASE WHEN event_id % 4 <> 0 THEN ts END AS seen_at
FROM events"""

_PROFILE_TESTS = [
    ("event_id", "event_id IS NULL"),
    ("ts", "ts IS NULL"),
    ("user_id", "user_id IS NULL"),
    ("event_type", f"event_type IS NULL OR trim(event_type) IN {_NAN_TEXT}"),
    ("value", "value IS NULL OR isnan(value)"),
    ("reading", "reading IS NULL OR isnan(reading)"),
    ("label", f"label IS NULL OR trim(label) IN {_NAN_TEXT}"),
    ("seen_at", "seen_at IS NULL"),
]

_MISSING_PROFILE = (
    f"WITH g AS ({_GAPPY_EVENTS}),\n a AS (SELECT count(*) AS n, "
    + ", ".join(f"count(*) FILTER (WHERE {t}) AS m{i}" for i, (_, t) in enumerate(_PROFILE_TESTS))
    + " FROM g)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, m{i} AS missing, 100.0::DOUBLE * m{i} / nullif(n, 0) AS pct_missing FROM a"
        for i, (c, _) in enumerate(_PROFILE_TESTS)))

_DOUBLED_CUSTOMERS = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 10 = 0 THEN c_name END AS c_note
FROM customer
UNION ALL
SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END,
       CASE WHEN c_custkey % 50 <> 0 THEN c_name END,
       CASE WHEN c_custkey % 50 <> 0 THEN c_nationkey END,
       CASE WHEN c_custkey % 50 <> 0 THEN c_acctbal END,
       CASE WHEN c_custkey % 50 <> 0 THEN (CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END) END,
       CASE WHEN c_custkey % 50 <> 0 THEN (CASE WHEN c_custkey % 10 = 0 THEN c_name END) END
FROM customer"""

_STAYS = """
SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS arrival_date,
       CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS depart_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_CALENDAR = f"""
WITH s AS ({_STAYS}),
d AS (SELECT arrival_date AS date FROM s UNION SELECT depart_date FROM s)
SELECT date, CAST(dayofmonth(date) AS INTEGER) AS day, CAST(weekofyear(date) AS INTEGER) AS week,
       CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
       CAST(dayofweek(date) + 1 AS INTEGER) AS weekday,
       coalesce(CAST(year(date) * 10000 + month(date) * 100 + dayofmonth(date) AS BIGINT), -1) AS id
FROM d"""

_CI_JOIN = """
WITH t AS (
  SELECT c_name AS city,
         CASE c_custkey % 5
           WHEN 0 THEN 'nation_' || CAST(c_nationkey AS VARCHAR)
           WHEN 1 THEN 'Nation_' || CAST(c_nationkey AS VARCHAR)
           WHEN 2 THEN 'NATION_' || CAST(c_nationkey AS VARCHAR) || ' '
           WHEN 3 THEN NULL
           ELSE 'NATION_' || CAST(c_nationkey AS VARCHAR) END AS country,
         c_acctbal AS avg_temperature
  FROM customer)
SELECT t.city, n.n_nationkey AS country_id, t.country, t.avg_temperature
FROM t JOIN nation n ON lower(t.country) = lower(n.n_name)"""

_CLASSES = [(seg, sign) for seg in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
            for sign in ("credit", "debt")]

_PIVOT_SUM = (
    "SELECT c_nationkey, "
    + ", ".join(
        f"CAST(sum(CAST(trunc(c_acctbal) AS INTEGER)) FILTER (WHERE c_mktsegment = '{seg}' AND "
        f"c_acctbal {'>=' if sign == 'credit' else '<'} 0) AS BIGINT) AS {seg.lower()}_{sign}"
        for seg, sign in _CLASSES)
    + " FROM customer GROUP BY c_nationkey")


def _sas_date(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL OR isnan({col}) OR {col} = 0 THEN NULL "
            f"ELSE DATE '1960-01-01' + CAST(floor({col}) AS INTEGER) END")


_ARRIVALS_ORDER_SQL = ", ".join(f'"{c}" NULLS FIRST' for c in demo.ARRIVALS_ORDER)

_ARRIVED = "CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)"
_RAW_COLUMNS = {
    "cicid": "CAST(CASE WHEN l_orderkey % 97 <> 5 THEN l_orderkey * 10 + l_linenumber END AS DOUBLE)",
    "i94yr": "CAST(year(o_orderdate) AS DOUBLE)", "i94mon": "CAST(month(o_orderdate) AS DOUBLE)",
    "i94cit": "CAST(c_nationkey AS DOUBLE)", "i94res": "CAST(o_custkey % 25 AS DOUBLE)", "i94port": "o_orderpriority",
    "arrdate": f"CASE l_orderkey % 101 WHEN 1 THEN 0.0::DOUBLE WHEN 2 THEN NULL WHEN 3 THEN 'NaN'::DOUBLE "
               f"WHEN 4 THEN {_ARRIVED} + 0.5 ELSE {_ARRIVED} END",
    "i94mode": "CAST(CASE WHEN l_linenumber % 5 = 4 THEN 9 WHEN l_linenumber % 5 <> 0 THEN l_linenumber % 5 END AS DOUBLE)",
    "i94addr": "o_orderstatus",
    "depdate": f"CASE WHEN l_orderkey % 103 = 1 THEN {_ARRIVED} - 3 WHEN l_linenumber <> 7 "
               "THEN CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) END",
    "i94bir": "l_quantity", "i94visa": "CAST(CASE WHEN l_orderkey % 50 = 0 THEN 7 ELSE 1 + l_linenumber % 3 END AS DOUBLE)",
    "count": "1.0::DOUBLE", "biryear": "CAST(year(o_orderdate) - l_quantity AS DOUBLE)", "gender": "l_linestatus",
    "airline": "c_mktsegment", "visatype": "l_returnflag", "admnum": "CAST(l_orderkey AS DOUBLE)",
    **{c: c for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax")}}
_NOTHING = "(l_orderkey % 89 = 7 AND l_linenumber = 1)"
# The raw arrivals without the rows that hold nothing: staging drops those.
_RAW_ARRIVALS = ("SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in _RAW_COLUMNS.items())
                 + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
                 + f" WHERE NOT {_NOTHING}")
_STAGED_ARRIVALS = f"""SELECT * FROM ({_RAW_ARRIVALS})
QUALIFY cicid IS NULL OR row_number() OVER (PARTITION BY cicid ORDER BY {_ARRIVALS_ORDER_SQL}) = 1"""

_FACT = f"""
WITH d AS ({_STAGED_ARRIVALS}),
f AS (
  SELECT CAST(trunc(cicid) AS BIGINT) AS id, CAST(trunc(i94cit) AS INTEGER) AS birth_country_id,
         CAST(trunc(i94res) AS INTEGER) AS residence_country_id, i94port AS port_id,
         {_sas_date('arrdate')} AS arrival_date,
         CAST(trunc(i94mode) AS SMALLINT) AS transport_mode_id, i94addr AS arrival_state,
         {_sas_date('depdate')} AS depart_date,
         CAST(trunc(i94bir) AS INTEGER) AS age_in_yrs, CAST(trunc(i94visa) AS SMALLINT) AS visa,
         CAST(trunc("count") AS INTEGER) AS "count", CAST(trunc(biryear) AS INTEGER) AS birth_year,
         gender, airline, visatype, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax
  FROM d)"""

_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
# Rows with a larger count lose to the smaller text of the two; rows without a race are dropped.
_STAGED_DEMOGRAPHICS = """
WITH pc AS (SELECT c_nationkey, count(*) AS total, count(*) FILTER (WHERE c_custkey % 2 = 0) AS male,
                   count(*) FILTER (WHERE c_acctbal < 0) AS veterans
            FROM customer GROUP BY c_nationkey),
pr AS (SELECT c_nationkey, c_mktsegment, count(*) AS cnt FROM customer GROUP BY c_nationkey, c_mktsegment)
SELECT n_name AS "City", 'Region ' || CAST(n_regionkey AS VARCHAR) AS "State",
       CAST(CAST(30 + pc.c_nationkey / 2 AS DOUBLE) AS VARCHAR) AS "Median Age",
       CAST(male AS VARCHAR) AS "Male Population", CAST(total - male AS VARCHAR) || '.0' AS "Female Population",
       CAST(total AS VARCHAR) AS "Total Population",
       CASE WHEN pc.c_nationkey % 6 <> 0 THEN CAST(veterans AS VARCHAR) END AS "Number of Veterans",
       CAST(veterans AS VARCHAR) || '.0' AS "Foreign-born", '2.5' AS "Average Household Size",
       'R' || CAST(n_regionkey AS VARCHAR) AS "State Code",
       upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || '-Segment Members' AS "Race",
       least(CAST(cnt AS VARCHAR), CASE WHEN pr.c_nationkey % 4 = 0 THEN CAST(cnt + 1 AS VARCHAR) END) AS "Count"
FROM pr JOIN pc ON pr.c_nationkey = pc.c_nationkey JOIN nation ON pc.c_nationkey = n_nationkey"""
_CITY_DEMOGRAPHICS = (
    f"""
WITH sd AS ({_STAGED_DEMOGRAPHICS})
SELECT "City" AS city, "State" AS state, CAST("Median Age" AS FLOAT) AS median_age,
       CAST("Male Population" AS BIGINT) AS male_population,
       CAST(CAST("Female Population" AS DOUBLE) AS BIGINT) AS female_population,
       CAST("Total Population" AS BIGINT) AS total_population,
       CAST("Number of Veterans" AS BIGINT) AS number_of_veterans,
       CAST(CAST("Foreign-born" AS DOUBLE) AS BIGINT) AS foreign_born,
       CAST("Average Household Size" AS FLOAT) AS average_household_size, "State Code" AS state_code, """
    + ", ".join(f"""CAST(sum(CAST("Count" AS INTEGER)) FILTER (WHERE upper("Race") = '{seg}-SEGMENT MEMBERS') AS BIGINT)"""
                f" AS {seg.lower()}_segment_members" for seg in _SEGMENTS)
    + """
FROM sd GROUP BY ALL""")
_CITY = """CASE c_custkey % 6 WHEN 1 THEN 'O"Hare, ' || c WHEN 2 THEN 'two' || chr(10) || 'lines, ' || c
            WHEN 3 THEN ' ' || c || ' ' WHEN 4 THEN '"' || c || '"' ELSE c END"""
_PORTS = f"""SELECT 'P' || CAST(c_custkey AS VARCHAR) AS code, {_CITY} AS city,
       CASE WHEN c_nationkey % 5 <> 0 THEN 'S' || CAST(c_nationkey AS VARCHAR) END AS state, c_custkey
FROM (SELECT *, c_name || ', N' || CAST(c_nationkey AS VARCHAR) AS c FROM customer)"""

ORACLE_SQL: dict[str, str] = {
    "missing_profile": _MISSING_PROFILE,
    "drop_sparse_columns": """
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN event_id % 10 = 0 OR event_id % 100 = 1 THEN value END AS almost_sparse
FROM events""",
    "drop_empty_rows": f"""
WITH g AS ({_GAPPY_EVENTS})
SELECT reading, label FROM g WHERE NOT ((reading IS NULL OR isnan(reading)) AND label IS NULL)""",
    "require_columns": f"""
WITH g AS ({_GAPPY_EVENTS})
SELECT event_id, reading, label FROM g
WHERE reading IS NOT NULL AND NOT isnan(reading) AND label IS NOT NULL""",
    "dedupe_exact": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "dedupe_by_key": """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                           ORDER BY ts NULLS FIRST, event_id NULLS FIRST, value NULLS FIRST, props NULLS FIRST) = 1""",
    "clean_small_table": f"""
WITH d AS ({_DOUBLED_CUSTOMERS}),
k AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM d
      WHERE NOT (c_custkey IS NULL AND c_name IS NULL AND c_nationkey IS NULL
                 AND (c_acctbal IS NULL OR isnan(c_acctbal)) AND c_mktsegment IS NULL)
        AND c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL)
SELECT * FROM k
QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment
                           ORDER BY c_custkey NULLS FIRST, c_name NULLS FIRST, c_acctbal NULLS FIRST) = 1""",
    "null_tokens": f"""
WITH t AS (
  SELECT o_orderkey,
         CASE o_orderkey % 7 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN ' NA'
                             WHEN 4 THEN 'null' ELSE o_orderstatus END AS status,
         CASE o_orderkey % 11 WHEN 0 THEN '#N/A' WHEN 1 THEN 'None' WHEN 2 THEN 'NaN'
                              ELSE o_orderpriority END AS priority
  FROM orders)
SELECT o_orderkey,
       CASE WHEN status IN ({_sql_list(PANDAS_NA_TOKENS)}) THEN NULL ELSE status END AS status,
       CASE WHEN priority IN ({_sql_list(PANDAS_NA_TOKENS)}) THEN NULL ELSE priority END AS priority
FROM t""",
    "conform_columns": """
SELECT o_orderkey AS order_id,
       CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS customer_id,
       CAST(trunc(o_totalprice) AS INTEGER) AS total_price,
       CAST(o_totalprice AS FLOAT) AS price_f,
       o_orderstatus,
       CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""",
    "epoch_days": f"""
WITH s AS (
  SELECT o_orderkey,
         CASE o_orderkey % 100 WHEN 1 THEN 0.0::DOUBLE WHEN 2 THEN NULL WHEN 3 THEN 'NaN'::DOUBLE
                               WHEN 4 THEN -0.5::DOUBLE WHEN 5 THEN -366.25::DOUBLE
              ELSE CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) + 0.5
         END AS day_count
  FROM orders)
SELECT o_orderkey, day_count, {_sas_date('day_count')} AS arrival_date FROM s""",
    "parse_date": """
WITH d AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
         CASE o_orderkey % 9 WHEN 0 THEN 'D/S' WHEN 1 THEN '' WHEN 2 THEN NULL
              ELSE strftime(o_orderdate, '%m%d%Y') END AS order_text
  FROM orders)
SELECT o_orderkey, order_text, CASE WHEN o_orderkey % 9 > 2 THEN day END AS order_date, day AS slash_date,
       CAST(CASE WHEN o_orderkey % 2 = 1 THEN day + INTERVAL 40 YEAR ELSE day END AS DATE) AS short_date
FROM d""",
    "date_diff": f"""
WITH s AS ({_STAYS})
SELECT l_orderkey, l_linenumber, CAST(date_diff('day', arrival_date, depart_date) AS INTEGER) AS stay_days
FROM s""",
    "calendar_dim": _CALENDAR,
    "calendar_roundtrip": _CALENDAR,
    "visa_dim": """
WITH v AS (SELECT DISTINCT CAST(CASE WHEN o_custkey % 5 <> 0 THEN o_custkey % 5 - 1 END AS SMALLINT) AS visa_cat_id,
                           o_orderstatus AS visatype
           FROM orders)
SELECT visa_cat_id, visatype,
       CASE visa_cat_id WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS visa_cat
FROM v""",
    "transport_mode_dim": """
WITH m AS (SELECT DISTINCT CAST(CASE WHEN l_linenumber % 5 = 4 THEN 9
                                     WHEN l_linenumber % 5 <> 0 THEN l_linenumber % 5 END AS SMALLINT) AS id
           FROM lineitem)
SELECT id, CASE id WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land' WHEN 9 THEN 'Other' END AS mode
FROM m""",
    "ci_join": _CI_JOIN,
    "ci_join_sql": _CI_JOIN,
    "group_mean": """
SELECT c_mktsegment AS City, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS Country,
       avg(CASE WHEN c_custkey % 17 IN (0, 1, 2) THEN NULL ELSE floor(c_acctbal * 4) / 4 END) AS average_temperature
FROM customer GROUP BY 1, 2""",
    "pivot_sum": _PIVOT_SUM,
    "pivot_sum_many": "SELECT l_returnflag, " + ", ".join(
        f'CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_orderkey % 80 = {k}) AS BIGINT) AS "{k}.5"'
        for k in range(80)) + " FROM lineitem GROUP BY l_returnflag",
    "port_dim": f"SELECT code AS port_id, city, state FROM ({_PORTS})",
    "port_dim_sparse": f"""
SELECT code AS port_id, CASE WHEN c_custkey % 20 = 0 THEN city END AS city, state FROM ({_PORTS})""",
    "arrivals_fact": _FACT + """
SELECT *, CAST(date_diff('day', arrival_date, depart_date) AS INTEGER) AS stay_days FROM f""",
    "star_report": _FACT + """,
g AS (SELECT *, CAST(date_diff('day', arrival_date, depart_date) AS INTEGER) AS stay_days FROM f)
SELECT CAST(year(arrival_date) AS INTEGER) AS year, CAST(month(arrival_date) AS INTEGER) AS month,
       CASE transport_mode_id WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land' WHEN 9 THEN 'Other' END AS mode,
       count(*) AS arrivals,
       count(*) FILTER (WHERE visa = 1) AS business_arrivals,
       CAST(sum(stay_days) AS BIGINT) AS total_stay_days,
       sum(stay_days) / count(stay_days) AS avg_stay_days
FROM g GROUP BY 1, 2, 3""",
    "stage_arrivals": _STAGED_ARRIVALS,
    "stage_arrivals_all": _RAW_ARRIVALS,
    "stage_demographics": _STAGED_DEMOGRAPHICS,
    "stage_temperatures": """
WITH t AS (
  SELECT strftime(date_trunc('month', CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS dt,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'n/a'
              ELSE CAST(floor((o_totalprice % 4000) / 25) / 4 - 5 AS VARCHAR) END AS AverageTemperature,
         upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS City,
         'Nation_' || CAST(c_nationkey AS VARCHAR) AS Country
  FROM orders JOIN customer ON o_custkey = c_custkey),
d AS (SELECT dt, City, Country, min(AverageTemperature) AS AverageTemperature
      FROM t WHERE AverageTemperature IS NOT NULL GROUP BY dt, City, Country)
SELECT City, Country, avg(try_cast(AverageTemperature AS DOUBLE)) AS average_temperature
FROM d GROUP BY City, Country""",
    "stage_countries": """
SELECT DISTINCT
       CASE c_custkey % 50 WHEN 0 THEN NULL WHEN 1 THEN '9' || CAST(c_nationkey AS VARCHAR)
            ELSE CAST(c_nationkey AS VARCHAR) END AS Code,
       CASE c_custkey % 50 WHEN 0 THEN 'REGION_' || CAST(c_nationkey % 5 AS VARCHAR)
            WHEN 1 THEN 'Nation_' || CAST(c_nationkey AS VARCHAR) WHEN 2 THEN 'NATION_' || CAST(c_nationkey AS VARCHAR) || ' '
            WHEN 3 THEN NULL ELSE 'NATION_' || CAST(c_nationkey AS VARCHAR) END AS Country
FROM customer""",
    "stage_ports": f'SELECT DISTINCT code AS "Code", city AS "City", state AS "State" FROM ({_PORTS})',
    "city_demographics_dim": _CITY_DEMOGRAPHICS,
    # every number of a SAS file is a double, and a missing one is null, so NaN is too
    "sas_transport_stage": f"""
SELECT * REPLACE (CASE WHEN isnan(arrdate) THEN NULL ELSE arrdate END AS arrdate, CAST(l_partkey AS DOUBLE) AS l_partkey,
                  CAST(l_suppkey AS DOUBLE) AS l_suppkey) FROM ({_RAW_ARRIVALS})
QUALIFY cicid IS NULL OR row_number() OVER (PARTITION BY cicid ORDER BY {_ARRIVALS_ORDER_SQL}) = 1""",
    "dedupe_repeated_keys": """
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_quantity, l_extendedprice) = 1""",
    "csv_quoted_breaks": f'SELECT code AS "Code", city AS "City", state AS "State" FROM ({_PORTS})',
    "replace_table": f'SELECT code AS "Code", city AS "City", state AS "State" FROM ({_PORTS}) WHERE state IS NOT NULL',
    "rejected_values": """
WITH o AS (SELECT CAST(o_orderkey AS BIGINT) AS "OKEY", * FROM orders)
SELECT "OKEY", 'o_custkey' AS column_name, 'x' AS text FROM o WHERE o_custkey % 13 = 0
UNION ALL SELECT "OKEY", 'o_totalprice', CAST(o_totalprice AS VARCHAR) FROM o WHERE trunc(o_totalprice) NOT BETWEEN -32768 AND 32767""",
    "fact_rejects": f"""
WITH d AS (SELECT CAST(trunc(cicid) AS BIGINT) AS id, CAST(admnum AS BIGINT) AS k FROM ({_RAW_ARRIVALS}))
SELECT id, 'birth_year' AS column_name, '3.0E9' AS text FROM d WHERE k % 61 = 0
UNION ALL SELECT id, 'depart_date', '1.0E8' FROM d WHERE k % 59 = 0""",
    "footer_profile": "WITH e AS (SELECT count(*) AS n FROM events) " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({t}) AS missing, 100.0 * count(*) FILTER ({t}) / nullif(any_value(n), 0) AS pct_missing "
        "FROM events, e" for c, t in {**{c: "false" for c in ("event_id", "ts", "user_id", "event_type", "value")},
                                      "reading": "event_id % 5 IN (0, 1)", "label": "event_id % 3 IN (0, 1)", "seen_at": "event_id % 4 = 0",
                                      "buyer": "event_id % 6 = 0", "price": "event_id % 7 = 0", "day": "event_id % 8 = 0",
                                      "odd": "event_id % 9 = 0"}.items()),
    "arrivals_by_day": _FACT + """
SELECT arrival_date AS date, CAST(year(arrival_date) AS INTEGER) AS year, CAST(month(arrival_date) AS INTEGER) AS month,
       count(*) AS arrivals, CAST(sum(date_diff('day', arrival_date, depart_date)) AS BIGINT) AS total_stay_days
FROM f WHERE dayofweek(arrival_date) = 0 AND year(arrival_date) = 1995 GROUP BY 1, 2, 3""",
    "surrogate_keys": """
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'),
b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM a))
SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS key FROM a
UNION ALL SELECT o_custkey, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY o_custkey) FROM b""",
    "ci_join_skewed": """
SELECT l_orderkey, l_linenumber, country, n_nationkey AS "Code", n_name AS "Country"
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 'Nation_7' ELSE 'NATION_' || CAST(l_suppkey % 25 AS VARCHAR) END AS country
      FROM lineitem) JOIN nation ON lower(country) = lower(n_name)""",
}

_LABELS = "CASE {0} WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END"
_MODES = "CASE {0} WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land' WHEN 9 THEN 'Other' END"
_FACT_COLUMNS = ("id birth_country_id residence_country_id port_id arrival_date transport_mode_id arrival_state "
                 "depart_date age_in_yrs visa count birth_year gender airline visatype l_partkey l_suppkey "
                 "l_extendedprice l_discount l_tax stay_days").split()
# Each written table of the two jobs: its rows as SQL over the CTEs below, and its columns.
_WRITTEN = {
    "stage_arrivals": ("SELECT * FROM sa", tuple(_RAW_COLUMNS)),
    "stage_temperatures": ("SELECT * FROM st", ("City", "Country", "average_temperature")),
    "stage_demographics": ("SELECT * FROM sd", ("City", "State", "Median Age", "Male Population", "Female Population",
                                                "Total Population", "Number of Veterans", "Foreign-born",
                                                "Average Household Size", "State Code", "Race", "Count")),
    "stage_ports": ("SELECT * FROM sp", ("Code", "City", "State")),
    "stage_countries": ("SELECT * FROM sc", ("Code", "Country")),
    "final_fact": ("SELECT * FROM fact", tuple(_FACT_COLUMNS)),
    "final_calendar": ("SELECT * FROM calendar", ("date", "day", "weekday", "id", "year", "month", "week")),
    "final_visa": (f"SELECT DISTINCT visa AS visa_cat_id, visatype, {_LABELS.format('visa')} AS visa_cat FROM fact",
                   ("visa_cat_id", "visatype", "visa_cat")),
    "final_mode": (f"SELECT DISTINCT transport_mode_id AS id, {_MODES.format('transport_mode_id')} AS mode FROM fact",
                   ("id", "mode")),
    "final_temperature": ("SELECT st.City AS city, sc.Code AS country_id, st.Country AS country, "
                          "average_temperature AS avg_temperature FROM st JOIN sc ON lower(st.Country) = lower(sc.Country)",
                          ("city", "country_id", "country", "avg_temperature")),
    "final_demographics": ("SELECT * FROM cities", (
        "city", "state", "median_age", "male_population", "female_population", "total_population",
        "number_of_veterans", "foreign_born", "average_household_size", "state_code",
        *(f"{seg.lower()}_segment_members" for seg in _SEGMENTS))),
    "final_port": ('SELECT "Code" AS port_id, "City" AS city, "State" AS state FROM sp', ("port_id", "city", "state")),
}


def _sql_column_sums(name: str, rows: str, columns: tuple[str, ...]) -> str:
    parts = []
    for c in columns:
        # NaN has no whole number and counts as absent
        text = f'CAST(try_cast(round(try_cast(t."{c}" AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)' if c in _AS_NUMBER else f't."{c}"::VARCHAR'
        parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count({text}) AS present, "
                     f"CAST(sum(('0x' || md5({text})[1:8])::BIGINT) AS BIGINT) AS checksum, "
                     f"{'count(*)' if name.startswith('stage') else 'NULL'} AS observed_rows FROM ({rows}) t")
    return "\nUNION ALL ".join(parts)


ORACLE_SQL["star_schema"] = f"""
WITH sa AS MATERIALIZED ({_STAGED_ARRIVALS}),
fact AS MATERIALIZED ({ORACLE_SQL["arrivals_fact"]}),
st AS MATERIALIZED ({ORACLE_SQL["stage_temperatures"]}),
sc AS MATERIALIZED ({ORACLE_SQL["stage_countries"]}),
sp AS MATERIALIZED ({ORACLE_SQL["stage_ports"]}),
sd AS MATERIALIZED ({_STAGED_DEMOGRAPHICS}),
cities AS MATERIALIZED ({_CITY_DEMOGRAPHICS}),
dates AS (SELECT arrival_date AS date FROM fact UNION SELECT depart_date FROM fact),
calendar AS (SELECT {_CALENDAR.split("SELECT", 4)[-1].split("FROM d")[0]} FROM dates)
""" + "\nUNION ALL ".join(_sql_column_sums(n, rows, cols) for n, (rows, cols) in _WRITTEN.items())


__all__ = ["QUERIES", "ORACLE_SQL", "Query"]
