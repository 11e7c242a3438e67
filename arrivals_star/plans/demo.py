"""Domain-shaped inputs derived by Spark from the given test tables.

The given tables hold no nulls, NaN or malformed text, so each frame below derives them from the
row keys (``key % n``): the derivation touches every row and keeps every row, so the work grows
with the tables. Each frame has a twin in SQL in ``registry.py`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key: Column, n: int, cases: dict[int, Column | object], default: Column) -> Column:
    """``CASE key % n WHEN k THEN v ... ELSE default END``."""
    expr = None
    for k, v in cases.items():
        v = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(key % n == k, v) if expr is None else expr.when(key % n == k, v)
    return expr.otherwise(default)


def _sas_days(ts: Column) -> Column:
    return F.datediff(ts.cast("date"), F.lit("1960-01-01").cast("date")).cast("double")


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events plus a double with null and NaN, a text with null and 'NaN', a timestamp with null."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        _case(k, 5, {0: F.lit(None).cast("double"), 1: F.lit(float("nan"))}, F.col("value")).alias("reading"),
        _case(k, 3, {0: F.lit(None).cast("string"), 1: "NaN"}, F.col("event_type")).alias("label"),
        F.when(k % 4 != 0, F.col("ts")).alias("seen_at"))


def sparse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events plus a column present on 1 row in 10 (90 % missing) and one on 11 in 100 (89 %)."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select("*", F.when(k % 10 == 0, F.col("value")).alias("sparse"),
                    F.when((k % 10 == 0) | (k % 100 == 1), F.col("value")).alias("almost_sparse"))


def doubled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer twice over: a 90 %-missing note, missing segments, and all-missing rows in the copy."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    cols = {"c_custkey": F.col("c_custkey"), "c_name": F.col("c_name"),
            "c_nationkey": F.col("c_nationkey"), "c_acctbal": F.col("c_acctbal"),
            "c_mktsegment": F.when(k % 4 != 0, F.col("c_mktsegment")),
            "c_note": F.when(k % 10 == 0, F.col("c_name"))}
    first = c.select(*[v.alias(n) for n, v in cols.items()])
    second = c.select(*[F.when(k % 50 != 0, v).alias(n) for n, v in cols.items()])
    return first.unionAll(second)


def token_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with missing-value tokens in two text columns, and ' NA' (not a token)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        _case(k, 7, {0: "NA", 1: "n/a", 2: "", 3: " NA", 4: "null"}, F.col("o_orderstatus")).alias("status"),
        _case(k, 11, {0: "#N/A", 1: "None", 2: "NaN"}, F.col("o_orderpriority")).alias("priority"))


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as text, as a CSV reader gives them: decimal text for whole numbers, malformed values."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("OKEY"),
        F.when(F.col("o_custkey") % 13 == 0, F.lit("x"))
         .otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.col("o_totalprice").cast("string").alias("price_f"),
        "o_orderstatus", "o_orderpriority",
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"))


def sas_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the order date as a SAS day count plus 0.5, and zero, null, NaN, negative counts."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey", _case(k, 100, {
        1: F.lit(0.0), 2: F.lit(None).cast("double"), 3: F.lit(float("nan")), 4: F.lit(-0.5),
        5: F.lit(-366.25)}, _sas_days(F.col("o_orderdate")) + 0.5).alias("day_count"))


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the order date as MMddyyyy text (and 'D/S', '', null), as month/day/year without
    leading zeros, and, 40 years on for odd keys, as ddMMyy (years 92-98 and 32-38)."""
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    later = F.when(k % 2 == 1, F.add_months(d, 480)).otherwise(d)
    return o.select("o_orderkey",
                    _case(k, 9, {0: "D/S", 1: "", 2: F.lit(None).cast("string")},
                          F.date_format(d, "MMddyyyy")).alias("order_text"),
                    F.concat_ws("/", F.month(d), F.dayofmonth(d), F.year(d)).alias("slash_text"),
                    F.date_format(later, "ddMMyy").alias("short_text"))


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order: arrival = order date, departure = ship date (null on line 7)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber",
                    F.col("o_orderdate").cast("date").alias("arrival_date"),
                    F.when(F.col("l_linenumber") != 7, F.col("l_shipdate").cast("date")).alias("depart_date"))


def visa_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as visa codes 0-3 (0 unknown) or null, with the status as visa type."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_custkey")
    return o.select(F.when(k % 5 != 0, k % 5 - 1).cast("smallint").alias("visa"),
                    F.col("o_orderstatus").alias("visatype"))


def mode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as transport mode codes 1, 2, 3, 9 or null."""
    li = table(spark, sf_dir, "lineitem")
    m = F.col("l_linenumber") % 5
    return li.select(F.when(m == 4, F.lit(9)).when(m != 0, m).cast("smallint").alias("transport_mode_id"))


def customer_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as (City, Country, average_temperature text); countries in mixed case, some with a
    trailing blank (no match) or null."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    nk = F.col("c_nationkey").cast("string")
    country = _case(k, 5, {0: F.concat(F.lit("nation_"), nk), 1: F.concat(F.lit("Nation_"), nk),
                           2: F.concat(F.lit("NATION_"), nk, F.lit(" ")),
                           3: F.lit(None).cast("string")},
                    F.concat(F.lit("NATION_"), nk))
    return c.select(F.col("c_name").alias("City"), country.alias("Country"),
                    F.col("c_acctbal").cast("string").alias("average_temperature"))


def nation_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as a country list (Code, Country)."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("Code"), F.col("n_name").alias("Country"))


def balance_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer balances in quarters as text by (segment, nation), with malformed, empty and null text."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    quarters = (F.floor(F.col("c_acctbal") * 4) / 4).cast("string")
    return c.select(F.col("c_mktsegment").alias("City"),
                    F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Country"),
                    _case(k, 17, {0: "x", 1: "", 2: F.lit(None).cast("string")}, quarters)
                    .alias("AverageTemperature"))


def balance_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as (nation, class, whole balance); classes like 'AUTOMOBILE Credit' / 'AUTOMOBILE-Debt'."""
    c = table(spark, sf_dir, "customer")
    cls = F.concat(F.col("c_mktsegment"),
                   F.when(F.col("c_acctbal") < 0, F.lit("-Debt")).otherwise(F.lit(" Credit")))
    return c.select("c_nationkey", cls.alias("class"), F.col("c_acctbal").cast("int").alias("balance"))


def order_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem quantities by return flag and one of 80 shares, a double."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_returnflag", (F.col("l_orderkey") % 80 + F.lit(0.5)).alias("share"),
                     F.col("l_quantity").cast("bigint").alias("quantity"))


def customer_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as a port list (Code, City, State): one port per customer, a comma inside City, or
    quotes or a line break or outer blanks, no State where the nation key is a multiple of 5."""
    c = table(spark, sf_dir, "customer")
    nk = F.col("c_nationkey")
    plain = F.concat(F.col("c_name"), F.lit(", N"), nk.cast("string"))
    city = _case(F.col("c_custkey"), 6, {
        1: F.concat(F.lit('O"Hare, '), plain), 2: F.concat(F.lit("two\nlines, "), plain),
        3: F.concat(F.lit(" "), plain, F.lit(" ")), 4: F.concat(F.lit('"'), plain, F.lit('"'))}, plain)
    return c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("Code"), city.alias("City"),
                    F.when(nk % 5 != 0, F.concat(F.lit("S"), nk.cast("string"))).alias("State"))


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arrivals in the SAS layout (numbers as double, dates as day counts): one row per line
    item with its order and customer. (l_orderkey, l_linenumber) repeats in the data, so ids repeat.

    Some rows have no id, a null, zero, NaN or fractional day count, a departure before the
    arrival, an unknown visa code, or nothing at all.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # the two smaller tables meet first, so that the line items are shuffled once, by order
    oc = o.join(c, o.o_custkey == c.c_custkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey)
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    mode, arrived = ln % 5, _sas_days(F.col("o_orderdate"))
    rows = j.select(
        F.when(k % 97 != 5, k * 10 + ln).cast("double").alias("cicid"),
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        (F.col("o_custkey") % 25).cast("double").alias("i94res"),
        F.col("o_orderpriority").alias("i94port"),
        _case(k, 101, {1: F.lit(0.0), 2: F.lit(None).cast("double"), 3: F.lit(float("nan")), 4: arrived + 0.5},
              arrived).alias("arrdate"),
        F.when(mode == 4, F.lit(9)).when(mode != 0, mode).cast("double").alias("i94mode"),
        F.col("o_orderstatus").alias("i94addr"),
        F.when(k % 103 == 1, arrived - 3).when(ln != 7, _sas_days(F.col("l_shipdate"))).alias("depdate"),
        F.col("l_quantity").alias("i94bir"),
        F.when(k % 50 == 0, 7).otherwise(1 + ln % 3).cast("double").alias("i94visa"),
        F.lit(1.0).alias("count"),
        (F.year("o_orderdate") - F.col("l_quantity")).cast("double").alias("biryear"),
        F.col("l_linestatus").alias("gender"),
        F.col("c_mktsegment").alias("airline"),
        F.col("l_returnflag").alias("visatype"),
        F.col("l_orderkey").cast("double").alias("admnum"),
        "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
        ((k % 89 == 7) & (ln == 1)).alias("nothing"))
    return rows.select(*[F.when(~F.col("nothing"), F.col(c)).alias(c) for c in rows.columns if c != "nothing"])


#: Rows of one file of a derived raw table, so that it is read by several tasks as real inputs are.
FILE_ROWS = 100_000


def written(df: DataFrame, path: str) -> DataFrame:
    """A derived raw table as Parquet, read back: a query that scans its input twice derives it once."""
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def odd_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arrivals with birth years that fit no int on one order in 61 and departures past the year
    9999 on one in 59."""
    a = raw_arrivals(spark, sf_dir)
    k = F.col("admnum").cast("bigint")
    return a.withColumns({"biryear": F.when(k % 61 == 0, F.lit(3e9)).otherwise(F.col("biryear")),
                          "depdate": F.when(k % 59 == 0, F.lit(1e8)).otherwise(F.col("depdate"))})


def footer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gappy events plus a whole number, a decimal, a date and a boolean with nulls."""
    g = gappy_events(spark, sf_dir)
    k = F.col("event_id")
    return g.withColumns({"buyer": F.when(k % 6 != 0, F.col("user_id")),
                          "price": F.when(k % 7 != 0, F.col("value").cast("decimal(18,2)")),
                          "day": F.when(k % 8 != 0, F.col("ts").cast("date")), "odd": F.when(k % 9 != 0, k % 2 == 1)})


def skewed_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a country name in mixed case, one third of all rows in one country."""
    li = table(spark, sf_dir, "lineitem")
    country = F.when(F.col("l_orderkey") % 3 == 0, F.lit("Nation_7")).otherwise(
        F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 25).cast("string")))
    return li.select("l_orderkey", "l_linenumber", country.alias("country"))


# Dedupe order for raw arrivals: every column but the id, then the tie-break columns.
ARRIVALS_ORDER = ("i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr",
                  "depdate", "i94bir", "i94visa", "count", "biryear", "gender", "airline", "visatype",
                  "admnum", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax")


def write_indexed_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header and a leading unnamed index column, as a pandas writer leaves it.

    The index is ``monotonically_increasing_id``: unique without a shuffle or a single-task sort.
    """
    _pandas_csv(df).csv(path)


def _pandas_csv(df: DataFrame, sep: str = ","):
    return (df.select(F.monotonically_increasing_id().alias(""), "*").write.mode("overwrite")
            .option("header", True).option("sep", sep).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_raw_demographics(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The raw city demographics as pandas-style CSV with ';' and a leading index column."""
    _pandas_csv(raw_demographics(spark, sf_dir), ";").csv(path)


def raw_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw monthly temperatures (all text, as read from CSV) per (segment city, nation country):
    several orders fall on one (dt, City, Country), with different readings; some readings are
    empty or malformed; an uncertainty column is 95 % missing."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = F.col("o_orderkey")
    # Quarter degrees from -5 to 35: sums of quarters are exact, so means do not depend on order.
    reading = (F.floor((F.col("o_totalprice") % 4000) / 25) / 4 - 5).cast("string")
    return j.select(
        F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "month"), "yyyy-MM-dd").alias("dt"),
        _case(k, 23, {0: F.lit(None).cast("string")}, _case(k, 29, {0: "n/a"}, reading)).alias("AverageTemperature"),
        F.when(k % 20 == 0, F.lit("0.5")).alias("AverageTemperatureUncertainty"),
        F.initcap(F.lower(F.col("c_mktsegment"))).alias("City"),
        F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string")).alias("Country"))


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw city demographics: one city per nation, one row per (city, segment) as 'race', counts
    of customers; whole numbers partly written as '1234.0', gaps, every row twice, in one nation
    of four once more with a larger count, and in one of seven once more without a race."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    per_city = (c.groupBy("c_nationkey")
                .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("c_custkey") % 2 == 0).alias("male"),
                     F.count_if(F.col("c_acctbal") < 0).alias("veterans")))
    per_race = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("cnt"))
    j = per_race.join(per_city, "c_nationkey").join(n, F.col("c_nationkey") == n.n_nationkey)
    nk = F.col("c_nationkey")
    rows = j.select(
        F.col("c_nationkey"), F.col("n_name").alias("City"),
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("State"),
        (F.lit(30.0) + nk / 2).cast("string").alias("Median Age"),
        F.col("male").cast("string").alias("Male Population"),
        (F.col("total") - F.col("male")).cast("double").cast("string").alias("Female Population"),
        F.col("total").cast("string").alias("Total Population"),
        F.when(nk % 6 != 0, F.col("veterans").cast("string")).alias("Number of Veterans"),
        F.concat(F.col("veterans").cast("string"), F.lit(".0")).alias("Foreign-born"),
        F.lit("2.5").alias("Average Household Size"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("State Code"),
        F.concat(F.initcap(F.lower(F.col("c_mktsegment"))), F.lit("-Segment Members")).alias("Race"),
        F.col("cnt").cast("string").alias("Count"))
    more = rows.where(nk % 4 == 0).withColumn("Count", (F.col("Count").cast("bigint") + 1).cast("string"))
    no_race = rows.where(nk % 7 == 0).withColumn("Race", F.lit(None).cast("string"))
    return rows.unionAll(rows).unionAll(more).unionAll(no_race).drop("c_nationkey")


def raw_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ports: the customer port list, every row twice."""
    p = customer_ports(spark, sf_dir)
    return p.unionAll(p)


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw countries, one row per customer: its nation's code and upper-case name; on some customers
    a region name with the literal code 'NA', the name in another case under another code (which
    fans out in the join), the name with a trailing blank (which does not match), or no name."""
    c = table(spark, sf_dir, "customer")
    nk, odd = F.col("c_nationkey"), F.col("c_custkey") % 50
    name = F.concat(F.lit("NATION_"), nk.cast("string"))
    return c.select(
        F.when(odd == 0, F.lit("NA")).when(odd == 1, F.concat(F.lit("9"), nk.cast("string")))
        .otherwise(nk.cast("string")).alias("Code"),
        F.when(odd == 0, F.concat(F.lit("REGION_"), (nk % 5).cast("string")))
        .when(odd == 1, F.initcap(F.lower(name))).when(odd == 2, F.concat(name, F.lit(" ")))
        .when(odd != 3, name).alias("Country"))


def empty_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The port list with a City on one port in 20 only (95 % missing)."""
    p = customer_ports(spark, sf_dir)
    return p.withColumn("City", F.when(F.substring("Code", 2, 20).cast("bigint") % 20 == 0, F.col("City")))


def write_raw_inputs(spark: SparkSession, sf_dir: str, out_dir: str):
    """Write the five raw inputs of the staging job under ``out_dir``; returns their ``RawInputs``.

    Arrivals as Parquet (with a 95 %-missing column), temperatures as CSV, and the three small
    tables as pandas-style CSV with a leading index column (demographics with ';').
    """
    from .jobs import RawInputs, together

    base = out_dir.rstrip("/")
    paths = RawInputs(arrivals=f"{base}/arrivals", temperatures=f"{base}/temperatures",
                      demographics=f"{base}/demographics", ports=f"{base}/ports",
                      countries=f"{base}/countries")
    together(spark, {
        "arrivals": lambda: (sparse_arrivals(spark, sf_dir).write.mode("overwrite")
                             .option("maxRecordsPerFile", FILE_ROWS).parquet(paths.arrivals)),
        "temperatures": lambda: (raw_temperatures(spark, sf_dir).write.mode("overwrite")
                                 .option("header", True).csv(paths.temperatures)),
        "demographics": lambda: write_raw_demographics(spark, sf_dir, paths.demographics),
        "ports": lambda: write_indexed_csv(raw_ports(spark, sf_dir), paths.ports),
        "countries": lambda: write_indexed_csv(raw_countries(spark, sf_dir), paths.countries)}, 5)
    return paths


def sparse_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arrivals plus a visa-post column present on 1 id in 20 (95 % missing)."""
    a = raw_arrivals(spark, sf_dir)
    return a.withColumn("visapost", F.when(F.col("cicid") % 20 == 1, F.lit("ABC")))
