"""The reference job's call sequence, through the compatibility names."""

import contextlib
import io

from pyspark.sql import functions as F

from arrivals_star import compat
from arrivals_star.plans import demo

SF = "/root/testdata/sf0.001"


def test_stage_and_final_call_sequence(spark, scratch):
    base = scratch("compat")
    raw = demo.write_raw_inputs(spark, SF, base + "/raw")
    stg, fin = base + "/stage/", base + "/final/"
    staged = [
        compat.create_immigration_stage_table(raw.arrivals, spark, stg + "sas_data"),
        compat.create_temperature_stage_table(raw.temperatures, spark, stg + "global_temperatures"),
        compat.create_us_cities_demographics_stage_table(raw.demographics, stg + "us-cities-demographics.csv"),
        compat.create_ports_stage_table(raw.ports, stg + "i94_ports.csv"),
        compat.create_country_stage_table(raw.countries, stg + "i94_countries.csv"),
    ]
    # Each staging function returns the table it wrote: its plan scans files and shuffles nothing.
    for df in staged:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "Exchange" not in buf.getvalue() and df.count() > 0
    arrivals, temps = staged[0], staged[1]
    known = arrivals.where("cicid IS NOT NULL")
    assert known.count() == known.select("cicid").distinct().count() < arrivals.count()
    assert dict(temps.dtypes)["average_temperature"] == "double"

    fact = compat.process_immigrant_stg_data(stg + "sas_data", spark, fin)
    time_df = compat.create_time_dim(fact, fin)
    visa_df = compat.create_visa_dim(fact, fin)
    mode_df = compat.create_transport_mode_dim(fact, fin)
    temp_df = compat.create_global_temp_dim(stg + "global_temperatures", stg + "i94_countries.csv", spark, fin)
    city_df = compat.create_us_cities_demographics_dim(spark, stg + "us-cities-demographics.csv", fin)
    port_df = compat.create_port_dim(stg + "i94_ports.csv", spark, fin)

    assert fact.count() == spark.read.parquet(stg + "sas_data").count()
    for name, df in [("time_dim", time_df), ("visa_dim", visa_df), ("transport_mode_dim", mode_df),
                     ("temperature_dim", temp_df), ("us_city_demographics_dim", city_df), ("port_dim", port_df)]:
        assert spark.read.parquet(fin + name).count() == df.count() > 0


def test_profile_and_cleaners(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, None, None), (2, None, "b")],
                               "k int, empty string, v string")
    prof = compat.missing_values_spark_data_frame(df)
    assert prof.columns == ["cols", "values", "% missing values"]
    assert {r.cols: r.values for r in prof.collect()} == {"k": 1, "empty": 4, "v": 1}
    cleaned = compat.clean_spark_dataframe(prof, df, 90)
    assert cleaned.columns == ["k", "v"] and cleaned.count() == 3
    small = compat.clean_pandas_df(compat.missing_values_pandas_dataframe(df), df, 90, cols=["k"])
    assert sorted(map(tuple, small.collect())) == [(1, "a"), (2, "b")]


def test_conform_helpers(spark):
    df = spark.createDataFrame([(20566.0, "04302016", "12.0")], "arrdate double, d string, n string")
    out = compat.change_datatype_of_cols(compat.rename_columns(compat.drop_columns(df, ["zz"]), {"n": "num"}),
                                         {"num": "int"})
    out = compat.change_string_col_to_date_col(compat.change_sas_date_to_iso_format(out, ["arrdate"]), "d", "%m%d%Y")
    r = out.select(F.col("arrdate").cast("string"), F.col("d").cast("string"), "num").first()
    assert tuple(r) == ("2016-04-22", "2016-04-30", 12)
