"""The reference job's function names and parameter orders, over this library's builders.

For callers switching over: each function keeps the name, arguments and side effect (the table
it writes) of the function it replaces, and returns a Spark DataFrame. What differs:

- profiles are Spark DataFrames with columns ``cols``, ``values``, ``% missing values`` (call
  ``toPandas()`` to get the small frame the reference returned); no chart is drawn;
- the three small-table stage functions, which took no session, use the active session, read
  and clean with Spark, and write a CSV folder without an index column;
- dates are ``DateType`` instead of ISO text, and casts never fail a task (see the README).

Output paths are concatenated with table names as before (``output_path + "time_dim"``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.clean import clean, drop_empty_rows, drop_sparse_columns
from .operators.conform import cast_columns, drop_columns as _drop_columns
from .operators.conform import rename_columns as _rename_columns
from .operators.conform import sas_dates_to_dates, text_to_date_column
from .operators.dims import (calendar_dim, city_demographics_dim, port_dim, temperature_dim,
                             transport_mode_dim, visa_dim, write_calendar)
from .operators.fact import arrivals_fact
from .operators.profile import missing_profile
from .plans.jobs import stage_arrivals, stage_countries, stage_demographics, stage_ports, stage_temperatures
from .sources import read_csv, read_small_csv, read_table
from .sources.sinks import write_csv, write_parquet


def _session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active Spark session")
    return spark


def _profile(df: DataFrame) -> DataFrame:
    return missing_profile(df).select(F.col("column_name").alias("cols"), F.col("missing").alias("values"),
                                      F.col("pct_missing").alias("% missing values"))


def _sparse_drop(nan_count_df: DataFrame, df: DataFrame, missing_range: float) -> DataFrame:
    """Drop by a profile the caller made: only its rows for columns of ``df`` are read."""
    profile = nan_count_df.where(F.col("cols").isin(df.columns)).select(
        F.col("cols").alias("column_name"), F.col("% missing values").alias("pct_missing")).distinct()
    return drop_sparse_columns(df, float(missing_range), profile=profile)


def _written_csv(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as CSV and return the written table, read with ``df``'s schema: a caller using
    the result reads the files instead of re-running the staging plan."""
    write_csv(df, path)
    return read_csv(df.sparkSession, path, schema=df.schema, multi_line=True)


# ---- staging --------------------------------------------------------------------------------

def missing_values_spark_data_frame(df: DataFrame) -> DataFrame:
    """Missing count and percent per column, one aggregate scan."""
    return _profile(df)


def missing_values_pandas_dataframe(df: DataFrame) -> DataFrame:
    """Same profile; the input is a Spark DataFrame here."""
    return _profile(df)


def clean_spark_dataframe(nan_count_df: DataFrame, df: DataFrame, missing_range: float = 90) -> DataFrame:
    """Drop columns at or above ``missing_range`` percent missing, then rows missing everywhere."""
    return drop_empty_rows(_sparse_drop(nan_count_df, df, missing_range))


def clean_pandas_df(nan_count_df: DataFrame, df: DataFrame, missing_range: float = 90,
                    cols: Iterable[str] = ()) -> DataFrame:
    """Sparse columns, empty rows, rows missing a key column, duplicates, one row per key."""
    return clean(_sparse_drop(nan_count_df, df, missing_range), None, keys=list(cols))


def create_immigration_stage_table(file_path: str, spark: SparkSession, final_output_path: str,
                                   fmt: str = "parquet", dedupe: bool = True) -> DataFrame:
    """Staged arrivals from ``file_path`` (any installed reader format), written as Parquet and
    returned read back, so using the result does not re-run the profile and dedupe.
    ``dedupe=False`` keeps rows that repeat an id."""
    write_parquet(stage_arrivals(read_table(spark, file_path, fmt), dedupe=dedupe), final_output_path)
    return read_table(spark, final_output_path)


def create_temperature_stage_table(file_path: str, spark: SparkSession, final_output_path: str) -> DataFrame:
    """Mean temperature per city and country, written as CSV."""
    return _written_csv(stage_temperatures(read_csv(spark, file_path, escape="\\")), final_output_path)


def create_us_cities_demographics_stage_table(input_file_path: str, output_file_path: str) -> DataFrame:
    return _written_csv(stage_demographics(read_small_csv(_session(), input_file_path, sep=";")), output_file_path)


def create_ports_stage_table(input_file_path: str, output_file_path: str) -> DataFrame:
    return _written_csv(stage_ports(read_small_csv(_session(), input_file_path)), output_file_path)


def create_country_stage_table(input_file_path: str, output_file_path: str) -> DataFrame:
    return _written_csv(stage_countries(read_small_csv(_session(), input_file_path)), output_file_path)


# ---- final ----------------------------------------------------------------------------------

def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return _drop_columns(df, list(cols))


def rename_columns(df: DataFrame, cols_dict: Mapping[str, str]) -> DataFrame:
    return _rename_columns(df, cols_dict)


def change_datatype_of_cols(df: DataFrame, data_type_dict: Mapping[str, str]) -> DataFrame:
    return cast_columns(df, data_type_dict)


def change_sas_date_to_iso_format(df: DataFrame, date_cols_list: Iterable[str]) -> DataFrame:
    return sas_dates_to_dates(df, list(date_cols_list))


def change_string_col_to_date_col(df: DataFrame, col: str, string_format: str) -> DataFrame:
    return text_to_date_column(df, col, string_format)


def create_time_dim(df: DataFrame, output_path: str) -> DataFrame:
    cal = calendar_dim(df)
    write_calendar(cal, output_path + "time_dim")
    return cal


def create_visa_dim(df: DataFrame, output_path: str) -> DataFrame:
    out = visa_dim(df)
    write_parquet(out, output_path + "visa_dim")
    return out


def create_transport_mode_dim(df: DataFrame, output_path: str) -> DataFrame:
    out = transport_mode_dim(df)
    write_parquet(out, output_path + "transport_mode_dim")
    return out


def create_port_dim(input_path: str, spark: SparkSession, output_path: str) -> DataFrame:
    out = port_dim(read_csv(spark, input_path, multi_line=True))
    write_parquet(out, output_path + "port_dim")
    return out


def create_global_temp_dim(input_path_temp: str, input_path_country: str, spark: SparkSession,
                           output_path: str) -> DataFrame:
    out = temperature_dim(read_csv(spark, input_path_temp), read_csv(spark, input_path_country, multi_line=True))
    write_parquet(out, output_path + "temperature_dim")
    return out


def create_us_cities_demographics_dim(spark: SparkSession, input_path: str, output_path: str) -> DataFrame:
    out = city_demographics_dim(read_csv(spark, input_path, multi_line=True))
    write_parquet(out, output_path + "us_city_demographics_dim")
    return out


def process_immigrant_stg_data(file_path: str, spark: SparkSession, output_path: str) -> DataFrame:
    """Writes the fact and returns it read back, so the dimensions built from the returned frame
    do not re-run the fact plan."""
    write_parquet(arrivals_fact(read_table(spark, file_path)), output_path + "immigration_fact")
    return read_table(spark, output_path + "immigration_fact")


__all__ = ["missing_values_spark_data_frame", "missing_values_pandas_dataframe", "clean_spark_dataframe",
           "clean_pandas_df", "create_immigration_stage_table", "create_temperature_stage_table",
           "create_us_cities_demographics_stage_table", "create_ports_stage_table",
           "create_country_stage_table", "drop_columns", "rename_columns", "change_datatype_of_cols",
           "change_sas_date_to_iso_format", "change_string_col_to_date_col", "create_time_dim",
           "create_visa_dim", "create_transport_mode_dim", "create_port_dim", "create_global_temp_dim",
           "create_us_cities_demographics_dim", "process_immigrant_stg_data"]
