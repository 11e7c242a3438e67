"""The arrivals fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import lenient_cast, qcol, resolve_names, sas_days_to_date
from ..sources.sinks import write_parquet
from .conform import cast_columns, drop_columns, keep_rejects, rename_columns, sas_dates_to_dates, with_day_span

# ---------------------------------------------------------------------------------------------
# The data model of the fact table. (The id is a bigint: at the volumes this is made
# for, ids pass 2,147,483,647, and an int would turn them into nulls.)
ARRIVALS_DROPPED = ("i94yr", "i94mon", "visapost", "entdepa", "entdepd", "matflag", "admnum",
                    "fltno", "dtadfile", "dtaddto")
ARRIVALS_NAMES = {"cicid": "id", "i94cit": "birth_country_id", "i94res": "residence_country_id",
                  "i94port": "port_id", "arrdate": "arrival_date", "i94mode": "transport_mode_id",
                  "i94addr": "arrival_state", "depdate": "depart_date", "i94bir": "age_in_yrs",
                  "i94visa": "visa", "biryear": "birth_year"}
ARRIVALS_TYPES = {"id": "bigint", "birth_country_id": "int", "residence_country_id": "int",
                  "port_id": "string", "transport_mode_id": "smallint", "arrival_state": "varchar(2)",
                  "age_in_yrs": "int", "visa": "smallint", "count": "int", "birth_year": "int",
                  "gender": "varchar(1)", "airline": "string", "visatype": "string"}
ARRIVALS_DATES = ("arrival_date", "depart_date")
# ---------------------------------------------------------------------------------------------

_RAW_NAME = {v: k for k, v in ARRIVALS_NAMES.items()}
# Raw columns the fact needs; staging must not drop them as sparse.
ARRIVALS_REQUIRED = tuple(_RAW_NAME.get(c, c) for c in [*ARRIVALS_TYPES, *ARRIVALS_DATES])


def arrivals_fact(staged: DataFrame, zero_is_null: bool = True) -> DataFrame:
    """Fact table from staged arrivals: drop, rename, cast, SAS dates to dates, stay_days.

    A single map-only projection (Catalyst collapses the steps): no shuffle, no Python. Columns
    keep their position; raw columns in none of the lists pass through; stay_days comes last.
    """
    df = cast_columns(rename_columns(drop_columns(staged, ARRIVALS_DROPPED), ARRIVALS_NAMES),
                      ARRIVALS_TYPES)
    df = sas_dates_to_dates(df, ARRIVALS_DATES, zero_is_null)
    return with_day_span(df, "stay_days", "depart_date", "arrival_date")


def arrivals_fact_with_rejects(staged: DataFrame, zero_is_null: bool = True, name: str = "rejects",
                               observation: Observation | None = None) -> DataFrame:
    """``arrivals_fact`` with a last column that lists the values its casts and dates lost.

    A zero day count that stands for no date is not lost. Same single projection; see
    ``keep_rejects`` for the counters and ``rejected_values`` for the rows.
    """
    df = rename_columns(drop_columns(staged, ARRIVALS_DROPPED), ARRIVALS_NAMES)
    fields = {f.name: f.dataType for f in df.schema.fields}
    casts = zip(resolve_names(fields, ARRIVALS_TYPES), ARRIVALS_TYPES.values())
    converted: dict[str, Column] = {c: lenient_cast(qcol(c), t, fields[c]) for c, t in casts}
    dates = resolve_names(fields, ARRIVALS_DATES)
    if zero_is_null:
        df = df.select(*[F.nullif(qcol(c), F.lit(0)).alias(c) if c in dates else qcol(c) for c in df.columns])
    converted |= {c: sas_days_to_date(qcol(c), zero_is_null) for c in dates}
    df = keep_rejects(df, converted, name, observation)
    return with_day_span(df, "stay_days", "depart_date", "arrival_date").select(
        *[qcol(c) for c in df.columns if c != name], "stay_days", qcol(name))


FACT_PARTITIONS = ("arrival_year", "arrival_month")


def write_fact_by_month(fact: DataFrame, path: str) -> None:
    """Write the fact in folders by year and month of arrival, so that a report over a part of the
    calendar reads only its months (S9). Rows are rebalanced by folder; a large month is split."""
    day = F.col("arrival_date")
    write_parquet(fact.withColumns({"arrival_year": F.year(day), "arrival_month": F.month(day)}), path, FACT_PARTITIONS)


def arrivals_by_day(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Arrivals and stays on the given days: date, year, month, arrivals, total_stay_days.

    ``fact`` is laid out by ``write_fact_by_month``; ``days`` are the wanted rows of the calendar,
    chosen by any of its columns. The join is on the folders' columns as well as on the date, so
    Spark prunes the fact's folders at run time by the months that the chosen days fall in. The
    fact is reduced to days before it meets the calendar's other columns.
    """
    wanted = days.select("date", F.col("year").alias("y"), F.col("month").alias("m"))
    met = fact.join(wanted, (F.col("arrival_year") == F.col("y")) & (F.col("arrival_month") == F.col("m"))
                    & (F.col("arrival_date") == F.col("date")))
    return met.groupBy("date", F.col("y").alias("year"), F.col("m").alias("month")).agg(
        F.count(F.lit(1)).alias("arrivals"), F.sum("stay_days").alias("total_stay_days"))


__all__ = ["arrivals_fact_with_rejects", "FACT_PARTITIONS", "write_fact_by_month", "arrivals_by_day", "ARRIVALS_DROPPED", "ARRIVALS_NAMES", "ARRIVALS_TYPES", "ARRIVALS_DATES",
           "ARRIVALS_REQUIRED", "arrivals_fact"]
