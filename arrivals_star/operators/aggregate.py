"""Aggregations: the grouped mean of staging (A1) and a report over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lenient_cast, qcol


def group_mean(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean of ``value`` read as double, by ``keys`` (A1); malformed text is ignored like null.

    Partial averages are combined in each task before the shuffle, so a hot key moves one row
    per task.
    """
    v = lenient_cast(qcol(value), "double", df.schema[value].dataType)
    return df.groupBy(*[qcol(k) for k in keys]).agg(F.avg(v).alias(name))


def stay_report(fact: DataFrame, calendar: DataFrame, modes: DataFrame, visas: DataFrame) -> DataFrame:
    """Arrivals and stays by arrival year, month and transport mode, read through the dimensions.

    Columns: year, month, mode, arrivals, business_arrivals, total_stay_days, avg_stay_days.

    The fact is first reduced to the grain of the join keys (date, mode, visa pair), which is
    bounded by days x modes x visa pairs however many arrivals there are; only that small table
    meets the dimensions.
    """
    pre = (fact.groupBy("arrival_date", "transport_mode_id", "visa", "visatype")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("stay_days").alias("stay_sum"),
                F.count("stay_days").alias("stay_n")))
    cal = calendar.select(F.col("date"), "year", "month")
    mode = modes.select(F.col("id"), "mode")
    visa = visas.select(F.col("visa_cat_id"), F.col("visatype").alias("v_type"), "visa_cat")
    joined = (pre.join(cal, pre.arrival_date == cal.date, "left")
              .join(mode, pre.transport_mode_id == mode.id, "left")
              .join(visa, (pre.visa == visa.visa_cat_id) & (pre.visatype == visa.v_type), "left"))
    return (joined.groupBy("year", "month", "mode")
            .agg(F.sum("n").alias("arrivals"),
                 F.coalesce(F.sum(F.when(F.col("visa_cat") == "Business", F.col("n"))), F.lit(0))
                 .cast("bigint").alias("business_arrivals"),
                 F.sum("stay_sum").alias("total_stay_days"),
                 (F.sum("stay_sum") / F.sum("stay_n")).alias("avg_stay_days")))


__all__ = ["group_mean", "stay_report"]
