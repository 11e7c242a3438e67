"""Missing-value profile of a table (P1-P5): one aggregate scan, one row per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_missing, qcol


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count missing values per column.

    Returns ``column_name string, missing bigint, pct_missing double`` with one row per column,
    in column order. Missing means null, NaN in a floating column, or NaN text in a string column
    (see ``functions.is_missing``). ``pct_missing`` is ``100 * missing / rows``, computed in that
    order, and null for an empty table.

    All counts, the row count included, come from a single aggregate: every scan task sends one
    partial row to a single-partition final step, so the cost is one pass over the data whatever
    its size, and the result is as small as the column list.
    """
    names = list(columns) if columns is not None else list(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    counts = [F.count_if(is_missing(qcol(c), types[c])).alias(f"m{i}") for i, c in enumerate(names)]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing"))
                        for i, c in enumerate(names)])
    return (wide.select("rows", F.inline(entries))
            .select("column_name", "missing",
                    (F.lit(100.0) * F.col("missing") / F.nullif(F.col("rows"), F.lit(0)))
                    .alias("pct_missing")))


#: Session settings under which Spark answers counts of Parquet columns from the files' footers.
FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: rows, and n0, n1, ... values of each column that are not null (see ``footer_profile``)."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"),
                                        *[F.count(qcol(c)).alias(f"n{i}") for i, c in enumerate(columns)])


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``missing_profile`` of a Parquet table that reads the data of as few columns as it can.

    Where only null is missing, the footers know the count: whole numbers, decimals, booleans and dates are
    answered by Spark's aggregate push-down, without reading a page. Floating and text columns
    (which may hold NaN) and types without push-down are scanned, in one aggregate. Two small rows
    reach the driver.
    """
    df = spark.read.parquet(path)
    names = list(columns) if columns is not None else list(df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    counted = [c for c in names if isinstance(kinds[c], (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType))]
    scanned = [c for c in names if c not in counted]
    before = {k: spark.conf.get(k, None) for k in FOOTER_SETTINGS}
    for k, v in FOOTER_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        row = footer_counts(spark, path, counted).first()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    total = row["rows"] or 0  # no file, no footer: the counts are null
    missing = {c: total - (row[f"n{i}"] or 0) for i, c in enumerate(counted)}
    if scanned:
        missing |= {r["column_name"]: r["missing"] for r in missing_profile(df, scanned).collect()}
    rows = [(c, missing[c], 100.0 * missing[c] / total if total else None) for c in names]
    return spark.createDataFrame(rows, "column_name string, missing bigint, pct_missing double")


def sparse_columns(profile: DataFrame, threshold: float = 90.0) -> list[str]:
    """Names of columns whose percent missing is at least ``threshold`` (inclusive).

    Collects only the filtered profile, which has at most one row per column.
    """
    rows = profile.filter(F.col("pct_missing") >= F.lit(float(threshold))).select("column_name").collect()
    return [r.column_name for r in rows]


__all__ = ["missing_profile", "FOOTER_SETTINGS", "footer_counts", "footer_profile", "sparse_columns"]
