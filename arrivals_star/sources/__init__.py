"""Readers (S1-S7). Every reader is lazy and declares no schema inference pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions import PANDAS_NA_TOKENS, null_tokens, qcol
from .quoted_csv import read_quoted_csv
from .replace import current_path
from .sas_transport import FORMAT as SAS_TRANSPORT, register_sas

# Name of the leading index column a pandas CSV writer leaves, as Spark's CSV reader names it.
INDEX_COLUMN = "_c0"


def drop_index_column(df: DataFrame) -> DataFrame:
    """Drop the unnamed leading index column of a CSV written by pandas, if present."""
    return df.drop(INDEX_COLUMN) if INDEX_COLUMN in df.columns else df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Scan a table in any installed format (S1, S6); e.g. ``fmt='parquet'`` for staged arrivals.

    ``sas_transport`` is this package's own reader of SAS transport files; for other SAS files pass
    the format name of an external reader that is on the classpath.
    """
    if fmt == SAS_TRANSPORT:
        register_sas(spark)
    else:
        path = current_path(spark, path)
    return spark.read.format(fmt).options(**options).load(path)


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
             schema: T.StructType | str | None = None, escape: str = '"',
             multi_line: bool = False) -> DataFrame:
    """Scan CSV with a header (S2-S4). Without ``schema`` every column is text, so no inference
    pass runs over the data; only the empty field reads as null.

    A quote inside a quoted value is doubled, as most writers do (``escape="\\\\"``: after a
    backslash). ``multi_line`` lets quoted values hold line breaks; a file is then read by one
    task, so it is for small tables only (``read_quoted_csv`` is for large ones).
    """
    path = current_path(spark, path)
    reader = (spark.read.option("sep", sep).option("header", header).option("escape", escape)
              .option("multiLine", multi_line))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def apply_null_tokens(df: DataFrame, tokens: Iterable[str] = PANDAS_NA_TOKENS,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Turn missing-value tokens ('NA', 'n/a', 'NULL', ...) into null in text columns.

    Defaults to pandas' read_csv tokens and every string column.
    """
    toks = tuple(tokens)
    names = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[null_tokens(qcol(c), toks).alias(c) if c in names else qcol(c)
                       for c in df.columns])


def read_small_csv(spark: SparkSession, path: str, sep: str = ",",
                   tokens: Iterable[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Scan one of the small CSV inputs the way the staging job expects them (S3-S5, S7):
    text columns, doubled quotes and quoted line breaks, missing-value tokens as null, a leading
    index column dropped."""
    return apply_null_tokens(drop_index_column(read_csv(spark, path, sep, multi_line=True)), tokens)


__all__ = ["INDEX_COLUMN", "read_table", "read_csv", "apply_null_tokens", "read_small_csv", "read_quoted_csv",
           "drop_index_column", "SAS_TRANSPORT", "register_sas"]
