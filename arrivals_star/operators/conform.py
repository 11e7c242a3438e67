"""Conforming names and types (J1-J3, J8) and the date rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_missing, lenient_cast, qcol, resolve_names, sas_days_to_date, text_to_date


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the named columns; names not in the table are ignored."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by an old→new map in one projection.

    Names match case-insensitively, as in Spark's default resolution; names not in the table
    are ignored. The map is applied once (no chains: a→b, b→c renames a to b and b to c).
    """
    lower = {k.lower(): v for k, v in mapping.items()}
    return df.select(*[qcol(c).alias(lower.get(c.lower(), c)) for c in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast columns by a name→type map in one projection, never failing a task.

    A name not in the table raises. Values that do not fit give null (see ``lenient_cast``).
    """
    fields = {f.name.lower(): f for f in df.schema.fields}
    resolve_names(fields, types)
    wanted = {k.lower(): v for k, v in types.items()}
    return df.select(*[
        lenient_cast(qcol(f.name), wanted[f.name.lower()], f.dataType).alias(f.name)
        if f.name.lower() in wanted else qcol(f.name)
        for f in df.schema.fields])


def keep_rejects(df: DataFrame, converted: Mapping[str, Column], name: str = "rejects",
                 observation: Observation | None = None) -> DataFrame:
    """Replace columns by their converted form and keep the values that the conversion lost.

    A value is lost if it was there (not null, NaN, NaN text or empty text) and its converted form
    is null. The new column ``name`` lists a row's lost values as (column, text), null for a row
    without any, which is next to nothing in a columnar file. An ``observation`` counts them per
    column. Both come from the scan that converts.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    unknown = [c for c in converted if c not in fields]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    lost = {}
    for c, new in converted.items():
        there = ~is_missing(qcol(c), fields[c])
        if isinstance(fields[c], T.StringType):
            there = there & (qcol(c) != "")
        lost[c] = there & new.isNull()
    told = F.array_compact(F.array(*[
        F.when(gone, F.struct(F.lit(c).alias("column_name"), qcol(c).cast("string").alias("text"))) for c, gone in lost.items()]))
    # flags first: the observation and the list read the columns as they were
    marked = df.withColumn(name, F.when(F.size(told) > 0, told))
    if observation is not None:
        marked = marked.observe(observation, *[F.count_if(gone).alias(c) for c, gone in lost.items()])
    return marked.select(*[converted[c].alias(c) if c in converted else qcol(c) for c in df.columns], qcol(name))


def cast_with_rejects(df: DataFrame, types: Mapping[str, str | T.DataType], name: str = "rejects",
                      observation: Observation | None = None) -> DataFrame:
    """``cast_columns`` that keeps the values it turns into null (J3, F10; see ``keep_rejects``)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = dict(zip(resolve_names(fields, types), types.values()))
    return keep_rejects(df, {c: lenient_cast(qcol(c), t, fields[c]) for c, t in names.items()}, name, observation)


def rejected_values(df: DataFrame, keys: Sequence[str], name: str = "rejects") -> DataFrame:
    """One row per lost value: the row's keys, ``column_name`` and ``text``.

    On a written table the scan reads the keys and the list only.
    """
    return df.where(qcol(name).isNotNull()).select(*[qcol(k) for k in resolve_names(df.columns, keys)], F.inline(qcol(name)))


def sas_dates_to_dates(df: DataFrame, columns: Sequence[str], zero_is_null: bool = True) -> DataFrame:
    """Replace SAS day-count columns with dates, in place (X1). Names ignore case; unknown ones raise."""
    wanted = set(resolve_names(df.columns, columns))
    return df.select(*[sas_days_to_date(qcol(c), zero_is_null).alias(c) if c in wanted else qcol(c)
                       for c in df.columns])


def text_to_date_column(df: DataFrame, column: str, strptime_format: str) -> DataFrame:
    """Replace a text column holding dates in a strptime format with a date column."""
    (name,) = resolve_names(df.columns, [column])
    return df.withColumn(name, text_to_date(qcol(name), strptime_format))


def with_day_span(df: DataFrame, name: str, end: str, start: str) -> DataFrame:
    """Add ``name = datediff(end, start)``: days from start to end, null if either is null."""
    return df.withColumn(name, F.datediff(qcol(end), qcol(start)))


def pivot_name(value: str) -> str:
    """Column name for a pivot value: lower case, spaces and hyphens to underscores."""
    return value.lower().replace(" ", "_").replace("-", "_")


def normalise_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Apply ``pivot_name`` to the given columns; two columns ending with one name raise."""
    targets = set(columns)
    names = [pivot_name(c) if c in targets else c for c in df.columns]
    seen: set[str] = set()
    clashes = sorted({n for n in names if n in seen or seen.add(n)})
    if clashes:
        raise ValueError(f"column names collide after normalising: {clashes}")
    return df.toDF(*names)


__all__ = ["drop_columns", "rename_columns", "cast_columns", "keep_rejects", "cast_with_rejects", "rejected_values", "sas_dates_to_dates",
           "text_to_date_column", "with_day_span", "pivot_name", "normalise_names"]
