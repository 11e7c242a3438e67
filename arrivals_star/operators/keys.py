"""Rows numbered in a global order, and stable dense surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import qcol, resolve_names
from ..session import scratch_path

#: ``monotonically_increasing_id`` is (partition << ROW_BITS) + row.
ROW_BITS = 33


def stored_in_order(store: Callable[[DataFrame, str], DataFrame], df: DataFrame, by: Sequence[Column],
                    name: str) -> tuple[DataFrame, DataFrame]:
    """The rows written in ascending order with a column ``at``, and where each partition starts.

    ``store(frame, name)`` writes a frame and gives it back as read. ``at`` is
    partition << ROW_BITS | row. The second frame, (pid, start), has one row per partition:
    start + row is a row's place among all rows. Rows that ``by`` does not tell apart are split
    between partitions by their place in the input, so no group of them is one task's.
    """
    keyed = df.withColumn("tie", F.monotonically_increasing_id())
    order = [*by, F.col("tie").asc()]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = store(ranged.withColumn("at", F.monotonically_increasing_id()), name)
    counts = rows.groupBy(F.shiftright("at", ROW_BITS).alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    # one row per partition, so the running sum over all of them is small
    starts = counts.select("pid", (F.sum("n").over(Window.orderBy("pid")) - F.col("n")).alias("start"))
    return rows, starts


def place(at: Column, start: Column) -> Column:
    return start + at.bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def assign_keys(members: DataFrame, columns: Sequence[str], known: DataFrame | None = None,
                key: str = "key") -> DataFrame:
    """A number for every distinct member: (columns, key), old members first.

    Members in ``known`` (the result of the load before) keep their number. New ones follow the
    largest number without a gap, in the order of their columns, nulls first; the first load
    starts at 1. Null is a value like any other. Members that are in ``known`` only stay in it.

    New members are range-sorted once and written; a partition's first number is the sum of the
    counts of the partitions before it, so no task numbers all rows, as a window without
    partitions would. Only the largest number comes to the driver.
    """
    names = resolve_names(members.columns, columns)
    new, top = members.select(*[qcol(c) for c in names]).distinct(), 0
    if known is not None:
        kept = known.select(*[qcol(c) for c in names], qcol(key))
        same = F.lit(True)
        for c in names:
            same = same & new[f"`{c}`"].eqNullSafe(kept[f"`{c}`"])
        new = new.join(kept, same, "left_anti")
        top = known.agg(F.max(qcol(key))).first()[0] or 0
    rows, starts = stored_in_order(_stored, new, [qcol(c).asc_nulls_first() for c in names], "members")
    numbered = rows.join(F.broadcast(starts), F.shiftright("at", ROW_BITS) == F.col("pid")).select(  # a row per partition
        *[qcol(c) for c in names], (place(F.col("at"), F.col("start")) + top + 1).alias(key))
    return numbered if known is None else kept.unionByName(numbered)


__all__ = ["ROW_BITS", "stored_in_order", "place", "assign_keys"]
