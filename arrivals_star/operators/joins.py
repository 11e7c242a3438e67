"""Joins (JN1), also with a hot key inside a shuffle join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def join_ignore_case(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     how: str = "inner") -> DataFrame:
    """Equi-join on lower-cased text keys (JN1).

    Nulls never match and values are not trimmed; duplicate keys on the right fan out. No hint is
    given: a lookup table whose measured size is under the session's broadcast threshold is
    broadcast by AQE, and a larger one is joined by shuffle, where AQE splits a hot key.
    """
    return left.join(right, F.lower(left[_quoted(left_key)]) == F.lower(right[_quoted(right_key)]), how)


def heavy_hitters(df: DataFrame, key: Column, share: float, tracked: int = 10_000) -> list[str]:
    """Values of ``key`` that at least ``share`` of the rows have, by a mergeable frequency sketch.

    Each task keeps ``tracked`` items at most; counts err by a small part of rows / tracked, so
    a value near the share may be told or not, and a value far over it is always told. At most
    1 / share values reach the driver.
    """
    most = max(int(1 / share), 1)
    found = df.select(key.alias("k")).where("k IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"), F.call_function("approx_top_k", F.col("k"), F.lit(most), F.lit(tracked)).alias("top"))
    row = found.select("n", F.expr("transform(top, t -> struct(t.item AS item, t.count AS n))").alias("top")).first()
    return [t["item"] for t in row["top"] or [] if t["n"] >= share * row["n"]]


def join_ignore_case_skewed(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
                            share: float = 0.01, salts: int | None = None) -> DataFrame:
    """The rows of ``join_ignore_case`` where keys of ``left`` may be hot and ``right`` too large to broadcast.

    Keys that ``share`` or more of the left rows have are found first, by one scan of the key
    column. Rows of such a key are dealt over ``salts`` parts (the session's shuffle partitions without it), and the right rows of these keys are copied to each part; all other rows
    are joined as they are. At most 1 / share keys are copied, so the copies are bounded by the
    right rows of these keys times ``salts``. AQE's skew handling does the same from measured
    sizes, but only where a partition holds many map outputs; this holds for any input.
    """
    if how not in ("inner", "left", "leftouter", "left_outer", "semi", "leftsemi", "left_semi", "anti", "leftanti", "left_anti"):
        raise ValueError(f"right rows are copied, so a {how} join has no plain result")
    lk, rk = F.lower(left[_quoted(left_key)]), F.lower(right[_quoted(right_key)])
    hot = heavy_hitters(left, lk, share)
    if not hot:
        return join_ignore_case(left, right, left_key, right_key, how)
    if salts is None:
        salts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    dealt = left.withColumn("__part", F.when(lk.isin(hot), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0))
    all_parts = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    copied = right.withColumn("__copy", F.explode(F.when(rk.isin(hot), all_parts).otherwise(F.array(F.lit(0).cast("long")))))
    same = (F.lower(dealt[_quoted(left_key)]) == F.lower(copied[_quoted(right_key)])) & (dealt["__part"] == copied["__copy"])
    return dealt.join(copied, same, how).drop("__part", "__copy")


__all__ = ["join_ignore_case", "heavy_hitters", "join_ignore_case_skewed"]
