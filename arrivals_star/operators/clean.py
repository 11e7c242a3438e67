"""Cleaning (C1-C9): sparse columns, empty rows, required columns, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import qcol, resolve_names
from .profile import missing_profile, sparse_columns


def drop_sparse_columns(df: DataFrame, threshold: float = 90.0, protected: Sequence[str] = (),
                        profile: DataFrame | None = None) -> DataFrame:
    """Drop columns with at least ``threshold`` percent missing (C1); ``protected`` ones are kept.

    The only eager step of the cleaners: one aggregate scan, then the one-row-per-column profile
    is collected to decide the columns. Only unprotected columns are profiled, as the others stay
    whatever their count, so a columnar scan reads just those (none at all when every column is
    protected).
    """
    keep = {c.lower() for c in protected}
    candidates = [c for c in df.columns if c.lower() not in keep]
    if not candidates:
        return df
    prof = profile if profile is not None else missing_profile(df, candidates)
    drop = [c for c in sparse_columns(prof, threshold) if c.lower() not in keep]
    return df.drop(*drop) if drop else df


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is null (or NaN in a floating column)."""
    if not df.columns:
        raise ValueError("no columns left: every column was dropped, so every row would be empty")
    return df.dropna(how="all")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of ``columns`` is null, or NaN in a floating column (C4).

    Names ignore case; an unknown one raises.
    """
    return df.dropna(how="any", subset=resolve_names(df.columns, columns))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column; nulls compare equal."""
    return df.distinct()


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
                  keep_null_keys: bool = False) -> DataFrame:
    """Keep one row per key: the smallest by ``order``, then by every other column.

    Ordering compares nulls first, ascending. Because the ordering covers every column, the
    survivor does not depend on partitioning or file order. Null keys are equal to each other;
    with ``keep_null_keys`` a row with a null in its key is a key of its own and stays.

    Planned as ``min`` over one struct of the non-key columns in ranking order: since the
    ranking covers every column, the smallest struct is the surviving row, and the shuffle
    carries each row once (``min_by`` would carry it twice, as value and as ordering). A partial
    aggregate in each scan task keeps one row per key before the shuffle, so a key holding a
    third of the table sends one row per task, not a third of the table, to its reducer; a
    ``row_number`` window would ship and sort every row of that key in one task.

    Rows that ``keep_null_keys`` keeps go through the same scan and aggregate: their group key has
    a member of its own per row, which also spreads them over all reducers.
    """
    keys, order = resolve_names(df.columns, keys), resolve_names(df.columns, order)
    rest = [c for c in df.columns if c not in keys]
    own = _row_of_its_own(keys) if keep_null_keys else None
    group = [qcol(k) for k in keys] + ([own.alias("__own")] if keep_null_keys else [])
    if not rest:
        return df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).select(*[qcol(c) for c in df.columns])
    ranking = [c for c in order if c not in keys] + [c for c in rest if c not in order]
    kept = F.min(F.struct(*[qcol(c) for c in ranking]))
    return (df.groupBy(*group).agg(kept.alias("__kept"))
            .select(*[qcol(k) for k in keys], "__kept.*")
            .select(*[qcol(c) for c in df.columns]))


def _row_of_its_own(keys: Sequence[str]):
    """A number of its own for each row with a null key, null for the others."""
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | qcol(k).isNull()
    return F.when(unknown, F.monotonically_increasing_id())


def dedupe_repeated_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
                         keep_null_keys: bool = False) -> DataFrame:
    """The rows of ``dedupe_by_key``, for keys that seldom repeat.

    First the keys alone are counted: a hash aggregate over fixed-width sums, with partial counts
    per task, that reads the key columns only. Keys that occur once take no further part: their rows go
    from the scan to the result. Only rows of repeated keys are reduced. Both joins are plain: few
    repeated keys are broadcast by AQE, so no whole row is shuffled but those of repeated keys;
    """
    keys = resolve_names(df.columns, keys)
    found = df if not keep_null_keys else df.dropna(how="any", subset=keys)
    names = [f"__k{i}" for i in range(len(keys))]
    repeated = (found.groupBy(*[qcol(k).alias(n) for k, n in zip(keys, names)])
                .agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n"))
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & qcol(k).eqNullSafe(F.col(n))
    once = df.join(repeated, same, "left_anti")
    return once.unionByName(dedupe_by_key(df.join(repeated, same, "left_semi"), keys, order))


def clean(df: DataFrame, threshold: float | None = 90.0, keys: Sequence[str] = (), order: Sequence[str] = (),
          protected: Sequence[str] = (), observation: Observation | None = None) -> DataFrame:
    """The whole small-table cleaner (C9): C1, C2, then with keys C4 and a dedupe by key,
    without keys C5.

    With keys, the exact-duplicate pass is skipped: the key dedupe keeps the smallest whole row
    per key, which is the row an exact dedupe followed by a key dedupe would keep, so one shuffle
    does both. An ``observation`` records the output row count without an extra scan (C3).
    ``threshold=None`` skips the sparse-column step (for a caller that already dropped them).
    """
    sparse_dropped = df if threshold is None else drop_sparse_columns(df, threshold, protected)
    out = drop_empty_rows(sparse_dropped)
    if keys:
        out = dedupe_by_key(require_columns(out, keys), keys, order)
    else:
        out = dedupe_rows(out)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    return out


__all__ = ["drop_sparse_columns", "drop_empty_rows", "require_columns", "dedupe_rows",
           "dedupe_by_key", "dedupe_repeated_keys", "clean"]
