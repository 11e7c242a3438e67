"""Writers (S8-S10). Each writes once; nothing is collected to the driver.

A table that is there already is replaced only when the new one is complete (see ``replace.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .replace import replace_table


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), tasks: int | None = None) -> None:
    """Write Parquet, replacing what is there.

    With ``partition_by`` (S9) rows are first brought together by those columns, so a folder gets
    one file and not one per task. By default Spark rebalances: AQE merges small shuffle
    partitions and splits those a hot folder makes large, from measured sizes, however many
    shuffle partitions the session has. For a table of a known small bound whose folders hold a
    few rows each, ``tasks`` gives the number of writing tasks instead, as rebalancing by size
    would leave all its files to one task.
    """
    if partition_by:
        keys = [F.col(c) for c in partition_by]
        df = df.repartition(tasks, *keys) if tasks else df.hint("rebalance", *keys)
    replace_table(df.sparkSession, path, lambda folder: df.write.partitionBy(*partition_by).parquet(folder))


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write CSV with a header, replacing what is there (S10); no index column, written by the
    executors in parallel rather than through a driver-side frame.

    Values are kept as they are, outer blanks included; quotes are doubled. A value with a line
    break is quoted, so a table that may hold one is read back with ``read_csv(multi_line=True)``.
    """
    writer = (df.write.option("header", True).option("sep", sep).option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    replace_table(df.sparkSession, path, writer.csv)


__all__ = ["write_parquet", "write_csv"]
