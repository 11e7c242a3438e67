"""CSV with quoted line breaks, read by many tasks per file.

Spark reads such a file with ``multiLine``, in one task. Here the file is read as lines, which
Spark splits, and the lines of a record are put together:

1. Each split of a file says how many quotes it holds: one grouped sum over the lines.
2. The running sum over the splits before it tells whether a split begins inside quotes.
3. Within a split a running sum does the same for each line. A line that begins outside of quotes
   and holds an even number of them is a whole record; only the lines of longer records are
   grouped, by the line that opens the record, which may lie in an earlier split.

Quotes must be doubled inside quoted values (RFC 4180) and stand only there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .replace import current_path


def quoted_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """One row per CSV record of a file or folder: ``record``, its text. Empty records are left out,
    and each file's first record that is not empty if it is the header."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))
    by_split = Window.partitionBy("file", "split").orderBy("at")
    so_far = by_split.rowsBetween(Window.unboundedPreceding, -1)
    # one row per split of a file
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("in_split"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("file").alias("f"), F.col("split").alias("s"),
                           F.coalesce(F.sum("in_split").over(earlier), F.lit(0)).alias("ahead"))
    outside = (F.col("ahead") + F.coalesce(F.sum("quotes").over(so_far), F.lit(0))) % 2 == 0
    lines = (lines.join(splits, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s")))
             .withColumn("outside", outside).withColumn("even", F.col("quotes") % 2 == 0))
    opens = F.col("outside") & ~F.col("even")
    to_here = by_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("opened", F.last(F.when(opens, F.col("at")), ignorenulls=True).over(to_here))
    filled = F.col("outside") & (F.trim(F.regexp_replace("value", "\r$", "")) != "")
    first = F.min(F.when(filled & (F.col("split") == 0), F.col("at"))).over(Window.partitionBy("file", "split"))
    lines = lines.withColumn("is_header", F.coalesce(F.col("at") == first, F.lit(False)) if header else F.lit(False))

    whole = lines.where("outside AND even AND NOT is_header").where(filled).select(F.col("value").alias("record"))
    # lines of longer records; those of a record that an earlier split opens get its last opening line
    part = lines.where("NOT (outside AND even)")
    opened = part.groupBy("file", "split").agg(F.max("opened").alias("last_opened"))
    opened = opened.select(F.col("file").alias("f"), F.col("split").alias("s"),
                           F.last("last_opened", ignorenulls=True).over(earlier).alias("opened_before"))
    part = part.drop("f", "s").join(opened, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s")))
    part = part.withColumn("owner", F.coalesce("opened", "opened_before"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "at", "value"))), lambda x: x["value"]), "\n")
    longer = (part.groupBy("file", "owner").agg(joined.alias("record"), F.bool_or("is_header").alias("is_header"))
              .where("NOT is_header").select("record"))
    return whole.unionByName(longer).select(F.regexp_replace("record", "\r$", "").alias("record"))


def read_quoted_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                    schema: T.StructType | str | None = None) -> DataFrame:
    """Scan CSV whose quoted values may hold line breaks; rows as ``multiLine`` gives them.

    Without ``schema`` every column is text, named by the header of the first file. Lines are
    shuffled once, by split; a record's text is then parsed by Spark's CSV parser.
    """
    path = current_path(spark, path)
    if schema is None:
        schema = spark.read.options(sep=sep, header=header, escape='"', multiLine=True).csv(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    ddl = ", ".join("`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() for f in schema.fields)
    # multiLine keeps the line breaks of a value as they are
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    records = quoted_records(spark, path, header)
    return records.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")


__all__ = ["quoted_records", "read_quoted_csv"]
