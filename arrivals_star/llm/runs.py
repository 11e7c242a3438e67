"""Documents grouped into runs, and exchanges between runs and buckets.

Operators that compare every part of every document with every other share this shape:

* a *run* holds whole documents (by a hash of the id) and is one task's input;
* each run sends each *bucket* of the key space one compressed row, in which a key that the run
  holds many times appears once: a key that a third of all documents share reaches its bucket
  once per run, not once per document;
* the bucket answers every run with one compressed row.

The documents are shuffled once; Spark reuses that exchange wherever the plan needs runs again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

RUN_BYTES = 8 << 20
MAX_ID = (1 << 63) - 1


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def documents_in_runs(df: DataFrame, id_col: str, text_col: str, run_bytes: int = RUN_BYTES) -> tuple[DataFrame, int, int]:
    """(run, doc_id, text as bytes), the number of runs and the bytes of all texts.

    Null text counts as empty. At least one run per shuffle partition, and as many as hold
    ``run_bytes`` each. Rows with a null id keep it and go to one of the runs by their text.
    """
    picked = df.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(shuffle_partitions(df), -(-size // run_bytes))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    run = F.pmod(key, F.lit(n)).cast("int")
    return picked.select(run.alias("run"), "doc_id", "text"), n, size


ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(),
         "string": pa.string(), "boolean": pa.bool_()}


def arrow_rows(rows: list[tuple], ddl: str) -> pa.Table:
    """Arrow table of Python rows, with the types of a Spark schema text."""
    fields = [x.split() for x in ddl.split(", ")]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, ARROW[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])
