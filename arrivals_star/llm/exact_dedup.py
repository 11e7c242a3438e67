"""Exact dedup: tree-merge of sorted digest runs.

Each partition sorts the digests of its texts into runs, one per range of digests, in which a
digest appears once with its smallest id and its count. In rounds, every node of a range sends its
runs to the lowest node of its group of ``FAN``, which merges them; after the last round node 0 of
each range holds the group of every digest. Ranges are as many as shuffle partitions, so no task
holds all digests, and a text that a third of the rows share is one entry of a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import merge

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from arrivals_star.llm.runs import MAX_ID, arrow_rows, shuffle_partitions

FAN = 8
DIGEST = 32
RUN_ROWS = 1 << 18  # digests that one run holds at most; a partition makes as many runs as it needs
RUN = "part int, node int, digests binary, ids binary, counts binary, sizes binary"
GROUP = "digest binary, keep_id long, group_size long"


def normalised(text):
    """Text with every run of the six ASCII blanks as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _pack(part: int, node: int, rows: list[tuple[bytes, int, int, int]]) -> tuple:
    digests, ids, counts, sizes = zip(*rows)
    as_bytes = lambda x: np.array(x, np.int64).tobytes()
    return part, node, b"".join(digests), as_bytes(ids), as_bytes(counts), as_bytes(sizes)


def _rows(row: dict) -> Iterator[tuple[bytes, int, int, int]]:
    d = row["digests"]
    cols = [np.frombuffer(row[c], np.int64).tolist() for c in ("ids", "counts", "sizes")]
    return zip((d[i:i + DIGEST] for i in range(0, len(d), DIGEST)), *cols)


def _fold(rows: Iterator[tuple[bytes, int, int, int]]) -> Iterator[tuple[bytes, int, int, int]]:
    """One row per digest of a sorted stream: smallest id, summed count, verified length."""
    last = None
    for digest, doc, count, size in rows:
        if last is not None and digest == last[0]:
            if size != last[3]:
                raise ValueError(f"two texts of {size} and {last[3]} bytes have the digest {digest.hex()}")
            last = (digest, min(last[1], doc), last[2] + count, size)
        else:
            if last is not None:
                yield last
            last = (digest, doc, count, size)
    if last is not None:
        yield last


def sorted_runs(n_parts: int, n_nodes: int):
    """Sorted runs of one partition, one per range of digests."""
    def emit(node: int, digests: list[bytes], ids: list[int], sizes: list[int]) -> pa.RecordBatch:
        by_part: dict[int, list] = {}
        for row in _fold(iter(sorted(zip(digests, ids, [1] * len(ids), sizes)))):
            by_part.setdefault(int.from_bytes(row[0][:4]) % n_parts, []).append(row)
        rows = [_pack(p, node, x) for p, x in by_part.items()]
        return arrow_rows(rows, RUN).combine_chunks().to_batches()[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId() % n_nodes
        digests, ids, sizes = [], [], []
        for batch in batches:
            digests += batch["digest"].to_pylist()
            ids += batch["doc_id"].fill_null(MAX_ID).to_pylist()
            sizes += batch["size"].to_pylist()
            if len(digests) >= RUN_ROWS:
                yield emit(node, digests, ids, sizes)
                digests, ids, sizes = [], [], []
        if digests:
            yield emit(node, digests, ids, sizes)
    return work


def merge_round(key: tuple, table: pa.Table) -> pa.Table:
    """Merge the runs that meet at one node; the result is one run of the lowest node."""
    rows = table.to_pylist()
    merged = list(_fold(merge(*map(_rows, rows))))
    return arrow_rows([_pack(rows[0]["part"], min(r["node"] for r in rows), merged)], RUN)


def open_root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            got = [(d, None if doc == MAX_ID else doc, n) for d, doc, n, _ in _rows(row)]
            yield from arrow_rows(got, GROUP).to_batches()


def exact_groups(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, size) of every row, and (digest, keep_id, group_size) of every text."""
    text = normalised(F.col(text_col))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("norm")).select(
        "doc_id", F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").cast("long").alias("size"))
    n = shuffle_partitions(df)
    rounds = 1
    while FAN ** rounds < n:
        rounds += 1
    runs = rows.mapInArrow(sorted_runs(n, FAN ** rounds), RUN)
    for k in range(1, rounds + 1):
        runs = (runs.withColumn("meet", (F.col("node") / F.lit(FAN ** k)).cast("int"))
                .groupBy("part", "meet").applyInArrow(merge_round, RUN))
    return rows, runs.mapInArrow(open_root, GROUP)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal when they are after replacing each run of ASCII blanks by one space; null is
    empty. The smallest id of a group stays (``kept``). Null ids come after all others; a group
    whose ids are all null has a null ``keep_id`` and all its rows stay, as do rows that repeat
    the kept id. Other columns are ignored; an empty table gives an empty result.
    """
    rows, groups = exact_groups(df, id_col, text_col)
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM t JOIN g USING (text_sha256)
"""

__all__ = ["exact_dedup", "op9_exact_dedup", "OP9_SQL"]
