"""Vector code compression: product codes with integer codebooks, found through memoised grid cells.

A vector of integers is cut into equal parts; each part position has a codebook whose entries are
moved in rounds to the floor of the mean of the parts nearest to them. Finding the nearest entry:

* a part lies in a coarse grid cell, a box of side ``cell``. The cell's hash names a slot of a
  table; the slot holds the cell and the entries that are not dominated across its box. An entry is
  dominated if its smallest distance to the box is over another entry's largest distance to it.
* only the entries of the part's cell are evaluated exactly. A tie goes to the lower index, and an
  entry that ties with the nearest one anywhere in the box is never dominated.

The table has a fixed size: a cell that finds its slot taken by another one takes the slot over.
Every round is one pass over the vectors, which gives a few sums per task; only codebooks (entries
x dimensions numbers) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arrivals_star.llm.spans import U64, mix
from arrivals_star.llm.tables import Tables

CELL = 512
LARGE = 1 << 26  # past it, squared distances may not fit 64 bits
MOST = 1 << 40  # larger components count as this
MOST_ERROR = (1 << 63) - 1
SLOT_BITS = 14
ROWS = 8192  # vectors that are evaluated at once
SUMS = "part int, entry int, position int, total long, n long"


class CellTable:
    """Entries not dominated in each grid cell met so far, for one codebook (entries x width)."""

    def __init__(self, book: np.ndarray, cell: int):
        if not 0 < cell <= LARGE:
            raise ValueError(f"a cell's side is 1 to {LARGE}, not {cell}")
        self.book, self.cell = book, cell
        slots = 1 << SLOT_BITS
        self.cells = np.zeros((slots, book.shape[1]), np.int64)
        self.filled = np.zeros(slots, bool)
        self.stays = np.zeros((slots, len(book)), bool)
        rng = np.random.default_rng(5)
        self.factors = rng.integers(1, 1 << 62, book.shape[1], dtype=np.uint64) * U64(2) + U64(1)
        self.met = self.opened = 0

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """Mask (cells x entries) from smallest and largest distance between entry and box."""
        low = (cells * self.cell)[:, None, :]
        high = low + (self.cell - 1)
        to_low, to_high = low - self.book, self.book - high
        nearest = np.maximum(np.maximum(to_low, to_high), 0)
        farthest = np.maximum(np.abs(to_low), np.abs(to_high))
        least, most = (nearest ** 2).sum(axis=2), (farthest ** 2).sum(axis=2)
        return least <= most.min(axis=1)[:, None]

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Mask (parts x entries) of the entries that must be evaluated."""
        cells = x // self.cell
        with np.errstate(over="ignore"):
            slot = (mix((cells.view(U64) * self.factors).sum(axis=1, dtype=U64)) & U64((1 << SLOT_BITS) - 1)).astype(np.int64)
        miss = np.flatnonzero(~self.filled[slot] | (self.cells[slot] != cells).any(axis=1))
        out = self.stays[slot]
        self.met += len(x)
        if len(miss):
            # the first part of each slot takes it; the other parts of its cell read what it wrote
            _, first = np.unique(slot[miss], return_index=True)
            new = miss[first]
            self.cells[slot[new]], self.filled[slot[new]] = cells[new], True
            self.stays[slot[new]] = self.undominated(cells[new])
            self.opened += len(new)
            out[miss] = self.stays[slot[miss]]
            other = miss[(self.cells[slot[miss]] != cells[miss]).any(axis=1)]
            if len(other):  # two cells of one slot in the same block
                out[other] = self.undominated(cells[other])
                self.opened += len(other)
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, lower ones first, and its squared distance."""
        if max(np.abs(x).max(initial=0), np.abs(self.book).max(initial=0)) > LARGE:
            far = ((x.astype(object)[:, None] - self.book) ** 2).sum(axis=2)  # Python's integers
            code = far.argmin(axis=1).astype(np.int64)
            return code, np.minimum(far[np.arange(len(x)), code], MOST_ERROR)
        part, entry = np.nonzero(self.candidates(x))
        far = ((x[part] - self.book[entry]) ** 2).sum(axis=1)
        opens = np.searchsorted(part, np.arange(len(x)))
        least = np.minimum.reduceat(far, opens) if len(x) else far
        hit = np.flatnonzero(far == np.repeat(least, np.diff(np.append(opens, len(part)))))
        _, first = np.unique(part[hit], return_index=True)
        return entry[hit[first]], least


def whole_vectors(col: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have ``dim`` finite components, and floor(scale * component) of them."""
    col = col.cast(pa.list_(pa.float64())) if not pa.types.is_list(col.type) else col
    lengths = col.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = col.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    size = np.maximum(lengths, 0)
    starts = np.cumsum(size) - size
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    keep = np.flatnonzero((lengths == dim) & (bad[starts + size] == bad[starts]))
    return keep, scaled(flat[starts[keep][:, None] + np.arange(dim)], scale)


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -MOST, MOST).astype(np.int64)


def _blocks(v: np.ndarray) -> Iterator[np.ndarray]:
    for a in range(0, len(v), ROWS):
        yield v[a:a + ROWS]


def part_sums(books: np.ndarray, scale: int, cell: int):
    """Per part position and entry: the sum of the parts assigned to it, by dimension, and their number."""
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [CellTable(b, cell) for b in books]
        total, n = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for v in _blocks(whole_vectors(batch["v"], parts * width, scale)[1]):
                for p, table in enumerate(tables):
                    x = np.ascontiguousarray(v[:, p * width:(p + 1) * width])
                    code, _ = table.nearest(x)
                    np.add.at(total[p], code, x)
                    n[p] += np.bincount(code, minlength=entries)
        p, e = np.nonzero(n)
        at = np.repeat(np.arange(len(p)), width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p[at].astype(np.int32)), pa.array(e[at].astype(np.int32)),
             pa.array(np.tile(np.arange(width, dtype=np.int32), len(p))), pa.array(total[p, e].reshape(-1)), pa.array(n[p, e][at])],
            names=["part", "entry", "position", "total", "n"])
    return work


def part_codes(books: np.ndarray, scale: int, cell: int):
    """id, label, code and error of every row that has a whole vector."""
    parts, _, width = books.shape
    digits = np.array([f"{k:02x}" for k in range(256)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [CellTable(b, cell) for b in books]
        for batch in batches:
            keep, whole = whole_vectors(batch["v"], parts * width, scale)
            codes, errors = [], []
            for v in _blocks(whole):
                found = [t.nearest(np.ascontiguousarray(v[:, p * width:(p + 1) * width])) for p, t in enumerate(tables)]
                codes += ["".join(row) for row in digits[np.stack([c for c, _ in found], axis=1)]]
                errors.append(np.minimum(np.sum([e.astype(object) for _, e in found], axis=0), MOST_ERROR).astype(np.int64)
                              if any(e.dtype == object for _, e in found) else np.sum([e for _, e in found], axis=0))
            at = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(at), batch["label"].take(at), pa.array(codes, pa.string()),
                 pa.array(np.concatenate(errors) if errors else np.zeros(0, np.int64))], names=["id", "label", "code", "error"])
    return work


def first_books(rows: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray:
    """Codebooks (parts x entries x width) of the parts of the rows with the smallest ids."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    seeds = (rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & F.forall("v", finite))
             .orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect())
    same = [r["v"] for r in seeds if len(r["v"]) == len(seeds[0]["v"])]
    if not same:
        return np.zeros((parts, 0, 0), np.int64)
    m = scaled(np.array(same, np.float64), scale)
    return np.ascontiguousarray(m.reshape(len(m), parts, -1).transpose(1, 0, 2))


def train_books(rows: DataFrame, books: np.ndarray, rounds: int, scale: int, cell: int) -> np.ndarray:
    for _ in range(rounds):
        sums = (rows.mapInArrow(part_sums(books, scale, cell), SUMS).groupBy("part", "entry", "position")
                .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
                .collect())  # as many rows as the books have numbers
        books = books.copy()
        for r in sums:
            books[r["part"], r["entry"], r["position"]] = int(r["total"]) // r["n"]
    return books


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, cell: int = CELL) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every row that has a whole vector.

    Components become floor(scale * x). Codebooks start as the parts of the vectors with the
    ``entries`` (at most 256) smallest ids, null ids last, and rows of one id in the order of their
    vectors; with fewer vectors they are shorter. ``error`` is the squared distance to the coded vector and
    ``label_error`` its sum over rows of equal label (null is a label). Scaled components past
    2**40 either way count as that, an error past 64 bits as the largest number that fits, and
    a sum past them is null.

    Rows whose vector is null or empty, holds a null or non-finite component, or has another
    length than that of the smallest id, take no part; lengths that ``parts`` does not divide never
    do. Rows that repeat an id are rows of their own. Other columns are ignored; an empty table
    gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    books = first_books(rows, parts, entries, scale)
    if books.shape[1]:
        books = train_books(rows, books, rounds, scale, cell)
        coded = rows.mapInArrow(part_codes(books, scale, cell), f"id {kinds['id']}, label {kinds['label']}, code string, error long")
    else:
        coded = rows.where("false").select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    tables = Tables(df.sparkSession)
    coded = tables.store(coded, "codes")
    labels = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("label")


def oracle_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """DuckDB twin: every part against every entry, round by round."""
    ctes = [f"""k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding))""",
            f"""p AS MATERIALIZED (
  SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM k, (SELECT unnest(range({parts})) AS p))""",
            f"b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM p WHERE r <= {entries})"]
    for k in range(rounds + 1):
        ctes.append(f"""a{k} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT p.r, p.p, b.e, list_sum([(p.x[i] - b.c[i]) * (p.x[i] - b.c[i]) FOR i IN range(1, len(p.x) + 1)]) AS d
    FROM p JOIN b{k} b ON p.p = b.p) GROUP BY r, p)""")
        if k < rounds:
            ctes.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS c FROM (
      SELECT p, e, i, CAST(floor_sum AS BIGINT) AS m FROM (
        SELECT p, e, i, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS floor_sum FROM (
          SELECT p.p, a.e, unnest(p.x) AS y, unnest(range(len(p.x))) AS i FROM p JOIN a{k} a ON a.r = p.r AND a.p = p.p)
        GROUP BY p, e, i)) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)""")
    body = ",\n".join(ctes)
    return f"""
WITH {body},
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{rounds}),
o AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM k JOIN o USING (r) CROSS JOIN h
"""


__all__ = ["vector_codes", "CellTable", "op12_vector_codes", "oracle_sql"]
