"""Exact top-k by inner product: columnar branch-and-bound.

Vectors are stored in vertical blocks: a block holds ``BLOCK_ROWS`` vectors, dimension by
dimension. For one query the scores of all vectors of a block grow a few dimensions at a time.
After each step a vector's score is at most its partial sum plus |rest of query| * |rest of
vector| (Cauchy-Schwarz on the mass that remains); vectors whose bound lies under the k-th best
score that is sure so far leave the block, which is compacted before the next dimensions.

Query blocks meet vector blocks; each pair keeps k rows per query, and the best k of all blocks
are chosen in a last grouped step. Scores are sums of integers, exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from arrivals_star.llm.runs import arrow_rows, shuffle_partitions

BLOCK_ROWS = 8192
QUERY_ROWS = 4096
STEP = 16  # dimensions between two prunings
EXACT = 1 << 53
BLOCK = "block int, n int, dim int, ids binary, rows binary"
BEST = "query_id long, vec_id long, score long"


def narrow(m: np.ndarray) -> bytes:
    """A matrix of integers in the narrowest type that holds them; its size names the type."""
    kind = next(t for t in (np.int16, np.int32, np.int64) if not m.size or (m.min() >= np.iinfo(t).min and m.max() <= np.iinfo(t).max))
    return np.ascontiguousarray(m, kind).tobytes()


def widen(raw: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, {2: np.int16, 4: np.int32, 8: np.int64}[len(raw) // (n * dim)]).astype(np.int64).reshape(dim, n)


def vertical_blocks(key: tuple, table: pa.Table) -> pa.Table:
    """Pack a block's vectors by dimension, one packed row for each length of vector."""
    block = key[0].as_py()
    ids = table["vec_id"].to_numpy()
    values = table["v"].combine_chunks()
    lengths = values.value_lengths().to_numpy()
    flat = values.flatten().to_numpy()
    starts = np.cumsum(lengths) - lengths
    rows = []
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        m = flat[starts[at][:, None] + np.arange(dim)]
        rows.append((block, len(at), dim, ids[at].tobytes(), narrow(m.T)))
    return arrow_rows(rows, BLOCK)


def branch_and_bound(columns: np.ndarray, ids: np.ndarray, query: np.ndarray, query_id: int, rest: np.ndarray,
                     k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (id, score) of a vertical block for one query; ties go to smaller ids.

    ``rest[s]`` holds each vector's norm from dimension s * STEP on (float64).
    """
    dim = len(query)
    alive = np.flatnonzero(ids != query_id)
    part = np.zeros(len(alive), columns.dtype)
    q_rest = np.sqrt(np.cumsum((query.astype(np.float64) ** 2)[::-1])[::-1])
    for d in range(0, dim, STEP):
        e = min(d + STEP, dim)
        part = part + query[d:e] @ columns[d:e, alive]
        if e == dim or len(alive) <= k or part.dtype == np.int64:
            continue  # integers past 2**53 are summed to the end: a float bound would not be safe
        # a relative slack keeps the bound above the exact value in spite of rounding
        slack = q_rest[e] * rest[e // STEP][alive] * (1 + 1e-9) + 1e-6
        sure = part - slack
        floor = np.partition(sure, len(sure) - k)[len(sure) - k]
        stay = part + slack >= floor
        if not stay.all():
            alive, part = alive[stay], part[stay]
    score = part
    if len(alive) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        stay = score >= kth
        alive, score = alive[stay], score[stay]
    order = np.lexsort((ids[alive], -score))[:k]
    return ids[alive][order], score[order]


def block_best(k: int):
    def work(key: tuple, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out = []
        packed, asked = ([(r["dim"], np.frombuffer(r["ids"], np.int64), widen(r["rows"], r["n"], r["dim"]))
                          for r in table.to_pylist()] for table in (vectors, queries))
        best: dict[int, list] = {}
        for dim, ids, columns in packed:
            mine = [(i, q) for d, qi, q in asked if d == dim for i, q in zip(qi.tolist(), q.T)]
            if not mine:
                continue
            tops = [max(1, *(int(np.abs(m).max(initial=0)) for m in (columns, q))) for _, q in mine]
            big = max(1, int(np.abs(columns).max(initial=0))) * max(tops) * max(dim, 1) >= EXACT
            # float64 holds these sums exactly and multiplies fast; larger values stay integers
            work_columns = columns if big else columns.astype(np.float64)
            squares = columns.astype(np.float64) ** 2
            steps = -(-dim // STEP) + 1
            rest = np.zeros((steps, columns.shape[1]))
            for s in range(steps - 2, -1, -1):
                rest[s] = rest[s + 1] + squares[s * STEP:(s + 1) * STEP].sum(axis=0)
            rest = np.sqrt(rest)
            for i, q in mine:
                got = branch_and_bound(work_columns, ids, q if big else q.astype(np.float64), i, rest, k)
                best.setdefault(i, []).append(got)
        for i, parts in best.items():
            ids = np.concatenate([p[0] for p in parts])
            score = np.concatenate([p[1] for p in parts]).astype(np.int64)
            order = np.lexsort((ids, -score))[:k]
            out += [(i, int(v), int(s)) for v, s in zip(ids[order], score[order])]
        return arrow_rows(out, BEST)
    return work


def exact_top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
                every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products.

    Components become floor(scale * x). Queries are the rows whose id is divisible by ``every``;
    candidates are all rows but those with the query's id. Ties go to the smaller id; fewer
    candidates give fewer rows. A row takes no part if its id or vector is null or empty, or a
    component is null or not finite. Vectors of different lengths are not compared. Rows that
    repeat an id are candidates each, and ask once. Scores must fit 64 bits. Other columns are
    ignored; an empty table gives an empty result.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    ok = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.forall(
        v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = df.where(ok).select(F.col(id_col).cast("long").alias("vec_id"),
                               F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"))
    n = rows.count()
    parts = max(1, -(-n // BLOCK_ROWS))
    ask_parts = max(1, -(-n // (every * QUERY_ROWS)))

    def blocks(frame: DataFrame, count: int) -> DataFrame:
        keyed = frame.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))
        return keyed.groupBy("block").applyInArrow(vertical_blocks, BLOCK)

    asks = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    lists = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    # every query block meets every vector block: a stated query set against all rows, in blocks
    vectors = blocks(rows, parts).withColumn("ask", lists(ask_parts)).withColumn("with", F.col("block"))
    queries = blocks(asks, ask_parts).withColumn("ask", F.col("block")).withColumn("with", lists(parts))
    best = (queries.groupBy("ask", "with").cogroup(vectors.groupBy("ask", "with"))
            .applyInArrow(block_best(k), BEST))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (best.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op7_exact_topk(spark, sf_dir: str) -> DataFrame:
    return exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP7_SQL = """
WITH r AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), q AS (SELECT DISTINCT ON (vec_id) vec_id, v FROM r WHERE vec_id % 50 = 0),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id, unnest(q.v) * unnest(r.v) AS p, unnest(range(len(q.v))) AS i
  FROM q JOIN r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
), t AS (SELECT query_id, vec_id, CAST(sum(p) AS BIGINT) AS score FROM s GROUP BY ALL),
u AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM t)
SELECT query_id, rank, vec_id, score FROM u WHERE rank <= 5
"""

__all__ = ["exact_top_k", "op7_exact_topk", "OP7_SQL"]
