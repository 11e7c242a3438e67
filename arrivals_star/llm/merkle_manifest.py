"""Merkle manifest of a table, with a proof per row: octopus multiproofs.

A row is a leaf; the leaves of a group (a source) make a tree of nodes of up to 16 children, and
the trees' subroots, in the order of their groups, make the top tree over them.

1. Leaves are written in order of (group, id). Consecutive leaves of one range partition are cut
   into *leaf partitions* of at most ``PANEL`` rows. Partition starts give every leaf its place.
2. Nodes are built level by level: up to 16 digests a group, hashed by Spark's ``sha2``.
3. The leaves that a leaf partition holds of a tree are one interval, and so is what it can derive
   from them on every level. The digests it lacks are therefore the rest of the first and of the
   last run of 16 on each level: at most 30 coordinates (tree, level, index) a level, whatever the
   number of its leaves. That union is computed once and fetched with one join.
4. The partition derives the interior nodes that its rows share once, and expands the proof of
   each row from them.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arrivals_star.llm.runs import arrow_rows
from arrivals_star.llm.tables import Tables
from arrivals_star.operators.keys import ROW_BITS, place, stored_in_order

FAN = 16
FAN_BITS = 4
PANEL_BITS = 13
PANEL = 1 << PANEL_BITS
HEX = 64
TOP = -1  # the tree over the subroots
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
OUT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
       "verified boolean, proof string")


def digest_of(values: list[Column]) -> Column:
    """Hex sha256 of each value's byte count, ':' and text; '-' stands for null."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _up(x: Column, bits: Column) -> Column:
    """ceil(x / 2**bits) of a long."""
    whole = F.call_function("shiftright", x, bits)
    return whole + (F.call_function("shiftleft", whole, bits) < x).cast("long")


def node_levels(tables: Tables, nodes: DataFrame, widest: int, name: str) -> list[DataFrame]:
    """Levels of trees from (tree, index, width, digest): width is the tree's number of nodes there.

    A level is left out for the trees whose last node lies below it.
    """
    levels = [nodes]
    while widest > 1:
        children = F.array_sort(F.collect_list(F.struct("index", "digest")))
        joined = F.concat_ws("", F.transform(children, lambda c: c["digest"]))
        nodes = (levels[-1].where("width > 1")
                 .groupBy("tree", F.shiftright("index", FAN_BITS).alias("index"), _up(F.col("width"), F.lit(FAN_BITS)).alias("width"))
                 .agg(F.sha2(joined.cast("binary"), 256).alias("digest")))
        levels.append(tables.store(nodes, f"{name}-{len(levels)}"))
        widest = -(-widest // FAN)
    return levels


def missing_nodes(pieces: DataFrame, widest: int) -> DataFrame:
    """The digests (panel, tree, level, index) that each leaf partition cannot derive.

    A piece (panel, tree, first, n, width) is an interval of a tree's leaves.
    """
    levels = 0
    while widest > 1:
        widest, levels = -(-widest // FAN), levels + 1
    if not levels:
        return pieces.select("panel", "tree", F.lit(0).alias("level"), F.col("first").alias("index")).where("false")
    bits = F.col("level") * FAN_BITS
    by_level = (pieces.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
                .select("panel", "tree", "level", F.call_function("shiftright", F.col("first"), bits).alias("a"),
                        _up(F.col("first") + F.col("n"), bits).alias("b"), _up(F.col("width"), bits).alias("w"))
                .where("w > 1"))
    left = F.col("a") - F.col("a") % FAN
    right = F.least(F.call_function("shiftleft", _up(F.col("b"), F.lit(FAN_BITS)), F.lit(FAN_BITS)), F.col("w"))
    none = F.array().cast("array<bigint>")
    lacks = F.concat(F.when(left < F.col("a"), F.sequence(left, F.col("a") - 1)).otherwise(none),
                     F.when(F.col("b") < right, F.sequence(F.col("b"), right - 1)).otherwise(none))
    return by_level.select("panel", "tree", "level", F.explode(lacks).alias("index"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(first: int, digests: list[str], width: int, fetched: dict[int, dict[int, str]]) -> tuple[list, list[str]]:
    """Runs of children (first run's index, joined digests) per level over an interval, and its top nodes."""
    levels = []
    while width > 1:
        got = fetched.get(len(levels), {})
        last = first + len(digests)
        lo, hi = first - first % FAN, min(-(-last // FAN) * FAN, width)
        row = [got[i] for i in range(lo, first)] + digests + [got[i] for i in range(last, hi)]
        runs = ["".join(row[k:k + FAN]) for k in range(0, len(row), FAN)]
        levels.append((lo // FAN, runs))
        digests, first, width = [sha(r) for r in runs], lo // FAN, -(-width // FAN)
    return levels, digests


def siblings(levels: list, index: int, memo: dict, level: int = 0) -> str:
    """The siblings of a node and of all nodes above it in its tree, bottom up, left to right."""
    if level == len(levels):
        return ""
    key = (level, index)
    if key not in memo:
        first, runs = levels[level]
        run, at = runs[index // FAN - first], index % FAN * HEX
        memo[key] = run[:at] + run[at + HEX:] + siblings(levels, index // FAN, memo, level + 1)
    return memo[key]


def fold(levels: list, index: int, digest: str) -> str:
    """The top node of a tree, from a node's digest and its siblings."""
    for first, runs in levels:
        run, at = runs[index // FAN - first], index % FAN * HEX
        digest = sha(run[:at] + digest + run[at + HEX:])
        index //= FAN
    return digest


def expand(with_proofs: bool):
    """Proofs of a leaf partition from its leaves and from the facts fetched for it."""
    def work(key: tuple, leaves: pa.Table, facts: pa.Table) -> pa.Table:
        rows = sorted(leaves.to_pylist(), key=lambda r: r["at"])
        pieces, fetched = [], {}
        for f in facts.to_pylist():
            if f["digest"] is None:
                pieces.append(f)
            else:
                fetched.setdefault(f["tree"], {}).setdefault(f["level"], {})[f["index"]] = f["digest"]
        pieces.sort(key=lambda p: p["tree"])
        top, pieces = pieces[0], pieces[1:]
        trees, at = [], 0
        for p in pieces:
            part = rows[at:at + p["n"]]
            at += p["n"]
            levels, ends = climb(p["index"], [r["leaf"] for r in part], p["width"], fetched.get(p["tree"], {}))
            trees.append((p, part, levels, ends[0]))
        over, ends = climb(top["index"], [t[3] for t in trees], top["width"], fetched.get(TOP, {}))
        root, memo, out = ends[0], {}, []
        for p, part, levels, subroot in trees:
            above, inside = siblings(over, p["tree"], memo), {}
            for i, r in enumerate(part, p["index"]):
                first = siblings(levels, i, inside) + above
                inside.pop((0, i), None)
                folded = fold(over, p["tree"], fold(levels, i, r["claim"] or r["leaf"]))
                out.append((r["doc_id"], r["leaf"], subroot, root, sha(first), folded, folded == root,
                            first if with_proofs else None))
        return arrow_rows(out, OUT)
    return work


def merkle_manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "source",
                    columns: tuple[str, ...] = COLUMNS, claimed: dict[str, Column] | None = None,
                    with_proofs: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (and proof) of every row.

    A leaf hashes the row's ``columns`` (null: ``-``; else UTF-8 byte count, ``:``, value). Leaves
    of a group ascend by id, null ids first; rows of one id ascend by leaf. Groups ascend
    bytewise, the null group first. ``claimed`` gives columns as a copy under audit has them: the
    row's digest over those is folded with the manifest's own siblings, and ``verified`` says
    whether that gives the root. ``proof`` (the joined siblings) is null unless ``with_proofs``.

    Null values, empty and long texts are hashed like any other; equal rows are leaves of their
    own. Other columns are ignored. An empty table gives an empty result.
    """
    tables, now = Tables(df.sparkSession), {c: F.col(c) for c in columns}
    leaf, claim = digest_of(list(now.values())), digest_of(list((now | (claimed or {})).values()))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).cast("string").alias("group"),
                     leaf.alias("leaf"), (claim if claimed else F.lit(None).cast("string")).alias("claim"))
    # written before the sort, so that its sampling does not hash every text again
    rows = tables.store(rows.withColumn("claim", F.expr("nullif(claim, leaf)")), "leaves")
    rows, starts = stored_in_order(tables.store, rows, [F.col(c).asc_nulls_first() for c in ("group", "doc_id", "leaf")], "ordered")
    panel, pid = F.shiftright("at", PANEL_BITS).alias("panel"), F.shiftright("at", ROW_BITS)
    cut = rows.groupBy(panel, "group").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n"))
    cut = cut.join(F.broadcast(starts), pid == F.col("pid")).select(  # one row per partition
        "panel", "group", "at", "n", place(F.col("at"), F.col("start")).alias("place"))
    cut = tables.store(cut, "cut")
    groups, group_starts = stored_in_order(
        tables.store, cut.groupBy("group").agg(F.min("place").alias("opens"), F.sum("n").alias("width")),
        [F.col("group").asc_nulls_first()], "groups")
    groups = groups.join(F.broadcast(group_starts), pid == F.col("pid")).select(
        F.col("group").alias("of"), "opens", "width", place(F.col("at"), F.col("start")).alias("tree"))
    n_trees, widest = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("width"), F.lit(0))).first()
    pieces = tables.store(cut.join(groups, F.col("group").eqNullSafe(F.col("of"))).select(
        "panel", F.col("group").alias("of"), "tree", F.col("at").alias("opens_at"),
        (F.col("place") - F.col("opens")).alias("first"), "n", "width"), "pieces")

    # the leaves of a piece follow each other
    leaves = rows.withColumn("panel", panel).join(
        pieces.select(F.col("panel").alias("p"), "of", "tree", "opens_at", "first", "width"),
        (F.col("panel") == F.col("p")) & F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("first") + F.col("at") - F.col("opens_at")).alias("index"), "width", F.col("leaf").alias("digest"))
    low = node_levels(tables, tables.store(leaves, "nodes"), widest, "nodes")
    subroots = low[0].where("width = 1")
    for level in low[1:]:
        subroots = subroots.unionByName(level.where("width = 1"))
    subroots = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("index"),
                               F.lit(n_trees).cast("long").alias("width"), "digest")
    high = node_levels(tables, tables.store(subroots, "subroots"), n_trees, "top")

    nodes = None
    for level, frame in [*enumerate(low), *enumerate(high)]:
        frame = frame.select("tree", F.lit(level).alias("level"), "index", "digest")
        nodes = frame if nodes is None else nodes.unionByName(frame)
    tops = pieces.groupBy("panel").agg(F.min("tree").alias("first"), F.max("tree").alias("last")).select(
        "panel", F.lit(TOP).cast("long").alias("tree"), "first", (F.col("last") - F.col("first") + 1).alias("n"),
        F.lit(n_trees).cast("long").alias("width"))
    spans = pieces.select("panel", "tree", "first", "n", "width").unionByName(tops)
    fetched = missing_nodes(spans, max(widest, n_trees)).join(nodes, ["tree", "level", "index"]).select(
        "panel", "tree", "level", "index", "digest", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("width"))
    facts = fetched.unionByName(spans.select("panel", "tree", F.lit(-1).alias("level"), F.col("first").alias("index"),
                                             F.lit(None).cast("string").alias("digest"), "n", "width"))
    leaves = rows.select(panel, "at", "doc_id", "leaf", "claim")
    out = leaves.groupBy("panel").cogroup(facts.groupBy("panel")).applyInArrow(expand(with_proofs), OUT)
    return out if with_proofs else out.drop("proof")


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    struck = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return merkle_manifest(docs, claimed={
        "text": F.when(struck, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))})


def oracle_sql(levels: int = 7) -> str:
    """DuckDB twin: trees of at most 16 ** levels leaves, each level a grouped step."""
    piece = lambda c: f"coalesce(strlen({c})::VARCHAR || ':' || {c}, '-')"
    head = " || ".join(piece(c) for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [f"""t AS (
  SELECT doc_id, source, sha256({head} || {piece("text")}) AS leaf,
         CASE WHEN (xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)) % 5 = 0
           THEN sha256({head} || {piece(lower)}) END AS claim
  FROM documents)""",
            """l AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS w FROM t)""",
            "a0 AS MATERIALIZED (SELECT tree, pos AS i, w, leaf AS h FROM l)"]
    up = lambda a, b: f"""{b} AS MATERIALIZED (
  SELECT tree, i // 16 AS i, (w + 15) // 16 AS w, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {a} WHERE w > 1 GROUP BY ALL)"""  # noqa: E731
    ctes += [up(f"a{k}", f"a{k + 1}") for k in range(levels)]
    ctes.append("s AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT tree, h FROM a{k} WHERE w = 1" for k in range(levels + 1)) + ")")
    ctes.append("b0 AS MATERIALIZED (SELECT 0 AS tree, tree AS i, count(*) OVER () AS w, h FROM s)")
    ctes += [up(f"b{k}", f"b{k + 1}") for k in range(levels)]
    ctes.append("r AS (" + " UNION ALL ".join(f"SELECT h FROM b{k} WHERE w = 1" for k in range(levels + 1)) + ")")
    ctes.append("f0 AS MATERIALIZED (SELECT l.*, coalesce(claim, leaf) AS h, '' AS proof FROM l)")
    last = "f0"
    for side, tree in (("a", "f.tree"), ("b", "0")):
        for k in range(levels):
            at = f"(f.pos // {16 ** k})" if side == "a" else f"(f.tree // {16 ** k})"
            new = f"{side}f{k}"
            ctes.append(f"""{new}g AS MATERIALIZED (
  SELECT f.doc_id, f.tree, f.pos, string_agg(n.h, '' ORDER BY n.i) FILTER (n.i <> {at}) AS sib,
         string_agg(CASE WHEN n.i = {at} THEN f.h ELSE n.h END, '' ORDER BY n.i) AS run
  FROM {last} f JOIN {side}{k} n ON n.tree = {tree} AND n.i // 16 = {at} // 16 AND n.w > 1 GROUP BY f.doc_id, f.tree, f.pos),
{new} AS MATERIALIZED (
  SELECT f.doc_id, f.source, f.leaf, f.claim, f.tree, f.pos, f.w, coalesce(sha256(g.run), f.h) AS h, f.proof || coalesce(g.sib, '') AS proof
  FROM {last} f LEFT JOIN {new}g g ON g.tree = f.tree AND g.pos = f.pos)""")
            last = new
    body = ",\n".join(ctes)
    return f"""
WITH {body}
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM {last} f JOIN s USING (tree) CROSS JOIN r
"""


__all__ = ["merkle_manifest", "digest_of", "missing_nodes", "op11_merkle_manifest", "oracle_sql"]
