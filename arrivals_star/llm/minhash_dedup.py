"""MinHash near-dedup with HyperMinHash sketches.

A document's shingles fall into ``BUCKETS`` buckets by the top bits of their hash; a register keeps
the smallest hash of its bucket in 16 bits: its leading-zero count and its next ten mantissa bits.

1. Texts with the same set of shingles are one class; everything below is about one document of
   each class (its smallest id).
2. Bands of compressed registers are hashed to band groups, of as many registers as the threshold
   allows (``band_shape``): six at 0.85, five at 0.8. An empty register borrows that
   which comes first, of those that are not empty, in an order of its own: each register then is an
   equal draw from the set, and two registers of a small set are as little tied as those of a large
   one. A pair with Jaccard 0.85 shares no band of 42 with a probability of about 2e-9
   (0.623 ** 42), one with 0.8 no band of 51 with about 2e-9 as well (0.672 ** 51).
3. In every band group each document is paired with the smallest one. Pairs whose
   collision-corrected Jaccard estimate lies six standard errors under the threshold go; the
   others are confirmed on their full sets of shingles. Links give components.
4. A band group that still holds two components may hide a link not at its smallest document. In
   such a group every document outside the group's largest component is compared by sketch with
   all documents of other components, in blocks of ``TILE`` documents a side. A block gives no
   pairs, but a forest: as few pairs as connect the documents that may be similar. The trees of
   all blocks make clusters of documents that are near each other, not just in one band group.
5. Within a cluster, every document outside its largest component is compared with all others on
   full sets, in blocks of ``SETS_TILE`` documents a side, and a block gives as few links as connect
   its components. So both sides of every task are bounded, and rows grow with the documents, not
   with the square of a group. Components of all links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arrivals_star.llm import spans
from arrivals_star.llm.components import components
from arrivals_star.llm.runs import arrow_rows
from arrivals_star.llm.tables import Tables

U64 = np.uint64
BUCKET_BITS, MANTISSA = 8, 10
BUCKETS = 1 << BUCKET_BITS
MISSED = 1e-8  # chance, at most, that a pair at the threshold shares no band
COMPARED = 128  # registers that an estimate compares
PAIRS = 1 << 15  # (document, filled register) pairs that are looked up at once
TILE = 1024  # documents of either side of a block that compares sketches
SETS_TILE = 512  # and of one that compares full sets
SLICE = 1 << 21
FOLD = np.arange(256)
FOLD[65:91] += 32
SKETCH = "doc_id long, n_shingles long, set_hash binary, registers binary"
SETS = "doc_id long, shingles binary"
BAND = "key long, doc_id long"


def document_sets(col: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of the documents: distinct shingle hashes in (document, hash) order, and bounds.

    A shingle is ``width`` words of A-Z lower-cased text; fewer words are one shingle together.
    """
    buf, offsets = spans.run_buffer(col)
    hasher = spans.SpanHash(11, FOLD)
    d, n = 0, len(offsets) - 1
    while d < n:
        e = max(d + 1, int(np.searchsorted(offsets, offsets[d] + SLICE, "right")) - 1)
        part, bounds = buf[offsets[d]:offsets[e]], offsets[d:e + 1] - offsets[d]
        starts, ends, doc = spans.words(part, bounds)
        word = hasher(part, starts, ends)
        base = U64(0x9E3779B97F4A7C15)
        count = np.bincount(doc, minlength=e - d)
        with np.errstate(over="ignore"):
            m = max(len(word) - width + 1, 0)
            acc = np.zeros(m, U64)
            for k in range(width):
                acc = acc * base + word[k:k + m]
            whole = np.flatnonzero(doc[:m] == doc[width - 1:]) if m else np.zeros(0, np.int64)
            h, owner = acc[whole], doc[whole]
            # documents of fewer words: the same sum over the words they have
            few = np.flatnonzero((count > 0) & (count < width))
            first = np.cumsum(count) - count
            short = np.zeros(len(few), U64)
            for k in range(width - 1):
                here = count[few] > k
                short[here] = short[here] * base + word[first[few[here]] + k]
            short = short * base + count[few].astype(U64)
            h = spans.mix(np.concatenate([h, short]))
        owner = np.concatenate([owner, few])
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
        yield h, np.searchsorted(owner, np.arange(e - d + 1))
        d = e


def registers(h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """HyperMinHash registers (n documents x BUCKETS, 0 = empty) of hashes sorted by (owner, hash)."""
    out = np.zeros((n, BUCKETS), np.uint16)
    bucket = (h >> U64(64 - BUCKET_BITS)).astype(np.int64)
    slot = owner * BUCKETS + bucket
    first = np.ones(len(h), bool)
    first[1:] = slot[1:] != slot[:-1]
    bits = 64 - BUCKET_BITS
    low = h[first] & U64((1 << bits) - 1)
    _, size = np.frexp((low >> U64(4)).astype(np.float64))  # exact: 53 bits
    size = np.where(size > 0, size + 4, 4)
    zeros = np.minimum(bits - size + 1, 63).astype(np.uint16)  # 1 = no leading zero
    after = np.maximum(size - 1 - MANTISSA, 0).astype(U64)  # bits below the mantissa
    mantissa = (low >> after) & U64((1 << MANTISSA) - 1)
    out.reshape(-1)[slot[first]] = zeros << np.uint16(MANTISSA) | mantissa.astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, low: float = 0.85) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimate of register rows, corrected for chance collisions, and its standard error.

    The error is that at ``low``, and at 0.85 where that is larger.

    Registers of different sets of n and m elements agree by chance about
    0.1699 * registers / 2**r * 4nm / (n + m)**2 times (Yu and Weber, HyperMinHash).
    """
    union = ((a > 0) | (b > 0)).sum(axis=-1)
    same = ((a == b) & (a > 0)).sum(axis=-1)
    chance = 0.169919487159739 * 2.0 ** -MANTISSA * a.shape[-1] * 4.0 * n * m / (n + m) ** 2
    used, low = np.maximum(union, 1), min(low, 0.85)
    return np.maximum(same - chance, 0) / used, np.sqrt(low * (1 - low) / used)


def sketch(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, ids = 0, batch["doc_id"]
            for h, bounds in document_sets(batch["text"], width):
                n = len(bounds) - 1
                size = np.diff(bounds)
                owner = np.repeat(np.arange(n), size)
                regs = registers(h, owner, n)
                # 128-bit identity of the set: sums of two finalised hashes
                with np.errstate(over="ignore"):
                    parts = [np.concatenate([[U64(0)], np.cumsum(spans.mix(h ^ U64(s)))]) for s in (0x1234567, 0xABCDEF01234)]
                    sums = np.stack([(p[bounds[1:]] - p[bounds[:-1]]) for p in parts], axis=1)
                raw = np.ascontiguousarray(sums).tobytes()
                rr = regs.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(done, n), pa.array(size.astype(np.int64)),
                     pa.array([raw[i * 16:i * 16 + 16] for i in range(n)], pa.binary()),
                     pa.array([rr[i * 2 * BUCKETS:(i + 1) * 2 * BUCKETS] for i in range(n)], pa.binary())],
                    names=["doc_id", "n_shingles", "set_hash", "registers"])
                done += n
    return work


def full_sets(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, ids = 0, batch["doc_id"]
            for h, bounds in document_sets(batch["text"], width):
                n = len(bounds) - 1
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(done, n), pa.array([h[i:j].tobytes() for i, j in zip(bounds, bounds[1:])], pa.binary())],
                    names=["doc_id", "shingles"])
                done += n
    return work


def _orders() -> np.ndarray:
    """Per filled register and borrower: its rank in the borrower's order, and its number in the low byte.

    Each register's order is a fixed shuffle of its own that begins with the register itself.
    """
    n = np.arange(BUCKETS)
    key = spans.mix(spans.mix(np.arange(BUCKETS * BUCKETS, dtype=U64) + U64(0x5851F42D4C957F2D))).reshape(BUCKETS, BUCKETS)
    key[n, n] = 0
    rank = key.argsort(axis=1).argsort(axis=1)
    return (rank.T << BUCKET_BITS | n[:, None]).astype(np.uint16)


def lent(regs: np.ndarray) -> np.ndarray:
    """Registers with the empty ones filled, each with the number of the register it comes from.

    Every row has a register that is not empty.
    """
    orders = _orders()
    out = np.zeros(regs.shape, np.uint32)
    step = max(PAIRS // BUCKETS, 1)
    for d in range(0, len(regs), step):
        part = regs[d:d + step]
        doc, filled = np.nonzero(part)
        first = np.searchsorted(doc, np.arange(len(part)))
        place = np.minimum.reduceat(orders[filled], first, axis=0) & np.uint16(BUCKETS - 1)
        out[d:d + step] = place.astype(np.uint32) << np.uint32(16) | np.take_along_axis(part, place.astype(np.int64), axis=1)
    return out


def band_shape(per_cent: int) -> tuple[int, int]:
    """Registers of a band and number of bands, for pairs of this similarity.

    The longest bands that miss a pair at the threshold with a chance of at most ``MISSED``; where
    none do (under 0.07) each register is a band.
    """
    low = per_cent / 100
    fits = [r for r in range(1, BUCKETS + 1) if (1 - low ** r) ** (BUCKETS // r) <= MISSED]
    rows = max(fits, default=1)
    return rows, BUCKETS // rows


def bands(per_cent: int):
    """One row per document and band: a hash of the band's number and registers.

    Of n bands, band k holds the registers k, k + n, k + 2 n and so on.
    """
    rows, n = band_shape(per_cent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            dense = lent(_registers(batch["registers"])).astype(U64)
            key = np.broadcast_to(np.arange(n, dtype=U64), (len(dense), n)).copy()
            with np.errstate(over="ignore"):
                for k in range(rows):
                    key = spans.mix(key * U64(0x9E3779B97F4A7C15) + dense[:, k * n:(k + 1) * n])
            ids = np.repeat(batch["doc_id"].to_numpy(zero_copy_only=False), n)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(ids)], names=["key", "doc_id"])
    return work


def _registers(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(len(col), -1)


def plausible(low: float):
    """Pairs (a, b, ra, rb, na, nb) whose estimate does not rule the threshold out."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (batch[c].to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
            jaccard, error = estimate(_registers(batch["ra"]), _registers(batch["rb"]), n, m, low)
            keep = (jaccard >= low - 6 * error) & (np.minimum(n, m) >= low * np.maximum(n, m))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep))
    return work


def similar(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= per_cent * (len(x) + len(y) - both)


def confirm(per_cent: int):
    """Pairs (a, b, sa, sb) whose full sets are similar enough."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(np.frombuffer(x, U64), np.frombuffer(y, U64), per_cent)
                    for x, y in zip(batch["sa"].to_pylist(), batch["sb"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return work


def _sides(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Asking rows and member rows of a block (members by size), and all rows' columns."""
    asks, outside, doc, comp = (table[c].to_numpy() for c in ("asks", "outside", "doc_id", "component"))
    size = table["n_shingles"].to_numpy().astype(float)
    members = np.flatnonzero(~asks)
    return np.flatnonzero(asks), members[np.argsort(size[members], kind="stable")], outside, doc, comp, size


def _near(i: int, members: np.ndarray, outside: np.ndarray, doc: np.ndarray, comp: np.ndarray, size: np.ndarray,
          regs: np.ndarray, low: float) -> tuple[np.ndarray, np.ndarray]:
    """Members of other components that may be similar to the asking row i, and their estimates.

    If a member asks too, only the one with the larger id asks the other.
    """
    # documents of too different sizes cannot be similar
    lo, hi = np.searchsorted(size[members], [low * size[i] * (1 - 1e-9), size[i] / low * (1 + 1e-9)])
    near = members[lo:hi]
    near = near[(comp[near] != comp[i]) & (~outside[near] | (doc[near] < doc[i]))]
    if not len(near):
        return near, np.zeros(0)
    jaccard, error = estimate(regs[near], regs[i], size[near], size[i], low)
    fits = jaccard >= low - 6 * error
    return near[fits], jaccard[fits]


def near_forest(per_cent: int):
    """As few pairs (a, b) of a block as connect all its documents that may be similar."""
    def work(key: tuple, table: pa.Table) -> pa.Table:
        ask, members, *cols = _sides(table)
        regs = _registers(table["registers"].combine_chunks())
        doc = cols[1]
        _, row = np.unique(doc, return_inverse=True)  # a document may stand on both sides
        tree = np.arange(len(doc))
        pairs = []
        for i in ask:
            near, _ = _near(i, members, *cols, regs, per_cent / 100)
            others, first = np.unique(tree[row[near]], return_index=True)
            new = others != tree[row[i]]
            if new.any():
                pairs += [(int(doc[i]), int(doc[j])) for j in near[first[new]]]
                tree[np.isin(tree, others[new])] = tree[row[i]]
        return arrow_rows(pairs, "a long, b long")
    return work


def block_links(per_cent: int):
    """Links (a, b) of a block, confirmed on full sets: as few as connect its components."""
    def work(key: tuple, table: pa.Table) -> pa.Table:
        ask, members, *cols = _sides(table)
        regs = _registers(table["registers"].combine_chunks())
        sets, doc = table["shingles"], cols[1]
        _, part = np.unique(cols[2], return_inverse=True)
        links = []
        for i in ask:
            near, jaccard = _near(i, members, *cols, regs, per_cent / 100)
            near = near[np.argsort(-jaccard, kind="stable")]
            near, mine = near[part[near] != part[i]], np.frombuffer(sets[int(i)].as_py(), U64)
            while len(near):
                j, near = near[0], near[1:]
                if similar(mine, np.frombuffer(sets[int(j)].as_py(), U64), per_cent):
                    links.append((int(doc[i]), int(doc[j])))
                    part[part == part[j]] = part[i]
                    near = near[part[near] != part[i]]
        return arrow_rows(links, "a long, b long")
    return work


def _in_blocks(docs: DataFrame, group: str, tile: int, cols: list[str]) -> DataFrame:
    """(group, ask, with, asks, ...): every block of documents outside the group's largest component
    meets every block of its documents."""
    counts = docs.groupBy(group, "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy(group).agg(F.max_by("component", F.struct("n", "component")).alias("largest"),
                                        F.max("n").alias("most"), F.sum("n").alias("total"))
    blocks = lambda n: F.ceil(n / F.lit(tile)).cast("int")
    docs = docs.join(largest, group).withColumns({
        "outside": F.col("component") != F.col("largest"), "n_with": blocks(F.col("total")),
        "n_ask": blocks(F.col("total") - F.col("most"))})
    at = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = [group, "doc_id", "component", "outside", *cols]
    members = docs.where("n_ask > 0").select(every("n_ask").alias("ask"), at("n_with").alias("with"), F.lit(False).alias("asks"), *cols)
    return members.unionByName(docs.where("outside").select(
        at("n_ask").alias("ask"), every("n_with").alias("with"), F.lit(True).alias("asks"), *cols)).groupBy(group, "ask", "with")


def near_dup_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                        per_cent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Two documents are linked when 100 * |intersection| >= per_cent * |union| of their distinct
    ``width``-word shingles (A-Z lower-cased, words between ASCII blanks; a text of fewer words is
    one shingle). Texts without words are linked with nothing. ``component_id`` is the smallest id
    reachable over links; ``kept`` marks that row. Rows with a null id have no links, a null
    component and stay. Rows that repeat an id count as one node. Other columns are ignored; an
    empty table gives an empty result.
    """
    picked = df.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    tables = Tables(df.sparkSession)
    sketches = tables.store(picked.mapInArrow(sketch(width), SKETCH), "sketches")
    used = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = used.groupBy("set_hash", "n_shingles").agg(F.min("doc_id").alias("first"))
    # one sketch per class: equal sets have equal registers
    firsts = tables.store(used.groupBy("set_hash", "n_shingles")
                     .agg(F.min("doc_id").alias("doc_id"), F.first("registers").alias("registers"))
                     .select("doc_id", "n_shingles", "registers"), "classes")

    rows = tables.store(firsts.mapInArrow(bands(per_cent), BAND), "all-bands")
    shared = rows.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = tables.store(rows.join(shared.select("key", "hub"), "key"), "bands")
    pairs = met.where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    side = lambda c: firsts.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n{c}"))
    # sets of too different sizes cannot be similar; that is known before any sketch is fetched
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("na", "nb") * 100 >= F.greatest("na", "nb") * per_cent)
    part = lambda c: firsts.select(
        F.col("doc_id").alias(c), F.substring("registers", 1, 2 * COMPARED).alias(f"r{c}"))
    pairs = tables.store(pairs.join(part("a"), "a").join(part("b"), "b")
                         .mapInArrow(plausible(per_cent / 100), "a long, b long"), "pairs")

    def sets_of(ids: DataFrame) -> DataFrame:
        """(doc_id, shingles) of the wanted documents; a repeated id counts once."""
        # the ids grow with the corpus, so both sides are shuffled whatever the size of this one
        texts = picked.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(full_sets(width), SETS)
        return texts.groupBy("doc_id").agg(F.max("shingles").alias("shingles"))

    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = tables.store(sets_of(ends), "sets")
    links = tables.store(pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
                         .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
                         .mapInArrow(confirm(per_cent), "a long, b long"), "links")
    component = components(links, tables)
    more = _hidden_links(tables, met, component, firsts, sets_of, per_cent)
    if more is not None:
        component = components(links.unionByName(more), tables)

    label = component.withColumnRenamed("node", "first")
    result = (sketches.join(classes, ["set_hash", "n_shingles"], "left").join(label, "first", "left")
              .select("doc_id", "n_shingles", F.coalesce("component", "first", "doc_id").alias("component_id")))
    result = tables.store(result.select("doc_id", "n_shingles", "component_id",
                                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")), "near-copies")
    tables.drop(keep=1)
    return result


def _hidden_links(tables: Tables, met: DataFrame, component: DataFrame, firsts: DataFrame, sets_of, per_cent: int) -> DataFrame | None:
    """Links between components that meet in a band group; None where no documents of two are near."""
    label = component.select(F.col("node").alias("doc_id"), "component")
    own = tables.store(met.join(label, "doc_id", "left")
                       .select("key", "doc_id", F.coalesce("component", "doc_id").alias("component")), "labels")
    mark = lambda seed: F.sum(F.xxhash64(F.lit(seed), "doc_id").cast("decimal(38,0)"))
    groups = (own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                     F.count(F.lit(1)).alias("total"), mark(1).alias("m1"), mark(2).alias("m2"))
              .where("low < high"))
    # bands of the same documents give the same pairs
    groups = groups.groupBy("total", "m1", "m2").agg(F.min("key").alias("key")).select("key")
    sketch_of = firsts.select("doc_id", "n_shingles", F.substring("registers", 1, 2 * COMPARED).alias("registers"))
    members = tables.store(own.join(groups, "key").join(sketch_of, "doc_id"), "open")
    trees = tables.store(_in_blocks(members, "key", TILE, ["n_shingles", "registers"])
                         .applyInArrow(near_forest(per_cent), "a long, b long").distinct(), "near")
    if trees.isEmpty():
        return None
    clusters = components(trees, tables).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    docs = (clusters.join(label, "doc_id", "left").select("cluster", "doc_id", F.coalesce("component", "doc_id").alias("component"))
            .join(sketch_of, "doc_id").join(sets_of(clusters.select("doc_id")), "doc_id"))
    docs = tables.store(docs, "clusters")
    return tables.store(_in_blocks(docs, "cluster", SETS_TILE, ["n_shingles", "registers", "shingles"])
                        .applyInArrow(block_links(per_cent), "a long, b long"), "hidden")


def op5_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dup_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 3], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON r.doc_id = e.a)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

__all__ = ["near_dup_components", "op5_minhash_dedup", "OP5_SQL"]
