"""Document fingerprints: improbable-feature digests (after Roussev's similarity digests, 2010).

1. A feature is a window of ``window`` bytes. Its Shannon entropy, in ``BINS`` steps, says how rare
   it is: one pass counts the entropies of all windows of all texts, and the bin that fewest
   windows have is the rarest.
2. Of every ``reach`` neighbouring features the rarest one (the first of equals) gets a point.
   Features of ``points`` points or more, and at least the one with the most, are selected.
3. Selected features set ``HASHES`` bits each in a chain of Bloom filters of ``BITS`` bits; a filter
   that holds ``FILLED`` features is followed by a new one.
   Texts under ``short`` bytes have too few such windows: all their windows of ``SMALL`` bytes are features.
4. Two digests are compared filter by filter: the overlap of their bits between what chance gives
   (0) and what the smaller filter allows (1). Each filter of the digest with fewer features counts
   with its best partner, and the sum is divided by the features of the larger digest.

A fingerprint is text: the number of features of each filter, then the filters in hex.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arrivals_star.llm.spans import U64, mix
from arrivals_star.llm.tables import Tables
from arrivals_star.operators.keys import ROW_BITS

BINS = 1000
BITS, HASHES, FILLED = 2048, 5, 160
SMALL = 6
CHANCE = 0.3  # share of the way from chance to full overlap that still counts as chance
SLICE = 1 << 20
SCALE = 1 << 20
COMPARED = 512  # filters of either digest that are compared at once


@dataclass(frozen=True)
class Features:
    """Bytes of a feature, neighbours that compete, the points a feature needs, and the bytes of a text that has any.

    ``short`` is at least ``window + reach``.
    """
    window: int = 32
    reach: int = 32
    points: int = 8
    short: int = 256


def entropy_bins(buf: np.ndarray, window: int) -> np.ndarray:
    """Entropy of every window of a buffer, as 0 .. BINS - 1; one entry per window."""
    n = len(buf)
    if n < window:
        return np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)  # equal bytes among the window - 1 next to each
    for k in range(1, window):
        same = (buf[k:] == buf[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    terms = [0] + [round(c * math.log2(c) * SCALE) for c in range(1, window + 1)]
    step = np.diff(np.array(terms, np.int64))  # step[c]: a byte joins c equal ones
    total = np.empty(n - window + 1, np.int64)
    counts = np.bincount(buf[:window], minlength=1)
    total[0] = sum(terms[c] for c in counts.tolist())
    # the first byte of a window leaves it, then the byte after the window enters
    total[1:] = total[0] + np.cumsum(step[before[window:]] - step[after[:n - window]])
    most = round(window * math.log2(window) * SCALE)
    return np.minimum((most - total) * BINS // most, BINS - 1)


def rank_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy bin, rarest first; equal counts by bin."""
    rank = np.empty(BINS, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(BINS)
    return rank


def selected(buf: np.ndarray, offsets: np.ndarray, rank: np.ndarray, shape: Features) -> tuple[np.ndarray, np.ndarray]:
    """Places of the selected features of the documents of a buffer, and the document of each."""
    none = np.zeros(0, np.int64)
    n, w, reach = len(buf), shape.window, shape.reach
    if n < w + reach - 1:  # short texts only, which have other features
        return none, none
    keys = rank[entropy_bins(buf, w)] * n + np.arange(n - w + 1)  # the first of equals is the least
    size = np.diff(offsets)
    last = offsets[:-1] + size - w  # place of a document's last feature
    # least key of every `reach` features from a place on, by doubling
    least, have = keys, 1
    while have < reach:
        more = min(have, reach - have)
        least = np.minimum(least[:len(least) - more], least[more:])
        have += more
    at = np.arange(len(least))
    doc = np.searchsorted(offsets, at, "right") - 1
    whole = at + reach - 1 <= last[doc]
    score = np.bincount(least[whole] % n, minlength=n)
    best_at = np.flatnonzero(score)
    best_doc = np.searchsorted(offsets, best_at, "right") - 1
    # the most points of each document (the first of equals)
    order = np.lexsort((best_at, -score[best_at], best_doc))
    first = order[np.unique(best_doc[order], return_index=True)[1]]
    score[best_at[first]] = shape.points
    place = np.flatnonzero(score >= shape.points)
    return place, np.searchsorted(offsets, place, "right") - 1


def filter_bits(buf: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """HASHES bit numbers of each selected feature."""
    if not len(place):
        return np.zeros((0, HASHES), np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(buf, window)[place]
    words = np.zeros((len(place), -(-window // 8) * 8), np.uint8)
    words[:, :window] = rows
    h = np.full(len(place), U64(0x2545F4914F6CDD1D))
    with np.errstate(over="ignore"):
        for k, column in enumerate(words.view("<u8").T):
            h = mix(h * U64(0x9E3779B97F4A7C15) + column + U64(k))
    return _bits_of(h)


def _bits_of(h: np.ndarray) -> np.ndarray:
    shift = np.arange(HASHES, dtype=np.uint64) * U64(11)
    return ((h[:, None] >> shift) & U64(BITS - 1)).astype(np.int64)


def short_bits(text: bytes) -> np.ndarray:
    """Bits of a short text: its windows of SMALL bytes, or the whole of it if there is none."""
    if len(text) >= SMALL:
        return filter_bits(np.frombuffer(text, np.uint8), np.arange(len(text) - SMALL + 1), SMALL)
    return filter_bits(np.frombuffer(text, np.uint8), np.zeros(min(len(text), 1), np.int64), len(text))


def render(bits: np.ndarray) -> str:
    """Chained filters of a document's features, in the order of the text."""
    if not len(bits):
        return ""
    chain = np.arange(len(bits)) // FILLED
    filters = np.zeros((chain[-1] + 1, BITS), bool)
    filters[np.repeat(chain, HASHES), bits.reshape(-1)] = True
    return ",".join(map(str, np.bincount(chain).tolist())) + ":" + np.packbits(filters).tobytes().hex()


def fingerprints(texts: list[bytes], rank: np.ndarray, shape: Features) -> list[str]:
    """Fingerprint of every text; an empty text's is empty."""
    out: list[str] = [""] * len(texts)
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= SLICE):
            size += len(texts[b])
            b += 1
        part = texts[a:b]
        if len(part) == 1 and size > SLICE:
            place, bits = _long_features(part[0], rank, shape)
            owner = np.zeros(len(place), np.int64)
        else:
            buf = np.frombuffer(b"".join(part), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in part])])
            place, owner = selected(buf, offsets, rank, shape)
            bits = filter_bits(buf, place, shape.window)
        ends = np.searchsorted(owner, np.arange(b - a + 1))
        for i, text in enumerate(part):
            out[a + i] = render(bits[ends[i]:ends[i + 1]] if len(text) >= shape.short else short_bits(text))
        a = b
    return out


def _long_features(text: bytes, rank: np.ndarray, shape: Features) -> tuple[np.ndarray, np.ndarray]:
    """Features of one long text, in slices that overlap so far that each feature gets all its points."""
    reach = shape.reach + shape.window
    places, bits = [], []
    for lo in range(0, len(text), SLICE):
        start = max(lo - reach, 0)
        buf = np.frombuffer(text[start:lo + SLICE + reach + shape.window], np.uint8)
        place, _ = selected(buf, np.array([0, len(buf)]), rank, shape)
        place = place[(place + start >= lo) & (place + start < lo + SLICE)]
        places.append(place + start)
        bits.append(filter_bits(buf, place, shape.window))
    return np.concatenate(places), np.concatenate(bits)


def _filters(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    counts, _, raw = fingerprint.partition(":")
    n = np.array([int(c) for c in counts.split(",")])
    return n, np.unpackbits(np.frombuffer(bytes.fromhex(raw), np.uint8).reshape(len(n), -1), axis=1).astype(np.float32)


def likeness(a: str, b: str) -> float:
    """0 (nothing in common) to 1 (equal) for two fingerprints; empty ones are only like each other."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (na, fa), (nb, fb) = _filters(a), _filters(b)
    if (na.sum(), a) > (nb.sum(), b):
        na, fa, nb, fb = nb, fb, na, fa
    sa, sb = fa.sum(axis=1), fb.sum(axis=1)
    best = np.zeros(len(na))
    for i in range(0, len(na), COMPARED):
        for j in range(0, len(nb), COMPARED):
            x, y = sa[i:i + COMPARED, None], sb[None, j:j + COMPARED]
            most, chance = np.minimum(x, y), x * y / BITS
            floor = chance + CHANCE * (most - chance)
            over = fa[i:i + COMPARED] @ fb[j:j + COMPARED].T - floor
            room = most - floor
            score = np.where(room > 0, np.maximum(over, 0) / np.where(room > 0, room, 1), 0)
            best[i:i + COMPARED] = np.maximum(best[i:i + COMPARED], score.max(axis=1))
    return min(float((best * na).sum() / nb.sum()), 1.0)


def entropy_counts(window: int):
    """Number of windows of each entropy, per task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            texts, a = batch["text"].to_pylist(), 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) <= SLICE):
                    size += len(texts[b])
                    b += 1
                for buf, ends in _pieces(texts[a:b], window):
                    bins = entropy_bins(buf, window)
                    if not len(bins):
                        continue
                    inside = np.ones(len(bins), bool)
                    for e in ends[:-1].tolist():  # windows over a document's end
                        inside[max(e - window + 1, 0):e] = False
                    total += np.bincount(bins[inside], minlength=BINS)
                a = b
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bin", "n"])
    return work


def _pieces(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buffers with the ends of their documents; a long document comes in overlapping pieces."""
    if len(texts) == 1 and len(texts[0]) > SLICE:
        for lo in range(0, len(texts[0]), SLICE):
            buf = np.frombuffer(texts[0][lo:lo + SLICE + window - 1], np.uint8)
            yield buf, np.array([len(buf)])
    else:
        yield np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(x) for x in texts])


def entropy_ranks(df: DataFrame, text_col: str = "text", window: int = Features.window) -> np.ndarray:
    """Rank of each entropy bin over all windows of all texts, rarest first."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    counts = np.zeros(BINS, np.int64)
    rows = df.select(text.alias("text")).mapInArrow(entropy_counts(window), "bin int, n long")
    for r in rows.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # at most BINS rows
        counts[r["bin"]] = r["n"]
    return rank_of(counts)


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Features = Features(),
                ranks: np.ndarray | None = None) -> DataFrame:
    """doc_id, fingerprint of every row: equal texts have equal fingerprints.

    ``ranks`` fixes the rarity of the entropy bins; without it, it is that of the table's own
    texts, and fingerprints of different tables do not compare. Null text counts as empty; an empty
    text has an empty fingerprint, one of under SMALL bytes is one feature. Null ids stay null,
    repeated rows each give a row, other columns are ignored, an empty table gives an empty result.
    """
    rank = entropy_ranks(df, text_col, shape.window) if ranks is None else ranks
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(fingerprints(batch["text"].to_pylist(), rank, shape), pa.string())],
                names=["doc_id", "fingerprint"])
    return df.select(F.col(id_col).alias("doc_id"), text.alias("text")).mapInArrow(
        work, f"doc_id {df.select(F.col(id_col)).schema[0].dataType.simpleString()}, fingerprint string")


def edited(text: str, after: str) -> str:
    """The text with its last quarter replaced by the first as many characters of another."""
    n = len(text) // 4
    return text[:len(text) - n] + after[:n]


#: Rows between the two steps: fingerprints as bytes, the edited one as what differs from the other.
PROBE = ("doc_id long, at long, n_chars long, edited_sha binary, counts string, bits binary, edited_counts string, "
         "change binary, near_edited double, near_next double, text binary")
OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
       "near_next double")
ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}


def _batch(ddl: str, cols: list) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in ddl.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[k]) for c, k in zip(cols, kinds)], names=names)


def _split(fingerprint: str) -> tuple[str, bytes]:
    counts, _, bits = fingerprint.partition(":")
    return counts, bytes.fromhex(bits)


def _join(counts: str, bits: bytes) -> str:
    return f"{counts}:{bits.hex()}" if counts else ""


def _differ(a: bytes, b: bytes) -> bytes:
    """b, with the bytes that a has too exclusive-ored by them; twice gives b again."""
    n = min(len(a), len(b))
    return (np.frombuffer(a, np.uint8, n) ^ np.frombuffer(b, np.uint8, n)).tobytes() + b[n:]


def _probe(ids: list, at: list, texts: list[bytes], after: list[bytes], prints: list[str], after_prints: list[str],
           rank: np.ndarray, shape: Features, keep_text: list[bool]) -> pa.RecordBatch:
    spoken = [t.decode("utf-8", "surrogateescape") for t in texts]
    changed = [edited(s, x.decode("utf-8", "surrogateescape")).encode("utf-8", "surrogateescape") for s, x in zip(spoken, after)]
    new = fingerprints(changed, rank, shape)
    mine, theirs = [_split(p) for p in prints], [_split(p) for p in new]
    return _batch(PROBE, [ids, at, [len(s) for s in spoken], [hashlib.sha256(c).digest() for c in changed],
                          [c for c, _ in mine], [x for _, x in mine], [c for c, _ in theirs],
                          [_differ(x, y) for (_, x), (_, y) in zip(mine, theirs)],
                          [likeness(a, b) for a, b in zip(prints, new)], [likeness(a, b) for a, b in zip(prints, after_prints)],
                          [t if k else None for t, k in zip(texts, keep_text)]])


def _spelled_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PROBE as rows of OUT."""
    for batch in batches:
        c = {name: batch[name].to_pylist() for name in batch.schema.names}
        yield _batch(OUT, [c["doc_id"], c["n_chars"], [x.hex() for x in c["edited_sha"]], list(map(_join, c["counts"], c["bits"])),
                           [_join(n, _differ(x, y)) for n, x, y in zip(c["edited_counts"], c["bits"], c["change"])],
                           c["near_edited"], c["near_next"]])


def edit_probe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Features = Features(),
               ranks: np.ndarray | None = None) -> DataFrame:
    """How like each text is to an edited copy of it, and to the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    edited text has its last floor(n_chars / 4) code points replaced by the first as many of the
    next document; documents ascend by id, null ids last, rows of one id by their text's hash, and
    the first follows the last. Null text counts as empty; a single row is its own next. Other
    columns are ignored; an empty table gives an empty result.
    """
    rank = entropy_ranks(df, text_col, shape.window) if ranks is None else ranks
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc(), F.monotonically_increasing_id().asc()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows but the last of a partition are finished; its first and last row keep their text."""
        held = None
        for batch in batches:
            ids, texts, at = (batch[c].to_pylist() for c in ("doc_id", "text", "at"))
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) <= SLICE):
                    size += len(texts[b])
                    b += 1
                part = list(zip(ids[a:b], at[a:b], texts[a:b], fingerprints(texts[a:b], rank, shape)))
                if held is not None:
                    part.insert(0, held)
                held = part.pop()
                if part:
                    following = [*part[1:], held]
                    yield _probe([r[0] for r in part], [r[1] for r in part], [r[2] for r in part], [r[2] for r in following],
                                 [r[3] for r in part], [r[3] for r in following], rank, shape,
                                 [r[1] & ((1 << ROW_BITS) - 1) == 0 for r in part])
                a = b
        if held is not None:
            doc, at, text, mark = held
            counts, bits = _split(mark)
            yield _batch(PROBE, [[x] for x in (doc, at, None, None, counts, bits, None, None, None, None, text)])

    tables = Tables(df.sparkSession)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order[:2])
    ranged = ranged.withColumn("at", F.monotonically_increasing_id())
    found = tables.store(ranged.mapInArrow(work, PROBE), "probe", compression="zstd")

    # the last row of each partition meets the first row of the next one; both frames have a row per partition
    edge = found.where("text IS NOT NULL").withColumn("pid", F.shiftright("at", ROW_BITS))
    lasts = edge.where("n_chars IS NULL")
    firsts = edge.where(F.col("at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) == 0).select(
        F.col("pid").alias("next_pid"), F.col("text").alias("after"), F.col("counts").alias("after_counts"),
        F.col("bits").alias("after_bits"))
    pids = sorted(r["pid"] for r in lasts.select("pid").collect())
    follows = df.sparkSession.createDataFrame(
        [(p, pids[(i + 1) % len(pids)]) for i, p in enumerate(pids)], "pid long, next_pid long")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c = {name: batch[name].to_pylist() for name in batch.schema.names}
                yield _probe(c["doc_id"], c["at"], c["text"], c["after"], list(map(_join, c["counts"], c["bits"])),
                             list(map(_join, c["after_counts"], c["after_bits"])), rank, shape, [False] * batch.num_rows)

    ends = lasts.join(F.broadcast(follows), "pid").join(firsts, "next_pid").select(
        "doc_id", "at", "text", "after", "counts", "bits", "after_counts", "after_bits").mapInArrow(finish, PROBE)
    return found.where("n_chars IS NOT NULL").unionByName(ends).drop("at", "text").mapInArrow(_spelled_out, OUT)


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edit_probe(spark.read.parquet(f"{sf_dir}/documents.parquet"))


__all__ = ["Features", "fingerprint", "entropy_ranks", "likeness", "edit_probe", "op13_fingerprints"]
