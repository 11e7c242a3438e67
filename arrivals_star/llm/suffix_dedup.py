"""Suffix-array dedup: drop bytes covered by a 50-byte string of an earlier document.

The suffixes that matter are sorted by a distributed merge sort that is aware of common prefixes:

1. *Anchors.* Every window of ``width`` bytes has one anchor, the leftmost smallest hash of its
   16-byte grams, so equal windows have their anchor at the same place. Only suffixes at anchors
   (about one position in eighteen) are considered.
2. *Which can repeat.* Any window holds one of two 32-byte strings round its anchor. Runs of
   documents exchange sorted fingerprints of these, and learn which occur in two documents;
   suffixes round which neither does cannot repeat and are not sent.
3. *Merge sort.* Each run sorts its remaining suffixes (the ``width`` bytes from the anchor, then
   the bytes before it, read backwards), front-codes them against their neighbours and sends them
   to buckets; a bucket merges its runs with a loser tree whose nodes remember the common prefix
   with the last output, so that bytes known to be equal are never compared again.
4. *Answer.* From the merged order and its common prefixes a bucket knows, for each split of the
   window into m bytes before and width - m after the anchor, the smallest document with an equal
   window, by exact comparison of bytes. Runs get one bit per suffix and m back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from arrivals_star.llm import spans
from arrivals_star.llm.runs import MAX_ID, RUN_BYTES, arrow_rows, documents_in_runs, shuffle_partitions

U64 = np.uint64
GRAM = 16
PRINT = 32  # bytes of a fingerprinted string
ROWS = 1 << 13  # suffixes whose windows are marked at once
PAD = 0xFF  # stands for "outside the document"; UTF-8 has no such byte
PRINTS = "bucket int, run int, n long, prints binary, many binary"
KEYS = "bucket int, run int, n long, shared binary, tail binary, n_tail long, doc binary"
REPLY = "run int, kind int, bucket int, n long, mask binary"
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _words_at(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes at every position, as one unaligned view (buf has 8 spare bytes)."""
    return np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))


def _hash32(view: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the 32 bytes at each position."""
    h = np.full(len(at), U64(seed), U64)
    with np.errstate(over="ignore"):
        for k in range(0, PRINT, 8):
            h = spans.mix(h * U64(0x9E3779B97F4A7C15) + view[at + k])
    return h


class RunSuffixes:
    """Anchors of one run's documents, which are kept in id order."""

    def __init__(self, table: pa.Table, width: int, n_buckets: int):
        ids = table["doc_id"].combine_chunks()
        self.doc_id = ids.to_pylist()
        self.id_of_doc = ids.fill_null(MAX_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        text, self.offsets = spans.run_buffer(table["text"])
        # spare bytes on both sides, so that no read near an end needs a test
        self.lead = width
        self.buf = np.concatenate([np.full(width, PAD, np.uint8), text, np.full(width + 8, PAD, np.uint8)])
        self.view = _words_at(self.buf)
        self.width, self.n_buckets, self.n = width, n_buckets, len(text)
        self.back = width - GRAM  # most bytes of a window before its anchor
        self.at = self._anchors()
        self.doc = np.searchsorted(self.offsets, self.at, "right") - 1
        self.left = self.at - self.offsets[self.doc]
        self.right = self.offsets[self.doc + 1] - self.at
        x = self.at + self.lead
        with np.errstate(over="ignore"):
            gram = spans.mix(self.view[x] * U64(0x9E3779B97F4A7C15) + self.view[x + 8] * U64(0xC2B2AE3D27D4EB4F))
        self.bucket = ((gram >> U64(32)) % U64(n_buckets)).astype(np.int64)

    def _anchors(self) -> np.ndarray:
        """Positions that are the leftmost smallest gram of some window within one document."""
        out, reach = [], self.width - GRAM + 1
        ends = self.offsets[1:]
        for b in range(0, max(self.n - self.width + 1, 0), spans.BLOCK):
            e = min(self.n - self.width + 1, b + spans.BLOCK)  # windows starting in [b, e)
            x = slice(b + self.lead, e + self.lead + reach - 1)
            with np.errstate(over="ignore"):
                h = self.view[x] * U64(0x9E3779B97F4A7C15)
                h += self.view[x.start + 8:x.stop + 8] * U64(0xC2B2AE3D27D4EB4F)
                h ^= h >> U64(31)
                h *= U64(0xD6E8FEB86659FD93)
            # the high 43 bits of the hash, then the place: the smallest is the leftmost smallest
            h &= ~U64((1 << 21) - 1)
            h |= np.arange(len(h), dtype=U64)
            span = 1
            while span * 2 <= reach:
                np.minimum(h[:-span], h[span:], out=h[:-span])
                h = h[:-span]
                span *= 2
            best = np.minimum(h[:e - b], h[reach - span:reach - span + e - b])
            place = (best & U64((1 << 21) - 1)).astype(np.int64)
            valid = np.ones(e - b, bool)  # the last width - 1 starts of a document cross its end
            first = np.searchsorted(ends, b, "right")
            last = np.searchsorted(ends, e + self.width, "right")
            for end in np.unique(ends[first:last]).tolist():
                valid[max(end - self.width + 1 - b, 0):max(end - b, 0)] = False
            place = place[valid] + b
            if len(place):
                out.append(place[np.concatenate([[True], place[1:] != place[:-1]])])
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)

    def prints(self):
        """Per fingerprint: (bucket, 32-bit print) in order, many documents?, and anchors' two prints."""
        x = self.at + self.lead
        after = _hash32(self.view, x, 1)
        before = _hash32(self.view, x - GRAM, 2)
        keys, ok = [], (self.right >= PRINT, (self.left >= GRAM) & (self.right >= GRAM))
        for h in (after, before):
            keys.append((h >> U64(32)) % U64(self.n_buckets) << U64(32) | h & U64(0xFFFFFFFF))
        key = np.concatenate([keys[0][ok[0]], keys[1][ok[1]]])
        doc = np.concatenate([self.doc[ok[0]], self.doc[ok[1]]])
        order = np.argsort(key, kind="stable")
        key, doc = key[order], self.id_of_doc[doc[order]]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        many = (np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)) if len(at) else np.zeros(0, bool)
        return key[at], many, keys, ok

    def repeatable(self, replies: dict) -> np.ndarray:
        """Anchors of which one of the two fingerprints occurs in two documents."""
        key, _, keys, ok = self.prints()
        mask = _masks(replies, 0, spans.split_points(key >> U64(32), self.n_buckets), len(key))
        hot = key[mask]
        keep = np.zeros(len(self.at), bool)
        for k, valid in zip(keys, ok):
            found = np.searchsorted(hot, k)
            if len(hot):
                keep |= valid & (found < len(hot)) & (hot[np.minimum(found, len(hot) - 1)] == k)
        return np.flatnonzero(keep)

    def suffixes(self, a: np.ndarray) -> np.ndarray:
        """Matrix of sort keys: width bytes from the anchor, then the bytes before it, backwards."""
        size = self.width + self.back
        rows = np.lib.stride_tricks.sliding_window_view(self.buf, size)[self.at[a] + self.lead - self.back]
        out = np.empty((len(a), size), np.uint8)
        out[:, :self.width] = rows[:, self.back:]
        out[:, self.width:] = rows[:, :self.back][:, ::-1]
        short = np.flatnonzero(self.right[a] < self.width)
        col = np.arange(self.width)
        out[short, :self.width] = np.where(col < self.right[a[short], None], out[short, :self.width], PAD)
        short = np.flatnonzero(self.left[a] < self.back)
        col = np.arange(self.back)
        out[short, self.width:] = np.where(col < self.left[a[short], None], out[short, self.width:], PAD)
        return out

    def sorted_run(self, replies: dict):
        """Repeatable suffixes by (bucket, key): anchors, new-key flags, distinct keys, first ids."""
        a = self.repeatable(replies)
        key = self.suffixes(a)
        bucket = self.bucket[a]
        order = _lexsort(key, bucket, self.id_of_doc[self.doc[a]])
        a, key, bucket = a[order], key[order], bucket[order]
        shared = common_prefix(key)
        new = np.ones(len(a), bool)
        if len(a):
            new[1:] = (shared[1:] < key.shape[1]) | (bucket[1:] != bucket[:-1])
        return a, new, key[new], bucket[new], self.id_of_doc[self.doc[a[new]]]


def _lexsort(key: np.ndarray, bucket: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Order by bucket, then bytes of the key, then ``last``."""
    size = -(-key.shape[1] // 8) * 8
    wide = np.zeros((len(key), size), np.uint8)
    wide[:, :key.shape[1]] = key
    cols = wide.view(">u8").astype(U64)
    return np.lexsort([last, *(cols[:, k] for k in range(cols.shape[1] - 1, -1, -1)), bucket])


def common_prefix(key: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the row above it; 0 for the first."""
    n, size = key.shape
    out = np.zeros(n, np.int64)
    for b in range(1, n, 1 << 15):
        e = min(n, b + (1 << 15))
        differ = key[b:e] != key[b - 1:e - 1]
        out[b:e] = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
    return out


def front_code(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix lengths and the bytes after them, end to end."""
    shared = common_prefix(key)
    return shared.astype(np.uint8), key[np.arange(key.shape[1]) >= shared[:, None]]


def front_decode(shared: np.ndarray, tail: np.ndarray, size: int) -> np.ndarray:
    key = np.zeros((len(shared), size), np.uint8)
    key[np.arange(size) >= shared[:, None].astype(np.int64)] = tail
    row = np.arange(len(shared))
    for c in range(size):  # a byte not stored is that of the last row which stored its column
        key[:, c] = key[np.maximum.accumulate(np.where(shared <= c, row, 0)), c]
    return key


def merge_runs(runs: list[list[bytes]], shared: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """Multiway merge of sorted runs with a loser tree that keeps common prefix lengths.

    Every loser stores its common prefix with the key that beat it, which is also its common prefix
    with the last output of its subtree. Of two candidates the one that shares more with the last
    output is smaller; only if both share equally much are bytes compared, from there on. Returns
    run, index in the run and common prefix with the previous output, in merged order.
    """
    k = len(runs)
    size = 1
    while size < k:
        size *= 2
    heads, nexts = [None] * size, [0] * size
    for r in range(k):
        if runs[r]:
            heads[r] = runs[r][0]
    loser, loser_shared = [0] * size, [0] * size

    def play(a: int, la: int, b: int, lb: int):
        """(winner, its prefix, loser, its prefix); an exhausted run loses."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, lb, a, 0) if x is None else (a, la, b, 0)
        if la > lb:
            return a, la, b, lb
        if la < lb:
            return b, lb, a, la
        s, t = x[la:], y[la:]
        if s == t:
            return (a, la, b, len(x)) if a < b else (b, lb, a, len(x))
        same = la + len(s) - ((int.from_bytes(s) ^ int.from_bytes(t)).bit_length() + 7) // 8
        return (a, la, b, same) if s < t else (b, lb, a, same)

    winners = [(r, 0) for r in range(size)]
    level = size
    while level > 1:
        level //= 2
        nxt = []
        for i in range(level):
            (a, la), (b, lb) = winners[2 * i], winners[2 * i + 1]
            w, lw, l, ll = play(a, la, b, lb)
            loser[level + i], loser_shared[level + i] = l, ll
            nxt.append((w, lw))
        winners = nxt
    cur, cur_shared = winners[0]
    order_run, order_at, order_shared = [], [], []
    while heads[cur] is not None:
        i = nexts[cur]
        order_run.append(cur)
        order_at.append(i)
        order_shared.append(cur_shared)
        i += 1
        nexts[cur] = i
        if i < len(runs[cur]):
            heads[cur] = runs[cur][i]
            cur_shared = shared[cur][i]
        else:
            heads[cur], cur_shared = None, 0
        node = (cur + size) // 2
        while node:
            other_shared = loser_shared[node]
            # the usual case first: this candidate shares more with the last output
            if cur_shared <= other_shared or heads[cur] is None:
                cur, cur_shared, loser[node], loser_shared[node] = play(cur, cur_shared, loser[node], other_shared)
            node //= 2
    return order_run, order_at, order_shared


def _masks(replies: dict, kind: int, bound: np.ndarray, n: int) -> np.ndarray:
    mask = np.zeros(n, bool)
    for b in range(len(bound) - 1):
        if bound[b + 1] > bound[b]:
            m, blob = replies[kind, b]
            mask[bound[b]:bound[b + 1]] = spans.unpack_bits(blob, m)
    return mask


def _replies(table: pa.Table) -> dict:
    cols = [table[c].to_pylist() for c in ("kind", "bucket", "n", "mask")]
    return {(k, b): (n, m) for k, b, n, m in zip(*cols)}


def send_prints(width: int, n_buckets: int):
    def work(key: tuple, table: pa.Table) -> pa.Table:
        run, rows = key[0].as_py(), []
        prints, many, _, _ = RunSuffixes(table, width, n_buckets).prints()
        bound = spans.split_points(prints >> U64(32), n_buckets)
        low = (prints & U64(0xFFFFFFFF)).astype(np.uint32)
        for b in range(n_buckets):
            i, j = bound[b], bound[b + 1]
            if j > i:
                rows.append((b, run, j - i, spans.pack_sorted(low[i:j]), spans.pack_bits(many[i:j])))
        return arrow_rows(rows, PRINTS)
    return work


def match_prints(key: tuple, table: pa.Table) -> pa.Table:
    """Fingerprints of one bucket that occur in two documents, as a mask for each run."""
    bucket, runs, ns = key[0].as_py(), table["run"].to_pylist(), table["n"].to_pylist()
    prints = np.concatenate([spans.unpack_sorted(c, n, np.uint32) for c, n in zip(table["prints"].to_pylist(), ns)])
    many = np.concatenate([spans.unpack_bits(c, n) for c, n in zip(table["many"].to_pylist(), ns)])
    order = np.sort(prints)
    hot = np.unique(np.concatenate([order[1:][order[1:] == order[:-1]], prints[many]]))
    found = np.searchsorted(hot, prints)
    mask = (found < len(hot)) & (hot[np.minimum(found, len(hot) - 1)] == prints) if len(hot) else np.zeros(len(prints), bool)
    bounds = np.concatenate([[0], np.cumsum(ns)])
    return arrow_rows([(r, 0, bucket, n, spans.pack_bits(mask[i:i + n])) for r, n, i in zip(runs, ns, bounds)], REPLY)


def send_suffixes(width: int, n_buckets: int):
    def work(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        run, rows = key[0].as_py(), []
        _, _, keys, bucket, doc = RunSuffixes(docs, width, n_buckets).sorted_run(_replies(replies))
        bound = spans.split_points(bucket, n_buckets)
        for b in range(n_buckets):
            i, j = bound[b], bound[b + 1]
            if j > i:
                shared, tail = front_code(keys[i:j])
                rows.append((b, run, j - i, spans.pack(shared), spans.pack(tail), len(tail), spans.pack(doc[i:j])))
        return arrow_rows(rows, KEYS)
    return work


def earlier_windows(merged: np.ndarray, shared: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """For sorted distinct keys and m: the smallest id among keys with an equal window at m."""
    n, size = merged.shape
    back = size - width
    left = merged[:, width:]
    order = _lexsort(left, np.zeros(n, np.int8), np.zeros(n, np.int8))
    left_shared = np.empty(n, np.int64)
    left_shared[order] = common_prefix(left[order])
    out = np.empty((back + 1, n), np.int64)
    out[:] = least
    for m in range(back + 1):
        right_new = shared < width - m
        right_new[0] = True
        right = np.cumsum(right_new) - 1
        pairs = np.flatnonzero(np.bincount(right)[right] > 1)
        if not len(pairs):
            continue
        new = left_shared[order] < m
        new[:1] = True
        cls = np.empty(n, np.int64)
        cls[order] = np.cumsum(new) - 1
        key = right[pairs] * n + cls[pairs]
        o = np.argsort(key, kind="stable")
        first = np.ones(len(o), bool)
        first[1:] = key[o][1:] != key[o][:-1]
        low = np.minimum.reduceat(least[pairs][o], np.flatnonzero(first))
        out[m, pairs[o]] = low[np.cumsum(first) - 1]
    return out


def merge_suffixes(width: int):
    size = width + width - GRAM

    def work(key: tuple, table: pa.Table) -> pa.Table:
        bucket, ids, ns = key[0].as_py(), table["run"].to_pylist(), table["n"].to_pylist()
        runs, shared, keys, docs = [], [], [], []
        for n, s, t, nt, d in zip(ns, *(table[c].to_pylist() for c in ("shared", "tail", "n_tail", "doc"))):
            common = spans.unpack(s, n, np.uint8)
            k = front_decode(common, spans.unpack(t, nt, np.uint8), size)
            raw = k.tobytes()
            runs.append([raw[i:i + size] for i in range(0, len(raw), size)])
            shared.append(common.tolist())
            keys.append(k)
            docs.append(spans.unpack(d, n, np.int64))
        run, at, common = (np.array(x, np.int64) for x in merge_runs(runs, shared))
        bounds = np.concatenate([[0], np.cumsum(ns)])
        entry = bounds[run] + at  # place of each merged suffix in the order of arrival
        doc = np.concatenate(docs)
        new = common < size
        new[0] = True
        cls = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        least = np.minimum.reduceat(doc[entry], firsts)
        merged = np.concatenate(keys)[entry[firsts]]
        # the common prefix of distinct neighbours: that of the first of a class with the one before
        low = earlier_windows(merged, common[firsts], least, width)
        earlier = np.empty((len(entry), size - width + 1), bool)
        for m in range(size - width + 1):
            earlier[entry, m] = low[m][cls] < doc[entry]
        return arrow_rows([(r, 1, bucket, n * earlier.shape[1], spans.pack_bits(earlier[i:i + n].reshape(-1)))
                           for r, n, i in zip(ids, ns, bounds)], REPLY)
    return work


def remove_bytes(width: int, n_buckets: int):
    def work(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        x, got = RunSuffixes(docs, width, n_buckets), _replies(replies)
        a, new, keys, bucket, first_doc = x.sorted_run(got)
        splits = x.back + 1
        bound = spans.split_points(bucket, n_buckets)
        elsewhere = _masks(got, 1, bound * splits, len(keys) * splits).reshape(len(keys), splits)
        group = np.cumsum(new) - 1
        doc = x.doc[a]
        own = x.id_of_doc[doc] > first_doc[group]
        mark, m = np.zeros(x.n, bool), np.arange(splits)  # starts of windows that go
        for b in range(0, len(a), ROWS):
            part = a[b:b + ROWS]
            hit = own[b:b + ROWS, None] | elsewhere[group[b:b + ROWS]]
            hit &= (x.left[part, None] >= m) & (x.right[part, None] >= width - m)
            row, split = np.nonzero(hit)
            mark[x.at[part[row]] - split] = True
        gone = spans.covered_from(mark, width)
        rows, text = [], x.buf[x.lead:x.lead + x.n]
        for d, doc_id in enumerate(x.doc_id):
            i, j = x.offsets[d], x.offsets[d + 1]
            g = gone[i:j]
            n_spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
            rows.append((doc_id, int(j - i), int(g.sum()), n_spans, hashlib.sha256(text[i:j][~g].tobytes()).hexdigest()))
        return arrow_rows(rows, OUT)
    return work


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50,
                 n_buckets: int | None = None, run_bytes: int = RUN_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document.

    A byte goes when a ``width``-byte string over it also starts in a document with a smaller id;
    strings never cross documents and are judged on the input. ``n_spans`` counts maximal removed
    runs. Null text is empty. Rows with equal ids do not remove each other's bytes; rows with a
    null id come after all others and keep the null. Other columns are ignored; an empty table
    gives an empty result. ``width`` is at least 48.
    """
    if width < GRAM + PRINT:
        raise ValueError(f"width must be at least {GRAM + PRINT}")
    n_buckets = n_buckets or shuffle_partitions(df)
    docs, _, _ = documents_in_runs(df, id_col, text_col, run_bytes)
    prints = docs.groupBy("run").applyInArrow(send_prints(width, n_buckets), PRINTS)
    repeated = prints.groupBy("bucket").applyInArrow(match_prints, REPLY)
    keys = (docs.groupBy("run").cogroup(repeated.groupBy("run"))
            .applyInArrow(send_suffixes(width, n_buckets), KEYS))
    merged = keys.groupBy("bucket").applyInArrow(merge_suffixes(width), REPLY)
    return (docs.groupBy("run").cogroup(repeated.unionByName(merged).groupBy("run"))
            .applyInArrow(remove_bytes(width, n_buckets), OUT))


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB twin: every window as a row, and the covered bytes as merged runs of windows.
OP2_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
w AS (SELECT doc_id, i, x[i + 1:i + 50] AS k
      FROM (SELECT doc_id, x, unnest(range(octet_length(x) - 49)) AS i FROM d WHERE octet_length(x) >= 50)),
r AS (SELECT k, min(doc_id) AS first FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)),
f AS (SELECT doc_id, i FROM w JOIN r USING (k) WHERE first < doc_id),
n AS (SELECT doc_id, i, sum(gap) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS gap FROM f)),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since, b,
         lead(a) OVER (PARTITION BY doc_id ORDER BY a) IS NULL AS last FROM s),
p AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
         string_agg(hex(x[since + 1:a]) || CASE WHEN last THEN hex(x[b + 1:octet_length(x)]) ELSE '' END, '' ORDER BY a) AS rest
  FROM kept JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(x) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(CASE WHEN rest IS NULL THEN x ELSE unhex(rest) END) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id)
"""

__all__ = ["suffix_dedup", "op2_suffix_dedup", "OP2_SQL"]
