"""SentencePiece encoding and decoding with a BPE model file, by suffix-array matching.

No piece of the model holds text on both sides of the start of a word, so texts are cut into units
before each run of blanks and each distinct unit is encoded once (see ``units``). The units that are
new in a slice are laid end to end and indexed by a suffix array (suffixes cut at the longest
piece). Every piece of the vocabulary is searched in it by bisection; its range of suffixes gives
all its occurrences, which are the edges start -> end with the piece's rank. Sorted by position
they form the graph that is relaxed: in every unit the best edge that joins two neighbouring
symbols (lowest rank, then leftmost) is taken until none is left, which is the model's BPE.
Characters without a piece become byte tokens.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arrivals_star.llm import spans
from arrivals_star.llm.units import UnitStore, slices

U64 = np.uint64
SPACE_PIECE = "▁"
NO_EDGE = 1 << 30
INDEXED = 1 << 18  # bytes of new units that one suffix array holds; more are encoded in parts
LONG_UNIT = 256  # longer units are merged by a heap instead of in step with the others
IDS = "doc_id long, ids array<int>"
TEXT = "doc_id long, ids array<int>, text string"
BLANK = np.zeros(256, bool)
BLANK[32] = True


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Pieces of a model file with their ranks, and the tables for matching and decoding."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        text = [sp.id_to_piece(i) for i in range(size)]
        self.byte_id = np.zeros(256, np.int64)
        normal, shown = [], []
        for i in range(size):
            if sp.is_byte(i):
                self.byte_id[int(text[i][1:-1], 16)] = i
                shown.append(bytes([int(text[i][1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                shown.append(b"")
            else:
                normal.append(i)
                shown.append(text[i].replace(SPACE_PIECE, " ").encode())
        if any(SPACE_PIECE in text[i].lstrip(SPACE_PIECE) for i in normal):
            raise ValueError("a piece of the model holds a blank after other characters")
        lengths = np.array([len(b) for b in shown])
        self.shown, self.shown_len = np.frombuffer(b"".join(shown), np.uint8), lengths
        self.shown_at = np.cumsum(lengths) - lengths
        # equal scores are equal ranks: the leftmost goes first
        scores = np.array([sp.get_score(i) for i in range(size)])
        self.rank = np.full(size, NO_EDGE, np.int64)
        self.rank[normal] = np.unique(-scores[normal], return_inverse=True)[1]
        self.pieces = [text[i].encode() for i in normal]
        self.piece_id = np.array(normal)
        self.piece_chars = np.array([len(text[i]) for i in normal])
        self.most_chars = int(self.piece_chars.max())
        self.width = -(-max(map(len, self.pieces)) // 8) * 8
        self.short = np.array([len(p) <= 8 for p in self.pieces])
        pad = lambda p, n, b: p + b * (n - len(p))
        number = lambda b: [int.from_bytes(pad(p, 8, b)) for p, s in zip(self.pieces, self.short) if s]
        self.short_low, self.short_high = np.array(number(b"\0"), U64), np.array(number(b"\xff"), U64)
        long = [p for p, s in zip(self.pieces, self.short) if not s]
        self.long_low = np.array(long, f"S{self.width}")
        self.long_high = np.array([pad(p, self.width, b"\xff") for p in long], f"S{self.width}")
        # ASCII characters that no longer piece holds: text can be cut on both sides of them
        inside = {c for p, n in zip((text[i] for i in normal), self.piece_chars) if n > 1 for c in p}
        self.alone = np.zeros(256, bool)
        self.alone[[b for b in range(128) if chr(b) not in inside and b != 32]] = True
        self.store = UnitStore()

    # -- suffix array and edges --

    def edges(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``at``, piece number) of every occurrence of every piece, by place.

        ``at`` holds the character starts of ``raw``, whose units end with a byte 0.
        """
        n, width = len(at), self.width
        wide = np.concatenate([raw, np.zeros(width, np.uint8)])
        key = np.lib.stride_tricks.sliding_window_view(wide, width)[at]
        key[np.maximum.accumulate(key == 0, axis=1)] = 0  # nothing behind the end of the unit
        cols = key.view(">u8").astype(U64)
        order = np.argsort(cols[:, 0], kind="stable")
        fresh = np.ones(n, bool)
        fresh[1:] = cols[order[1:], 0] != cols[order[:-1], 0]
        for c in range(1, width // 8):  # refine only suffixes that are still equal
            group = np.cumsum(fresh) - 1
            tied = np.flatnonzero(np.bincount(group)[group] > 1)
            tied = tied[np.add.reduceat(cols[order, c] > 0, np.flatnonzero(fresh))[group[tied]] > 0]
            if not len(tied):
                break
            sub = order[tied]
            order[tied] = sub[np.lexsort((cols[sub, c], group[tied]))]
            later = tied[1:][(tied[1:] == tied[:-1] + 1) & (group[tied[1:]] == group[tied[:-1]])]
            fresh[later] |= cols[order[later], c] != cols[order[later - 1], c]
        first = cols[order, 0]
        low, high = np.empty((2, len(self.pieces)), np.int64)
        low[self.short] = np.searchsorted(first, self.short_low, "left")
        high[self.short] = np.searchsorted(first, self.short_high, "right")
        sorted_key = key[order].view(f"S{width}").reshape(n)
        low[~self.short] = np.searchsorted(sorted_key, self.long_low, "left")
        high[~self.short] = np.searchsorted(sorted_key, self.long_high, "right")
        place = order[spans.ragged(low, high - low)]
        piece = np.repeat(np.arange(len(self.pieces)), high - low)
        by_place = np.argsort(place, kind="stable")
        return place[by_place], piece[by_place]

    # -- relaxing --

    def encode_units(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units of ``raw`` (unit k ends with a byte 0 before ``bounds[k + 1]``), and their counts."""
        at = np.flatnonzero((raw & 0xC0) != 0x80)
        unit = np.searchsorted(bounds, at, "right") - 1
        stop = at == bounds[unit + 1] - 1  # the closing bytes
        place, piece = self.edges(raw, at)
        n = len(at)
        # edges by start and length in characters, as ranks; the closing bytes have none
        table = np.full((n + 2, self.most_chars + 1), -1, np.int32)
        table[place, self.piece_chars[piece]] = self.piece_id[piece]
        nxt, prv = np.arange(1, n + 3), np.arange(-1, n + 1)
        stop = np.append(stop, [True, True])
        rank = np.append(self.rank, NO_EDGE)

        def edge_rank(c: np.ndarray) -> np.ndarray:
            """Rank of the edge over the symbol at c and the next one."""
            mid = nxt[c]
            size = nxt[mid] - c
            ok = ~stop[mid] & (size <= self.most_chars)
            return np.where(ok, rank[table[c, np.where(ok, size, 0)]], NO_EDGE)

        alive = np.ones(n, bool)
        alive[stop[:n]] = False
        best = np.full(n + 2, NO_EDGE, np.int64)
        chars = np.flatnonzero(alive)
        best[chars] = edge_rank(chars)
        counts = np.bincount(unit[chars], minlength=len(bounds) - 1)
        for u in np.flatnonzero(counts > LONG_UNIT):
            first = int(np.searchsorted(at, bounds[u]))
            self._heap(first, first + int(counts[u]), table, rank, nxt, prv, alive)
        act = chars[counts[unit[chars]] <= LONG_UNIT]
        while len(act):
            key = best[act] << 32 | act
            head = np.flatnonzero(np.append(True, unit[act[1:]] != unit[act[:-1]]))
            least = np.minimum.reduceat(key, head)
            open_unit = least < NO_EDGE << 32
            c = least[open_unit] & 0xFFFFFFFF
            mid = nxt[c]
            nxt[c] = nxt[mid]
            prv[nxt[c]] = c
            alive[mid] = False
            best[c] = edge_rank(c)
            p = prv[c]
            p = p[(p >= 0) & ~stop[p]]
            best[p] = edge_rank(p)
            stays = np.repeat(open_unit, np.diff(np.append(head, len(act))))
            act = act[stays & alive[act]]
        sym = np.flatnonzero(alive)
        ids = table[sym, np.minimum(nxt[sym] - sym, self.most_chars)]
        # characters without a piece: one token per byte
        lost = np.flatnonzero(ids < 0)
        ends = np.append(at, len(raw))
        size = np.ones(len(sym), np.int64)
        size[lost] = ends[sym[lost] + 1] - at[sym[lost]]
        out = np.repeat(ids, size).astype(np.uint16)
        if len(lost):
            where = spans.ragged(np.cumsum(size)[lost] - size[lost], size[lost])
            out[where] = self.byte_id[raw[spans.ragged(at[sym[lost]], size[lost])]]
        return out, np.bincount(unit[sym], size, len(bounds) - 1).astype(np.int64)

    def _heap(self, lo: int, hi: int, table, rank, nxt, prv, alive) -> None:
        """The same for one long unit of the characters lo..hi - 1, with a heap of edges."""
        most = self.most_chars
        queue: list[tuple[int, int, int]] = []

        def offer(c: int) -> None:
            if lo <= c and nxt[c] < hi:
                end = int(nxt[nxt[c]])
                if end - c <= most and table[c, end - c] >= 0:
                    heapq.heappush(queue, (int(rank[table[c, end - c]]), c, end))

        for c in range(lo, hi):
            offer(c)
        while queue:
            _, c, end = heapq.heappop(queue)
            if not alive[c] or nxt[c] >= hi or nxt[nxt[c]] != end:
                continue  # one of its symbols is gone or has grown
            alive[nxt[c]] = False
            nxt[c] = end
            prv[end] = c
            offer(c)
            offer(int(prv[c]))

    # -- texts --

    def encode(self, buf: np.ndarray, bounds: np.ndarray, opens: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice's texts end to end, and their counts; ``opens``: texts start here, not before."""
        sizes = np.diff(bounds)
        mark = np.frombuffer(SPACE_PIECE.encode(), np.uint8)
        marked = (buf[:-2] == mark[0]) & (buf[1:-1] == mark[1]) & (buf[2:] == mark[2]) if len(buf) > 2 else np.zeros(0, bool)
        if marked.any():  # the model takes its own mark for a blank
            buf = buf.copy()
            first = np.flatnonzero(marked)
            buf[first] = 32
            keep = np.ones(len(buf), bool)
            keep[first + 1] = keep[first + 2] = False
            sizes = np.add.reduceat(np.append(keep, False), bounds[:-1]) * (sizes > 0) if len(sizes) else sizes
            buf = buf[keep]
            bounds = np.concatenate([[0], np.cumsum(sizes)])
        if opens:  # a blank before every text that has characters
            has = sizes > 0
            out = np.full(len(buf) + int(has.sum()), 32, np.uint8)
            new = np.concatenate([[0], np.cumsum(sizes + has)])
            out[spans.ragged(new[:-1][has] + 1, sizes[has])] = buf
            buf, bounds = out, new
        n = len(buf)
        if not n:
            return np.zeros(0, np.uint16), np.zeros(len(sizes), np.int64)
        cut = np.zeros(n, bool)
        blank, alone = buf == 32, self.alone[buf]
        cut[1:] = blank[1:] & ~blank[:-1] | alone[1:] | alone[:-1]
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        whole = buf.tobytes()

        def spell(at: np.ndarray):
            units = [whole[i:j].replace(b" ", mark.tobytes()) + b"\0" for i, j in zip(starts[at].tolist(), ends[at].tolist())]
            bounds = np.concatenate([[0], np.cumsum([len(u) for u in units])])
            flat, counts, k = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)], 0
            while k < len(units):
                e = max(k + 1, int(np.searchsorted(bounds, bounds[k] + INDEXED, "right")) - 1)
                got = self.encode_units(np.frombuffer(b"".join(units[k:e]), np.uint8), bounds[k:e + 1] - bounds[k])
                flat.append(got[0])
                counts.append(got[1])
                k = e
            return np.concatenate(flat), np.concatenate(counts)

        ids, lengths = self.store.ids(buf, starts, ends, spell)
        totals = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(totals[np.searchsorted(starts, bounds)])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts with these ids end to end, and their bounds; the opening blank goes."""
        sizes = self.shown_len[ids]
        raw = self.shown[spans.ragged(self.shown_at[ids], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        first = ends[:-1][(np.diff(ends) > 0)]
        drop = first[raw[first] == 32]
        keep = np.ones(len(raw), bool)
        keep[drop] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        return raw[keep], kept[ends]


class _Model:
    """The model of a file, loaded at its first use in a task."""

    def __init__(self, path: str):
        self.path, self.model = path, None

    def __call__(self) -> PieceModel:
        self.model = self.model or PieceModel(self.path)
        return self.model


def encode_batches(load: _Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = load()
            buf, offsets = spans.run_buffer(batch["text"])
            held: list[np.ndarray] = []

            def rows(first: int, flat: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.int32)))
                return pa.RecordBatch.from_arrays([batch["doc_id"].slice(first, len(counts)), ids], names=["doc_id", "ids"])

            for first, lo, hi, bounds in slices(buf, offsets, BLANK):
                flat, counts = model.encode(buf[lo:hi], bounds, lo == offsets[first])
                if hi < offsets[first + 1]:
                    held.append(flat)
                    continue
                if held:
                    flat = np.concatenate([*held, flat])
                    counts, held = np.array([len(flat)]), []
                yield rows(first, flat, counts)
    return work


def decode_batches(load: _Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = load()
            col = batch["ids"].fill_null([]) if batch["ids"].null_count else batch["ids"]
            bounds = col.offsets.to_numpy().astype(np.int64)
            raw, ends = model.decode(col.values.to_numpy()[bounds[0]:bounds[-1]].astype(np.int64), bounds - bounds[0])
            text = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)])
            try:
                text = text.cast(pa.string())
            except pa.ArrowInvalid:  # byte tokens that are no UTF-8: replaced, as the library does
                text = pa.array([t.decode("utf-8", "replace") for t in text.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], text], names=["doc_id", "ids", "text"])
    return work


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id and the ids of every text, equal to the sentencepiece library's on the same model.

    Null and empty texts have no ids. Null ids of documents stay null; repeated rows each give a
    row; other columns are ignored; an empty table gives an empty result.
    """
    docs = _documents(df, id_col, text_col)
    return docs.mapInArrow(encode_batches(_Model(path or model_path())), IDS)


def decode_documents(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """doc_id, ids and the text they spell. Null or no ids are the empty text.

    Exact for the ids of any text, but that the model's own mark comes back as a blank.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(decode_batches(_Model(path or model_path())), TEXT)


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, ids and decoded text of every document: both steps in one task, with one model."""
    load = _Model(path or model_path())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decode_batches(load)(encode_batches(load)(batches))

    return _documents(df, id_col, text_col).mapInArrow(work, TEXT)


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_hash (xxhash64 of the id array), decoded_sha256 of every document."""
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("text", 256).alias("decoded_sha256"))


__all__ = ["PieceModel", "encode_documents", "decode_documents", "round_trip", "op4_sentencepiece"]
