"""Packing: documents in the order of a space-filling curve, cut into full sequences.

A document's hashed byte grams are projected to ``DIMS`` numbers; the cell they fall in has a
place on a Hilbert curve. Documents are range-sorted by that place (copies and hot places are
spread by a hash of the id), and each range is packed as one stream: sequences of ``length`` ids,
then the rest of the range in sequences of powers of two, so nothing is padded.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from arrivals_star.llm import spans
from arrivals_star.llm.runs import arrow_rows, shuffle_partitions
from arrivals_star.llm.units import UnitStore, slices

U64 = np.uint64
DIMS, BITS, SLOTS = 4, 8, 1 << 12
END_ID = 1
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long")
MARK = "\x01"  # stands for the end of a word; text that holds it is encoded by the library itself
BLANK = spans.SPACE


# --- the curve -----------------------------------------------------------------------------------

def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # inverse undo
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) > 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):  # Gray encode
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(17).normal(size=(DIMS, SLOTS)).astype(np.float32)


def curve_cells(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Cells (documents x DIMS) of the mean projection of each document's hashed 4-byte grams."""
    n, size = len(offsets) - 1, 4
    sums, table = np.zeros((n, DIMS)), _projection()
    for b in range(0, max(len(buf) - size + 1, 0), spans.BLOCK):
        e = min(len(buf) - size + 1, b + spans.BLOCK)
        part = np.ascontiguousarray(buf[b:e + size - 1])
        gram = np.ndarray((e - b,), "<u4", part, strides=(1,))
        slot = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)
        # grams that reach into the next document say nothing about either; they count for the first
        first = int(np.searchsorted(offsets, b, "right")) - 1
        last = int(np.searchsorted(offsets, e, "left"))
        inside = np.clip(offsets[first:last], b, e) - b
        docs = np.flatnonzero(np.diff(np.append(inside, e - b)) > 0)
        for k in range(DIMS):
            sums[first + docs, k] += np.add.reduceat(table[k][slot], inside[docs])
    mean = sums / np.maximum(np.diff(offsets), 1)[:, None]
    return np.minimum((np.tanh(mean * 4) + 1) / 2 * (1 << BITS), (1 << BITS) - 1).astype(np.int64)


@F.arrow_udf(LongType())
def curve_key(text: pa.Array) -> pa.Array:
    buf, offsets = spans.run_buffer(text)
    return pa.array(hilbert_key(curve_cells(buf, offsets), BITS))


# --- the tokeniser -------------------------------------------------------------------------------

def _kinds() -> np.ndarray:
    """Class of each byte: 0 blank, 1 letter, 2 digit, 3 other ASCII sign, 4 left to the library."""
    t = np.full(256, 4, np.uint8)
    t[33:127] = 3
    t[48:58] = 2
    t[65:91] = t[97:123] = 1
    t[[ord("'"), ord("<")]] = 4  # contractions, special tokens
    t[0xC3] = 1  # Latin-1 letters are this byte and one more
    t[BLANK] = 0
    return t


KINDS = _kinds()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class WordTokeniser:
    """Ids of a lower-casing word-end BPE vocabulary, as the tokenizers library gives them.

    Runs of ASCII and Latin-1 letters, single digits and runs of ASCII signs are split here and
    merged by the fast BPE of tiktoken on the same vocabulary, in which a byte 1 stands for the
    word end; blank-separated text with any other character goes to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        shown = _byte_letters()
        ranks, ends = {}, np.zeros(1 << 16, bool)
        for token, i in vocab.items():
            end = token.endswith("</w>") and token != "</w>"
            raw = bytes(shown[c] for c in (token[:-4] if end else token))
            ends[i] = end
            if MARK.encode() not in raw or len(raw) == 1 and not end:
                ranks[raw + MARK.encode() if end else raw] = i
        self.fast = tiktoken.Encoding("words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})
        self.ends = ends
        self.store = UnitStore()

    def units(self, buf: np.ndarray, bounds: np.ndarray):
        """Lower-cased copy, starts, ends and whether the library is needed, of a slice's units."""
        kind = KINDS[buf]
        lead = np.flatnonzero(buf == 0xC3)
        text = LOWER[buf]
        if len(lead):
            lead = lead[lead + 1 < len(buf)]
            second = buf[lead + 1]
            letter = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)
            kind[lead[letter] + 1] = 1
            kind[lead[~letter]] = 4
            upper = lead[letter & (second <= 0x9E)] + 1
            text[upper] = buf[upper] + 0x20
        starts, ends, _ = spans.words(buf, bounds)
        if not len(starts):
            return text, starts, ends, np.zeros(0, bool)
        odd = np.zeros(len(buf) + 1, np.int32)
        np.cumsum(kind == 4, out=odd[1:])
        slow = odd[ends] > odd[starts]
        if slow.any():
            inside = spans.ragged(starts[slow], (ends - starts)[slow])
            text[inside] = buf[inside]
            kind[inside] = 4
        # units of the other words: from one change of class to the next; digits stand alone
        cut = np.ones(len(buf), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        inner = bounds[(bounds > 0) & (bounds < len(buf))]
        cut[inner] = True
        if slow.any():
            cut[starts[slow]] = True
        at = np.flatnonzero(cut)
        stop = np.append(at[1:], len(buf))
        used = kind[at] != 0
        return text, at[used], stop[used], kind[at[used]] == 4

    def encode(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice's documents end to end, and each document's number of ids."""
        text, starts, ends, slow = self.units(buf, bounds)
        raw = text.tobytes()

        def spell(at: np.ndarray):
            slow_at = slow[at]
            joined = b"".join(raw[i:j] + b"\x01" for i, j in zip(starts[at[~slow_at]].tolist(), ends[at[~slow_at]].tolist()))
            flat = np.array(self.fast.encode_ordinary(joined.decode("utf-8")), np.uint16)
            stop = np.flatnonzero(self.ends[flat]) + 1
            lengths = np.zeros(len(at), np.int64)
            lengths[~slow_at] = np.diff(stop, prepend=0)
            if not slow_at.any():
                return flat, lengths
            words = [raw[i:j].decode("utf-8", "replace") for i, j in zip(starts[at[slow_at]].tolist(), ends[at[slow_at]].tolist())]
            got = [e.ids for e in self.library.encode_batch(words, add_special_tokens=False)]
            lengths[slow_at] = [len(g) for g in got]
            out, place = np.zeros(int(lengths.sum()), np.uint16), np.cumsum(lengths) - lengths
            out[spans.ragged(place[~slow_at], lengths[~slow_at])] = flat
            out[spans.ragged(place[slow_at], lengths[slow_at])] = np.array([i for g in got for i in g], np.uint16)
            return out, lengths

        ids, lengths = self.store.ids(text, starts, ends, spell)
        totals = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(totals[np.searchsorted(starts, bounds)])


def _byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones for themselves,
    the others, in order, for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


# --- packing -------------------------------------------------------------------------------------

class Packer:
    """Cuts a stream of documents into pieces of full sequences; yields rows of finished ones."""

    def __init__(self, length: int, sequence_id: int):
        self.length, self.sequence_id = length, sequence_id
        self.waiting: list[tuple] = []  # (doc, start, ids, doc_tokens) of the open sequence
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        start, total = 0, len(ids)
        while start < total:
            take = min(total - start, self.length - self.held)
            self.waiting.append((doc, start, ids[start:start + take], total))
            self.held += take
            start += take
            if self.held == self.length:
                yield from self._close(self.length)

    def _close(self, size: int) -> Iterator[tuple]:
        """Rows of one sequence of the first ``size`` waiting ids."""
        offset, left = 0, []
        for doc, start, ids, total in self.waiting:
            take = min(len(ids), size - offset)
            if take:
                yield (doc, start, take, zlib.crc32(ids[:take].astype("<u4").tobytes()), total, self.sequence_id, offset, size)
                offset += take
            if take < len(ids):
                left.append((doc, start + take, ids[take:], total))
        self.waiting, self.held = left, self.held - size
        self.sequence_id += 1

    def finish(self) -> Iterator[tuple]:
        """The rest of the stream, in sequences of falling powers of two."""
        while self.held:
            yield from self._close(1 << (self.held.bit_length() - 1))


def pack_partition(path: str, length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokeniser = None
        packer = Packer(length, TaskContext.get().partitionId() << 40)
        for batch in batches:
            if tokeniser is None:
                tokeniser = WordTokeniser(path)
            ids = batch["doc_id"].to_pylist()
            buf, offsets = spans.run_buffer(batch["text"])
            rows, held, owner = [], [], None  # parts of a document that is longer than a slice

            def flush(owner, held):
                return packer.add(ids[owner], np.concatenate([*held, np.array([END_ID], np.uint16)]))

            for first, lo, hi, bounds in slices(buf, offsets, BLANK):
                flat, sizes = tokeniser.encode(buf[lo:hi], bounds)
                at = np.concatenate([[0], np.cumsum(sizes)])
                for k in range(len(sizes)):
                    if owner is not None and owner != first + k:
                        rows += flush(owner, held)
                        held = []
                    owner = first + k
                    held.append(flat[at[k]:at[k + 1]])
            if owner is not None:
                rows += flush(owner, held)
            if rows:
                yield from arrow_rows(rows, PIECES).to_batches()
        if packer.held:
            yield from arrow_rows(list(packer.finish()), PIECES).to_batches()
    return work


def tokeniser_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 2048,
                   path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    A document's ids are those of the vocabulary file ``path`` without special tokens, then id 1.
    Every id lies in exactly one piece; the pieces of a sequence follow each other from offset 0.
    Sequences hold ``length`` ids, or a smaller power of two at the end of a range, so none is
    padded. Null and empty texts are the end id alone. Null ids stay null; rows that repeat an id
    are packed each; other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    keyed = docs.withColumn("place", curve_key("text")).withColumn("spread", F.xxhash64("doc_id", F.octet_length("text")))
    ordered = (keyed.repartitionByRange(shuffle_partitions(df), "place", "spread")
               .sortWithinPartitions("place", "spread").select("doc_id", "text"))
    return ordered.mapInArrow(pack_partition(path or tokeniser_path(), length), PIECES)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


__all__ = ["hilbert_key", "WordTokeniser", "Packer", "pack_documents", "op6_packing"]
