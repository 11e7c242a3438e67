"""Vectorised helpers over one concatenated byte buffer: words, span hashes, packed arrays.

A *run* is a group of whole documents that one task holds: their UTF-8 bytes lie end to end in
one buffer and ``offsets`` has one more entry than there are documents. All functions work in
blocks of ``BLOCK`` bytes, so temporaries do not grow with the longest document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
U64 = np.uint64
_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)


def is_space_table() -> np.ndarray:
    """True at the six ASCII blanks: tab, line feed, vertical tab, form feed, return, space."""
    t = np.zeros(256, bool)
    t[[9, 10, 11, 12, 13, 32]] = True
    return t


SPACE = is_space_table()


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spread every input bit over the word."""
    h = h ^ (h >> U64(33))
    h = h * _M1
    h ^= h >> U64(29)
    h *= _M2
    h ^= h >> U64(32)
    return h


def run_buffer(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column, without a Python object per value."""
    if isinstance(col, pa.Array):
        col = pa.chunked_array([col])
    parts, lengths = [], []
    for c in col.chunks:
        if not len(c):
            continue
        c = c.cast(pa.large_binary())
        o = np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1]
        parts.append(np.frombuffer(c.buffers()[2] or b"", np.uint8)[o[0]:o[-1]])
        lengths.append(np.diff(o))
    if not parts:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    lens = np.concatenate(lengths)
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)), np.concatenate([[0], np.cumsum(lens)])


class SpanHash:
    """64-bit polynomial hash of arbitrary byte spans of a buffer, from prefix sums.

    ``fold`` maps each byte before hashing (used to lower-case A-Z).
    """

    def __init__(self, seed: int, fold: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        word = rng.integers(0, 1 << 63, 258, dtype=np.uint64) * U64(2) + U64(1)
        self.table = word[:256] if fold is None else word[:256][fold]
        base = int(word[256])
        inverse = pow(base, -1, 1 << 64)
        self.base = base
        self.powers = self._powers(base, BLOCK)
        # inverse ** s from its three 12-bit digits (and a fourth for very long runs)
        self.digits = [self._powers(pow(inverse, 1 << (12 * k), 1 << 64), 1 << 12) for k in range(4)]

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(1, U64)
        while len(out) < n:
            step = U64(pow(base, len(out), 1 << 64))
            out = np.concatenate([out, out * step])
        return out[:n]

    def _prefix(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Sum of table[byte] * base**index before each of the sorted positions."""
        out = np.empty(len(at), U64)
        carry, scale = U64(0), 1
        step = pow(self.base, BLOCK, 1 << 64)
        lo = 0
        for b in range(0, len(buf) + 1, BLOCK):
            hi = np.searchsorted(at, b + BLOCK, "left")
            part = buf[b:b + BLOCK]
            sums = np.empty(len(part) + 1, U64)
            sums[0] = 0
            np.cumsum(self.table[part] * self.powers[:len(part)], out=sums[1:])
            sums *= U64(scale)
            sums += carry
            if hi > lo:
                out[lo:hi] = sums[at[lo:hi] - b]
            lo, carry, scale = hi, sums[-1], scale * step % (1 << 64)
        return out

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of buf[starts[i]:ends[i]] for non-overlapping spans in ascending order."""
        if not len(starts):
            return np.zeros(0, U64)
        with np.errstate(over="ignore"):
            h = self._prefix(buf, ends) - self._prefix(buf, starts)
            for k, digit in enumerate(self.digits):
                at = (starts >> (12 * k)) & 0xFFF
                if k and not at.any():
                    continue
                h *= digit[at]
            return mix(h + (ends - starts).astype(U64))


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document index of every word (maximal run of non-blank bytes)."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts, ends = [], []
    for b in range(0, n, BLOCK):
        e = min(n, b + BLOCK)
        solid = ~SPACE[buf[b:e]]
        before = np.empty(e - b, bool)
        before[1:] = solid[:-1]
        before[0] = b > 0 and not SPACE[buf[b - 1]]
        after = np.empty(e - b, bool)
        after[:-1] = solid[1:]
        after[-1] = e < n and not SPACE[buf[e]]
        starts.append(np.flatnonzero(solid & (~before | cut[b:e])) + b)
        ends.append(np.flatnonzero(solid & (~after | cut[b + 1:e + 1])) + b + 1)
    s, t = np.concatenate(starts), np.concatenate(ends)
    return s, t, np.searchsorted(offsets, s, "right") - 1


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start..start+length-1 of every span, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the positions 0..n-1 that lie in [start, start + width) of any start."""
    mark = np.zeros(n, bool)
    mark[starts] = True
    return covered_from(mark, width)


def covered_from(mark: np.ndarray, width: int) -> np.ndarray:
    """Mask of the positions that a marked one is at or less than ``width`` before."""
    seen = np.cumsum(mark, dtype=np.int32)
    out = seen > 0
    out[width:] = seen[width:] > seen[:-width]
    return out


def pack(a: np.ndarray) -> bytes:
    """Bytes of an array, one plane per byte of the item, compressed."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b""
    return pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes, n: int, dtype) -> np.ndarray:
    """Inverse of :func:`pack`."""
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(pa.decompress(blob, decompressed_size=n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(dtype).reshape(n) if n else np.zeros(0, dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending unsigned array, as packed differences."""
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(blob: bytes, n: int, dtype) -> np.ndarray:
    return np.cumsum(unpack(blob, n, dtype), dtype=dtype)


def pack_bits(mask: np.ndarray) -> bytes:
    return pa.compress(np.packbits(mask).tobytes(), codec="zstd", asbytes=True)


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=(n + 7) // 8, codec="zstd")
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def split_points(buckets_sorted: np.ndarray, n: int) -> np.ndarray:
    """Bounds of each bucket 0..n-1 in an ascending bucket column."""
    return np.searchsorted(buckets_sorted, np.arange(n + 1))
