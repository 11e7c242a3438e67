"""SAS transport files (version 5) as a Spark data source, ``sas_transport``.

The layout is SAS Institute's public record layout of transport data sets (TS-140): records of 80
bytes; a library and a member header; one description of 140 bytes per column; then rows of a
fixed length, numbers as IBM System/370 doubles and text padded with blanks, up to the end of the
file, which is padded to a whole record with blanks. A file holds one data set.

Rows have a fixed length, so a file is read by as many tasks as there are ranges of ``split_bytes``,
each a whole number of rows. A task reads its range in batches and decodes only the wanted columns,
a column of a batch at a time. A path is a file or a folder of files (the writer's tasks write one
each), in any file system that Arrow opens.

Differences that the format makes: there is no empty text (a blank value is null), trailing blanks
are not kept, NaN and the infinities are missing (null), numbers are doubles whose size is under
7.2e75 (smaller than 5.4e-79 gives 0), and blank rows at the end of a file that are shorter than
80 bytes cannot be told from padding.
"""

from __future__ import annotations

import struct
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

# ---------------------------------------------------------------------------------------------
# Fixed values of the format.
RECORD = 80
COLUMN_BYTES = 140
LIBRARY = b"HEADER RECORD*******LIBRARY HEADER RECORD!!!!!!!000000000000000000000000000000  "
MEMBER = b"HEADER RECORD*******MEMBER  HEADER RECORD!!!!!!!000000000000000001600000000140  "
DESCRIPTOR = b"HEADER RECORD*******DSCRPTR HEADER RECORD!!!!!!!000000000000000000000000000000  "
COLUMNS = b"HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!000000%04d00000000000000000000  "
ROWS = b"HEADER RECORD*******OBS     HEADER RECORD!!!!!!!000000000000000000000000000000  "
NUMBER, TEXT = 1, 2
LONGEST_TEXT = 200
# Numeric missing values: a first byte of '.', '_' or 'A' to 'Z', then zeros.
MISSING = (0x2E, 0x5F, *range(0x41, 0x5B))
# ---------------------------------------------------------------------------------------------

SPLIT_BYTES = 64 << 20
BATCH_ROWS = 1 << 14
FORMAT = "sas_transport"


def ibm_to_ieee(raw: np.ndarray) -> np.ndarray:
    """Doubles of big-endian IBM 370 doubles (n x 8 bytes); missing values are NaN.

    A value is 0.fraction * 16 ** (exponent - 64): the 56 bits of the fraction are rounded to 53.
    """
    word = np.ascontiguousarray(raw).view(">u8").reshape(-1).astype(np.uint64)
    exponent = ((word >> np.uint64(56)) & np.uint64(0x7F)).astype(np.int64)
    fraction = word & np.uint64((1 << 56) - 1)
    value = np.ldexp(fraction.astype(np.float64), 4 * (exponent - 64) - 56)
    value = np.where(word >> np.uint64(63), -value, value)
    first = raw[:, 0]
    return np.where((fraction == 0) & np.isin(first, MISSING), np.nan, value)


def ieee_to_ibm(values: np.ndarray) -> np.ndarray:
    """Big-endian IBM 370 doubles (n x 8 bytes); NaN and the infinities are missing."""
    x = np.asarray(values, np.float64)
    finite = np.isfinite(x)
    fraction, two = np.frexp(np.abs(np.where(finite, x, 0)))  # 0.5 <= fraction < 1
    sixteen = -(-two // 4)
    whole = np.ldexp(fraction, 56 - (4 * sixteen - two)).astype(np.uint64)  # exact: 53 bits, shifted by up to 3
    exponent = sixteen + 64
    if (finite & (whole != 0) & (exponent > 127)).any():
        raise ValueError("a number is too large for a SAS transport file (7.2e75)")
    small = (whole == 0) | (exponent < 0)
    word = (exponent.clip(0, 127).astype(np.uint64) << np.uint64(56)) | whole
    word = np.where(small, np.uint64(0), word | (np.signbit(x).astype(np.uint64) << np.uint64(63)))
    word = np.where(finite, word, np.uint64(0x2E << 56))
    return word.astype(">u8").view(np.uint8).reshape(-1, 8)


@dataclass(frozen=True)
class SasColumn:
    name: str
    kind: int
    length: int
    at: int


@dataclass(frozen=True)
class SasFile:
    path: str
    first: int  # byte of the first row
    size: int
    row: int  # bytes of a row
    columns: tuple[SasColumn, ...]

    def n_rows(self, f) -> int:
        """Rows up to the end of the file: blanks that fill its last record are no rows."""
        n = (self.size - self.first) // self.row
        while n and self.row < RECORD:
            last = self.first + (n - 1) * self.row
            if last < self.size - RECORD + 1 or f.read_at(self.row, last).strip(b" "):
                break
            n -= 1
        return n


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not
                                        path.startswith("file://") else path)
    return pafs.LocalFileSystem(), path


def _files(path: str) -> list[str]:
    fs, inner = _opened(path)
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [inner]
    found = fs.get_file_info(pafs.FileSelector(inner))
    return sorted(f.path for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))


def read_header(path: str, inner: str) -> SasFile:
    """Columns and row layout of one file."""
    fs, _ = _opened(path)
    with fs.open_input_file(inner) as f:
        size, at, n, length = f.size(), 0, None, COLUMN_BYTES
        if f.read_at(48, 0) != LIBRARY[:48]:
            raise ValueError(f"{inner} is no SAS transport file of version 5")
        while n is None:
            record = f.read_at(RECORD, at)
            if len(record) < RECORD:
                raise ValueError(f"{inner} has no column descriptions")
            if record.startswith(MEMBER[:48]):
                length = int(record[74:78])
            elif record.startswith(COLUMNS[:48]):
                n = int(record[54:58])
            at += RECORD
        raw = f.read_at(n * length, at)
        at += -(-n * length // RECORD) * RECORD
        if not f.read_at(RECORD, at).startswith(ROWS[:48]):
            raise ValueError(f"{inner} has no row header")
    columns = []
    for k in range(n):
        part = raw[k * length:(k + 1) * length]
        kind, _, width, _ = struct.unpack(">hhhh", part[:8])
        columns.append(SasColumn(part[8:16].decode("ascii").rstrip(), kind, width, struct.unpack(">i", part[84:88])[0]))
        label = part[16:56].decode("utf-8", "replace").rstrip()
        if label:  # long names do not fit the eight bytes of a name
            columns[-1] = SasColumn(label, *[getattr(columns[-1], x) for x in ("kind", "length", "at")])
    return SasFile(inner, at + RECORD, size, sum(c.length for c in columns), tuple(columns))


def schema_of(columns: tuple[SasColumn, ...]) -> T.StructType:
    return T.StructType([T.StructField(c.name, T.DoubleType() if c.kind == NUMBER else T.StringType()) for c in columns])


@dataclass
class Rows(InputPartition):
    """Rows first to first + n of one file."""
    path: str
    file: SasFile
    first: int
    n: int


def decode_rows(raw: bytes, row: int, columns: list[SasColumn]) -> pa.RecordBatch:
    """The wanted columns of whole rows."""
    table = np.frombuffer(raw, np.uint8).reshape(-1, row)
    arrays = []
    for c in columns:
        cell = np.ascontiguousarray(table[:, c.at:c.at + c.length])
        if c.kind == NUMBER:
            full = np.zeros((len(cell), 8), np.uint8)  # numbers may be cut to fewer bytes
            full[:, :c.length] = cell
            value = ibm_to_ieee(full)
            arrays.append(pa.array(value, mask=np.isnan(value)))
        else:
            blank = cell == 0x20
            size = c.length - np.argmin(blank[:, ::-1], axis=1)
            size[blank.all(axis=1)] = 0
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            body = cell[np.arange(c.length) < size[:, None]].tobytes()
            texts = pa.StringArray.from_buffers(len(cell), pa.py_buffer(offsets), pa.py_buffer(body))
            arrays.append(pc.if_else(pa.array(size > 0), texts, pa.scalar(None, pa.string())))
    return pa.RecordBatch.from_arrays(arrays, names=[c.name for c in columns])


class SasReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options
        self.path = options["path"]
        self.split = int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self) -> list[Rows]:
        parts = []
        fs, _ = _opened(self.path)
        for inner in _files(self.path):
            file = read_header(self.path, inner)
            with fs.open_input_file(inner) as f:
                total = file.n_rows(f)
            step = max(self.split // max(file.row, 1), 1)
            parts += [Rows(self.path, file, a, min(step, total - a)) for a in range(0, total, step)]
        return parts or [Rows(self.path, SasFile("", 0, 0, 1, ()), 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if not partition.n:
            return
        file = partition.file
        by_name = {c.name: c for c in file.columns}
        wanted = [by_name[f.name] for f in self.schema.fields]
        fs, _ = _opened(partition.path)
        with fs.open_input_file(file.path) as f:
            for a in range(partition.first, partition.first + partition.n, BATCH_ROWS):
                n = min(BATCH_ROWS, partition.first + partition.n - a)
                yield decode_rows(f.read_at(n * file.row, file.first + a * file.row), file.row, wanted)


def _padded(text: bytes, n: int) -> bytes:
    return text[:n].ljust(n, b" ")


def header_bytes(names: list[str], kinds: list[int], lengths: list[int]) -> bytes:
    """Everything before the rows."""
    stamp = b"01JAN60:00:00:00"
    out = [LIBRARY, b"SAS     SAS     SASLIB  9.4     " + _padded(b"", 32) + stamp, _padded(stamp, RECORD),
           MEMBER, DESCRIPTOR, b"SAS     ROWS    SASDATA 9.4     " + _padded(b"", 32) + stamp,
           _padded(stamp, 16) + _padded(b"", 64), COLUMNS % len(names)]
    at, described = 0, b""
    for k, (name, kind, length) in enumerate(zip(names, kinds, lengths)):
        described += struct.pack(">hhhh", kind, 0, length, k + 1) + _padded(f"V{k + 1}".encode(), 8)
        described += _padded(name.encode(), 40) + _padded(b"", 8) + struct.pack(">hhh", 0, 0, 0) + b"\0\0"
        described += _padded(b"", 8) + struct.pack(">hh", 0, 0) + struct.pack(">i", at) + b"\0" * 52
        at += length
    return b"".join(out) + _padded(described, -(-len(described) // RECORD) * RECORD) + ROWS


@dataclass
class Written(WriterCommitMessage):
    path: str


class SasWriter(DataSourceArrowWriter):
    """One file per task; files of a job that does not finish are deleted."""

    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.names = [f.name for f in schema.fields]
        numbers = (T.NumericType,)
        for f in schema.fields:
            if not isinstance(f.dataType, (*numbers, T.StringType)):
                raise ValueError(f"column {f.name}: {f.dataType.simpleString()} is neither a number nor text")
            if len(f.name.encode()) > 40:
                raise ValueError(f"column name {f.name!r} is longer than 40 bytes")
        self.kinds = [NUMBER if isinstance(f.dataType, numbers) else TEXT for f in schema.fields]
        lengths = {k.lower()[7:]: int(v) for k, v in options.items() if k.lower().startswith("length.")}
        self.lengths = [8 if k == NUMBER else lengths.get(n.lower(), LONGEST_TEXT) for n, k in zip(self.names, self.kinds)]
        if overwrite:
            raise ValueError("write to a new folder; a table in place of another one is replaced by replace_table")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, inner = _opened(self.path)
        fs.create_dir(inner)
        path = f"{inner}/part-{uuid.uuid4().hex}.xpt"
        size = 0
        with fs.open_output_stream(path) as out:
            out.write(header_bytes(self.names, self.kinds, self.lengths))
            for batch in iterator:
                raw = self._rows(batch)
                size += len(raw)
                out.write(raw)
            out.write(b" " * (-size % RECORD))
        return Written(path)

    def _rows(self, batch: pa.RecordBatch) -> bytes:
        cells = []
        for col, name, kind, length in zip(batch.columns, self.names, self.kinds, self.lengths):
            if kind == NUMBER:
                cells.append(ieee_to_ibm(col.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)))
            else:
                texts = col.cast(pa.string()).fill_null("")
                offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
                body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
                size = np.diff(offsets)
                if size.max(initial=0) > length:
                    raise ValueError(f"column {name}: a text of {size.max()} bytes, over its length {length}")
                cell = np.full((len(texts), length), 0x20, np.uint8)
                cell[np.arange(length) < size[:, None]] = body
                cells.append(cell)
        return np.concatenate(cells, axis=1).tobytes() if cells else b""

    def commit(self, messages: list) -> None:
        """Files of tasks that ran twice are not among the messages: only those of the messages stay."""
        fs, _ = _opened(self.path)
        kept = {m.path for m in messages if m is not None}
        for path in _files(self.path):
            if path not in kept:
                fs.delete_file(path)

    def abort(self, messages: list) -> None:
        fs, _ = _opened(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(m.path)


class SasTransport(DataSource):
    """Options: ``path``; ``columns`` (comma list, the only ones decoded), ``split_bytes``; to write,
    ``length.<column>`` for text columns (bytes, 200 without it)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        files = _files(self.options["path"])
        if not files:
            raise ValueError(f"no files in {self.options['path']}")
        whole = schema_of(read_header(self.options["path"], files[0]).columns)
        names = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        unknown = [c for c in names if c not in whole.names]
        if unknown:
            raise ValueError(f"unknown columns {unknown}")
        return T.StructType([whole[c] for c in names]) if names else whole

    def reader(self, schema: T.StructType) -> SasReader:
        return SasReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> SasWriter:
        return SasWriter(schema, self.options, overwrite)


def register_sas(spark: SparkSession) -> None:
    """Make the format known to the session; the code travels with the plan, executors need no copy."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SasTransport)


__all__ = ["FORMAT", "SasTransport", "register_sas", "ibm_to_ieee", "ieee_to_ibm", "header_bytes", "decode_rows"]
