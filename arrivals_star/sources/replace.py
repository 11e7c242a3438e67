"""Replacing a table without a moment in which neither the old nor the new one is there.

A new table is written beside the old one, to ``<path>.new-<id>``. Only when all of it is there, a
small manifest ``<path>.switch`` names it, the old folder is moved to ``<path>.old-<id>``, the new one
to ``<path>``, and manifest and old folder go. A job that ends before the manifest is written leaves
the old table in place; one that ends after it leaves a manifest, which says where the new table is:
``current_path`` reads it, and the next ``replace_table`` or ``finish_switch`` completes the moves.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _manifest(spark: SparkSession, path: str) -> dict[str, str] | None:
    fs, to_path = _fs(spark, path)
    name = to_path(path + ".switch")
    if not fs.exists(name):
        return None
    stream = fs.open(name)
    try:
        text = bytes(b & 0xFF for b in stream.readAllBytes()).decode()
    finally:
        stream.close()
    return json.loads(text) if text.endswith("}") else {}  # cut off while it was written: not in force


def current_path(spark: SparkSession, path: str) -> str:
    """Where the table's files are: ``path``, or the new folder while a switch is not finished."""
    path = path.rstrip("/")
    told = _manifest(spark, path)
    if told:
        fs, to_path = _fs(spark, path)
        if fs.exists(to_path(told["new"])):
            return told["new"]
    return path


def finish_switch(spark: SparkSession, path: str) -> None:
    """Complete a switch that a job left half-way; nothing to do without a manifest."""
    path = path.rstrip("/")
    told = _manifest(spark, path)
    if told is None:
        return
    fs, to_path = _fs(spark, path)
    if told:
        if fs.exists(to_path(told["new"])):
            if fs.exists(to_path(path)):
                _move(fs, to_path, path, told["old"])
            _move(fs, to_path, told["new"], path)
    fs.delete(to_path(path + ".switch"), False)
    if told:
        fs.delete(to_path(told["old"]), True)


def _move(fs, to_path, a: str, b: str) -> None:
    if not fs.rename(to_path(a), to_path(b)):
        raise OSError(f"could not move {a} to {b}")


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Call ``write(folder)`` with a fresh folder, then put that folder in the place of ``path``.

    The old table can be read until the switch, also by the plan that ``write`` runs. What a killed
    job wrote before its switch stays under ``<path>.new-<id>`` (see ``drop_unfinished``). One job
    may replace a table at a time.
    """
    path = path.rstrip("/")
    finish_switch(spark, path)
    mark = uuid.uuid4().hex
    told = {"new": f"{path}.new-{mark}", "old": f"{path}.old-{mark}"}
    write(told["new"])
    fs, to_path = _fs(spark, path)
    stream = fs.create(to_path(path + ".switch"), False)
    try:
        stream.write(bytearray(json.dumps(told).encode()))
    finally:
        stream.close()
    finish_switch(spark, path)


def drop_unfinished(spark: SparkSession, path: str) -> list[str]:
    """Delete what killed jobs wrote beside a table and never switched to; no job may be writing it."""
    path = path.rstrip("/")
    finish_switch(spark, path)
    fs, to_path = _fs(spark, path)
    found = [str(f.getPath()) for f in fs.globStatus(to_path(path + ".new-*")) or []]
    for f in found:
        fs.delete(to_path(f), True)
    return found


__all__ = ["current_path", "finish_switch", "replace_table", "drop_unfinished"]
