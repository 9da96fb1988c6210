"""Atomic publishing of written tables (S5): folders first, a manifest last.

Tables go to folders that no reader knows yet. A manifest, a small JSON file
that names them, is written beside and renamed into place at the end, under the next
number. A job that stops anywhere before leaves the manifest before it in force, whose
folders no later job touches; readers see one whole state or the next, never a mixture.
Files are reached by Hadoop's file system interface, as Spark's own are, so any store
that Spark writes to will do.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_NAME = "manifest-%09d.json"


def _files(spark: SparkSession, folder: str):
    """Hadoop's file system of a folder, and its Path class."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the manifests, ascending."""
    fs, path = _files(spark, folder)
    if not fs.exists(path(folder)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(folder))]
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"manifest-(\d{9})\.json", n)))


def _number(spark: SparkSession, folder: str) -> int:
    """The number of the manifest in force; 0 if there is none."""
    return max(_numbers(spark, folder), default=0)


def published(spark: SparkSession, folder: str) -> dict | None:
    """What the manifest in force says; None where nothing was published."""
    n = _number(spark, folder)
    return _content(spark, folder, n) if n else None


def _content(spark: SparkSession, folder: str, n: int) -> dict:
    fs, path = _files(spark, folder)
    stream = fs.open(path(f"{folder}/{_NAME % n}"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, content: dict, expected: int | None = None) -> int:
    """Put a manifest in force and return its number. ``expected`` is the number that the writer
    began from: if another writer published since, this raises and changes nothing."""
    fs, path = _files(spark, folder)
    now = _number(spark, folder)
    if expected is not None and now != expected:
        raise RuntimeError(f"{folder}: manifest {now} was published meanwhile, expected {expected}")
    fs.mkdirs(path(folder))
    draft, final = path(f"{folder}/.draft-{uuid.uuid4().hex}"), path(f"{folder}/{_NAME % (now + 1)}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"{folder}: another writer published manifest {now + 1}")
    return now + 1


def version(spark: SparkSession, folder: str) -> int:
    """The number of the manifest in force, for ``publish(expected=...)``."""
    return _number(spark, folder)


def expire(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete all manifests but the last ``keep`` (one at least), and the tables, folders within
    ``folder``, that only deleted ones name; returns those. For manifests that map names to folders.

    Tables go before the manifest that names them, so a call that stops is made good by the next one.
    Folders that no manifest names, those of a job under way or stopped, are left alone."""
    fs, path = _files(spark, folder)
    numbers = _numbers(spark, folder)
    old, kept = numbers[: -max(1, keep)], numbers[-max(1, keep) :]
    held = {name for n in kept for name in _content(spark, folder, n).values()}
    gone = []
    for n in old:
        for name in sorted(set(_content(spark, folder, n).values()) - held):
            if fs.delete(path(f"{folder}/{name}"), True):
                gone.append(name)
        fs.delete(path(f"{folder}/{_NAME % n}"), False)
    return gone
