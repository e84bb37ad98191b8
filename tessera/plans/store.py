"""Intermediate tables written once per application under the shared folder.

Several queries start from the same expensive intermediate (the per-user
split, the term-frequency table).  Each is written as parquet under
``spark.checkpoint.dir`` the first time it is needed and read back after
that: later queries skip the upstream work, and a lost executor re-reads
the table instead of recomputing its lineage.

A table belongs to the files it was made from: its key holds their names,
sizes and times, so a rewritten folder is read anew and the table of the old
one is removed.  :func:`scope` removes, at its end, the tables that were made
inside it and that no other open scope uses; :func:`release` removes them at once.
"""

from __future__ import annotations

import dataclasses
import hashlib
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path, shared_root

T = TypeVar("T")

_TABLES: dict[tuple, str] = {}
_LOCKS: dict[tuple, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def once(cache: dict, key: tuple, make: Callable[[], T]) -> T:
    """``cache[key]``, made by ``make()`` the first time; callers from several
    threads wait for one build instead of each running it."""
    value = cache.get(key)
    if value is not None:
        return value
    with _LOCKS_GUARD:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        value = cache.get(key)
        if value is None:
            value = cache[key] = make()
    return value


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system: any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _path(spark, path)
    return bool(fs.exists(at))


def _state(spark: SparkSession, path: str) -> tuple:
    """Size and number of all files below a path; names, sizes and times of its
    own entries (a folder's time changes with the files in it)."""
    at, fs = _path(spark, path)
    if not fs.exists(at):
        return (path,)
    whole = fs.getContentSummary(at)
    entries = [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(at)]
    return path, whole.getLength(), whole.getFileCount(), tuple(sorted(entries))


def fingerprint(spark: SparkSession, source: object) -> str:
    """The state of a data folder, or of the files of a descriptor (its fields
    named ``..._path``), as a digest; empty for any other value."""
    if isinstance(source, str):
        paths = [source] if "/" in source else []
    elif dataclasses.is_dataclass(source):
        values = [getattr(source, f.name) for f in dataclasses.fields(source) if f.name.endswith("_path")]
        paths = [v for v in values if v is not None]
    else:
        paths = []
    if not paths:
        return ""
    return hashlib.sha256(repr([_state(spark, p) for p in paths]).encode()).hexdigest()[:16]


_SCOPES: list[set[tuple]] = []
_INNERMOST = threading.local()


def stored(spark: SparkSession, name: str, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written once per (application, shared folder, ``name``,
    ``key``); a data source that leads the key counts with its files' state."""
    state = fingerprint(spark, key[0]) if key else ""
    base = (spark.sparkContext.applicationId, shared_root(spark), name, *key)
    k = (*base, state)

    def write() -> str:
        for old in [o for o in _TABLES if o[:-1] == base and o != k]:  # of the files as they were
            _remove(spark, old)
        path = shared_path(spark, f"tables/{name}")
        # zstd: hashes kept as hex digits take half the space they take in snappy files
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        return path

    path = once(_TABLES, k, write)
    opened = getattr(_INNERMOST, "scopes", [])
    if opened:
        opened[-1].add(k)
    return spark.read.parquet(path)


def _remove(spark: SparkSession, key: tuple) -> None:
    path = _TABLES.pop(key, None)
    if path is not None:
        at, fs = _path(spark, path)
        fs.delete(at, True)


def release(spark: SparkSession, name: str | None = None) -> int:
    """Remove this application's stored tables (of one name, if given) from the
    shared folder; how many.  They are built again when next asked for."""
    app = spark.sparkContext.applicationId
    with _LOCKS_GUARD:
        keys = [k for k in _TABLES if k[0] == app and (name is None or k[2] == name)]
        for k in keys:
            _remove(spark, k)
    return len(keys)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread makes inside are removed at the end, unless they
    were there before or another open scope has asked for them.  Results read
    from them have to be written or collected inside."""
    mine: set[tuple] = set()
    own = _INNERMOST.scopes = getattr(_INNERMOST, "scopes", [])
    own.append(mine)
    with _LOCKS_GUARD:
        before = set(_TABLES)
        _SCOPES.append(mine)
    try:
        yield
    finally:
        own.pop()
        with _LOCKS_GUARD:
            _SCOPES[:] = [s for s in _SCOPES if s is not mine]
            for k in mine - before - set().union(*_SCOPES):
                _remove(spark, k)
