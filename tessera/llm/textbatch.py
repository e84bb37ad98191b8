"""Columnar helpers shared by the text operators.

Texts arrive in Python as Arrow batches.  The helpers view a run of texts as
one UTF-8 byte array plus document offsets, so byte classes, words and rolling
hashes are numpy passes over bytes instead of Python loops over strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from .shipping import ship

#: Texts are worked on in runs of about this many bytes (one longer text is a
#: run of its own), which bounds a task's memory whatever the batch holds.
RUN_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C55)
_POW: dict[str, np.ndarray] = {}


def byte_runs(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, bytes, offsets)`` of consecutive texts of about ``limit``
    bytes together; null texts are empty."""
    column = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(column)
    _, offset_buffer, data_buffer = column.buffers()
    if n == 0:
        return
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get("up")
    if have is None or len(have) < n:
        size = max(n, 2 * RUN_BYTES)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POW[name] = np.multiply.accumulate(steps)
    return _POW["up"], _POW["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over bytes, for :func:`span_hash`."""
    up, _ = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    terms = sums[1:]
    terms[:] = data
    terms += np.uint64(1)
    terms *= up[:len(data)]
    np.cumsum(terms, out=terms)
    return sums


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: equal strings hash alike wherever they stand."""
    _, down = _powers(len(sums))
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def gram_hash(sums: np.ndarray, size: int) -> np.ndarray:
    """:func:`span_hash` of the spans of ``size`` bytes at every place."""
    _, down = _powers(len(sums))
    h = sums[size:] - sums[:-size]
    h *= down[:len(h)]
    h += np.uint64(size)
    return mix(h)


#: Bytes to lower case, ASCII only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that separate words: space and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Every ASCII byte that is neither letter nor digit; bytes above 0x7F are in words.
NOT_WORD = np.ones(256, bool)
NOT_WORD[128:] = False
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    NOT_WORD[_lo:_hi] = False


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(begin, end, doc)`` of the maximal separator-free byte spans of each text."""
    inside = ~separator[data]
    edge = np.zeros(len(data) + 1, bool)
    starts = edge[:-1].copy()
    if len(data):
        starts[0] = inside[0]
        starts[1:] = inside[1:] & ~inside[:-1]
        cut = offsets[:-1][offsets[:-1] < len(data)]
        starts[cut] = inside[cut]
        edge[1:-1] = inside[:-1] & ~inside[1:]
        edge[-1] = inside[-1]
        cut = cut[cut > 0]
        edge[cut] = inside[cut - 1]
    begin = np.flatnonzero(starts)
    end = np.flatnonzero(edge)
    doc = np.searchsorted(offsets, begin, "right") - 1
    return begin, end, doc


def _parts(rows: int, size: int, most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """``(first, count)`` of slices of about ``most`` bytes, so that results
    leave the worker before the next ones are made."""
    step = max(1, int(rows * min(1.0, most / max(size, 1))))
    for at in range(0, rows, step):
        yield at, min(step, rows - at)


def annotate(
    docs: DataFrame,
    text: str,
    keep: list[str],
    out: str,
    fields: StructType,
    work: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """``docs[keep]`` plus a struct column ``out`` computed from the texts.

    ``work()`` is called once in each task and returns the function from a
    text column to the arrays of ``fields``.  A name of ``keep`` equal to
    ``out`` is an error; other columns of ``docs`` don't matter.
    """
    if out in keep:
        raise ValueError(f"column {out!r} exists already")
    if len(set(keep)) != len(keep):
        raise ValueError("a column is listed twice")
    body = "__text"
    while body in keep:
        body += "_"
    source = docs.select(*[docs[k] for k in keep], docs[text].alias(body))
    ship(docs.sparkSession)
    schema = StructType([*(docs.schema[k] for k in keep), StructField(out, fields)])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = work()
        for whole in batches:
            for at, n in _parts(whole.num_rows, whole.nbytes):
                batch = whole.slice(at, n)
                parts = apply(batch.column(len(keep)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.StructArray.from_arrays(parts, names=names)], names=[*keep, out])

    return source.mapInArrow(run, schema)
