"""Packing documents into training sequences by non-negative least squares.

A document's tokens are cut into full windows, which are sequences of their
own, and a remainder.  Shallow combinations of two or three remainder lengths
that fill a window exactly are enumerated; non-negative least squares against
the histogram of remainder lengths says how often to repeat each; the counts
are rounded down to what the histogram holds.  The remainders left over are
packed greedily end to end and cut at window ends; the last, unfilled window
is cut at the powers of two of its length.  So no sequence needs padding.

Tokens are written once to the shared folder (:mod:`wordtokens`).  The driver
sees only the histogram (one count for each length below the window).  A
remainder finds its place from its rank among equal lengths alone: ranks are
prefix sums of counts by (task, length), so equal lengths, however many, are
never gathered in one task.  A full window's number holds its task's, below
2**30, and its own in the task.

Defined results: a null or empty text is one document of the end token only;
each of several equal rows is packed by itself; an empty table gives an empty
result; columns other than the key and the text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from . import textbatch as tb
from .wordtokens import before_parts, tokenise

#: Sequences of full windows are numbered from here on, others from 0.
FULL = 1 << 62

# -- the plan -------------------------------------------------------------------
def combinations(hist: np.ndarray, window: int, heavy: int = 128) -> list[tuple[int, ...]]:
    """Pairs of lengths that fill the window, and triples with two of the
    ``heavy`` most frequent lengths."""
    have = hist > 0
    have[0] = False
    found = {(a, window - a) for a in range(1, window // 2 + 1) if have[a] and have[window - a]}
    top = [int(v) for v in np.argsort(-hist, kind="stable")[:heavy] if have[v]]
    for i, a in enumerate(top):
        for b in top[i:]:
            c = window - a - b
            if c > 0 and have[c]:
                found.add(tuple(sorted((a, b, c))))
    return sorted(found)


def nnls(slots: np.ndarray, hist: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise ``|A x - hist|``: accelerated
    projected gradient.  Column p of A counts the lengths in ``slots[p]``
    (-1: none)."""
    used = slots >= 0
    row = np.repeat(np.arange(len(slots)), slots.shape[1])[used.ravel()]
    length = slots[used]

    def a(x: np.ndarray) -> np.ndarray:
        return np.bincount(length, x[row], len(hist))

    def a_t(r: np.ndarray) -> np.ndarray:
        return np.bincount(row, r[length], len(slots))

    v = np.ones(len(slots))
    for _ in range(30):  # the largest eigenvalue bounds the step
        v = a_t(a(v))
        v /= np.linalg.norm(v)
    step = 1 / (np.linalg.norm(a_t(a(v))) * 1.05)
    x = y = np.zeros(len(slots))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * a_t(a(y) - hist))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


@dataclass(frozen=True)
class Plan:
    """Where the remainder of length L and rank r goes.

    ``start[L]`` lists the ranks at which the slots of L begin; slot j takes
    the sequences from ``sequence[L][j]`` on, at ``offset[L][j]``.  Ranks from
    ``quota[L]`` on lie in the stream at ``stream[L] + (r - quota[L]) * L``.
    """

    window: int
    quota: np.ndarray
    stream: np.ndarray
    patterns: int
    total: int
    start: dict[int, np.ndarray] = field(default_factory=dict)
    sequence: dict[int, np.ndarray] = field(default_factory=dict)
    offset: dict[int, np.ndarray] = field(default_factory=dict)
    tail: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def sequences(self) -> int:
        """How many sequences hold remainders."""
        return self.patterns + self.total // self.window + len(self.tail)

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """``(begin, size, sequence, offset)`` of each part of a remainder."""
        if rank < self.quota[length]:
            j = int(np.searchsorted(self.start[length], rank, "right")) - 1
            return [(0, length, int(self.sequence[length][j] + rank - self.start[length][j]),
                     int(self.offset[length][j]))]
        at = int(self.stream[length] + (rank - self.quota[length]) * length)
        out, begin = [], 0
        whole = self.total // self.window
        while begin < length:
            sequence, offset = divmod(at, self.window)
            room = self.window - offset
            if sequence == whole:
                j = int(np.searchsorted(self.tail, offset, "right")) - 1
                sequence += j
                room = (int(self.tail[j + 1]) if j + 1 < len(self.tail) else self.total % self.window) - offset
                offset -= int(self.tail[j])
            size = min(room, length - begin)
            out.append((begin, size, self.patterns + sequence, offset))
            begin, at = begin + size, at + size
        return out


def make_plan(hist: np.ndarray, window: int) -> Plan:
    """The plan for a histogram of remainder lengths below the window."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    chosen: list[tuple[tuple[int, ...], int]] = []
    combos = combinations(left, window)
    if combos:
        slots = np.full((len(combos), 3), -1, np.int64)
        for p, c in enumerate(combos):
            slots[p, :len(c)] = c
        x = nnls(slots, left.astype(float))
        for p in np.argsort(-x, kind="stable").tolist():
            # round down, and to what is left
            need = {v: combos[p].count(v) for v in combos[p]}
            times = min(int(x[p] + 1e-6), *(int(left[v]) // m for v, m in need.items()))
            if times > 0:
                chosen.append((combos[p], times))
                for v, m in need.items():
                    left[v] -= m * times
    start: dict[int, list[int]] = {}
    sequence: dict[int, list[int]] = {}
    offset: dict[int, list[int]] = {}
    taken = np.zeros(window, np.int64)
    patterns = 0
    for combo, times in chosen:
        at = 0
        for v in combo:
            start.setdefault(v, []).append(int(taken[v]))
            sequence.setdefault(v, []).append(patterns)
            offset.setdefault(v, []).append(at)
            taken[v] += times
            at += v
        patterns += times
    lengths = np.arange(window, dtype=np.int64)
    volume = left * lengths
    stream = np.empty(window, np.int64)
    stream[::-1] = np.cumsum(volume[::-1]) - volume[::-1]  # longest first
    total = int(volume.sum())
    rest, tail, at = total % window, [], 0
    for bit in range(window.bit_length(), -1, -1):
        if rest >> bit & 1:
            tail.append(at)
            at += 1 << bit
    arrays = [{k: np.array(v, np.int64) for k, v in d.items()} for d in (start, sequence, offset)]
    return Plan(window, taken, stream, patterns, total, *arrays, np.array(tail, np.int64))


# -- pieces -----------------------------------------------------------------
def pack(docs: DataFrame, definition: str, end_id: int, window: int = 2048, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``: one
    row for each piece; ``ids`` are little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    tokens, width = tokenise(docs, definition, end_id, window, doc_id, text)
    step = int(width[-1])
    counts = tokens.groupBy("part", "rem").agg(F.count("*").alias("count"))
    hist = np.zeros(window, np.int64)
    for r in counts.groupBy("rem").agg(F.sum("count").alias("count")).collect():
        hist[r["rem"]] = r["count"]
    plan = make_plan(hist, window)
    bases = before_parts(counts.where("rem > 0"), ["rem"], "count")
    remainders = tokens.where("rem > 0").select(doc_id, "part", "n", "rem", "local", "ids_rem").join(
        bases, ["part", "rem"]).select(doc_id, "n", "rem", (F.col("base") + F.col("local")).alias("rank"), "ids_rem")
    schema = StructType([tokens.schema[doc_id], *(StructField(n, t) for n, t in (
        ("start", LongType()), ("length", LongType()), ("doc_tokens", LongType()), ("sequence_id", LongType()),
        ("offset", LongType()), ("ids", BinaryType())))])
    sent = spark.sparkContext.broadcast(plan)

    def piece(docs_, at, rows):
        column = list(zip(*rows, strict=True)) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [docs_.take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in column[:5]),
             pa.array(column[5], pa.binary())], names=schema.names)

    def place(batches):
        plan = sent.value
        for whole in batches:
            for a, b in tb._parts(whole.num_rows, whole.nbytes):
                batch = whole.slice(a, b)
                at, rows = [], []
                _, n, rem, rank, ids = (batch.column(i).to_pylist() for i in range(5))
                for i in range(batch.num_rows):
                    wide = np.frombuffer(ids[i], width).astype("<u4").tobytes()
                    for begin, size, sequence, offset in plan.place(rem[i], rank[i]):
                        at.append(i)
                        rows.append((n[i] - rem[i] + begin, size, n[i], sequence, offset,
                                     wide[4 * begin:4 * (begin + size)]))
                yield piece(batch.column(0), at, rows)

    def fulls(batches):
        for whole in batches:
            for a, b in tb._parts(whole.num_rows, whole.nbytes):
                batch = whole.slice(a, b)
                at, rows = [], []
                _, part, n, n_full, full_at, ids = (batch.column(i).to_pylist() for i in range(6))
                for i in range(batch.num_rows):
                    for k in range(n_full[i]):
                        own = ids[i][k * window * step:(k + 1) * window * step]
                        at.append(i)
                        rows.append((k * window, window, n[i], FULL + (part[i] << 32) + full_at[i] + k, 0,
                                     np.frombuffer(own, width).astype("<u4").tobytes()))
                yield piece(batch.column(0), at, rows)

    whole_windows = tokens.where("n_full > 0").select(doc_id, "part", "n", "n_full", "full_at", "ids_full")
    return remainders.mapInArrow(place, schema).unionByName(whole_windows.mapInArrow(fulls, schema))
