"""Best-fit packing after a dominance reduction.

Documents keep their tokens together: only one longer than the window is cut,
into full windows and a last piece.  The pieces below the window make a
bin-packing instance that is a histogram of lengths.  Going through it from
the longest piece on, sets of at most three pieces which provably belong
together are fixed for good: a set dominates if whatever else an optimal
packing puts beside the longest piece can be exchanged for it, piece by piece,
without another sequence.  That shrinks the instance; passes repeat until
nothing more can be fixed.  What remains is packed best fit, longest first,
whole runs of equal lengths and of equally full sequences at a time.

The driver sees one count for each length below the window.  The plan is a
list of runs: pieces of one length whose ranks are consecutive go to
consecutive sequences.  At most ``3 * window`` runs of sequences exist and
one holds at most ``sqrt(2 * window)`` different lengths, so the plan's size
is bounded by the window alone, whatever the input.  A piece finds its place
from its rank among the pieces of its length (prefix sums of counts by task
and length); equal lengths are never gathered.

Defined results: a null or empty text is one document of the end id only;
each of several equal rows, and each row without an id, is packed by itself;
an empty table gives an empty result; columns other than the key and the text
are ignored.  Among equally good sequences the one with the smallest number
is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from . import textbatch as tb
from .packing import FULL
from .wordtokens import before_parts, tokenise


# -- dominance ------------------------------------------------------------------
def _smallest(left: np.ndarray, count: int, without: int) -> list[int]:
    """The ``count`` shortest pieces besides one of length ``without``."""
    out: list[int] = []
    for v in np.flatnonzero(left).tolist():
        have = int(left[v]) - (v == without)
        out += [v] * min(have, count - len(out))
        if len(out) == count:
            break
    return out


def _longest_below(left: np.ndarray, bound: int, without: int) -> int:
    """The longest piece of at most ``bound`` besides one of length ``without`` (0: none)."""
    for v in np.flatnonzero(left[:bound + 1])[::-1].tolist():
        if v != without or left[v] > 1:
            return v
    return 0


def _best_pair(left: np.ndarray, room: int, without: int) -> tuple[int, int]:
    """The two pieces ``a >= b`` of the largest sum of at most ``room``; of
    equal sums the one with the longest ``a``."""
    have = left[:room + 1].copy()
    have[without:without + 1] -= 1
    have[0] = 0
    lengths = np.flatnonzero(have > 0)
    if not len(lengths):
        return 0, 0
    # the longest b <= min(a, room - a), another piece than a
    limit = np.minimum(lengths, room - lengths)
    at = np.searchsorted(lengths, limit, "right") - 1
    own = (at >= 0) & (lengths[at] == lengths) & (have[lengths] < 2)
    at = at - own
    ok = at >= 0
    if not ok.any():
        return 0, 0
    a, b = lengths[ok], lengths[at[ok]]
    best = np.flatnonzero(a + b == (a + b).max())[-1]
    return int(a[best]), int(b[best])


def dominant_set(left: np.ndarray, j: int, window: int) -> tuple[int, ...] | None:
    """A set of pieces which some optimal packing puts together with the
    longest piece ``j``, or None if none of up to three pieces is proven.

    With room for no other piece ``j`` stays alone.  With room for one more at
    most, or if one fills the window, the longest that fits takes the place of
    any other.  With room for two at most, the longest single one dominates
    all pairs if it is as long as the best pair together; otherwise the best
    pair dominates if its longer piece is the longest that fits at all, and
    no pair with a longer second piece fits beside any shorter first one: then
    any other set goes into the pair's places, piece for piece.
    """
    room = window - j
    few = _smallest(left, 3, j)
    if not few or few[0] > room:
        return (j,)
    one = _longest_below(left, room, j)
    if one == room or len(few) < 2 or few[0] + few[1] > room:
        return (j, one)
    if len(few) == 3 and sum(few) <= room:
        return None
    a, b = _best_pair(left, room, j)
    if one >= a + b:
        return (j, one)
    if a == one:
        # another pair (x, y), x >= y, fits piece for piece if y <= b; a longer y needs x + y <= room, x >= y > b
        rest = left.copy()
        rest[j] -= 1
        rest[:b + 1] = 0
        longer = _smallest(rest, 2, 0)
        if len(longer) < 2 or sum(longer) > room:
            return (j, a, b)
    return None


def reduce(hist: np.ndarray, window: int) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """``(set, times)`` fixed by dominance, and the counts that are left.

    A proof holds as long as the set's lengths last, since fewer other pieces
    only take alternatives away; so it is applied as often as they last.
    """
    left = hist.astype(np.int64).copy()
    left[0] = 0
    fixed: list[tuple[tuple[int, ...], int]] = []
    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(left)[::-1].tolist():
            while left[j]:
                found = dominant_set(left, j, window)
                if found is None:
                    break
                need = np.bincount(found, minlength=j + 1)
                used = np.flatnonzero(need)
                times = int((left[used] // need[used]).min())
                fixed.append((found, times))
                left[used] -= times * need[used]
                changed = True
    return fixed, left


# -- the plan -------------------------------------------------------------------
@dataclass(frozen=True)
class Plan:
    """Runs of pieces, sorted by ``length`` and ``rank``: the run's k-th piece
    goes to sequence ``sequence + k // each`` at ``offset + (k % each) * length``."""

    first: np.ndarray  # of each length: its first run (and one past the last length)
    rank: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    fixed: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(sequence, offset)`` of the pieces of these lengths and ranks."""
        span = np.int64(self.rank.max(initial=0)) + 1
        by = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        # ranks stay below the count of a length; pairs are compared as one number where that fits
        if len(self.first) * int(span) < 1 << 62:
            run = np.searchsorted(by * span + self.rank, length * span + np.minimum(rank, span - 1), "right") - 1
        else:
            run = np.array([self.first[v] + np.searchsorted(self.rank[self.first[v]:self.first[v + 1]], r, "right") - 1
                            for v, r in zip(length.tolist(), rank.tolist(), strict=True)], np.int64)
        k = rank - self.rank[run]
        return self.sequence[run] + k // self.each[run], self.offset[run] + k % self.each[run] * length


def best_fit(left: np.ndarray, window: int, first: int = 0) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs ``(length, pieces, each, sequence, offset)`` by best fit, longest
    first, and the number after the last sequence.

    Sequences with equal room that stand side by side are one span; each step
    fills the spans with the least sufficient room, ``room // length`` pieces
    to a sequence, so it ends as placing the pieces one by one would.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}  # room: spans (first sequence, how many)
    runs: list[tuple[int, int, int, int, int]] = []
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        for room in sorted(r for r in rooms if r >= length):
            each = room // length
            spans = sorted(rooms.pop(room))
            while spans and n:
                at, count = spans.pop(0)
                full = min(count, n // each)
                if full:
                    runs.append((length, full * each, each, at, window - room))
                    rooms.setdefault(room - each * length, []).append((at, full))
                    n -= full * each
                    at, count = at + full, count - full
                if count and n:  # fewer pieces than one sequence of the span takes
                    runs.append((length, n, n, at, window - room))
                    rooms.setdefault(room - n * length, []).append((at, 1))
                    at, count, n = at + 1, count - 1, 0
                if count:
                    spans.insert(0, (at, count))
            if spans:
                rooms.setdefault(room, []).extend(spans)
            if not n:
                break
        if n:
            each = window // length
            full, rest = divmod(n, each)
            if full:
                runs.append((length, full * each, each, first, 0))
                rooms.setdefault(window - each * length, []).append((first, full))
                first += full
            if rest:
                runs.append((length, rest, rest, first, 0))
                rooms.setdefault(window - rest * length, []).append((first, 1))
                first += 1
    return runs, first


def make_plan(hist: np.ndarray, window: int) -> Plan:
    """The plan for a histogram of piece lengths below the window."""
    fixed, left = reduce(hist, window)
    runs: list[tuple[int, int, int, int, int]] = []
    number = 0
    for lengths, times in fixed:
        offset = 0
        for v in sorted(set(lengths), reverse=True):
            each = lengths.count(v)
            runs.append((v, times * each, each, number, offset))
            offset += each * v
        number += times
    more, total = best_fit(left, window, number)
    table = np.array(sorted(runs + more, key=lambda r: r[0]), np.int64).reshape(-1, 5)
    length, pieces = table[:, 0], table[:, 1]
    ends = np.cumsum(pieces)
    first = np.searchsorted(length, np.arange(window + 1))
    base = np.concatenate([[0], ends])[first[length]] if len(table) else ends
    return Plan(first, ends - pieces - base, table[:, 2], table[:, 3], table[:, 4], total, number)


# -- pieces ---------------------------------------------------------------------
def pack(docs: DataFrame, definition: str, end_id: int, window: int = 4096, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, sequence_id, offset, ids)``: one row
    for each piece; ``ids`` are little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    tokens, width = tokenise(docs, definition, end_id, window, doc_id, text)
    step = int(width[-1])
    counts = tokens.where("rem > 0").groupBy("part", "rem").agg(F.count("*").alias("count"))
    hist = np.zeros(window, np.int64)
    for r in counts.groupBy("rem").agg(F.sum("count").alias("count")).collect():
        hist[r["rem"]] = r["count"]
    sent = spark.sparkContext.broadcast(make_plan(hist, window))
    bases = before_parts(counts, ["rem"], "count")
    pieces = tokens.where("rem > 0").select(doc_id, "part", "n_full", "rem", "local", "ids_rem").join(
        bases, ["part", "rem"]).select(doc_id, "n_full", "rem", (F.col("base") + F.col("local")).alias("rank"), "ids_rem")
    schema = StructType([tokens.schema[doc_id], StructField("piece", IntegerType()), *(StructField(n, t) for n, t in (
        ("start", LongType()), ("length", LongType()), ("sequence_id", LongType()), ("offset", LongType()),
        ("ids", BinaryType())))])

    def wide(ids: bytes) -> bytes:
        return np.frombuffer(ids, width).astype("<u4").tobytes()

    def last(batches):
        plan = sent.value
        for whole in batches:
            for a, b in tb._parts(whole.num_rows, whole.nbytes):
                batch = whole.slice(a, b)
                n_full, rem, rank = (np.asarray(batch.column(i), np.int64) for i in (1, 2, 3))
                sequence, offset = plan.place(rem, rank)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n_full.astype(np.int32)), pa.array(n_full * window), pa.array(rem),
                     pa.array(sequence), pa.array(offset),
                     pa.array([wide(x) for x in batch.column(4).to_pylist()], pa.binary())], names=schema.names)

    def fulls(batches):
        for whole in batches:
            for a, b in tb._parts(whole.num_rows, whole.nbytes):
                batch = whole.slice(a, b)
                part, n_full, full_at = (np.asarray(batch.column(i), np.int64) for i in (1, 2, 3))
                row = np.repeat(np.arange(batch.num_rows), n_full)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n_full) - n_full, n_full)
                ids = batch.column(4).to_pylist()
                size = window * step
                cut = [wide(ids[i][k * size:(k + 1) * size]) for i, k in zip(row.tolist(), piece.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(piece * window),
                     pa.array(np.full(len(row), window, np.int64)), pa.array(FULL + (part[row] << 32) + full_at[row] + piece),
                     pa.array(np.zeros(len(row), np.int64)), pa.array(cut, pa.binary())], names=schema.names)

    whole_windows = tokens.where("n_full > 0").select(doc_id, "part", "n_full", "full_at", "ids_full")
    return pieces.mapInArrow(last, schema).unionByName(whole_windows.mapInArrow(fulls, schema))
