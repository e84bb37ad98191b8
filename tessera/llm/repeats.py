"""Removal of repeated passages, exact over the whole corpus.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else.  The corpus is brought to size for suffix sorting by a filter
that misses nothing:

1. *Anchors.*  Each window of ``length`` bytes is represented by one k-gram in
   it, the least in a fixed order of hashes; equal windows have the same anchor
   at the same place.  Consecutive windows with one anchor make a segment.
   Heavy hitters among the anchors (above ``SHARE`` of all, hence at most
   ``1 / SHARE``; they are broadcast) come last in the order, so common lines
   don't gather the windows around them.
2. *Segments.*  Anchors and segment hashes are grouped by anchor.  Equal
   segments are repeats throughout; an anchor that occurs once has none.  Only
   anchors with several different segments need their texts.  Repeats within
   a task are settled there and posted once, so a hot passage has at most one
   posting for each run of texts.
3. *Run-length index.*  The texts of those segments, some megabytes at a time,
   are indexed (``rindex``); matching statistics mark the windows that occur in
   two segments.
4. Repeats are gathered by text and cut out.

Defined results: null texts are empty; texts shorter than ``length`` bytes
keep everything; of equal texts nothing is left if they are long enough; equal
rows count as different documents; an empty table gives an empty result.
Texts and segments are compared by 64-bit hashes before they are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..session import shared_path
from . import textbatch as tb
from .rindex import repeated_starts
from .shipping import ship

GRAM = 64
#: An anchor with more than this share of all anchors is a heavy hitter.
SHARE = 1e-5
#: Bytes of segments indexed together.
INDEXED = 1 << 19
_PLACE = 28  # bits of a position in a run of texts


class Anchors:
    """The segments of a run of texts, as arrays with one entry each:
    ``doc``, first and last window start, anchor place (all in the document),
    anchor hash and segment hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, heavy: np.ndarray, table: np.ndarray | None):
        n = len(data)
        none = np.zeros(0, np.int64)
        self.doc = self.first = self.last = self.place = none
        self.anchor = self.segment = np.zeros(0, np.uint64)
        if n < length:
            return
        sums = tb.prefix_hash(data)
        gram = tb.gram_hash(sums, GRAM)
        key = gram >> np.uint64(_PLACE + 1)
        key <<= np.uint64(_PLACE)
        key |= np.arange(len(gram), dtype=np.uint64)
        if len(heavy):
            some = np.flatnonzero(table[gram & np.uint64(len(table) - 1)])
            i = np.minimum(np.searchsorted(heavy, gram[some]), len(heavy) - 1)
            key[some[heavy[i] == gram[some]]] |= np.uint64(1 << 63)
        span = length - GRAM + 1
        low, have = key, 1
        while 2 * have <= span:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < span:
            low = np.minimum(low[:len(low) - (span - have)], low[span - have:])
        start = np.concatenate([np.arange(a, b - length + 1) for a, b in
                                zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) if b - a >= length] or [none])
        if not len(start):
            return
        anchor = (low[start] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        head = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]))
        tail = np.append(head[1:], len(start)) - 1
        first, last, place = start[head], start[tail], anchor[head]
        self.doc = np.searchsorted(offsets, first, "right") - 1
        base = offsets[self.doc]
        self.anchor = gram[place]
        shape = ((place - first) * 256 + (last - first)).astype(np.uint64)
        self.segment = tb.mix(tb.span_hash(sums, first, last + length) + shape)
        self.first, self.last, self.place = first - base, last - base, place - base


def _table(heavy: np.ndarray, bits: int = 22) -> np.ndarray:
    out = np.zeros(1 << bits, bool)
    out[heavy & np.uint64((1 << bits) - 1)] = True
    return out


def heavy_anchors(texts: DataFrame, length: int) -> np.ndarray:
    """Sorted anchors above ``SHARE`` of all: at most ``1 / SHARE``.  One above
    it overall is above it in some task, so rarer ones are left out there."""
    spec = StructType([StructField("anchor", LongType()), StructField("n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held, size, total = [], 0, 0

        def fold(key, n):
            k, c = np.unique(np.concatenate(held), return_counts=True) if held else (key[:0], n[:0])
            k, c = np.concatenate([key, k]), np.concatenate([n, c])
            uniq, at = np.unique(k, return_inverse=True)
            c = np.bincount(at, c, len(uniq)).astype(np.int64)
            keep = c >= max(2, int(SHARE * total / 4))
            return uniq[keep], c[keep]

        for batch in batches:
            for _, _, data, offsets in tb.byte_runs(batch.column(0)):
                held.append(Anchors(data, offsets, length, key[:0], None).anchor)
                size, total = size + len(held[-1]), total + len(held[-1])
                if size > 1 << 21:
                    key, n = fold(key, n)
                    held, size = [], 0
        key, n = fold(key, n)
        keep = n > SHARE * total
        yield pa.RecordBatch.from_arrays([pa.array(np.append(key[keep].view(np.int64), 0)),
                                          pa.array(np.append(n[keep], -total))], names=["anchor", "n"])

    path = shared_path(texts.sparkSession, "repeats/heavy")
    texts.select("text").mapInArrow(count, spec).write.parquet(path)
    counted = texts.sparkSession.read.schema(spec).parquet(path)
    total = -(counted.where("n < 0").agg(F.sum("n")).first()[0] or 0)
    rows = (counted.where("n > 0").groupBy("anchor").agg(F.sum("n").alias("n"))
            .where(F.col("n") > max(2.0, SHARE * total)).select("anchor").collect())
    return np.sort(np.array([r.anchor for r in rows], np.int64).view(np.uint64))


_BLOB = StructType([StructField("kind", IntegerType()), StructField("bucket", IntegerType()),
                    StructField("blob", BinaryType())])
_RANGE = StructType([StructField("unit", LongType()), StructField("first", LongType()), StructField("last", LongType()),
                     StructField("anchor", LongType())])
_POSTING, _REPEAT = 0, 1


def _merged(unit: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Ranges of each unit with adjoining ones joined."""
    order = np.lexsort((first, unit))
    unit, first, last = unit[order], first[order], last[order]
    if not len(unit):
        return unit, first, last
    new = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (first[1:] > last[:-1] + 1)]))
    return unit[new], first[new], np.maximum.reduceat(last, new)


def _ranges(unit, first, last, anchor=None) -> pa.RecordBatch:
    at = pa.array(anchor.view(np.int64)) if anchor is not None else pa.nulls(len(unit), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(unit.view(np.int64)), pa.array(first.astype(np.int64)), pa.array(last.astype(np.int64)), at],
        names=_RANGE.names)


def settle(texts: DataFrame, length: int, heavy: np.ndarray) -> DataFrame:
    """``(unit, first, last, anchor)``: windows known to repeat (null anchor),
    and segments whose texts decide (one of each kind)."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 8 * parts
    sent = spark.sparkContext.broadcast(heavy)

    def post(batches):
        heavy = sent.value
        table = _table(heavy)
        held, size = [], 0

        def flush():
            anchor, segment, unit, packed = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((segment, anchor))
            anchor, segment, unit, packed = (x[order] for x in (anchor, segment, unit, packed))
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])])
            group = np.cumsum(new) - 1
            count = np.bincount(group)
            again = count[group] > 1
            # equal segments here are settled; one posting stands for them, marked
            packed[new] |= (again[new].astype(np.uint64) << np.uint64(63))
            rows = np.stack([anchor[new], segment[new], unit[new], packed[new]])
            yield from _deal(_POSTING, (tb.mix(rows[0]) >> np.uint64(33)) % np.uint64(buckets), rows)
            first, last, _ = _unpack(packed[again])
            rows = np.stack([x.astype(np.uint64) for x in _merged(unit[again], first, last)])
            if rows.shape[1]:
                yield from _deal(_REPEAT, (tb.mix(rows[0]) >> np.uint64(33)) % np.uint64(buckets), rows)

        for batch in batches:
            units = np.asarray(batch.column(0)).view(np.uint64)
            for lo, hi, data, offsets in tb.byte_runs(batch.column(1)):
                a = Anchors(data, offsets, length, heavy, table)
                if len(a.doc):
                    packed = (a.first << 16 | (a.place - a.first) << 8 | (a.last - a.first)).astype(np.uint64)
                    held.append((a.anchor, a.segment, units[lo:hi][a.doc], packed))
                    size += len(a.doc)
                if size > 1 << 20:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def decide(batches):
        held = []
        for batch in batches:
            for kind, blob in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                rows = np.frombuffer(blob.as_buffer(), np.uint64).reshape(4 if kind == _POSTING else 3, -1)
                if kind == _POSTING:
                    held.append(rows)
                else:
                    yield _ranges(*rows)
        if not held:
            return
        rows = np.concatenate(held, axis=1)
        anchor, segment, unit, packed = rows[:, np.lexsort((rows[1], rows[0]))]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])])
        group = np.cumsum(new) - 1
        marked = np.bincount(group, packed >> np.uint64(63)) > 0
        again = ((np.bincount(group) > 1) | marked)[group]
        first, last, _ = _unpack(packed)
        yield _ranges(*_merged(unit[again], first[again], last[again]))
        own = np.cumsum(np.concatenate([[True], anchor[1:] != anchor[:-1]])) - 1
        kinds = np.bincount(own, new)[own] > 1
        ask = new & kinds  # one of each kind of segment of an anchor with several
        yield _ranges(unit[ask], first[ask], last[ask], anchor[ask])

    return texts.mapInArrow(post, _BLOB).repartition(parts, "bucket").mapInArrow(decide, _RANGE)


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    body = packed & np.uint64((1 << 63) - 1)
    first = (body >> np.uint64(16)).astype(np.int64)
    return first, first + (body & np.uint64(255)).astype(np.int64), first + (body >> np.uint64(8) & np.uint64(255)).astype(np.int64)


def _deal(kind: int, bucket: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order].astype(np.int64), rows[:, order]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    blobs = [rows[:, a:b].tobytes() for a, b in zip(edge, np.append(edge[1:], len(bucket)), strict=True)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(edge), pa.int32()), pa.array(bucket[edge], pa.int32()), pa.array(blobs, pa.binary())],
        names=_BLOB.names)


def index_segments(texts: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """``(unit, first, last)``: windows of the asked segments that occur in two of them."""
    wanted = asked.groupBy("unit").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("at"))
    # the same plan at every size: texts move to their requests
    joined = texts.join(wanted.hint("merge"), "unit")
    spec = StructType([StructField("anchor", LongType()), StructField("unit", LongType()),
                       StructField("first", LongType()), StructField("segment", BinaryType())])

    def cut(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256).to_pylist()
                out = [(x["anchor"], r["unit"], x["first"], raw[x["first"]:x["last"] + length])
                       for r in part for raw in (r["text"].encode("utf-8"),) for x in r["at"]]
                columns = list(zip(*out, strict=True)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary())], names=spec.names)

    def mark(batches):
        held: dict[tuple, list] = {}
        size, anchor = 0, None

        def done():
            strings = sorted({s for _, s in held})
            place = {s: i for i, s in enumerate(strings)}
            starts = repeated_starts(strings, length)
            unit, first, last = [], [], []
            for (_, s), owners in held.items():
                at = starts[place[s]]
                if len(at):
                    head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
                    ends = at[np.append(head[1:], len(at)) - 1]
                    for u, f in owners:
                        unit += [u] * len(head)
                        first += (f + at[head]).tolist()
                        last += (f + ends).tolist()
            return _ranges(*(np.array(x, np.int64) for x in (unit, first, last)))

        for batch in batches:
            for a, u, f, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != anchor and size >= INDEXED:
                    yield done()
                    held, size = {}, 0
                anchor = a
                if (a, s) not in held:
                    size += len(s)
                held.setdefault((a, s), []).append((u, f))
        if held:
            yield done()

    segments = joined.select("unit", "text", "at").mapInArrow(cut, spec)
    return segments.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(mark, _RANGE)


RESULT = StructType([
    StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("kept", BinaryType()),
    StructField("text", StringType()),
    StructField("spans", ArrayType(StructType([StructField("begin", LongType()), StructField("end", LongType())])))])


def remove_repeats(docs: DataFrame, keep: list[str], length: int = 200, text: str = "text",
                   out: str = "repeats") -> DataFrame:
    """``docs[keep]`` and a struct ``out``: the bytes left, also as text
    (without the parts of characters cut in two), and the maximal removed
    spans as byte offsets into the UTF-8 text."""
    if not GRAM <= length <= GRAM + 250:
        raise ValueError(f"length must lie between {GRAM} and {GRAM + 250}")
    if out in keep:
        raise ValueError(f"column {out!r} exists already")
    spark = docs.sparkSession
    ship(spark)
    body = F.coalesce(docs[text], F.lit(""))
    # one text stands for all equal ones: where it came from doesn't matter
    texts = docs.select(F.xxhash64(body).alias("unit"), body.alias("text"))
    path = shared_path(spark, "repeats/settled")
    settle(texts, length, heavy_anchors(texts, length)).write.parquet(path)
    settled = spark.read.schema(_RANGE).parquet(path)
    indexed = shared_path(spark, "repeats/indexed")
    index_segments(texts, settled.where("anchor IS NOT NULL"), length).write.parquet(indexed)
    found = settled.where("anchor IS NULL").unionByName(spark.read.schema(_RANGE).parquet(indexed))
    ranges = (found.select("unit", "first", "last").distinct().groupBy("unit")
              .agg(F.collect_list(F.struct("first", "last")).alias("__ranges")))
    names = [f"__k{i}" for i in range(len(keep))]
    rows = docs.select(*[docs[k].alias(n) for k, n in zip(keep, names, strict=True)], body.alias("__text"),
                       F.xxhash64(body).alias("unit"))
    joined = rows.join(ranges.hint("merge"), "unit", "left").select(*names, "__text", "__ranges")
    schema = StructType([*(StructField(n, docs.schema[k].dataType) for k, n in zip(keep, names, strict=True)),
                         StructField(out, RESULT)])
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for whole in batches:
            for lo, size in tb._parts(whole.num_rows, whole.nbytes):
                batch = whole.slice(lo, size)
                n_bytes, n_removed, kept, spans = [], [], [], []
                for body, ranges in zip(batch.column(len(names)).to_pylist(),
                                        batch.column(len(names) + 1).to_pylist(), strict=True):
                    raw = body.encode("utf-8")
                    gone, rest, at = [], [], 0
                    for r in sorted((r["first"], r["last"] + length) for r in ranges or ()):
                        if gone and r[0] <= gone[-1][1]:
                            gone[-1][1] = max(gone[-1][1], r[1])
                        else:
                            gone.append(list(r))
                    for a, b in gone:
                        rest.append(raw[at:a])
                        at = b
                    rest.append(raw[at:])
                    left = b"".join(rest)
                    n_bytes.append(len(raw))
                    n_removed.append(len(raw) - len(left))
                    kept.append(left)
                    spans.append([{"begin": a, "end": b} for a, b in gone])
                result = pa.StructArray.from_arrays(
                    [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()),
                     pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()), pa.array(spans, span)], names=RESULT.names)
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], result], names=schema.names)

    return joined.mapInArrow(cut, schema).select(*[F.col(n).alias(k) for k, n in zip(keep, names, strict=True)], out)
