"""Prefix trie of conversations, rolled up in depth bands.

Conversations are first rebuilt: each begins with the first few turns of the
conversation its id is derived from, and goes on with its own.  Every distinct
sequence of first turns is a node; its members are the conversations that
start with it.

*Keys.*  A turn is a 128-bit token of its role and text, a sequence of turns
the sum of ``token * B ** place`` in two 64-bit words.  Such sums are prefix
sums: rows are sorted by conversation and turn over range partitions, each
task sums its own, and one row a partition (read on the driver, as for
``zipWithIndex``) carries a conversation on that partitions cut.  So a
conversation of any length is many tasks' work, and a rebuilt prefix is
combined from its two parts' sums without hashing a turn again.

*Roll-up.*  Depths are cut into bands of :data:`BAND`.  Inside a band a node
explodes to its ancestors of the band only (at most :data:`BAND` rows,
summed by task before the shuffle).  Then the bands' top nodes hold totals of
their band, and are themselves banded the same way, level by level, until one
band holds all; on the way back, completed totals of each top node go to its
ancestors of the band above.  Rounds grow with the logarithm of the
greatest depth, rows with ``BAND`` times the nodes.

*Digests of members* are chained hashes, so a node's ids have to pass in
order: ids are sorted over range partitions, a partition hashes the nodes it
holds whole, and of nodes that partitions share only strings of a megabyte go
on to the task that chains them, one at a time.

Defined results: rows without a conv_id are left out; a null turn comes before
all others; of equal turns the smaller role comes first, then the smaller text
(as bytes), and repeated rows are turns of their own; null roles and texts are
empty; an empty table has no node at all, not even a root; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..session import shared_path
from .shipping import ship

#: Depths of a band, and bands of a band of bands.
BAND = 8
#: Turns that a conversation takes over at most.
HEAD = 3
#: A conversation takes over turns of the one with the next smaller multiple of this.
EVERY = 20
WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["depth", "a", "b"]
_BASE = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F)
_PIECE = 1 << 20
_EMPTY = hashlib.sha256(b"").hexdigest()
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _longs(*names: str) -> list[StructField]:
    return [StructField(n, LongType()) for n in names]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, f"trie/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _powers(side: int, n: int) -> np.ndarray:
    if len(_POW[side]) < n:
        steps = np.full(max(n, 1024), _BASE[side], np.uint64)
        steps[0] = 1
        _POW[side] = np.multiply.accumulate(steps)
    return _POW[side]


def _power(side: int, exponent: int) -> np.uint64:
    return np.uint64(pow(_BASE[side], exponent, 1 << 64))


def _unsigned(column: pa.Array) -> np.ndarray:
    return np.asarray(column, np.int64).view(np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


# -- turns ------------------------------------------------------------------
def _sorted_turns(table: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``(part, conv_id, idx, words, pa, pb, a, b)``, written: every turn with
    the sums before and with it inside its partition."""
    ship(table.sparkSession)
    rows = table.select(table[conv_id].cast("long").alias("conv_id"), table[turn].alias("turn"),
                        F.coalesce(table[role], F.lit("")).alias("role"), F.coalesce(table[text], F.lit("")).alias("text"))
    by_turn = F.asc_nulls_first("turn")
    # ranges by the first characters: boundaries stay short, and the rest of a tie is in one range
    ordered = (rows.where("conv_id IS NOT NULL")
               .repartitionByRange(F.asc("conv_id"), by_turn, F.asc("role"), F.substring("text", 1, 64).asc())
               .sortWithinPartitions("conv_id", by_turn, "role", "text"))
    token = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    source = ordered.select("conv_id", token.alias("token"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    schema = StructType(_longs("part", "conv_id", "idx", "words", "pa", "pb", "a", "b"))

    def run(batches):
        part = TaskContext.get().partitionId()
        last, count, total = None, 0, [0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = np.asarray(batch.column(0), np.int64)
            token = np.frombuffer(bytes.fromhex("".join(batch.column(1).to_pylist())), "<u8").reshape(n, 4)
            new = np.ones(n, bool)
            new[1:] = conv[1:] != conv[:-1]
            new[0] = conv[0] != last
            begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: goes on from the last batch
            idx = np.where(begin >= 0, np.arange(n) - begin, np.arange(n) + count)
            columns = []
            for side in range(2):
                term = token[:, side] * _powers(side, int(idx.max()) + 1)[idx]
                sums = np.cumsum(term)
                before = np.where(begin >= 0, (sums - term)[np.maximum(begin, 0)], np.uint64(-total[side] % (1 << 64)))
                with_row = sums - before
                columns.append((with_row - term, with_row))
                total[side] = int(with_row[-1])
            last, count = conv[-1], int(idx[-1]) + 1
            (pa_, a), (pb, b) = columns
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int64)), pa.array(conv), pa.array(idx), batch.column(2),
                 _signed(pa_), _signed(pb), _signed(a), _signed(b)], names=schema.names)

    return _written(source.mapInArrow(run, schema), "turns")


def _carried(turns: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """By partition: the conversation that goes on in it, its turns in earlier
    partitions and their sums.  One row a partition reaches the driver."""
    ends = turns.groupBy("part").agg(F.min("conv_id").alias("low"), F.max(F.struct("conv_id", "idx", "a", "b")).alias("last"))
    out: dict[int, tuple[int, int, int, int]] = {}
    conv, count, a, b = None, 0, 0, 0
    for r in sorted(ends.collect()):
        if conv is not None and r["low"] < conv:
            raise RuntimeError("partitions are not in order")
        if r["low"] == conv:
            out[r["part"]] = (conv, count, a, b)
        x = r["last"]
        if x["conv_id"] != conv:
            conv, count, a, b = x["conv_id"], 0, 0, 0
        a = (a + x["a"] * pow(_BASE[0], count, 1 << 64)) % (1 << 64)
        b = (b + x["b"] * pow(_BASE[1], count, 1 << 64)) % (1 << 64)
        count += x["idx"] + 1
    return out


def _placed(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, words, pa, pb, a, b)``: every turn's place in its
    conversation, from 0, and the sums over the whole conversation."""
    sent = turns.sparkSession.sparkContext.broadcast(_carried(turns))
    schema = StructType(_longs("conv_id", "pos", "words", "pa", "pb", "a", "b"))

    def run(batches):
        carried = sent.value
        for batch in batches:
            part, conv, idx = (np.asarray(batch.column(i), np.int64) for i in range(3))
            sums = [_unsigned(batch.column(i)).copy() for i in range(4, 8)]
            pos = idx.copy()
            for p in np.unique(part).tolist():
                if p in carried:
                    first, count, *ahead = carried[p]
                    rows = np.flatnonzero((part == p) & (conv == first))
                    pos[rows] += count
                    for k, x in enumerate(sums):
                        x[rows] = x[rows] * _power(k % 2, count) + np.uint64(ahead[k % 2])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(pos), batch.column(3), *(_signed(x) for x in sums)], names=schema.names)

    return turns.select("part", "conv_id", "idx", "words", "pa", "pb", "a", "b").mapInArrow(run, schema)


def _members(placed: DataFrame) -> DataFrame:
    """``(conv_id, depth, a, b, pa, pb, words, last)``, written: a row for every
    rebuilt conversation and depth, the root's included; ``last``: it ends there."""
    at = [F.max(F.when(F.col("pos") == k, F.struct("pa", "pb", "a", "b", "words"))).alias(f"turn{k}") for k in range(HEAD)]
    convs = placed.groupBy("conv_id").agg(F.count("*").alias("n"), *at)
    own = convs.select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % EVERY).alias("base"), *[F.col(f"turn{k}").alias(f"own{k}") for k in range(HEAD)])
    base = convs.where(F.col("conv_id") % EVERY == 0).select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"), *[f"turn{k}" for k in range(HEAD)])
    both = own.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))

    def sum_at(prefix: str, count: str, side: str) -> Column:
        """The sum over the first ``count`` turns."""
        cases = F.lit(0).cast("long")
        for k in range(HEAD):
            cases = F.when(F.col(count) == k + 1, F.col(f"{prefix}{k}.{side}")).otherwise(cases)
        return cases

    both = _written(both.select(
        "conv_id", "h", "taken", length.alias("length"), *[f"turn{k}" for k in range(HEAD)],
        sum_at("own", "h", "a").alias("own_a"), sum_at("own", "h", "b").alias("own_b"),
        sum_at("turn", "taken", "a").alias("head_a"), sum_at("turn", "taken", "b").alias("head_b")), "conversations")

    zero = F.lit(0).cast("long")
    root = F.struct(zero.alias("pa"), zero.alias("pb"), zero.alias("a"), zero.alias("b"), zero.alias("words"))
    heads = both.select("conv_id", "length", "taken", F.posexplode(F.array(root, *[f"turn{k}" for k in range(HEAD)])).alias("depth", "t"))
    names = ["conv_id", "depth", "a", "b", "pa", "pb", "words", "last"]
    heads = heads.where("depth <= taken").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "t.a", "t.b", "t.pa", "t.pb", "t.words",
        (F.col("depth") == F.col("length")).alias("last"))

    schema = StructType([*_longs(*names[:-1]), StructField("last", BooleanType())])
    inverse = [pow(base, -1, 1 << 64) for base in _BASE]

    def run(batches):
        back = [np.array([pow(i, k, 1 << 64) for k in range(HEAD + 1)], np.uint64) for i in inverse]
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            pos, h, taken, length = (np.asarray(column[c], np.int64) for c in ("pos", "h", "taken", "length"))
            sums = []
            for name in ("a", "b", "pa", "pb"):
                side = name[-1]
                own = _unsigned(column[name]) - _unsigned(column[f"own_{side}"])
                sums.append(_signed(_unsigned(column[f"head_{side}"]) + own * back[side == "b"][h - taken]))
            depth = pos - h + taken + 1
            yield pa.RecordBatch.from_arrays(
                [column["conv_id"], pa.array(depth), *sums, column["words"], pa.array(depth == length)], names=names)

    tails = placed.join(both.drop(*[f"turn{k}" for k in range(HEAD)]), "conv_id").where("pos >= h")
    return _written(heads.unionByName(tails.mapInArrow(run, schema)), "members")


# -- roll-up ------------------------------------------------------------------
def _paths(members: DataFrame, step: int) -> DataFrame:
    """Members at depths that ``step`` divides, each with the ``path`` of its
    ancestors at such depths in its band of ``BAND * step``; the band below's
    top nodes come as ``leaving`` rows, with the whole band above as path."""
    band = F.floor(F.col("depth") / F.lit(BAND * step))
    own = members.where(F.col("depth") % step == 0).withColumn("band", band)
    leaving = own.where((F.col("depth") % (BAND * step) == 0) & (F.col("depth") > 0)).withColumn("band", F.col("band") - 1)
    rest = [c for c in members.columns if c not in ("conv_id", *_KEY)]
    listed = own.unionByName(leaving).groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(F.struct(*_KEY, *rest))).alias("t"))  # at most BAND + 1
    nodes = F.transform("t", lambda x: F.struct(*[x[c].alias(c) for c in _KEY]))
    out = listed.select("conv_id", "band", nodes.alias("nodes"), F.posexplode("t").alias("i", "x"))
    return out.select("conv_id", "x.*", F.slice("nodes", F.lit(1), F.col("i")).alias("path"),
                      (F.floor(F.col("x.depth") / F.lit(BAND * step)) != F.col("band")).alias("leaving"))


def _summed(rows: DataFrame) -> DataFrame:
    """``rows (key, leaves, saved, path)``: sums over the nodes of the paths."""
    return (rows.select(F.explode("path").alias("k"), "leaves", "saved").groupBy(*[F.col(f"k.{c}").alias(c) for c in _KEY])
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))


def _totals(nodes: DataFrame, members: DataFrame, deepest: int) -> DataFrame:
    """``(key, leaves, saved)`` summed over every node's subtree."""
    own = F.array(F.struct(*_KEY))
    levels = 0
    while BAND ** (levels + 1) <= deepest:
        levels += 1
    if not levels:
        return _summed(nodes.withColumn("path", F.concat("path", own)))
    narrow = members.select("conv_id", *_KEY)
    in_band, exits = [nodes.select(*_KEY, "path")], []
    for level in range(levels + 1):
        # all members of a node have the same ancestors
        found = (_paths(narrow, BAND ** level).groupBy(*_KEY, "leaving").agg(F.first("path").alias("path")))
        found = _written(found.where("leaving") if not level else found, f"paths{level}")
        exits.append(found.where("leaving").drop("leaving"))
        if level:
            in_band.append(found.where("NOT leaving").drop("leaving"))
    sums = []
    value = nodes.select(*_KEY, "leaves", "saved")
    for level in range(levels + 1):
        rows = value.join(in_band[level], _KEY).withColumn("path", F.concat("path", own))
        sums.append(_written(_summed(rows), f"band{level}"))
        value = sums[-1].where(F.col("depth") % BAND ** (level + 1) == 0)
    total = sums[-1]
    for level in range(levels - 1, -1, -1):
        below = _summed(total.where("depth > 0").join(exits[level], _KEY))
        total = sums[level].unionByName(below).groupBy(*_KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        total = _written(total, f"total{level}")
    return total


# -- members' digests -----------------------------------------------------------
def _digests(members: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of the nodes where conversations end."""
    ends = members.where("last").select(*_KEY, "conv_id")
    ordered = ends.repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id")
    schema = StructType([*_longs(*_KEY, "conv_id"), StructField("digest", StringType()), StructField("piece", BinaryType())])

    def batch_of(rows: list) -> pa.RecordBatch:
        column = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(column, types, strict=True)], names=schema.names)

    def run(batches):
        node, first, parts, size, edge = None, 0, [], 0, True
        rows: list[tuple] = []

        def give(shared: bool) -> None:
            nonlocal parts, size
            if parts:
                raw = ",".join(parts).encode()
                rows.append((*node, first, None, raw) if shared else (*node, first, hashlib.sha256(raw).hexdigest(), None))
                parts, size = [], 0

        for batch in batches:
            *keys, conv = (c.to_pylist() for c in batch.columns)
            for key, c in zip(zip(*keys, strict=True), conv, strict=True):
                if key != node:
                    if node is not None:
                        give(edge)  # the partition's first node may have begun before
                        edge = False
                    node, first = key, c
                elif not parts:
                    first = c
                parts.append(str(c))
                size += len(parts[-1]) + 1
                if size >= _PIECE:
                    edge = True  # too long for one string: chained below
                    give(True)
            yield batch_of(rows)
            rows = []
        give(True)  # the last one may go on
        yield batch_of(rows)

    found = _written(ordered.mapInArrow(run, schema), "digests")
    out = StructType([*_longs(*_KEY), StructField("digest", StringType())])

    def chain(batches):
        node, state = None, None
        done: list[tuple] = []
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["depth"], r["a"], r["b"])
                if key != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(r["piece"])
                else:
                    state.update(b",")
                    state.update(r["piece"])
        if node is not None:
            done.append((*node, state.hexdigest()))
        column = list(zip(*done, strict=True)) if done else [[]] * 4
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in column[:3]), pa.array(column[3], pa.string())],
                                         names=out.names)

    pieces = found.where("digest IS NULL").select(*_KEY, "conv_id", "piece")
    chained = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "conv_id").mapInArrow(chain, out)
    return found.where("digest IS NOT NULL").select(*_KEY, "digest").unionByName(chained)


def trie(table: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)`` of every node."""
    members = _members(_placed(_sorted_turns(table, conv_id, turn, role, text)))
    nodes = _paths(members, 1).where("NOT leaving").groupBy(*_KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("words").alias("words"),
        F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("path").alias("path"))
    nodes = _written(nodes, "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    parent = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = _written(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
                     .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "tree")
    totals = _totals(nodes, members, deepest).select(
        *_KEY, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    above = nodes.select(*[F.col(c).alias(f"parent_{c}") for c in (*_KEY, "conv_id")])
    linked = nodes.drop("path", "leaves", "saved").join(
        above, (F.col("depth") - 1 == F.col("parent_depth")) & (F.col("pa") == F.col("parent_a"))
        & (F.col("pb") == F.col("parent_b")), "left")
    return (linked.join(totals, _KEY).join(_digests(members), _KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.lit(_EMPTY)).alias("ends_sha256")))
