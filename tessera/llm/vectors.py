"""Vector tables as blocks, and a grid of query blocks against row blocks.

Valid vectors of one dimension are stacked into blocks of a few thousand
rows.  A stated query set meets all rows in a grid: query groups x row groups,
each cell one join key.  Cells are balanced by construction (blocks are dealt
by hash), and each block is sent once to every group of the other side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from .shipping import ship

BLOCK = StructType([StructField("dim", IntegerType()), StructField("blk", LongType()), StructField("n", IntegerType()),
                    StructField("ids", BinaryType()), StructField("data", BinaryType())])

#: Products that one cell of the grid should hold, and cells at most.
CELL_PRODUCTS = 1 << 24
MOST_CELLS = 1 << 17


def blocks(table: DataFrame, rows: int, prepare: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
           vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Blocks of at most ``rows`` vectors of equal dimension.

    ``prepare`` takes a matrix of doubles and returns which rows take part and
    the array to store.  Rows with a null id, a null vector, no components or
    a null component take no part.
    """
    ship(table.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blk = TaskContext.get().partitionId() << 24
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                ids = batch.column(0)
                lists = batch.column(1)
                size = np.asarray(lists.value_lengths().fill_null(0))
                # a null component becomes NaN, which no prepared row may hold
                flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)
                start = np.cumsum(size) - size
                known = ~np.asarray(ids.is_null())
                for dim in np.unique(size[known & (size > 0)]).tolist():
                    own = np.flatnonzero(known & (size == dim))
                    x = flat[(start[own][:, None] + np.arange(dim)[None, :])]
                    finite = np.isfinite(x).all(1)
                    own, x = own[finite], x[finite]
                    used, data = prepare(x)
                    own = own[used]
                    if len(own):
                        key = np.asarray(ids.take(pa.array(own)).cast(pa.int64()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([dim], pa.int32()), pa.array([blk], pa.int64()), pa.array([len(own)], pa.int32()),
                             pa.array([key.tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())],
                            names=BLOCK.names)
                        blk += 1

    return table.select(table[vec_id].cast("long"), table[vector]).mapInArrow(run, BLOCK)


def grid(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int) -> DataFrame:
    """Every query block beside every row block of its dimension, cell by cell:
    ``dim, qgroup, cgroup`` and both blocks' columns prefixed ``q_`` and ``c_``.

    The grid has enough cells for :data:`CELL_PRODUCTS` products in each, with
    sides in the ratio of the two sets, which sends the fewest blocks about.
    """
    cells = min(MOST_CELLS, max(1, math.ceil(n_queries * n_rows / CELL_PRODUCTS)))
    across = max(1, min(cells, round(math.sqrt(cells * n_rows / max(n_queries, 1)))))
    down = max(1, math.ceil(cells / across))

    def side(df: DataFrame, p: str, groups: int, own: str, other: str, others: int) -> DataFrame:
        dealt = df.withColumn(own, F.pmod(F.xxhash64("blk"), F.lit(groups)).cast("int"))
        spread = dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        return spread.select("dim", "qgroup", "cgroup", *[F.col(c).alias(p + c) for c in ("blk", "n", "ids", "data")])

    q = side(queries, "q_", down, "qgroup", "cgroup", across)
    c = side(rows, "c_", across, "cgroup", "qgroup", down)
    return q.hint("merge").join(c, ["dim", "qgroup", "cgroup"])


#: Query blocks whose results a task holds before it hands them on.
HELD = 8


def search(cells: DataFrame, score_type: DataType, start: Callable, tile: Callable, finish: Callable) -> DataFrame:
    """Candidates ``(query_row, query_id, vec_id, score)`` of every query in every cell.

    ``start(q)`` makes the state of a query block, ``tile(state, q, c)`` works
    a row block into it and ``finish(state)`` lists its candidates; a block is
    ``(number, dim, ids, bytes)``.  A task keeps the states of a few query
    blocks; handing one on early costs rows, not results.
    """
    ship(cells.sparkSession)
    schema = StructType([StructField("query_row", LongType()), StructField("query_id", LongType()),
                         StructField("vec_id", LongType()), StructField("score", score_type)])
    number = pa.float64() if score_type.simpleString() == "double" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, tuple] = {}

        def give(key: tuple) -> pa.RecordBatch:
            state, ids = states.pop(key)
            at, vec, score = finish(state)
            at = np.asarray(at, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array((key[1] << 16) + at), pa.array(ids[at]), pa.array(np.asarray(vec, np.int64)),
                 pa.array(score, number)], names=schema.names)

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["dim"], r["q_blk"])
                q_ids = np.frombuffer(r["q_ids"], np.int64)
                c_ids = np.frombuffer(r["c_ids"], np.int64)
                q = (r["q_blk"], r["dim"], q_ids, r["q_data"])
                if key not in states:
                    if len(states) >= HELD:
                        yield give(next(iter(states)))
                    states[key] = (start(q), q_ids)
                tile(states[key][0], q, (r["c_blk"], r["dim"], c_ids, r["c_data"]))
        for key in list(states):
            yield give(key)

    wanted = ["dim", "q_blk", "q_ids", "q_data", "c_blk", "c_ids", "c_data"]
    return cells.select(*wanted).mapInArrow(run, schema)


def merge(candidates: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query row over all cells: ``(query_id, rank, vec_id, score)``."""
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


class Best:
    """The best ``k`` (score, id) of each query of a block, as heaps: larger
    scores first, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.heaps: list[list[tuple]] = [[] for _ in range(n)]

    def floor(self, i: int):
        """The k-th score so far, or None."""
        heap = self.heaps[i]
        return heap[0][0] if len(heap) == self.k else None

    def add(self, i: int, scores: list, ids: list) -> None:
        import heapq

        heap = self.heaps[i]
        for s, v in zip(scores, ids, strict=True):
            item = (s, -v)
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)

    def rows(self) -> tuple[list, list, list]:
        at = [i for i, h in enumerate(self.heaps) for _ in h]
        return at, [-v for h in self.heaps for _, v in h], [s for h in self.heaps for s, _ in h]
