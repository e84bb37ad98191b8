"""Exact top-k search by KD-trees, one for each shard of the rows.

Vectors become integers, floor(scale * x).  Each shard's tree halves its rows
at the median of the dimension with the widest box; every node has the tight
bounding box of its rows.  A query visits nodes best first: the box bounds
the inner product by sum(max(q_d lo_d, q_d hi_d)), and a node whose bound is
below the k-th score found so far, in this shard or any before it in the
task, ends the search of the shard.

Scores are exact at any size: in doubles or longs while no sum can exceed
them, else in Python integers for the rows that doubles can't rule out.

Defined results: vectors that are null, empty or hold a null or non-finite
component take no part, nor rows without an id; a result whose score doesn't
fit a long is an error; a query is compared with vectors of its own dimension, rows with its own id left
out; each of several equal query rows gets a list of its own; equal scores
rank by vec_id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .vectors import Best, blocks, grid, merge, search

_LONG = 1 << 63


def _integer(x: float, scale: int) -> int:
    """floor(scale * x), exact also where the product exceeds a double."""
    y = np.floor(x * scale)
    return int(y) if np.isfinite(y) else int(x) * scale


class Tree:
    """A KD-tree in arrays: rows in leaf order, boxes and row ranges by node
    (children of node i are 2i + 1 and 2i + 2).  ``raw`` are the vectors, of
    which the integers are made; as doubles they are whole numbers, infinite
    beyond the largest double."""

    def __init__(self, raw: np.ndarray, ids: np.ndarray, leaf: int, scale: int):
        x = _floors(raw, scale)
        depth = max(0, int(np.ceil(np.log2(max(len(x), 1) / leaf))))
        nodes = 2 ** (depth + 1) - 1
        self.inner = 2 ** depth - 1
        self.scale = scale
        order = np.arange(len(x))
        self.begin = np.zeros(nodes, np.int64)
        self.end = np.zeros(nodes, np.int64)
        self.end[0] = len(x)
        for i in range(self.inner):
            b, e = self.begin[i], self.end[i]
            mid = (b + e) // 2
            if e - b > 1:
                own = order[b:e]
                with np.errstate(invalid="ignore", over="ignore"):
                    wide = int(np.argmax(x[own].max(0) - x[own].min(0)))
                order[b:e] = own[np.argpartition(x[own, wide], mid - b)]
            self.begin[2 * i + 1], self.end[2 * i + 1] = b, mid
            self.begin[2 * i + 2], self.end[2 * i + 2] = mid, e
        self.x, self.raw, self.ids = x[order], raw[order], ids[order]
        spans = list(zip(self.begin, self.end, strict=True))
        self.most = [float(np.abs(self.x[b:e]).max(initial=0)) for b, e in spans]
        self.low = np.array([self.x[b:e].min(0) if e > b else x[0] for b, e in spans])
        self.high = np.array([self.x[b:e].max(0) if e > b else x[0] for b, e in spans])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products, (query, node), rounded up;
        infinite where doubles don't give one."""
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        with np.errstate(invalid="ignore", over="ignore"):
            bound = plus @ self.high.T + minus @ self.low.T
            reach = np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.high)).T
            bound = bound + 1e-12 * reach
        return np.where(np.isfinite(reach) & ~np.isnan(bound), bound, np.inf)

    def scores(self, b: int, e: int, most: float, raw: np.ndarray, query: np.ndarray, own: int,
               floor: int | None, k: int) -> tuple[np.ndarray, list]:
        """Which of the rows b to e - 1, but those of id ``own``, can be among
        the ``k`` best, and their exact scores."""
        take = self.ids[b:e] != own
        reach = most * float(np.abs(query).max()) * len(query)
        if reach < 1 << 53:  # every sum is exact in doubles
            score = self.x[b:e] @ query
        elif reach < 1 << 62 and most < 1 << 62 and float(np.abs(query).max()) < 1 << 62:
            score = self.x[b:e].astype(np.int64) @ query.astype(np.int64)
        else:
            with np.errstate(invalid="ignore", over="ignore"):
                about = self.x[b:e] @ query
                slack = 1e-12 * (np.abs(self.x[b:e]) @ np.abs(query))
                most_, least = about + slack, about - slack
                sure = np.isfinite(slack) & np.isfinite(about)
            near = take.copy()
            if floor is not None and abs(floor) < 1 << 1000:
                near &= ~(sure & (most_ < floor - abs(floor) * 1e-12))
            if sure.all() and (rest := int(take.sum()) - k) > 0:
                near &= most_ >= np.partition(least[take], rest)[rest]
            at = np.flatnonzero(near)
            exact = [_integer(v, self.scale) for v in raw]
            return at, [sum(_integer(v, self.scale) * q for v, q in zip(row, exact, strict=True))
                        for row in self.raw[b:e][at].tolist()]
        score = score.astype(np.int64)
        if floor is not None and abs(floor) < _LONG:
            take &= score >= floor
        at = np.flatnonzero(take)
        return at, score[at].tolist()

    def visit(self, best: Best, i: int, raw: np.ndarray, query: np.ndarray, own: int, bound: np.ndarray) -> None:
        """Work the shard's best rows for one query into its heap."""
        heap = [(-bound[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            floor = best.floor(i)
            if floor is not None and -top < floor:
                return  # nothing left can reach the k-th score
            b, e = self.begin[node], self.end[node]
            if b == e:
                continue
            if node < self.inner:
                for child in (2 * node + 1, 2 * node + 2):
                    heapq.heappush(heap, (-bound[child], child))
                continue
            at, score = self.scores(b, e, self.most[node], raw, query, own, floor, best.k)
            best.add(i, score, self.ids[b:e][at].tolist())


def _floors(x: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(x * scale)


def _longs(rows: tuple[list, list, list]) -> tuple[list, list, list]:
    """Candidates with scores as longs.  One above them is among the final
    best, so it is an error at once; one below is null until then."""
    at, ids, scores = rows
    for s, v in zip(scores, ids, strict=True):
        if s >= _LONG:
            raise OverflowError(f"the score {s} of vec_id {v} doesn't fit a long")
    return at, ids, [s if s >= -_LONG else None for s in scores]


def top_k(table: DataFrame, is_query: str, k: int, scale: int = 256, shard_rows: int = 4096, query_rows: int = 512,
          leaf: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows with the largest
    integer inner product for each row that satisfies ``is_query``."""

    def all_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(x)), x

    def matrix(block: tuple) -> np.ndarray:
        return np.frombuffer(block[3], np.float64).reshape(-1, block[1])

    asked = table.where(is_query)
    cells = grid(blocks(asked, query_rows, all_rows, vec_id, vector),
                 blocks(table, shard_rows, all_rows, vec_id, vector), asked.count(), table.count())
    trees: dict[tuple, Tree] = {}

    def tile(best: Best, q: tuple, c: tuple) -> None:
        key = c[:2]
        if key not in trees:
            if len(trees) >= 4:
                trees.clear()
            trees[key] = Tree(matrix(c), c[2], leaf, scale)
        tree, raw = trees[key], matrix(q)
        queries = _floors(raw, scale)
        bound = tree.bounds(queries)
        for i, own in enumerate(q[2].tolist()):
            tree.visit(best, i, raw[i], queries[i], own, bound[i])

    found = search(cells, LongType(), lambda q: Best(len(q[2]), k), tile, lambda s: _longs(s.rows()))
    # an error only where a score below all longs is among the best: nulls come last
    score = F.coalesce("score", F.raise_error(F.lit("a score doesn't fit a long")).cast("long"))
    return merge(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
