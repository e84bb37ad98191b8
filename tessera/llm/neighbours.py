"""Nearest neighbours by a block matrix join in 8-bit integers.

Vectors are quantised to int8, each with its own scale.  Products of int8
tiles estimate all inner products of a query block and a row block; by
Cauchy-Schwarz the estimate is off by at most |q^| |e_c| + |e_q| |c|, where e
is what quantising lost.  Pairs whose upper bound reaches the k-th lower bound
(or the k-th score found so far) survive and are recomputed from the original
vectors in double precision, components summed in order; heaps merge them.
No true neighbour can fall outside the bounds, so the result is exact.

Defined results: vectors that are null, zero, empty or hold a null or
non-finite component take no part, nor do rows without an id; a query is
compared with vectors of its own dimension, rows with its own id left out;
each of several equal query rows gets a list of its own; equal scores rank by
vec_id; with fewer than k candidates all are listed; an empty table gives an
empty result.  Components may be as large or small as doubles are; a sum that
overflows on its way is taken exactly instead, and infinite if it is itself
beyond all doubles.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .vectors import Best, blocks, grid, merge, search

#: Survivors recomputed at a time.
_PART = 1 << 13


def _usable(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used = np.flatnonzero((x != 0).any(1))
    return used, x[used]


class _Quantised:
    """int8 values (held as floats, so that a matrix product is exact and
    fast), scales, norms and losses of a block."""

    def __init__(self, block: tuple):
        _, dim, self.ids, data = block
        self.x = np.frombuffer(data, np.float64).reshape(-1, dim)
        top = np.abs(self.x).max(1)
        unit = self.x / top[:, None]  # squares of very large or small components are no doubles
        self.scale = top / 127
        q = np.clip(np.rint(unit * 127), -127, 127).astype(np.int8)
        back = q / 127.0
        # sums of int8 products stay below 2**24 up to 1040 components
        self.q = q.astype(np.float32 if dim <= 1040 else np.float64)
        with np.errstate(over="ignore", under="ignore"):
            self.loss = np.linalg.norm(unit - back, axis=1) * top
            self.norm = np.linalg.norm(unit, axis=1) * top
            self.norm_back = np.linalg.norm(back, axis=1) * top


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, components summed in order; where that isn't
    finite, the exact sum as the nearest double (infinite above all doubles)."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        score = np.add.accumulate(a * b, axis=1)[:, -1]
    for i in np.flatnonzero(~np.isfinite(score)).tolist():
        exact = sum(Fraction(x) * Fraction(y) for x, y in zip(a[i].tolist(), b[i].tolist(), strict=True))
        try:
            score[i] = float(exact)
        except OverflowError:
            score[i] = math.inf if exact > 0 else -math.inf
    return score


class _State:
    def __init__(self, q: tuple, k: int):
        self.q = _Quantised(q)
        self.best = Best(len(self.q.ids), k)

    def work(self, c: _Quantised, k: int) -> None:
        q = self.q
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            estimate = (q.q @ c.q.T).astype(np.float64) * q.scale[:, None] * c.scale[None, :]
            off = (q.norm_back[:, None] * c.loss[None, :] + q.loss[:, None] * c.norm[None, :]) * (1 + 1e-9)
            off += 1e-12 * q.norm[:, None] * c.norm[None, :] + 1e-300  # rounding of the products themselves
            lower, upper = estimate - off, estimate + off
        # a bound that is no finite number says nothing: the pair survives
        loose = ~(np.isfinite(lower) & np.isfinite(upper))
        lower[loose], upper[loose] = -np.inf, np.inf
        own = q.ids[:, None] == c.ids[None, :]
        lower[own] = -np.inf
        if lower.shape[1] > k:
            reach = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
        else:
            reach = np.full(len(q.ids), -np.inf)
        floor = np.array([-np.inf if (f := self.best.floor(i)) is None else f for i in range(len(q.ids))])
        i, j = np.nonzero((upper >= np.maximum(reach, floor)[:, None]) & ~own)
        for at in range(0, len(i), _PART):
            a, b = i[at:at + _PART], j[at:at + _PART]
            score = _scores(q.x[a], c.x[b])
            edges = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                self.best.add(int(a[s]), score[s:e].tolist(), c.ids[b[s:e]].tolist())


def nearest(table: DataFrame, is_query: str, k: int, block_rows: int = 2048, query_rows: int = 512,
            vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner
    product for each row that satisfies the SQL condition ``is_query``."""
    asked = table.where(is_query)
    cells = grid(blocks(asked, query_rows, _usable, vec_id, vector), blocks(table, block_rows, _usable, vec_id, vector),
                 asked.count(), table.count())
    kept: dict[tuple, _Quantised] = {}

    def tile(state: _State, _q: tuple, c: tuple) -> None:
        key = c[:2]
        if key not in kept:
            if len(kept) >= 4:
                kept.clear()
            kept[key] = _Quantised(c)
        state.work(kept[key], k)

    found = search(cells, DoubleType(), lambda q: _State(q, k), tile, lambda s: s.best.rows())
    return merge(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
