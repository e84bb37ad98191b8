"""R1's half-steps over packed blocks: Spark's own factors, ratings packed once for a grid."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tessera.operators import blockals
from tessera.operators import recommend as rec


def _rows(spark):
    # repeated pairs, ratings of zero and below, ids below zero, and an item that nearly all have
    rows = [(u - 3, (u * 7 + i * 5) % 31 - 2, float((u + i) % 6 - 1)) for u in range(45) for i in range(3 + u % 9)]
    rows += [(u - 3, 5, 2.0) for u in range(44)] + rows[:9]
    return spark.createDataFrame([(*r, n % 3) for n, r in enumerate(rows)], "user long, item long, rating double, fold int")


def test_factors_are_those_of_sparks_solver(spark, monkeypatch):
    monkeypatch.setattr(blockals, "TILE_ROWS", 60)  # several tiles on either side
    rows = _rows(spark)
    packed = blockals.pack(rec.als_rows(rows, "user", "item", "rating", "fold"), rec.ALS_BLOCKS, F.col("fold"))
    assert packed.blocks == -(-rows.count() // 60) > 5
    for fold in (0, 2):  # a fold's rows are left out where tiles are read
        plain = ALS(rank=3, maxIter=3, regParam=0.1, alpha=2.0, implicitPrefs=True, userCol="user", itemCol="item", ratingCol="rating",
                    seed=rec.ALS_SEED, coldStartStrategy="drop").fit(rec.als_input(rows.where(F.col("fold") != fold)))
        model = rec.train_als(packed.without(fold), 3, 0.1, 2.0, 3)
        for a, b in ((plain.userFactors, model.userFactors), (plain.itemFactors, model.itemFactors)):
            want, got = ({r.id: r.features for r in x.collect()} for x in (a, b))
            assert set(want) == set(got)
            for i, x in want.items():
                assert np.allclose(got[i], x, rtol=1e-5, atol=1e-6), (fold, i)
        rec.release_model(model)
    packed.release()


def test_ids_of_many_ratings_are_solved_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    counts = np.array([3, 50, 1, 17, 4])
    at, ratings = rng.integers(0, 9, counts.sum()), rng.integers(-2, 6, counts.sum()).astype(np.float32)
    factors = rng.standard_normal((9, 4)).astype(np.float32)
    y = factors.astype(float)
    ends = np.cumsum(counts)
    for cells in (1, 32, 1 << 14):
        monkeypatch.setattr(blockals, "CELLS", cells)
        got = blockals.solve(counts, at, ratings, factors, y.T @ y, 0.1, 2.0)
        for i, (a, b) in enumerate(zip(ends - counts, ends, strict=True)):
            v, r = y[at[a:b]], ratings[a:b].astype(float)
            left = y.T @ y + (v.T * 2 * abs(r)) @ v + 0.1 * (r > 0).sum() * np.eye(4)
            want = np.linalg.solve(left, (v[r > 0] * (1 + 2 * r[r > 0])[:, None]).sum(0))
            assert np.allclose(got[i], want, rtol=1e-6, atol=1e-7)


def test_a_grid_packs_its_ratings_once(spark, monkeypatch):
    from tessera.plans import store

    made, pack, handed = [], blockals.pack, []
    monkeypatch.setattr(blockals, "pack", lambda *args: made.append(pack(*args)) or made[-1])
    listed = rec.labelled_lists
    monkeypatch.setattr(rec, "labelled_lists", lambda *args: handed.append(1) or listed(*args))
    rows = _rows(spark).where("rating > 0")
    assert rec.grid_search(rows, (2, 3), (0.1,), k=3, n=5, parallelism=2).count() == 6
    # six fits, one set of tiles, gone at the end; no list leaves the task that makes it
    assert len(made) == 1 and not handed
    assert not any(store.exists(spark, path) for path in made[0].paths)


def test_null_ids_fail_as_in_sparks_solver(spark):
    rows = spark.createDataFrame([(1, 2, 1.0), (None, 2, 1.0)], "user long, item long, rating double")
    with pytest.raises(Exception, match="must not be null"):
        rec.train_als(rows, 2, 0.1, 1.0, 1)
