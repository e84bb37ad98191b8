"""R1-R8 on sf0.001: popularity values from FIXTURES, ALS repeatability."""

from pyspark.sql import functions as F

from tessera.plans import recommendations as R
from tessera.operators import recommend as rec
from tessera.operators.sampling import kfold_assign as rec_assign

from data_paths import SF0001


def test_popularity_expected_values(spark):
    top = R.popularity_top_n(spark, SF0001).orderBy("rank").limit(2).collect()
    assert [(r.item, r.total) for r in top] == [(86, 1356.0), (53, 1354.0)]
    pal = R.popularity_predictions_labels(spark, SF0001)
    assert pal.count() == 6850 and pal.where("label = 1").count() == 336
    assert round(R.popularity_auc(spark, SF0001).first()[0], 6) == 0.572797
    parity = R.split_user_parity(spark, SF0001).first()
    assert (parity.train_users, parity.test_users, parity.same_users) == (137, 137, True)


def test_als_same_rows_same_lists(spark):
    train, test = R.train_test(spark, SF0001)
    a = rec.recommend_top_n(rec.train_als(train, 5, 0.1, 1.0, 3), test, 10)
    b = rec.recommend_top_n(rec.train_als(train, 5, 0.1, 1.0, 3), test, 10)
    ra = sorted((r.user, r["rank"], r.item) for r in a.collect())
    rb = sorted((r.user, r["rank"], r.item) for r in b.collect())
    assert ra == rb
    per_user = a.groupBy("user").count().select(F.min("count"), F.max("count")).first()
    assert tuple(per_user) == (10, 10)


def test_lists_equal_spark_s_product_of_all_pairs(spark):
    train, test = R.train_test(spark, SF0001)
    model = rec.train_als(train, 6, 0.1, 1.0, 3)
    users = test.select("user").distinct()
    got = {}
    for r in rec.recommend_top_n(model, users, 20, method="blocks").collect():
        got.setdefault(r.user, {})[r["rank"]] = (r["item"], r.score)
    want = model.recommendForUserSubset(users, 20).collect()
    assert len(got) == len(want) > 100
    for r in want:
        for i, (item, rating) in enumerate(r.recommendations, start=1):
            mine, score = got[r.user][i]
            assert abs(score - rating) < 1e-5 and (mine == item or abs(dict(got[r.user].values())[item] - score) < 1e-5)


def test_new_user_named_list(spark):
    top = R.new_user_top_n(spark, SF0001, rank=5, reg=0.1, alpha=1.0).collect()
    assert len(top) == 25 and all(r.user == R.NEW_USER_ID for r in top)
    assert [r["rank"] for r in sorted(top, key=lambda r: r["rank"])] == list(range(1, 26))
    assert all(r.name for r in top)


def test_grid_search_small(spark):
    from tessera.operators.report import append_rows
    from tessera.session import shared_path

    log = shared_path(spark, "cv-log-test")
    train, _ = R.train_test(spark, SF0001)
    evals = rec.grid_search(rec_assign(train), ranks=(4,), regs=(0.1, 1.0), parallelism=4,
                            on_result=lambda row: append_rows(row, log))
    rows = evals.collect()
    assert spark.read.parquet(log).count() == 10
    assert len(rows) == 2 * 5 and all(r.auc is None or 0.0 <= r.auc <= 1.0 for r in rows)
    summary = R.grid_eval_summary(evals).collect()
    assert len(summary) == 2 and all(r.folds == 5 for r in summary)


def test_params_are_validated():
    import pytest

    with pytest.raises(ValueError):
        R.Params(top_n=1_000_000)
    with pytest.raises(ValueError):
        R.Params(folds=1)
    with pytest.raises(ValueError):
        R.Params(train_fraction=1.5)


def test_popularity_cv_against_plain_python(spark):
    from collections import Counter

    rows = R.kfold_assignment(spark, SF0001).collect()
    want = {}
    for n in (3, 20):
        aucs = []
        for fold in range(5):
            total = Counter()
            for r in rows:
                if r.fold != fold:
                    total[r["item"]] += r.rating
            top = sorted(total, key=lambda i: (-total[i], i))[:n]
            held = {(r.user, r["item"]) for r in rows if r.fold == fold}
            users = {u for u, _ in held}
            pos = [sum((u, i) in held for u in users) for i in top]
            neg = [len(users) - x for x in pos]
            area = sum(x * (sum(neg[k + 1:]) + neg[k] / 2) for k, x in enumerate(pos))
            aucs.append(area / (sum(pos) * sum(neg)))
        want[n] = sum(aucs) / 5
    got = R.popularity_cv_summary(spark, SF0001, lengths=(3, 20)).collect()
    assert [r.top_n for r in got] == sorted(want, key=lambda n: -want[n])
    assert all(abs(r.mean_auc - want[r.top_n]) < 1e-12 and r.folds == 5 for r in got)
    assert len(R.popularity_cv_summary(spark, SF0001, lengths=(3, 20), best=1).collect()) == 1


def test_grid_evaluations_accumulate_in_a_named_log(spark, tmp_path):
    log = str(tmp_path / "log")
    for alpha in (1.0, 2.0):
        grid = R.grid_search_cv(spark, SF0001, R.Params(folds=2), (2,), (0.1,), (alpha,), log_path=log)
        assert grid.count() == 2
    logged = spark.read.parquet(log)
    assert logged.count() == 4 and logged.where("logged_at IS NULL OR source IS NULL").count() == 0
    assert R.evaluation_log(spark) == R.evaluation_log(spark)


def test_fold_in_is_the_half_step(spark):
    import numpy as np

    train, _ = R.train_test(spark, SF0001)
    reg, alpha = 0.1, 2.0
    model = rec.train_als(train, 7, reg, alpha, 3)
    Y = {r.id: np.array(r.features, float) for r in model.itemFactors.collect()}
    items = sorted(Y)[:6]
    rows = [(1, items[0], 5.0), (1, items[1], 3.0), (1, items[1], 3.0), (1, items[2], -1.0), (1, 10**7, 9.0),
            (2, items[3], 1.0), (3, 10**7, 1.0), (4, items[4], 0.0)] + [(5, i, 1.0 + i % 3) for i in sorted(Y)]
    got = {r.user: np.array(r.features) for r in
           rec.fold_in(model, spark.createDataFrame(rows, "user long, item long, rating double"), reg, alpha).collect()}
    M = np.array(list(Y.values()))
    assert set(got) == {1, 2, 4, 5}
    for u, x in got.items():
        own = [(Y[i], r) for v, i, r in rows if v == u and i in Y]
        n = sum(r > 0 for _, r in own)
        a = M.T @ M + sum(alpha * abs(r) * np.outer(y, y) for y, r in own) + reg * n * np.eye(7)
        b = sum(((1 + alpha * r) * y for y, r in own if r > 0), np.zeros(7))
        assert np.allclose(x, np.linalg.solve(a, b), atol=1e-9), u
    # a user of the training rows gets the factors that the solver's own last half-step would give
    known = train.where("user = 4").select("user", "item", "rating")
    mine = rec.fold_in(model, known, reg, alpha).first()
    own = [(Y[r["item"]], r.rating) for r in known.collect()]
    a = M.T @ M + sum(alpha * r * np.outer(y, y) for y, r in own) + reg * len(own) * np.eye(7)
    assert mine is None or np.allclose(mine.features, np.linalg.solve(a, sum((1 + alpha * r) * y for y, r in own)), atol=1e-7)
    top = rec.top_n_of_factors(model, spark.createDataFrame([(9, got[1].tolist())], "user long, features array<double>"), 5)
    ids = np.array(sorted(Y))
    score = np.array([Y[i] @ got[1] for i in ids])
    assert [r["item"] for r in sorted(top.collect(), key=lambda r: r["rank"])] == ids[np.lexsort((ids, -score))[:5]].tolist()


def test_new_user_folded_in_named_list(spark):
    top = R.new_user_fold_in(spark, SF0001, rank=5, reg=0.1, alpha=1.0).collect()
    assert len(top) == 25 and all(r.user == R.NEW_USER_ID and r.name for r in top)
    assert [r["rank"] for r in sorted(top, key=lambda r: r["rank"])] == list(range(1, 26))
    own = {r["item"] for r in R.new_user_rows(spark, SF0001).collect()}
    retrained = {r["item"] for r in R.new_user_top_n(spark, SF0001, rank=5, reg=0.1, alpha=1.0).collect()}
    assert len({r["item"] for r in top} & (retrained | own)) >= 5


def test_a_grid_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    from tessera.plans import store

    log, fitted, fit = str(tmp_path / "log"), [], rec.train_als

    def stopping(train, rank, reg, alpha, *more, **kw):
        if len(fitted) == 2 and stop:
            raise RuntimeError("stopped")
        fitted.append((rank, reg))
        return fit(train, rank, reg, alpha, *more, **kw)

    monkeypatch.setattr(rec, "train_als", stopping)
    p, args = R.Params(folds=2, top_n=10), ((2,), (0.1, 1.0))
    stop = True
    try:
        R.grid_search_cv(spark, SF0001, p, *args, parallelism=1, log_path=log)
        raise AssertionError("did not stop")
    except RuntimeError:
        pass
    assert spark.read.parquet(log).count() == 2
    stop = False
    rows = R.grid_search_cv(spark, SF0001, p, *args, parallelism=1, log_path=log).collect()
    assert len(fitted) == 4 and len(rows) == 4 and spark.read.parquet(log).count() == 4
    assert {(r.reg, r.fold) for r in rows} == {(0.1, 0), (0.1, 1), (1.0, 0), (1.0, 1)}
    # other parameters of the run are another run
    assert R.logged_evaluations(spark, log, R.run_key(spark, SF0001, p))
    assert not R.logged_evaluations(spark, log, R.run_key(spark, SF0001, R.Params(folds=2, top_n=11)))
    store.release(spark, "grid")
    assert R.grid_search_cv(spark, SF0001, p, *args, log_path=log).count() == 4 and len(fitted) == 4


def test_bitmaps_label_like_the_join(spark):
    truth = spark.createDataFrame([(1, i) for i in (-70000, -1, 0, 1, 8, 9, 32768, 32769, 10**9)] * 2 + [(2, 5), (2, None), (3, None)],
                                  "user long, item long")
    scored = spark.createDataFrame(
        [(u, i + d, 0.5) for u in (1, 2, 4) for i in (-70000, -1, 0, 1, 5, 8, 32768, 10**9) for d in (-1, 0, 1)],
        "user long, item long, score double").distinct()
    bits = rec.item_bitmaps(truth)
    assert {(r.user, r.n_items) for r in bits.groupBy("user").agg(F.sum("n_items").alias("n_items")).collect()} == {(1, 9), (2, 1)}
    want = {(r.user, r["item"]): r.label for r in rec.label_by_membership(scored, truth).collect()}
    got = {(r.user, r["item"]): r.label for r in rec.label_by_bitmap(scored, bits).collect()}
    assert got == want and 0 < sum(want.values()) < len(want)


def test_a_written_model_keeps_its_items_together(spark):
    from pyspark.ml.recommendation import ALS

    rows = spark.createDataFrame([(u, i, float(1 + (u * i) % 7)) for u in range(40) for i in range(60) if (u + i) % 3],
                                 "user long, item long, rating double")
    plain = ALS(rank=4, maxIter=3, regParam=0.1, alpha=1.0, implicitPrefs=True, userCol="user", itemCol="item",
                ratingCol="rating", seed=rec.ALS_SEED, coldStartStrategy="drop").fit(rec.als_input(rows))
    model = rec.train_als(rows, 4, 0.1, 1.0, 3)
    # one block of items: a user's n best are shuffled once, not once for each of the solver's blocks
    assert plain.itemFactors.rdd.getNumPartitions() == rec.ALS_BLOCKS and model.itemFactors.rdd.getNumPartitions() == 1
    for a, b in ((plain.itemFactors, model.itemFactors), (plain.userFactors, model.userFactors)):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    users = rows.select("user").distinct()
    want = {(r.user, tuple(x.rating for x in r.recommendations)) for r in plain.recommendForUserSubset(users, 8).collect()}
    got = {}
    for r in sorted(rec.recommend_top_n(model, users, 8).collect(), key=lambda r: (r.user, r["rank"])):
        got.setdefault(r.user, []).append(r.score)
    assert {(u, tuple(s)) for u, s in got.items()} == want


def test_a_grid_leaves_no_model_behind(spark, monkeypatch):
    from tessera.plans import store

    made, write = [], rec.written_model
    monkeypatch.setattr(rec, "written_model", lambda model: made.append(write(model)) or made[-1])
    rows = spark.createDataFrame([(u, i, 1.0, (u + i) % 2) for u in range(30) for i in range(20) if (u * i) % 3],
                                 "user long, item long, rating double, fold int")
    assert rec.grid_search(rows, (2,), (0.1,), k=2, n=5, parallelism=2).count() == 2
    assert len(made) == 2 and not any(store.exists(spark, m.written_to) for m in made)


def _play_rows(spark):
    return spark.createDataFrame([(u, i * 3, float(1 + (u * i) % 7)) for u in range(50) for i in range(61) if (u * 5 + i) % 4],
                                 "user long, item long, rating double")


def test_lists_are_labelled_where_they_are_made(spark, monkeypatch):
    rows = _play_rows(spark)
    # a pair twice, an item and a user that the model hasn't, nulls, and a user with all items
    held = spark.createDataFrame([(u, (u * 11 + d) % 70 * 3) for u in range(40) for d in range(9)] + [(7, i * 3) for i in range(61)]
                                 + [(48, 6), (48, 6), (49, 10**10), (60, 3), (47, None), (None, 3)], "user long, item long")
    for block in (rec.PRODUCT_BLOCK, 9):  # all items in one block, or in seven
        monkeypatch.setattr(rec, "PRODUCT_BLOCK", block)
        model = rec.train_als(rows, 4, 0.1, 1.0, 3)
        assert (model.item_blocks == 1) == (block > 61)
        monkeypatch.setattr(rec, "USER_BLOCK", 16)
        for n in (8, 100):
            got = rec.labelled_lists(model, held, n)
            plan = got._jdf.queryExecution().executedPlan().toString()
            # listed pairs meet the held-out ones in their block, not in a join of pairs; one block needs no merging
            assert "LeftOuter" not in plan and "collect_top_k" not in plan
            assert ("Window" in plan) == (block == 9)
            assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
                ("user", "bigint"), ("item", "bigint"), ("rank", "int"), ("score", "double"), ("label", "double")]
            got = {(r.user, r["item"]): (r["rank"], r.score, r.label) for r in got.collect()}
            want = rec.als_predictions_labels(model, held, n).collect()
            assert len(want) == len(got) == 43 * min(n, 61) and {r.user for r in want} == {*range(40), 47, 48, 49}
            by_rank = {(u, rank): score for (u, _), (rank, score, _) in got.items()}
            assert len(by_rank) == len(got)
            for r in want:
                assert abs(by_rank[r.user, r["rank"]] - r.score) < 1e-5
                if (r.user, r["item"]) in got:
                    assert got[r.user, r["item"]][2] == r.label
                else:  # another of the same score
                    assert abs(by_rank[r.user, n] - r.score) < 1e-5


def test_equal_scores_are_listed_by_item(spark):
    import numpy as np

    items = np.array([5, 2, 9, 4, 7])
    y = np.array([[1, 0], [2, 0], [1, 0], [1, 0], [3, 0]], np.float32)
    x = np.array([[1, 0], [-1, 0]], np.float32)
    for n, want in ((3, [[7, 2, 4], [4, 5, 9]]), (9, [[7, 2, 4, 5, 9], [4, 5, 9, 2, 7]])):
        i, rank, j, score = rec._best_items(x, items, y, n)
        assert [items[j[i == u]].tolist() for u in (0, 1)] == want and rank.tolist() == [*range(1, len(want[0]) + 1)] * 2
        assert all(s == x[u] @ y[c] for u, c, s in zip(i, j, score, strict=True))


def test_the_grid_s_auc_is_that_of_the_labelled_product(spark, monkeypatch):
    from tessera.operators.metrics import auc_value

    rows = _play_rows(spark).withColumn("fold", F.pmod(F.xxhash64("user", "item"), F.lit(2)).cast("int"))
    kept = []
    monkeypatch.setattr(rec, "release_model", kept.append)
    got = [r.auc for r in rec.grid_search(rows, (3,), (0.1,), k=2, n=6).collect()]
    for fold, (model, auc) in enumerate(zip(kept, got, strict=True)):
        held = rows.where(F.col("fold") == fold)
        assert abs(auc - auc_value(rec.als_predictions_labels(model, held, 6))) < 1e-4
        assert abs(auc - auc_value(rec.labelled_lists(model, held, 6))) < 1e-12
