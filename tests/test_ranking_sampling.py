"""W1-W3 split and folds; the skew-safe ranking equals the plain window."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.keys import row_key
from tessera.operators.ranking import rank_within_groups, top_n_per_group
from tessera.operators.sampling import hash_sample, kfold_assign, kfold_partitions, per_user_split


def _ratings(spark, sizes):
    rows = [(u, i, float(i % 7)) for u, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "user bigint, item bigint, rating double")
    return df.withColumn("row_key", row_key("user", "item", "rating"))


def test_split_sizes(spark):
    df = _ratings(spark, {1: 1, 2: 2, 3: 5, 4: 100})
    s = per_user_split(df)
    got = {r.user: r.n for r in s.where("split = 'train'").groupBy("user").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 1, 2: 1, 3: 4, 4: 80}


def test_hot_group_path_matches_plain_window(spark):
    df = _ratings(spark, {1: 3, 2: 250, 3: 40, 4: 1})
    plain = rank_within_groups(df, ["user"], ["row_key", "item"], hash_col="row_key")
    split_hot = rank_within_groups(df, ["user"], ["row_key", "item"], hash_col="row_key", hot_rows=16)
    a = sorted((r.user, r.item, r.rn, r.n) for r in plain.collect())
    b = sorted((r.user, r.item, r.rn, r.n) for r in split_hot.collect())
    assert a == b
    w = Window.partitionBy("user").orderBy("row_key", "item")
    ref = sorted((r.user, r.item, r.rn) for r in df.withColumn("rn", F.row_number().over(w)).collect())
    assert [(u, i, rn) for u, i, rn, _ in b] == ref


def test_hot_path_split_equals_plain(spark):
    df = _ratings(spark, {7: 300, 8: 9})
    a = sorted(tuple(r) for r in per_user_split(df).collect())
    b = sorted(tuple(r) for r in per_user_split(df, hot_rows=20).collect())
    assert a == b


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), min_size=1, max_size=6))
def test_split_property(spark, sizes):
    s = per_user_split(_ratings(spark, sizes))
    train = {r.user: r.n for r in s.where("split = 'train'").groupBy("user").agg(F.count("*").alias("n")).collect()}
    assert train == {u: max(1, int(n * 0.8)) for u, n in sizes.items()}


def test_folds_balanced_disjoint_complete(spark):
    df = _ratings(spark, {1: 11, 2: 23, 3: 5})
    a = kfold_assign(df, 5)
    per = a.groupBy("user", "fold").count().collect()
    by_user = {}
    for r in per:
        by_user.setdefault(r.user, []).append(r["count"])
    for counts in by_user.values():
        assert max(counts) - min(counts) <= 1
    parts = kfold_partitions(a, 5)
    roles = parts.groupBy("fold_id", "role").count().collect()
    total = df.count()
    for i in range(5):
        val = sum(r["count"] for r in roles if r.fold_id == i and r.role == "val")
        tr = sum(r["count"] for r in roles if r.fold_id == i and r.role == "train")
        assert val + tr == total
    assert sum(r["count"] for r in roles if r.role == "val") == total


def test_hash_sample_is_partitioning_independent(spark):
    df = spark.range(2000).select(F.col("id").alias("k"))
    a = {r.k for r in hash_sample(df, 0.3, ["k"]).collect()}
    b = {r.k for r in hash_sample(df.repartition(7), 0.3, ["k"]).collect()}
    assert a == b and 450 < len(a) < 750


def test_top_n_per_group_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = top_n_per_group(df, ["g"], [F.desc("v")], 2)
    assert sorted((r.g, r.v) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.integers(1, 9), st.integers(1, 80), min_size=1, max_size=5),
       st.sampled_from([1, 3, 10, 1000]))
def test_hot_path_property(spark, sizes, hot_rows):
    df = _ratings(spark, sizes)
    got = sorted((r.user, r.item, r.rn, r.n) for r in rank_within_groups(
        df, ["user"], ["row_key", "item"], hash_col="row_key", hot_rows=hot_rows).collect())
    w = Window.partitionBy("user").orderBy("row_key", "item")
    want = sorted((r.user, r.item, r.rn, r.n) for r in df.select(
        "user", "item", F.row_number().over(w).alias("rn"),
        F.count("*").over(Window.partitionBy("user")).alias("n")).collect())
    assert got == want


def test_hot_path_on_real_ratings_equals_plain_split(spark):
    from tessera.plans import recommendations as R

    d = "/root/testdata/sf0.01"
    qualified = R.qualified_ratings(R.ratings_canonical(spark, d))
    hot = per_user_split(qualified, hot_rows=20)
    plain = R.split_ratings(spark, d)
    cols = ["user", "item", "rating", "row_key", "split"]
    assert hot.select(*cols).exceptAll(plain.select(*cols)).count() == 0
    assert plain.select(*cols).exceptAll(hot.select(*cols)).count() == 0


@pytest.mark.parametrize("hot_rows", [7, 2_000_000])
def test_folds_of_the_split_are_those_of_its_training_rows(spark, hot_rows):
    from data_paths import SF0001
    from tessera.plans import recommendations as R

    rows = R.ratings_canonical(spark, SF0001)
    split = per_user_split(rows, 0.8, folds=5, hot_rows=hot_rows)
    both = split.where("split = 'train'").drop("split")
    alone = kfold_assign(both.drop("fold"), 5)
    assert sorted(both.collect()) == sorted(alone.collect())
    assert split.where("split = 'test' AND fold IS NOT NULL").count() == 0


@pytest.mark.parametrize("hot_rows", [7, 2_000_000])
def test_global_index_is_consecutive_over_a_hot_user(spark, hot_rows):
    import hashlib

    from tessera.operators.sampling import global_kfold

    rows = [(1 if i % 3 else i, i % 11, float(i % 4), hashlib.md5(str(i // 2).encode()).hexdigest()) for i in range(300)]
    table = spark.createDataFrame(rows, "user long, item long, rating double, row_key string").repartition(7)
    got = global_kfold(table, 5, hot_rows=hot_rows).collect()
    want = sorted(rows, key=lambda r: (r[3], r[0], r[1], r[2]))
    assert [(r.user, r["item"], r.rating, r.row_key) for r in sorted(got, key=lambda r: r["index"])] == want
    assert [r["index"] for r in sorted(got, key=lambda r: r["index"])] == list(range(300))
    assert all(r.fold == r["index"] % 5 for r in got)
    assert global_kfold(table.limit(0), 5).count() == 0


def test_rank_shuffles_rows_once(spark):
    """Hot groups and their offsets are sent whole (they are few): no sort-merge join."""
    from tessera.operators.ranking import rank_within_groups

    rows = spark.range(400).selectExpr("id % 7 AS g", "md5(string(id)) AS h", "id AS v")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = rank_within_groups(rows, ["g"], ["h", "v"], hash_col="h", hot_rows=40)
        assert "SortMergeJoin" not in ranked._jdf.queryExecution().executedPlan().toString()
        got = {(r.g, r.v): (r.rn, r.n) for r in ranked.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    by_group = {}
    for r in rows.collect():
        by_group.setdefault(r.g, []).append((r.h, r.v))
    assert got == {(g, v): (i, len(own)) for g, own in by_group.items() for i, (_, v) in enumerate(sorted(own), 1)}
