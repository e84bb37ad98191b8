"""Intermediates written once per application and reused (K8)."""

from pyspark.sql import functions as F

from tessera.plans import store


def test_stored_builds_once_and_reuses(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5).select(F.col("id").alias("x"))

    a = store.stored(spark, "unit", ("k1",), build)
    b = store.stored(spark, "unit", ("k1",), build)
    assert len(calls) == 1
    assert sorted(r.x for r in a.collect()) == sorted(r.x for r in b.collect()) == [0, 1, 2, 3, 4]
    store.stored(spark, "unit", ("k2",), build)
    assert len(calls) == 2


def test_stored_table_is_a_lineage_cut(spark):
    df = store.stored(spark, "unit-cut", ("k",), lambda: spark.range(3).groupBy().count())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "HashAggregate" not in plan


def test_concurrent_callers_build_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    calls = []

    def build():
        calls.append(1)
        return spark.range(3).select(F.col("id").alias("x"))

    with ThreadPoolExecutor(max_workers=4) as pool:
        counts = list(pool.map(lambda _: store.stored(spark, "unit-threads", ("k",), build).count(),
                               range(4)))
    assert counts == [3, 3, 3, 3] and len(calls) == 1


def _files(spark):
    from tessera.session import shared_root

    at, fs = store._path(spark, f"{shared_root(spark)}/tessera/tables")
    return {f.getPath().getName() for f in fs.listStatus(at)} if fs.exists(at) else set()


def test_a_rewritten_folder_gives_fresh_results(spark, tmp_path):
    folder = str(tmp_path / "data")

    def doubled():
        return store.stored(spark, "unit-fresh", (folder,), lambda: spark.read.parquet(f"{folder}/t").selectExpr("x * 2 AS x"))

    spark.createDataFrame([(1,), (2,)], "x int").write.parquet(f"{folder}/t")
    assert sorted(r.x for r in doubled().collect()) == [2, 4]
    first = {f for f in _files(spark) if f.startswith("unit-fresh")}
    spark.createDataFrame([(5,)], "x int").write.mode("overwrite").parquet(f"{folder}/t")
    assert [r.x for r in doubled().collect()] == [10]
    now = {f for f in _files(spark) if f.startswith("unit-fresh")}
    assert len(first) == len(now) == 1 and first != now  # the old table is gone


def test_scopes_remove_what_was_made_in_them(spark):
    def table(name):
        return store.stored(spark, name, ("k",), lambda: spark.range(3).selectExpr("id AS x"))

    table("unit-outside")
    with store.scope(spark):
        table("unit-outside")
        table("unit-outer")
        with store.scope(spark):
            table("unit-outer")
            assert table("unit-inner").count() == 3
        names = {f.rsplit("-", 1)[0] for f in _files(spark)}
        assert "unit-outer" in names and "unit-inner" not in names
    names = {f.rsplit("-", 1)[0] for f in _files(spark)}
    assert "unit-outside" in names and not names & {"unit-outer", "unit-inner"}
    assert table("unit-inner").count() == 3  # built again
    assert store.release(spark, "unit-inner") == 1 and store.release(spark, "unit-inner") == 0
    assert "unit-inner" not in {f.rsplit("-", 1)[0] for f in _files(spark)}


def test_stored_hashes_take_about_half_their_digits(spark):
    import glob
    import os

    from pyspark.sql import functions as F
    from tessera.plans import store

    keys = spark.range(20000, numPartitions=1).select(F.md5(F.col("id").cast("string")).alias("row_key"))
    made = store.stored(spark, "hashes", ("x",), lambda: keys)
    path = made.inputFiles()[0].removeprefix("file://")
    size = sum(os.path.getsize(f) for f in glob.glob(f"{os.path.dirname(path)}/*.parquet"))
    assert made.count() == 20000 and size < 20000 * 36 * 0.65
    store.release(spark, "hashes")
