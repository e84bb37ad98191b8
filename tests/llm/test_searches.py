"""The vector searches against brute force, and against SQL on the given tables."""

import math

import pytest

from tessera.llm import kdtree, neighbours, registry


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, [math.sin(i * k) for k in range(1, 9)], 1) for i in range(300)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 8, 1), (303, [1.0, None] + [0.0] * 6, 1),
             (304, [float("nan")] * 8, 1), (305, [float("inf")] + [0.0] * 7, 1), (None, [1.0] * 8, 1),
             (306, [2.0] * 3, 1), (400, rows[7][1], 1), (401, rows[7][1], 1), (500, rows[20][1], 2)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")


def brute(rows, every, k, value, zero):
    good = {}
    for r in rows:
        e = r.embedding
        if r.vec_id is not None and e and all(x is not None and math.isfinite(x) for x in e) and (zero or any(e)):
            good[r.vec_id] = [value(x) for x in e]
    out = {}
    for q, a in good.items():
        if q % every == 0:
            scored = []
            for c, b in good.items():
                if c != q and len(a) == len(b):
                    total = 0
                    for x, y in zip(a, b, strict=True):
                        total += x * y
                    scored.append((-total, c))
            out[q] = [(c, -s) for s, c in sorted(scored)[:k]]
    return {q: v for q, v in out.items() if v}


def listed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_nearest(vectors):
    got = listed(neighbours.nearest(vectors, "vec_id % 20 = 0", 20, block_rows=64, query_rows=8))
    assert got == brute(vectors.collect(), 20, 20, float, False)
    assert neighbours.nearest(vectors.limit(0), "vec_id % 20 = 0", 20).count() == 0


def test_nearest_of_very_large_and_small_components(vectors, spark):
    odd = [(600, [1.0, 0, 0]), (601, [1e200, 1.0, 0]), (602, [0.03, 0, 0]), (603, [1e-200, 1e-201, 0]), (620, [1e-200, 3e-201, 1e-202]),
           (640, [1e200, -1e200, 1.0]), (641, [1e200, 1e200, 5.0]), (642, [-1e308, 1e308, 0]), (643, [5e-324, 0, 0]), (660, [1e155, 1e154, 2e154]),
           (644, [3e153, 1e154, -1e154])]
    table = vectors.unionByName(spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in odd], vectors.schema))
    rows = table.collect()
    want = brute(rows, 20, 20, float, False)
    from fractions import Fraction

    def exact(a, b):
        plain = 0.0
        for x, y in zip(a, b, strict=True):
            plain += x * y
        if math.isfinite(plain):
            return plain
        total = sum(Fraction(x) * Fraction(y) for x, y in zip(a, b, strict=True))
        try:
            return float(total)
        except OverflowError:
            return math.inf if total > 0 else -math.inf

    data = {i: [float(x) for x in v] for i, v in odd}
    for query in (600, 620, 640, 660):
        scored = sorted((-exact(data[query], v), c) for c, v in [*data.items(), (306, [2.0] * 3)] if c != query)
        want[query] = [(c, -s) for s, c in scored[:20]]
    assert want[600][0] == (601, 1e200) or want[600][0][1] >= 1e200
    got = listed(neighbours.nearest(table, "vec_id % 20 = 0", 20, block_rows=3, query_rows=2))
    assert got == want
    assert listed(neighbours.nearest(table, "vec_id % 20 = 0", 3)) == {q: v[:3] for q, v in want.items()}


def test_top_k(vectors):
    got = listed(kdtree.top_k(vectors, "vec_id % 50 = 0", 5, shard_rows=64, query_rows=4, leaf=8))
    assert got == brute(vectors.collect(), 50, 5, lambda x: math.floor(256 * x), True)
    assert kdtree.top_k(vectors.limit(0), "vec_id % 50 = 0", 5).count() == 0


def test_top_k_of_large_components(vectors, spark):
    large = [(600, [600_000.0] * 8), (650, [-524_288.5] + [3.0] * 7), (700, [2.0 ** 26 + 0.25, -1.0] + [0.0] * 6),
             (701, [2.0 ** 18 - 0.25, 1.0] + [0.5] * 6), (702, [-(2.0 ** 27)] + [0.0] * 7), (704, [-(2.0 ** 26)] * 8),
             (750, [0.0] * 6 + [1e-3, 0.0]), (800, [1.0, 2.0, 0.0]), (703, [5.0, 1.0, -1e300]), (705, [1.0, 1.0, 1.7e308])]
    table = vectors.unionByName(spark.createDataFrame([(i, x, 1) for i, x in large], vectors.schema))
    want = brute(table.collect(), 50, 5, lambda x: math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x), True)
    for leaf in (8, 400):
        got = listed(kdtree.top_k(table, "vec_id % 50 = 0", 5, shard_rows=64 if leaf == 8 else 4096, query_rows=4, leaf=leaf))
        assert got == want
    # of rows with a query's own id none takes a place
    same = [(0, [2.0 ** 24, 1.0])] * 40 + [(i, [2.0 ** 18 + i, 1.0]) for i in range(1, 20)]
    hits = kdtree.top_k(spark.createDataFrame(same, "vec_id long, embedding array<double>"), "vec_id = 0", 5, leaf=100)
    assert sorted((r.rank, r.vec_id) for r in hits.collect()) == [(k, 20 - k) for k in range(1, 6) for _ in range(40)]
    assert {600, 650, 700, 701, 702, 703, 704, 705} <= {v for hits in got.values() for v, _ in hits}


def test_top_k_fails_only_where_a_result_does_not_fit(spark):
    def run(rows):
        return listed(kdtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id = 0", 2))

    rows = [(0, [1.0, 2.0 ** 40]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, -(2.0 ** 30)])]
    assert run(rows) == {0: [(2, 2 * 65536), (1, 65536)]}
    with pytest.raises(Exception, match="fit a long"):
        run(rows[:2] + rows[3:])
    with pytest.raises(Exception, match="fit a long"):
        run([*rows, (4, [0.0, 2.0 ** 30])])


@pytest.mark.parametrize("name", ["op5_neighbours", "op10_topk"])
def test_equals_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = sorted(con.execute(registry.oracle_sql()[name]).fetchall())
    assert sorted(tuple(r) for r in registry.queries()[name](spark, sf).collect()) == want
