"""Vector codes against a full search, and against SQL on the given table."""

import hashlib
import math
import random

import numpy as np
import pytest

from tessera.llm import registry, vectorcodes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 0.5) for i, v, lab in rows], SCHEMA)


def brute(rows, entries=16, rounds=6):
    """Every entry tried, in Python's integers."""
    good = [(i, [math.floor(4096 * x) if abs(x) < 1e300 else 4096 * int(x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = len(good[0][1]) // 8
    start = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * size:(p + 1) * size] for _, v, _ in start] for p in range(8)]

    def nearest(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(8):
            parts = [v[p * size:(p + 1) * size] for _, v, _ in good]
            code = [nearest(x, books[p])[0] for x in parts]
            for k in range(len(books[p])):
                own = [x for x, c in zip(parts, code, strict=True) if c == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = []
    for i, v, lab in good:
        found = [nearest(v[p * size:(p + 1) * size], books[p]) for p in range(8)]
        out.append((i, lab, "".join(f"{c:02x}" for c, _ in found), sum(d for _, d in found)))
    sums: dict = {}
    for _, lab, _, e in out:
        sums[lab] = sums.get(lab, 0) + e
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, c, e, sums[lab]) for i, lab, c, e in out), key=str), hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, **more):
    coded, books = vectorcodes.compress(frame(spark, rows), **more)
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in vectorcodes.with_label_error(coded).collect()), key=str)
    want, sha = brute(rows)
    assert got == want and vectorcodes.digest(books) == sha


def test_codes_equal_a_full_search(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(300, None, 1), (301, [None] + [0.0] * 15, 1), (302, [math.nan] * 16, 1), (303, [math.inf] + [0.0] * 15, 1),
             (None, [0.1] * 16, 2), (5, [0.3] * 16, 1), (7, rows[7][1], 1), (7, rows[7][1], 1), (400, [0.0] * 16, 3),
             (-1, [-0.0001] * 16, 1)]
    for cell in (1, 64, 512, 1 << 20):
        check(spark, rows, cell=cell)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(i % 4)] * 8, 1) for i in range(40)] + [(50, [1.5 / 4096] * 8, 1), (51, [-0.5 / 4096] * 8, 1)]
    check(spark, rows)
    check(spark, [(1, [1.0] * 8, 1), (1, [0.0] * 8, None), (1, [1.0] * 8, None)])


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-4e5, 4e5) for _ in range(8)], 1) for i in range(60)]
    check(spark, rows)
    # beyond 64 bits, but the entries are the rows themselves
    check(spark, [(i, [2.0 ** 100 * (i + 1)] * 8, None) for i in range(2)])
    with pytest.raises(Exception, match="fit a long"):
        coded, _ = vectorcodes.compress(frame(spark, [(i, [1e6 * (i % 40)] * 8, 1) for i in range(60)]))
        coded.collect()


def test_odd_tables(spark):
    assert vectorcodes.compress(frame(spark, [(1, None, 1)]))[0].count() == 0
    coded, books = vectorcodes.compress(frame(spark, [(1, [], 1), (2, [], None)]))
    assert sorted((r.vec_id, r.code, r.error) for r in coded.collect()) == [(1, "00" * 8, 0), (2, "00" * 8, 0)]
    with pytest.raises(ValueError, match="one length"):
        vectorcodes.compress(frame(spark, [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)]))
    with pytest.raises(ValueError, match="one length"):
        vectorcodes.compress(frame(spark, [(1, [1.0] * 9, 1)]))


def test_cells_leave_out_entries_without_changing_the_nearest():
    rng = np.random.default_rng(1)
    entries = rng.integers(-4000, 4000, (16, 4))
    x = rng.integers(-4000, 4000, (5000, 4))
    nearest = vectorcodes.Nearest(entries.tolist(), 512, np.int64)
    code, d = nearest(x)
    full = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(2)
    assert (code == full.argmin(1)).all() and (d == full.min(1)).all()
    assert nearest.evaluated < 0.5 * full.size
    again = nearest.evaluated
    nearest(x)
    assert nearest.evaluated == 2 * again


def test_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    rel = con.execute(registry.oracle_sql()["op11_vector_codes"])
    want = sorted(rel.fetchall())
    got = registry.queries()["op11_vector_codes"](spark, sf)
    assert got.columns == [c[0] for c in rel.description]
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 0
