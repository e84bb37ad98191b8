"""The prefix trie against brute force, and against SQL on the given table."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from tessera.llm import convtrie, registry

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs int"


def brute(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        own = (len(m) - 1) * len(re.findall(rb"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += own
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def many_partitions(spark):
    """Small tables stay in several partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hard_rows():
    rng = random.Random(6)
    texts = ["yes", "no", "a b c", "", None, " \t x\x0by ", "é ü", "word " * 300]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts))
            for c in range(-45, 90) if c % 7 for t in range(rng.choice([1, 1, 2, 3, 5, 12]))]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 140) for t in range(4)]  # one group of copies
    rows += [(c, t, "user", f"turn {t // 2}") for c in (200, 201, 203) for t in range(600)]  # very long ones
    rows += [(203, 700, "user", "another end")]
    rows += [(300, None, "b", "x"), (300, None, "a", "y"), (300, None, "a", "x"), (300, 0, "a", "x"), (300, 0, "a", "x"),
             (301, 5, None, None), (302, 5, None, None), (302, 5, None, None), (None, 1, "user", "nobody's")]
    rng.shuffle(rows)
    return rows


def test_nodes_equal_brute_force(spark, many_partitions):
    rows = hard_rows()
    table = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    want = brute(rows)
    assert rows_of(convtrie.trie(table)) == want
    assert max(r[1] for r in want) >= 600 > convtrie.BAND ** 3


def test_a_conversation_over_all_partitions(spark, many_partitions):
    rows = [(40, t, "user", f"t{t % 3}") for t in range(900)] + [(41, t, "user", f"t{t % 3}") for t in range(10)]
    table = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    turns = convtrie._sorted_turns(table, "conv_id", "turn", "role", "text")
    assert turns.where("conv_id = 40").select("part").distinct().count() > 4
    assert rows_of(convtrie.trie(table)) == brute(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert convtrie.trie(empty).count() == 0
    # turnless once rebuilt: its only turn is replaced by those of a conversation that isn't there
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(lone, 0, "user", "hello")]
    table = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    got = rows_of(convtrie.trie(table))
    assert got == brute(rows) and got[0][:4] == (lone, 0, None, 1)


def test_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    rel = con.execute(registry.oracle_sql()["op12_conversation_trie"])
    want = sorted(rel.fetchall(), key=str)
    got = registry.queries()["op12_conversation_trie"](spark, sf)
    assert got.columns == [c[0] for c in rel.description]
    assert rows_of(got) == want and len(want) > 100
