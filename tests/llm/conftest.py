import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in any column, empty and very long texts, copies, near copies and
    repeated rows, and an extra column whose name a result has, too."""
    import random

    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    base, passage = prose(400), prose(60)
    words = base.split()
    near = " ".join(words[:200] + ["changed"] + words[201:])
    rows = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n\t "), (7, "two words"), (8, "two words"),
            (9, prose(90) + " " + passage), (10, passage + "\n" + prose(50)), (11, prose(30_000)), (12, "é" * 700),
            (13, "a" * 3000), (14, "x é" * 200), (None, prose(20)), (15, prose(25)), (15, prose(25)),
            (16, "Licensed under the Apache License, Version 2.0.\n" + prose(40)), (17, "1234 !!"), (18, prose(300))]
    # a chain: each links with the next, the ends don't link
    chain = prose(200).split()
    rows += [(20 + k, " ".join(chain[12 * k:] + [f"new{j}" for j in range(12 * k)])) for k in range(4)]
    rows.append((18, rows[19][1]))
    return spark.createDataFrame(
        [(i, t, "aa" if i and i % 3 else None, None, len(t) if t else None, 0.5) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
