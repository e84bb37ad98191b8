"""F8: sentence boundaries on planted texts (the SQL comparison is in test_oracle)."""

import random

from tessera.operators import sentences as S


def planted(seed, n):
    """Texts of known sentences with abbreviations, initials, numbers and quotes."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("bcdfglmnprst", k=1) + rng.choices("aeiou", k=1)) * rng.randint(2, 3) + rng.choice("nrst")
             for _ in range(400)]
    names = [w.capitalize() for w in words[:40]]
    starters = ["However", "Then", "But", "There", "They"]
    docs, truth = [], []
    for i in range(n):
        text, ends, at = [], [], 0
        for _ in range(rng.randint(4, 9)):
            s = [rng.choice(starters) if rng.random() < 0.6 else rng.choice(words).capitalize()]
            for _ in range(rng.randint(4, 10)):
                r = rng.random()
                if r < 0.05:
                    s += [rng.choice(["Dr.", "Mr.", "Prof."]), rng.choice(names)]
                elif r < 0.08:
                    s += ["e.g.", rng.choice(words)]
                elif r < 0.10:
                    s += [rng.choice("ABCDEFG") + ".", rng.choice(names)]
                elif r < 0.12:
                    s += [f"{rng.randint(1, 40)}.", rng.choice(words)]
                else:
                    s.append(rng.choice(words))
            s[-1] = rng.choice(words) + rng.choice([".", ".", ".", "?", "!", '."'])
            text += s
            at += len(s)
            ends.append(at - 1)
        docs.append((i, rng.choice(["\n", " "]).join(text)))
        truth.append(ends)
    return docs, truth


def test_planted_boundaries(spark):
    docs, truth = planted(1, 600)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    params = S.parameters(S.pieces(table)).cache()
    found = {(r.kind, r.w) for r in params.collect()}
    assert {("abbr", "dr"), ("abbr", "mr"), ("abbr", "prof"), ("abbr", "e.g")} <= found
    assert ("starter", "however") in found
    got = {i: [] for i, _ in docs}
    for r in S.sentences(table, params).collect():
        got[r.doc_id].append((r.sentence, r.first_pos, r.n_pieces, r.text))
    want_all = got_all = both = 0
    for (i, text), ends in zip(docs, truth, strict=True):
        rows = sorted(got[i])
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert " ".join(r[3] for r in rows).split() == text.split()
        mine = {r[1] + r[2] - 1 for r in rows}
        want_all, got_all, both = want_all + len(ends), got_all + len(mine), both + len(mine & set(ends))
    assert both / got_all > 0.98 and both / want_all > 0.98


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "... !! ?"), (6, "End. Start"), (7, "é.\n\nÀ?  b"), (8, "a " * 20_000 + "b. C")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    # statistics of a corpus: of eight texts they say nothing
    params = S.parameters(S.pieces(spark.createDataFrame(planted(2, 200)[0], "doc_id long, text string"))).cache()
    got = sorted((r.doc_id, r.sentence, r.text) for r in S.sentences(table, params).collect())
    assert [g[0] for g in got if g[0] < 4] == []
    assert [g for g in got if g[0] == 4] == [(4, 0, "one")]
    assert [g[2] for g in got if g[0] == 5] == ["... !!", "?"]
    assert [g[2] for g in got if g[0] == 6] == ["End.", "Start"]
    assert sum(len(g[2].split()) for g in got if g[0] == 8) == 20_002
    assert S.sentences(table.limit(0), params).count() == 0
    assert S.parameters(S.pieces(table.limit(0))).count() == 0


def test_tally_cuts_texts_once(spark):
    """The statistics come from one pass over the texts, and equal those of the pieces."""
    texts = [t for _, t in planted(3, 60)[0]] + ['He said "no!" Then (e.g.) b. End.', "a.\u2028 b!\u2028 c", "x", "", None, "... A. ?"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = S.tally(table)
    of_pieces = S.tally_of_pieces(S.pieces(table)).collect()
    assert sorted(map(str, seen.collect())) == sorted(map(str, of_pieces)) and len(of_pieces) > 100
    assert seen._jdf.queryExecution().executedPlan().toString().count("Generate ") <= 2  # initial and current plan
    kept = spark.createDataFrame(seen.collect(), seen.schema)
    assert sorted(map(str, S.found(kept).collect())) == sorted(map(str, S.parameters(S.pieces(table)).collect()))


def test_parameters_read_a_written_tally(spark, tmp_path):
    from tessera.plans import documents as D, store

    spark.createDataFrame([(i, t, "en", "s") for i, t in planted(4, 80)[0]], "doc_id long, text string, lang string, source string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = D.sentence_parameters(spark, str(tmp_path))
    assert any(k[2] == "sentence_tally" and str(tmp_path) in k for k in store._TABLES)
    assert ("abbr", "dr") in {(r.kind, r.w) for r in got.collect()}
