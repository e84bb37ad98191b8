"""The pipeline's stages, each judged on its own input."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def test_stages(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > sizes[0] / 2
    assert docs.where("start = 0").count() == sizes[-1]


def test_one_row_of_each_group_is_left(spark, docs):
    import random

    from tessera.llm import stages

    rng = random.Random(9)
    a, b, c, d, e = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(80)) for _ in range(5))
    near = b.replace(b.split()[40], "changed")
    rows = [(1, a), (1, a), (2, near), (None, b), (None, c), (None, c), (None, "c"), (3, "c"), (4, d), (4, e), (5, None), (6, "")]
    table = spark.createDataFrame([(i, t, "aa", None, len(t) if t else None, 0.5) for i, t in rows], docs.schema)
    kept = stages.near_copy_stage(spark, table, "")
    assert kept.columns == table.columns
    want = sorted([(1, a), (2, near), (None, c), (3, "c"), (4, d), (4, e), (5, None), (6, "")], key=str)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want
    cut = stages.repeat_stage(spark, kept, "")
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=str) == want
    pieces = stages.packing_stage(spark, cut, "").collect()
    assert sum(r.start == 0 for r in pieces) == len(want)
    assert sum(r.doc_tokens > 80 for r in pieces if r.start == 0) == 5


def test_rows_keep_a_column_named_like_the_key(spark, docs):
    from pyspark.sql import functions as F

    from tessera.llm import stages

    table = docs.withColumn("__row", F.concat(F.lit("x"), F.col("n_chars").cast("string")))
    kept = stages.near_copy_stage(spark, table, "")
    assert kept.columns == table.columns
    assert all(r["__row"] == (None if r.text is None or r.text == "" else f"x{len(r.text)}") for r in kept.collect())


def test_stages_of_an_empty_table(spark, empty):
    from tessera.llm import stages

    sf = "/root/testdata/sf0.001"
    for stage in (stages.quality_stage, stages.language_stage, stages.near_copy_stage, stages.repeat_stage):
        out = stage(spark, empty, sf)
        assert out.columns == empty.columns and out.count() == 0
    assert stages.packing_stage(spark, empty, sf).count() == 0


def test_unlearned_languages_go_and_short_clean_texts_stay(spark):
    from tessera.llm import stages

    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = ["Bu sabah kahvaltıda ekmek ve peynir yedik, sonra pazara gittik.",
           "Aamulla söimme leipää ja juustoa ja menimme sitten torille kävellen.", "zxq wvk jjq qqz xkcd vvw", "1234 !!", None]
    rows = spark.createDataFrame([(-1 - i, t, None, None, None) for i, t in enumerate(odd)], given.schema)
    short = given.where("length(text) BETWEEN 1 AND 200 AND text RLIKE '[a-z]{3}'")
    kept = {r.doc_id for r in stages.language_stage(spark, given.unionByName(rows), "").collect()}
    assert not kept & {-1, -2, -3, -4, -5}
    assert {r.doc_id for r in short.collect()} <= kept and len(kept) >= given.count() - 5


def test_stages_equal_brute_force(spark, docs):
    """Each stage's decisions on a small table against the operator's own row-by-row definition."""
    import collections
    import re

    from tessera.llm import language, quality, stages
    from tessera.llm.samples import remainder

    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")

    def rows_of(df):
        return collections.Counter(tuple(r) for r in df.collect())

    forest = quality.fit(given, labels)
    chosen = quality.score(given, forest, given.columns, out="q").where("q.predicted = 1").select(*given.columns)
    assert rows_of(stages.quality_stage(spark, given, sf)) == rows_of(chosen)
    profiles = language.fit(given, remainder(given["doc_id"], 4) != 2)
    want = collections.Counter()
    for r in given.collect():
        name, score = profiles.predict([r.text])
        want[tuple(r)] += name[0] != "und" and score[0] >= stages.LEAST_LANGUAGE_SCORE
    assert rows_of(stages.language_stage(spark, given, sf)) == +want
    # repeated passages: every byte covered by a string of 200 bytes that starts elsewhere, too
    raws = [(r, (r.text or "").encode()) for r in docs.collect()]
    count = collections.Counter(b[i:i + 200] for _, b in raws for i in range(len(b) - 199))
    cut = collections.Counter()
    for r, b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\x01" * 200
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
        cut[(r.doc_id, left if any(gone) else r.text)] += 1
    got = stages.repeat_stage(spark, docs, sf)
    assert got.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text) for r in got.collect()) == cut
    pieces = stages.packing_stage(spark, docs, sf).collect()
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
    assert sum(r.start == 0 for r in pieces) == docs.count()
    del re
