"""The plans on the reference's own file formats (hand-made files)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.plans import documents as D
from tessera.plans import recommendations as R
from tessera.sources.files import PlayFiles, PlotFiles


@pytest.fixture(scope="module")
def play_files(tmp_path_factory):
    d = tmp_path_factory.mktemp("plays")
    rng = np.random.default_rng(5)
    lines = []
    for user in range(1, 13):
        for item in rng.choice(60, size=30, replace=False):
            lines.append(f"{user} {item} {rng.integers(1, 20)}")
    lines.append(lines[0])  # a repeated line stays a second row
    (d / "plays.txt").write_text("\n".join(lines) + "\n")
    (d / "alias.txt").write_text("\t5\n7\t3\n8\t3\n9\t100\n")
    (d / "names.txt").write_text("".join(f"{i}\tname {i}\n" for i in range(0, 60, 2)) + "x\tbad\n4\tnew four\n")
    return PlayFiles(str(d / "plays.txt"), str(d / "alias.txt"), str(d / "names.txt"),
                     sample_fraction=1.0, new_user_items=(1, 7, 9), min_items=20)


@pytest.fixture(scope="module")
def plot_files(tmp_path_factory):
    d = tmp_path_factory.mktemp("plots")
    rng = np.random.default_rng(9)
    words = ["castle", "dragon", "knight", "queen", "ship", "storm", "sailor", "island",
             "robot", "planet", "laser", "station", "the", "and"]
    rows = ["Title,Genre,Year,Plot"]
    for i in range(30):
        topic = words[(i % 3) * 4:(i % 3) * 4 + 4] + words[12:]
        text = " ".join(rng.choice(topic, size=40))
        rows.append(f'"Film {i}","g{i % 3}",2000,"{text[:60]}\n{text[60:]} ""quoted"""')
    rows.append('"No plot","g0",2001,')
    (d / "plots.csv").write_text("\n".join(rows) + "\n")
    (d / "stop.txt").write_text("the\nand\n")
    return PlotFiles(str(d / "plots.csv"), str(d / "stop.txt"))


def test_ratings_from_files(spark, play_files):
    r = R.ratings_canonical(spark, play_files)
    assert r.count() == 12 * 30 + 1
    items = {row.item for row in r.select("item").distinct().collect()}
    assert 7 not in items and 8 not in items and 9 not in items
    new = {row.item for row in R.new_user_rows(spark, play_files).collect()}
    assert new == {1, 3, 100}


def test_sampled_plays(spark, play_files, tmp_path):
    from dataclasses import replace

    sampled = replace(play_files, sample_fraction=0.3)
    n = R.ratings_canonical(spark, sampled).count()
    assert 60 < n < 160


def test_sample_does_not_depend_on_splits_or_folders(spark, play_files, tmp_path):
    from dataclasses import replace
    from shutil import copy

    from tessera.sources import files

    copy(play_files.plays_path, tmp_path / "moved.txt")
    kept = []
    for path, split in ((play_files.plays_path, "128m"), (play_files.plays_path, "1k"), (str(tmp_path / "moved.txt"), "2k")):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            rows = files.plays(spark, replace(play_files, plays_path=path, sample_fraction=0.5)).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        kept.append(sorted(tuple(r) for r in rows))
    assert kept[0] == kept[1] == kept[2] and 100 < len(kept[0]) < 260


def test_occurrences_of_equal_rows(spark):
    from tessera.sources import files

    n = (1 << 16) * 2 + 3
    rows = spark.range(n).select(F.lit("a").alias("value")).union(spark.createDataFrame([("b",), (None,)], "value string"))
    got = {r.value: (r.n, r.least, r.most, r.kinds) for r in files._numbered(rows, "value").groupBy("value").agg(
        F.count(F.lit(1)).alias("n"), F.min("_occurrence").alias("least"), F.max("_occurrence").alias("most"),
        F.count_distinct("_occurrence").alias("kinds")).collect()}
    assert got == {"a": (n, 1, n, n), "b": (1, 1, 1, 1), None: (1, 1, 1, 1)}


def test_new_user_id_must_be_free(spark, play_files):
    with pytest.raises(Exception, match="already in the ratings"):
        R.train_plus_new_user(spark, play_files, R.Params(new_user_id=3)).collect()


def test_recommendations_from_files(spark, play_files):
    auc = R.popularity_auc(spark, play_files).first().auc
    assert 0.0 <= auc <= 1.0
    a = R.als_auc(spark, play_files, rank=4, reg=0.1, alpha=1.0).first().auc
    assert 0.0 <= a <= 1.0
    top = R.new_user_top_n(spark, play_files, rank=4, reg=0.1, alpha=1.0).collect()
    assert len(top) == 25
    names = {r.item: r.name for r in top}
    for item, name in names.items():
        if item == 4:
            assert name == "new four"
        elif item % 2 == 0 and item < 60:
            assert name == f"name {item}"
        else:
            assert name == f"Unknown({item})"


def test_concepts_from_files(spark, plot_files):
    p = D.Params(num_terms=50, k=3)
    docs = D.docs(spark, plot_files)
    assert docs.count() == 30
    assert docs.where(F.col("text").contains('"quoted"')).count() == 30
    vocab = [r.term for r in D.vocabulary(spark, plot_files, p).collect()]
    assert "the" not in vocab and "dragon" in vocab
    assert len(D.decomposition(spark, plot_files, p).s) == 3
    hits = D.keyword_search(spark, plot_files, p).where("query_id = 10").collect()
    assert len(hits) == 10
    report = D.run_report(spark, plot_files, p)
    assert report.where("section = 'concept 1'").count() == 3


def test_document_sample(spark, plot_files):
    half = D.Params(num_terms=50, k=3, sample_fraction=0.5)
    n = D.docs(spark, plot_files, half).count()
    assert 5 < n < 25
    assert D.tfidf(spark, plot_files, half).select("doc_id").distinct().count() <= n


def test_report_written_and_schema_rows(spark, plot_files):
    from tessera.operators.report import schema_table

    p = D.Params(num_terms=50, k=3)
    path = D.write_run_report(spark, plot_files, p)
    written = spark.read.parquet(path)
    assert written.where("section = 'svd' AND key = 'singular_values'").count() == 1
    rows = [tuple(r) for r in schema_table(D.docs(spark, plot_files, p)).orderBy("position").collect()]
    assert rows == [(0, "doc_id", "bigint", True), (1, "title", "string", True),
                    (2, "genre", "string", True), (3, "text", "string", True)]


def test_params_bound_the_broadcast_sides():
    with pytest.raises(ValueError):
        D.Params(num_terms=10_000_000)
    with pytest.raises(ValueError):
        D.Params(num_terms=50, k=60)
    with pytest.raises(ValueError):
        D.Params(sample_fraction=0.0)


def test_play_files_keep_the_reference_threshold_unless_told_otherwise(play_files):
    own = PlayFiles(play_files.plays_path, play_files.alias_path, play_files.names_path)
    assert R.min_items(own) == 100
    assert R.min_items(own, R.Params(min_items=30)) == 30
    assert R.min_items(play_files) == 20
    assert R.min_items("folder") == R.MIN_ITEMS


def test_plot_files_lexicon_and_exceptions_reach_the_term_table(spark, tmp_path):
    (tmp_path / "plots.csv").write_text(
        "Title,Genre,Plot\nA,g,oxen pulled castles\nB,g,the mice saw castles\n")
    (tmp_path / "stop.txt").write_text("the\n")
    (tmp_path / "lexicon.txt").write_text("ox\nmouse\ncastle\n")
    (tmp_path / "irregular.txt").write_text("mice\tmouse\nbroken line\noxen\toxes\n")
    plain = PlotFiles(str(tmp_path / "plots.csv"), str(tmp_path / "stop.txt"))
    given = PlotFiles(plain.csv_path, plain.stopwords_path, str(tmp_path / "lexicon.txt"),
                      str(tmp_path / "irregular.txt"))
    terms = {r.term for r in D.term_freq(spark, given).collect()}
    assert terms == {"oxes", "pulled", "castle", "mouse", "saw"}
    # the corpus's own lexicon knows neither "castle" nor irregular nouns
    assert {r.term for r in D.term_freq(spark, plain).collect()} == {"oxen", "pulled", "castles", "mice", "saw"}
    assert {(r.term, r.lemma) for r in D.lemmas(spark, given).where("term <> lemma").collect()} == {
        ("mice", "mouse"), ("oxen", "oxes"), ("castles", "castle")}
