"""FIXTURES.md §3 expected values at sf0.001."""

from pyspark.sql import functions as F

from data_paths import SF0001
from tessera.operators import textmining as T
from tessera.plans import documents as D
from tessera.plans import recommendations as R
from tessera.sources import tables


def test_recommender_values(spark):
    ratings = R.ratings_canonical(spark, SF0001)
    assert ratings.count() == 6000
    assert tables.alias_pairs(spark, SF0001).count() == 9
    assert ratings.select("user", "item").distinct().count() == 5329
    assert R.qualified_users(ratings).count() == 137
    train, test = R.train_test(spark, SF0001)
    assert (train.count(), test.count()) == (4586, 1213)
    assert (train.select("user").distinct().count(), test.select("user").distinct().count()) == (137, 137)


def test_text_values(spark):
    docs = D.docs(spark, SF0001)
    tok = D.tokens(spark, SF0001)
    assert docs.count() == 200 and tok.select("doc_id").distinct().count() == 200
    assert tok.count() == 63338
    df = T.document_frequency(T.token_counts(tok))
    assert df.count() == 22520
    top = [(r.term, r.df) for r in df.orderBy(F.desc("df"), "term").limit(3).collect()]
    assert top == [("the", 122), ("and", 116), ("that", 102)]
    assert df.where("df >= 2").count() == 7510


def test_values_at_sf001(spark):
    d = "/root/testdata/sf0.01"
    assert tables.alias_pairs(spark, d).count() == 870
    ratings = R.ratings_canonical(spark, d)
    assert ratings.select("user", "item").distinct().count() == 58571
    train, test = R.train_test(spark, d)
    assert (train.count(), test.count()) == (46156, 12244)
    top = [(r.item, r.total) for r in R.popularity_top_n(spark, d).orderBy("rank").limit(2).collect()]
    assert top == [(327, 4057.0), (319, 3758.0)]
    assert round(R.popularity_auc(spark, d).first().auc, 6) == 0.545514
    tok = D.tokens(spark, d)
    assert tok.count() == 312438
    df = T.document_frequency(T.token_counts(tok))
    assert df.count() == 68553 and df.where("df >= 2").count() == 30501
