"""Write PLANS.md: physical plans of the key queries (sf0.01).

Usage: python tests/dump_plans.py > PLANS.md
"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEY = ["ratings_canonical", "per_user_split", "popularity_predictions_labels", "kfold_partitions",
       "doc_tokens", "term_freq", "tfidf_coo", "keyword_search", "concept_top_docs", "hash_sample"]


def main() -> None:
    from __spark_entry__ import queries
    from tessera.session import get_session

    spark = get_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    q = queries()
    print("# Physical plans of the key queries\n")
    print("Generated by `python tests/dump_plans.py` at sf0.01 on `local[8]` (plans before AQE "
          "re-optimisation; stored intermediates appear as parquet scans of the shared folder).\n")
    from tessera.functions.keys import row_key
    from tessera.operators import textmining as T
    from tessera.operators.relational import resolve_aliases
    from tessera.operators.sampling import per_user_split
    from tessera.plans import documents as D
    from tessera.plans import recommendations as R
    from tessera.sources import tables
    from pyspark.sql import functions as F

    d = "/root/testdata/sf0.01"

    def show(title, df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:/[^,\]\s]*/tessera/", "<shared>/tessera/", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        print(f"## {title}\n\n```\n{plan.strip()}\n```\n")

    print("### Builds of the stored intermediates\n")
    plays = tables.play_counts(spark, d)
    show("build: ratings (stored)", resolve_aliases(plays, tables.alias_pairs(spark, d)).select(
        "user", "item", F.col("count").cast("double").alias("rating"),
        row_key("user", "item", "o_orderkey", "l_linenumber", "count").alias("row_key")))
    from tessera.operators.relational import semi_join
    from tessera.plans import store
    ratings = R.ratings_canonical(spark, d)
    users = store.stored(spark, "qualified_users", (d, R.MIN_ITEMS),
                         lambda: R.qualified_users(ratings).select("user"))
    show("build: split (stored; qualified users read from their stored table)",
         per_user_split(semi_join(ratings, users, "user"), folds=R.FOLDS))
    show("build: bag of words (stored)", T.token_counts(D.tokens(spark, d)))
    raw = D.raw_counts(spark, d)
    changes = T.lemma_changes(*D._terms_and_lexicon(raw))
    show("build: term frequencies (stored)",
         T.term_frequencies_from_counts(raw, changes, D.stopwords(spark, d), with_lengths=True))
    print("### Registered queries\n")
    for name in KEY:
        show(name, q[name](spark, d))


if __name__ == "__main__":
    main()
