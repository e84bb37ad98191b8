"""Play counts -> canonical ratings -> qualified users -> split -> popularity
baseline and implicit ALS, as DataFrame plans over a data folder (the
stand-in tables) or the reference's own files (``files.PlayFiles``).

Parameters default to the reference's, except ``MIN_ITEMS`` (see below).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import row_key
from ..operators import recommend as rec
from ..operators.metrics import confusion, exact_auc, mean_over_folds
from ..operators.ranking import top_n_per_group
from ..operators.relational import (distinct_pairs, distinct_per_key, lookup_with_default,
                                    resolve_aliases, semi_join, union_rows)
from ..operators.sampling import global_kfold as global_fold
from ..operators.sampling import kfold_partitions, per_user_split
from ..operators.report import append_rows
from ..session import shared_path
from ..sources import files, literals, tables
from . import store

# Users kept have at least so many distinct items.  ``PlayFiles`` carries the
# reference's 100; after alias resolution that leaves no user below sf0.1 on
# the stand-in data, so data folders use 20.
MIN_ITEMS = 20
TRAIN_FRACTION = 0.8
TOP_N = 50
FOLDS = 5
RANKS = (25, 50)
REGS = (1.0, 0.1, 0.01)
ALPHAS = (1.0,)
ITERATIONS = 5
NEW_USER_ID = 9999999
NEW_USER_COUNT = 1000
NEW_USER_ITEMS = tuple(range(8))
NEW_USER_TOP = 25
# List lengths compared by the popularity cross-validation, and how many are reported.
CV_LENGTHS = (5, 10, 20, 25, 40, 50)
CV_BEST = 5
# Training rows of the grid's concurrent fits together.
CONCURRENT_ROWS = 4_000_000


# A parquet data folder (stand-ins) or the reference's own files.
Source = str | files.PlayFiles


# The popular list is one value in every task: bounded here.
MAX_TOP_N = 10_000


@dataclass(frozen=True)
class Params:
    # ``None``: the source's own threshold (see ``min_items``).
    min_items: int | None = None
    train_fraction: float = TRAIN_FRACTION
    top_n: int = TOP_N
    folds: int = FOLDS
    # ALS user and item blocks: part of the model, never taken from the cluster.
    als_blocks: int = rec.ALS_BLOCKS
    # Must not be in the ratings; the job fails if it is.
    new_user_id: int = NEW_USER_ID

    def __post_init__(self) -> None:
        if not 1 <= self.top_n <= MAX_TOP_N:
            raise ValueError(f"top_n must be in 1..{MAX_TOP_N}, got {self.top_n}")
        if self.als_blocks < 1:
            raise ValueError(f"als_blocks must be at least 1, got {self.als_blocks}")
        if not 0.0 < self.train_fraction < 1.0:
            raise ValueError(f"train_fraction must be in (0, 1), got {self.train_fraction}")
        if self.folds < 2 or (self.min_items is not None and self.min_items < 1):
            raise ValueError("folds must be at least 2 and min_items at least 1")


def min_items(data_dir: Source, p: Params = Params()) -> int:
    """P7's threshold: the parameter, else that of the files, else ``MIN_ITEMS``."""
    if p.min_items is not None:
        return p.min_items
    return data_dir.min_items if isinstance(data_dir, files.PlayFiles) else MIN_ITEMS


def ratings_canonical(spark: SparkSession, data_dir: Source) -> DataFrame:
    """``(user, item, rating, row_key)``: play counts with aliased items
    replaced, written once per application (every later step reads it)."""
    def build() -> DataFrame:
        if isinstance(data_dir, files.PlayFiles):
            plays = files.plays(spark, data_dir)
            identity = ["user", "item", "row_id", "count"]
        else:
            plays = tables.play_counts(spark, data_dir)
            identity = ["user", "item", "o_orderkey", "l_linenumber", "count"]
        resolved = resolve_aliases(plays, aliases(spark, data_dir))
        return resolved.select(
            "user", "item",
            F.col("count").cast("double").alias("rating"),
            row_key(*identity).alias("row_key"),
        )
    return store.stored(spark, "ratings", (data_dir,), build)


def aliases(spark: SparkSession, data_dir: Source) -> DataFrame:
    """``(bad_id, good_id)``: the alias file, or the stand-in from ``part``."""
    if isinstance(data_dir, files.PlayFiles):
        return files.aliases(spark, data_dir)
    return tables.alias_pairs(spark, data_dir)


def entity_names(spark: SparkSession, data_dir: Source) -> DataFrame:
    """``(id, name)``: the name file, or the stand-in from ``part``."""
    if isinstance(data_dir, files.PlayFiles):
        return files.names(spark, data_dir)
    return tables.entity_names(spark, data_dir)


def distinct_items_per_user(ratings: DataFrame) -> DataFrame:
    """A2: ``(user, n_items)``."""
    return distinct_per_key(ratings, "user", "item", "n_items")


def qualified_users(ratings: DataFrame, min_items: int = MIN_ITEMS) -> DataFrame:
    """A2 + P7: users with at least ``min_items`` distinct items ``(user, n_items)``."""
    return distinct_items_per_user(ratings).where(F.col("n_items") >= min_items)


def qualified_ratings(ratings: DataFrame, min_items: int = MIN_ITEMS) -> DataFrame:
    """Ratings of qualified users only."""
    return semi_join(ratings, qualified_users(ratings, min_items).select("user"), "user")


def stored_qualified_users(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """The qualified users ``(user)``, written once per application."""
    least = min_items(data_dir, p)
    return store.stored(spark, "qualified_users", (data_dir, least), lambda: qualified_users(
        ratings_canonical(spark, data_dir), least).select("user"))


def split_table(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """W1 + W2: qualified ratings tagged ``split``, training rows with their
    ``fold``, written once per application (train and test sides and the folds
    of every later step read the same table; users are ordered once).

    The qualified-user set (one row per user) is stored first, so the split
    pass reads it instead of re-aggregating all ratings.
    """
    def build() -> DataFrame:
        users = stored_qualified_users(spark, data_dir, p)
        return per_user_split(semi_join(ratings_canonical(spark, data_dir), users, "user"), p.train_fraction, folds=p.folds)
    return store.stored(spark, "split", (data_dir, p), build)


def split_ratings(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """Qualified ratings tagged ``split``."""
    return split_table(spark, data_dir, p).drop("fold")


def train_test(spark: SparkSession, data_dir: Source, p: Params = Params()
               ) -> tuple[DataFrame, DataFrame]:
    s = split_ratings(spark, data_dir, p)
    return (s.where(F.col("split") == "train").drop("split"),
            s.where(F.col("split") == "test").drop("split"))


def popularity_top_n(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """A3 + T2 + W6: ``(rank, item, total, score)`` over the training rows."""
    train, _ = train_test(spark, data_dir, p)
    return rec.top_items(rec.item_popularity(train), p.top_n)


def popularity_predictions_labels(spark: SparkSession, data_dir: Source,
                                  p: Params = Params()) -> DataFrame:
    """J4 + J3: every test user x the popular list, labelled by the user's test items."""
    train, test = train_test(spark, data_dir, p)
    top = rec.top_items(rec.item_popularity(train), p.top_n)
    scored = rec.score_list_for_users(test.select("user").distinct(), top)
    return rec.label_by_membership(scored, test)


def popularity_auc(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """AUC of the popularity baseline on the test rows."""
    return exact_auc(popularity_predictions_labels(spark, data_dir, p))


def popularity_confusion(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """A10 on the popularity lists."""
    return confusion(popularity_predictions_labels(spark, data_dir, p))


def kfold_assignment(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """The training rows ``(user, item, rating, row_key, fold)``, a scan
    of the stored split (its train/validation expansion and every fit of the
    grid read it)."""
    return split_table(spark, data_dir, p).where(F.col("split") == "train").drop("split")


def global_kfold(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """W2 + W4: the training rows with a consecutive ``index`` in the order of
    their row key, and ``fold = index mod k``."""
    train, _ = train_test(spark, data_dir, p)
    return global_fold(train, p.folds)


def ground_truth_bitmaps(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """The test rows' items per user as bitmaps ``(user, bucket, n_items, bits)``."""
    _, test = train_test(spark, data_dir, p)
    return rec.item_bitmaps(test)


def popularity_labels_by_bitmap(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """J3 + J4: :func:`popularity_predictions_labels` with labels from bit tests."""
    train, test = train_test(spark, data_dir, p)
    top = rec.top_items(rec.item_popularity(train), p.top_n)
    scored = rec.score_list_for_users(test.select("user").distinct(), top)
    return rec.label_by_bitmap(scored, rec.item_bitmaps(test))


def kfold_table(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """``(user, item, rating, row_key, fold, fold_id, role)``."""
    return kfold_partitions(kfold_assignment(spark, data_dir, p), p.folds)


def popularity_cv_summary(spark: SparkSession, data_dir: Source, p: Params = Params(),
                          lengths: tuple[int, ...] = CV_LENGTHS, best: int = CV_BEST) -> DataFrame:
    """W3 + J2 + A12 + T3: cross-validated popularity lists.

    For every fold, the items most played in the other folds are listed for
    the fold's users and labelled by their rows of the fold; the AUC of the
    first ``n`` of a list is taken for each ``n`` in ``lengths``.  Returns
    ``(top_n, mean_auc, folds)``, the ``best`` lengths by mean AUC.

    Items are summed once for all folds; labels are combined map-side to one
    row per fold and rank, from which all lengths are read.
    """
    assigned = kfold_assignment(spark, data_dir, p)
    others = F.array(*[F.sum(F.when(F.col("fold") != i, F.col("rating"))) for i in range(p.folds)])
    totals = assigned.groupBy("item").agg(others.alias("_totals")).select(
        "item", F.posexplode("_totals").alias("fold", "total")).where(F.col("total").isNotNull())
    ranked = top_n_per_group(totals, ["fold"], [F.desc("total"), F.col("item")], max(lengths))
    # one row per fold, each with at most max(lengths) items
    lists = ranked.groupBy("fold").agg(F.collect_list(F.struct("item", "rank")).alias("_list"))
    scored = assigned.select("user", "fold").distinct().join(F.broadcast(lists), "fold").select(
        "user", "fold", F.inline("_list"))
    truth = assigned.select("user", "fold", "item").distinct().withColumn("_hit", F.lit(1.0))
    hit = F.coalesce(F.col("_hit"), F.lit(0.0))
    counts = scored.join(truth, ["user", "fold", "item"], "left").groupBy("fold", "rank").agg(
        F.sum(hit).alias("_pos"), F.sum(1.0 - hit).alias("_neg"))
    # a list's score falls with the rank: worse entries are those that follow
    after = Window.partitionBy("top_n", "fold").orderBy(F.desc("rank")).rowsBetween(
        Window.unboundedPreceding, -1)
    cut = counts.withColumn("top_n", F.explode(F.array(*[F.lit(n) for n in lengths]))).where(
        F.col("rank") <= F.col("top_n")).withColumn(
        "_below", F.coalesce(F.sum("_neg").over(after), F.lit(0.0)))
    area = F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0))
    classes = F.sum("_pos") * F.sum("_neg")
    evals = cut.groupBy("top_n", "fold").agg(F.when(classes > 0, area / classes).alias("auc"))
    return mean_over_folds(evals, ["top_n"]).limit(best)


def ground_truth_pairs(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """A7 in relational form: the distinct ``(user, item)`` pairs of the test rows."""
    _, test = train_test(spark, data_dir, p)
    return distinct_pairs(test, ["user", "item"])


def split_user_parity(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """One row: users only in train, only in test, and whether the sets are equal."""
    s = split_ratings(spark, data_dir, p)
    per_user = s.groupBy("user").agg(
        F.max(F.when(F.col("split") == "train", 1).otherwise(0)).alias("in_train"),
        F.max(F.when(F.col("split") == "test", 1).otherwise(0)).alias("in_test"))
    return per_user.agg(
        F.sum(F.col("in_train")).cast("bigint").alias("train_users"),
        F.sum(F.col("in_test")).cast("bigint").alias("test_users"),
        F.sum(F.when(F.col("in_train") != F.col("in_test"), 1).otherwise(0))
        .cast("bigint").alias("users_in_one_side"),
    ).withColumn("same_users", F.col("users_in_one_side") == 0)


def new_user_rows(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """S9 + J1: the new user's literal ratings, items mapped through the alias list."""
    items = (data_dir.new_user_items if isinstance(data_dir, files.PlayFiles)
             else NEW_USER_ITEMS)
    rows = literals.rating_rows(spark, p.new_user_id, list(items), NEW_USER_COUNT)
    resolved = resolve_aliases(rows, aliases(spark, data_dir))
    return resolved.select(
        "user", "item",
        F.col("count").cast("double").alias("rating"),
        row_key("user", "item", F.lit(""), F.lit(""), "count").alias("row_key"),
    )


def train_plus_new_user(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """Training rows with the new user's rows appended; the job fails if
    the new user's id is already there."""
    train, _ = train_test(spark, data_dir, p)
    taken = F.raise_error(F.lit(f"new user id {p.new_user_id} is already in the ratings"))
    checked = train.withColumn("user", F.when(F.col("user") == p.new_user_id, taken.cast("bigint"))
                               .otherwise(F.col("user")))
    return union_rows(checked, new_user_rows(spark, data_dir, p))


# ---- ALS (Spark's solver; results are checked by row counts and properties) ----

def best_params(evals: DataFrame) -> tuple[int, float, float]:
    """Parameters of the best mean AUC (ties: smaller rank, reg, alpha)."""
    best = mean_over_folds(evals, ["rank", "reg", "alpha"]).first()
    return int(best["rank"]), float(best["reg"]), float(best["alpha"])


def evaluation_log(spark: SparkSession) -> str:
    """K9: where this application's grid evaluations accumulate."""
    return shared_path(spark, "cv-results", unique=False)


def run_key(spark: SparkSession, data_dir: Source, p: Params = Params()) -> str:
    """What a fold's evaluation depends on besides its own parameters."""
    text = f"{data_dir}|{store.fingerprint(spark, data_dir)}|{min_items(data_dir, p)}|{p}|{ITERATIONS}"
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def logged_evaluations(spark: SparkSession, log: str, run: str) -> dict[tuple, float | None]:
    """``(rank, reg, alpha, fold)`` to AUC of the evaluations a log holds for a run."""
    if not store.exists(spark, log):
        return {}
    rows = spark.read.parquet(log)
    if "run" not in rows.columns:
        return {}
    return {(r["rank"], r["reg"], r["alpha"], r["fold"]): r["auc"] for r in rows.where(F.col("run") == run).collect()}


def grid_search_cv(spark: SparkSession, data_dir: Source, p: Params = Params(),
                   ranks=RANKS, regs=REGS, alphas=ALPHAS, parallelism: int | None = None,
                   log_path: str | None = None) -> DataFrame:
    """R4 + K9: ``(rank, reg, alpha, fold, auc)`` for the whole grid, run once
    per application and parameters.  Each evaluation is appended with its
    source, run key and time to the log table at ``log_path`` (default:
    :func:`evaluation_log`) as it finishes; the rows are stored.

    A grid that was cut off goes on where it stopped, in this application or
    another: evaluations of the same source (its files and their times), split
    and solver parameters that the log holds already are taken from it.

    ``parallelism`` fits run as concurrent jobs: small fits leave cores idle
    between their many short stages (sf0.01: 56 s with 4, 35 s with 8); when
    one fit fills the cluster, concurrency gains nothing and costs disk for
    every fit's shuffles.  By default it follows the training rows, 8 to 3."""
    def build() -> DataFrame:
        log = log_path or evaluation_log(spark)
        run = run_key(spark, data_dir, p)
        done = logged_evaluations(spark, log, run)
        assigned = kfold_assignment(spark, data_dir, p)
        # more than 8 fits would only wait for the driver; fewer than 3 leave cores idle
        fits = parallelism or max(3, min(8, CONCURRENT_ROWS // max(1, assigned.count())))
        return rec.grid_search(assigned, ranks, regs, alphas,
                               p.folds, p.top_n, ITERATIONS, fits, p.als_blocks,
                               on_result=lambda row: append_rows(
                                   row.withColumn("source", F.lit(str(data_dir)))
                                   .withColumn("run", F.lit(run))
                                   .withColumn("logged_at", F.current_timestamp()), log), done=done)
    return store.stored(spark, "grid",
                        (data_dir, p, tuple(ranks), tuple(regs), tuple(alphas)), build)


def grid_eval_summary(evals: DataFrame) -> DataFrame:
    """A12 + T3: mean AUC per parameter set, best first."""
    return mean_over_folds(evals, ["rank", "reg", "alpha"])


def chosen_params(spark: SparkSession, data_dir: Source, p: Params = Params()
                  ) -> tuple[int, float, float]:
    """The grid's best parameters."""
    return best_params(grid_search_cv(spark, data_dir, p))


_MODELS: dict[tuple, object] = {}


def als_model(spark: SparkSession, data_dir: Source, rank: int | None = None,
              reg: float | None = None, alpha: float | None = None, p: Params = Params()):
    """R1/R5 on all training rows, with the grid's best parameters unless
    given; fitted once per application and parameters."""
    if rank is None or reg is None or alpha is None:
        rank, reg, alpha = chosen_params(spark, data_dir, p)
    def make():
        train, _ = train_test(spark, data_dir, p)
        return rec.train_als(train, rank, reg, alpha, ITERATIONS, blocks=p.als_blocks)
    return store.once(_MODELS, ("als", spark.sparkContext.applicationId, data_dir, rank, reg,
                                alpha, p, store.fingerprint(spark, data_dir)), make)


def als_top_n(spark: SparkSession, data_dir: Source, p: Params = Params(), **kw) -> DataFrame:
    """R1 + R2: top-``n`` lists ``(user, rank, item, score)`` of the test users."""
    _, test = train_test(spark, data_dir, p)
    return rec.recommend_top_n(als_model(spark, data_dir, p=p, **kw), test, p.top_n)


def als_predictions_labels(spark: SparkSession, data_dir: Source, p: Params = Params(),
                           **kw) -> DataFrame:
    _, test = train_test(spark, data_dir, p)
    return rec.als_predictions_labels(als_model(spark, data_dir, p=p, **kw), test, p.top_n)


def als_auc(spark: SparkSession, data_dir: Source, p: Params = Params(), **kw) -> DataFrame:
    """R5 + R6: AUC on the test rows of a model trained on all training rows."""
    return exact_auc(als_predictions_labels(spark, data_dir, p, **kw))


def als_confusion(spark: SparkSession, data_dir: Source, p: Params = Params(), **kw) -> DataFrame:
    """R6 + A10: confusion counts of the same lists."""
    return confusion(als_predictions_labels(spark, data_dir, p, **kw))


def new_user_top_n(spark: SparkSession, data_dir: Source, p: Params = Params(),
                   rank: int | None = None, reg: float | None = None,
                   alpha: float | None = None) -> DataFrame:
    """Retrain (best grid parameters unless given) with the new user's
    rows; the top 25 items, named (``Unknown(id)`` when unnamed)."""
    if rank is None or reg is None or alpha is None:
        rank, reg, alpha = chosen_params(spark, data_dir, p)
    augmented = train_plus_new_user(spark, data_dir, p)
    model = rec.train_als(augmented, rank, reg, alpha, ITERATIONS, blocks=p.als_blocks)
    me = spark.range(1).select(F.lit(p.new_user_id).cast("bigint").alias("user"))
    top = rec.recommend_top_n(model, me, NEW_USER_TOP)
    names = entity_names(spark, data_dir)
    default = F.concat(F.lit("Unknown("), F.col("item").cast("string"), F.lit(")"))
    return lookup_with_default(top, names, "item", "id", "name", "name", default)


def new_user_fold_in(spark: SparkSession, data_dir: Source, p: Params = Params(),
                     rank: int | None = None, reg: float | None = None,
                     alpha: float | None = None) -> DataFrame:
    """R8 + T5 without retraining: the new user's factors from one half-step
    against the model of all training rows; the top 25 items, named
    (:func:`new_user_top_n` retrains)."""
    if rank is None or reg is None or alpha is None:
        rank, reg, alpha = chosen_params(spark, data_dir, p)
    model = als_model(spark, data_dir, rank, reg, alpha, p)
    factors = rec.fold_in(model, new_user_rows(spark, data_dir, p), reg, alpha)
    top = rec.top_n_of_factors(model, factors, NEW_USER_TOP)
    names = entity_names(spark, data_dir)
    default = F.concat(F.lit("Unknown("), F.col("item").cast("string"), F.lit(")"))
    return lookup_with_default(top, names, "item", "id", "name", "name", default)


def name_lookup_default(spark: SparkSession, data_dir: Source, p: Params = Params()) -> DataFrame:
    """The popular items with their names, ``Unknown(id)`` when unnamed."""
    top = popularity_top_n(spark, data_dir, p).select("rank", "item")
    names = entity_names(spark, data_dir)
    default = F.concat(F.lit("Unknown("), F.col("item").cast("string"), F.lit(")"))
    return lookup_with_default(top, names, "item", "id", "name", "name", default)
