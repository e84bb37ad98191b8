"""Recommendation operators: popularity baseline, labels, implicit ALS (A3, T2, W6,
J2-J4, W10, R1-R8).

Scores and labels are DataFrames ``(user, item, score, label)``; AUC and
confusion counts come from :mod:`.metrics`.  ALS models are Spark's own
(``pyspark.ml.recommendation.ALSModel``), solved by :mod:`.blockals`.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import collect_garbage, remove_path, shared_path
from ..shipping import ship
from . import blockals, innersearch
from .metrics import RUN, confusion, exact_auc, packed_auc, runs_auc, score_runs
from .ranking import top_n_per_group
from .relational import sum_per_key

ALS_SEED = 42
# ALS user and item blocks (Spark's default).  The model depends on their
# number, so it is a parameter and never follows the cluster.
ALS_BLOCKS = 10
# Factors of a block in the product of all users and items: every block of
# items hands on a user's best n, so their rows are n for each block.
PRODUCT_BLOCK = 1 << 15
# Users of a block of labelled lists, and scores computed at once from it.
USER_BLOCK = 1 << 12
SCORES = 1 << 20


def item_popularity(train: DataFrame, item_col: str = "item",
                    rating_col: str = "rating") -> DataFrame:
    """A3: ``(item, total)``, the summed rating per item (partial sums map-side)."""
    return sum_per_key(train, item_col, rating_col, "total")


def top_items(popularity: DataFrame, n: int, item_col: str = "item") -> DataFrame:
    """T2 + W6: the ``n`` largest totals ``(rank, item, total, score)``,
    ties by item; ``score = n - (rank - 1)``.

    ``orderBy().limit(n)`` is a two-phase top-k (each task keeps ``n``
    rows); the numbering window then runs over those ``n`` rows only.
    """
    order = [F.desc("total"), F.col(item_col)]
    top = popularity.orderBy(*order).limit(n)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.select(
        "rank", item_col, "total",
        (F.lit(n) - (F.col("rank") - 1)).cast("double").alias("score"))


def score_list_for_users(users: DataFrame, top: DataFrame, user_col: str = "user",
                         item_col: str = "item") -> DataFrame:
    """Every user gets the same scored list ``(user, item, score)``.

    The list is one array value, from a scalar subquery, that each user row
    expands with a generator: no join, no shuffle of users, no job before
    the action.
    """
    entry = F.struct(F.col(item_col).cast("bigint").alias(item_col),
                     F.col("score").cast("double").alias("score"))
    return users.select(user_col, F.inline(top.agg(F.collect_list(entry)).scalar()))


def label_by_membership(scored: DataFrame, truth: DataFrame, user_col: str = "user",
                        item_col: str = "item", label_col: str = "label") -> DataFrame:
    """``label = 1.0`` when ``(user, item)`` is among the truth rows, else 0.0.

    Truth is reduced to distinct pairs (map-side combined); the join is on
    ``(user, item)``, so a user with many rows is spread over many keys.
    """
    pairs = truth.select(user_col, item_col).distinct().withColumn("_hit", F.lit(1.0))
    joined = scored.join(pairs, [user_col, item_col], "left")
    return joined.withColumn(label_col, F.coalesce(F.col("_hit"), F.lit(0.0))).drop("_hit")


def item_bitmaps(truth: DataFrame, user_col: str = "user", item_col: str = "item") -> DataFrame:
    """``(user, bucket, n_items, bits)``: a user's items as bitmaps, one for
    each range of 32,768 item ids, so that a user with any number of rows is a
    few short rows; bits are set by task before the shuffle."""
    item = F.col(item_col).cast("bigint")
    sets = truth.where(item.isNotNull()).groupBy(user_col, F.bitmap_bucket_number(item).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(item)).alias("bits"))
    return sets.select(user_col, "bucket", F.bitmap_count("bits").alias("n_items"), "bits")


def label_by_bitmap(scored: DataFrame, bitmaps: DataFrame, user_col: str = "user", item_col: str = "item",
                    label_col: str = "label") -> DataFrame:
    """J3 by a bit test: ``label = 1.0`` when the item's bit is set for the user
    (the same labels as :func:`label_by_membership`)."""
    item = F.col(item_col).cast("bigint")
    sets = bitmaps.select(F.col(user_col).alias("_user"), F.col("bucket").alias("_bucket"), "bits")
    joined = scored.withColumn("_of", F.bitmap_bucket_number(item)).join(
        sets, (F.col(user_col) == F.col("_user")) & (F.col("_of") == F.col("_bucket")), "left")
    at = F.bitmap_bit_position(item)
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1
    return joined.withColumn(label_col, F.coalesce(hit, F.lit(False)).cast("double")).drop("_of", "_user", "_bucket", "bits")


def als_rows(ratings: DataFrame, user_col: str = "user", item_col: str = "item", rating_col: str = "rating",
             *more: str) -> DataFrame:
    """``(user int, item int, rating float)`` and the columns ``more``."""
    return ratings.select(F.col(user_col).cast("int").alias("user"),
                          F.col(item_col).cast("int").alias("item"),
                          F.col(rating_col).cast("float").alias("rating"), *more)


def als_input(ratings: DataFrame, user_col: str = "user", item_col: str = "item",
              rating_col: str = "rating", blocks: int = ALS_BLOCKS) -> DataFrame:
    """``(user int, item int, rating float)`` hash-arranged by user and item
    into ``blocks`` partitions (a hot user is spread over all) and sorted
    inside, so the same rows give Spark's solver the same model whatever the
    upstream partitioning."""
    return (
        als_rows(ratings, user_col, item_col, rating_col)
        .repartition(blocks, "user", "item")
        .sortWithinPartitions("user", "item", "rating")
    )


def train_als(ratings: DataFrame | blockals.Packed, rank: int, reg: float, alpha: float,
              max_iter: int = 5, seed: int = ALS_SEED, blocks: int = ALS_BLOCKS) -> ALSModel:
    """Implicit-feedback ALS on ``(user, item, rating)``; the model is
    written and read back (see :func:`written_model`).

    The half-steps are those of Spark's ``ALS``, over packed blocks of ratings
    (see :mod:`.blockals`), which a grid packs once for all its fits.
    """
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, implicitPrefs=True,
              userCol="user", itemCol="item", ratingCol="rating", seed=seed,
              coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks)
    given = isinstance(ratings, blockals.Packed)
    packed = ratings if given else blockals.pack(als_rows(ratings), blocks)
    model, model.solved, path = blockals.fit(packed, als)
    written = written_model(model)
    remove_path(packed.users.sparkSession, path)
    if not given:
        packed.release()
    return written


def written_model(model: ALSModel) -> ALSModel:
    """The model saved to the shared folder and loaded, its item factors in
    partitions of :data:`PRODUCT_BLOCK` rows; ``model.solved``, if there, are the
    users' and items' factors that take the place of its own.

    Spark's product of users and items takes every partition of items as a block
    of its own: packed, a user's best items are shuffled once and not once for
    each block of the solver.  The loaded model holds on to none of the
    solver's cached blocks and shuffles.
    """
    spark = model.itemFactors.sparkSession
    users, items = getattr(model, "solved", (None, model.itemFactors))
    path = shared_path(spark, "models/als")
    model.save(path)
    packed = -(-items.count() // PRODUCT_BLOCK) or 1
    if users is not None:
        users.write.mode("overwrite").parquet(f"{path}/userFactors")
    items.repartitionByRange(packed, "id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{path}/itemFactors")
    loaded = ALSModel.load(path).setBlockSize(PRODUCT_BLOCK)
    loaded.written_to = path
    loaded.item_blocks = packed
    return loaded


def release_model(model: ALSModel) -> None:
    """Remove a written model's files."""
    if getattr(model, "written_to", None):
        remove_path(model.itemFactors.sparkSession, model.written_to)


def _user_blocks(model: ALSModel, held_out: DataFrame) -> DataFrame:
    """``(ids, factors, at, items)``: the factors of the held-out users in blocks of
    about :data:`USER_BLOCK`, and their distinct held-out items, ``at`` being
    the user's place in the block."""
    count = -(-model.userFactors.count() // USER_BLOCK) or 1
    truth = held_out.select(F.col("user").cast("int").alias("user"), F.col("item").cast("long").alias("item")).where(
        F.col("user").isNotNull()).distinct()
    users = model.userFactors.select(F.col("id").alias("user"), "features")

    def dealt(rows: DataFrame):
        return rows.withColumn("_blk", F.pmod(F.xxhash64("user"), F.lit(count))).groupBy("_blk")

    def pack(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.asarray(left["user"], np.int64)
        order = np.argsort(known)
        asked = np.asarray(right["user"], np.int64)
        ids = np.intersect1d(known, asked)
        flat = np.asarray(left["features"].combine_chunks().flatten(), np.float32)
        factors = flat.reshape(len(known), -1)[order[np.searchsorted(known, ids, sorter=order)]] if len(known) else flat
        use = np.isin(asked, ids) & np.asarray(right["item"].is_valid())
        at = np.searchsorted(ids, asked[use])
        items = np.asarray(right["item"].fill_null(0), np.int64)[use]
        return pa.table({k: pa.array([v.tobytes()], pa.binary()) for k, v in
                         {"ids": ids, "factors": factors, "at": at.astype(np.int64), "items": items}.items()})

    return dealt(users).cogroup(dealt(truth)).applyInArrow(pack, "ids binary, factors binary, at binary, items binary")


def _item_blocks(model: ALSModel) -> DataFrame:
    """``(item_ids, item_factors)``: the item factors in blocks of at most
    :data:`PRODUCT_BLOCK`, one if the model was written as one."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, factors, held = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(x)], pa.binary()) for x in (ids, factors)],
                                              names=["item_ids", "item_factors"])

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, PRODUCT_BLOCK - held)
                ids.append(np.asarray(part.column(0), np.int64).tobytes())
                factors.append(np.asarray(part.column(1).flatten(), np.float32).tobytes())
                start, held = start + part.num_rows, held + part.num_rows
                if held == PRODUCT_BLOCK:
                    yield block()
                    ids, factors, held = [], [], 0
        if held:
            yield block()

    rows = model.itemFactors.select("id", "features")
    if getattr(model, "item_blocks", None) == 1:
        rows = rows.coalesce(1)
    return rows.mapInArrow(pack, "item_ids binary, item_factors binary")


def _best_items(factors: np.ndarray, item_ids: np.ndarray, item_factors: np.ndarray, n: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, rank, column, score)`` of each row's ``n`` best items, ties by item.
    Products are summed in double precision and rounded to the factors' own."""
    score = (factors.astype(float) @ item_factors.T.astype(float)).astype(np.float32)
    key = np.where(np.isnan(score), np.inf, score) if np.isnan(score).any() else score
    if n < len(item_ids):
        kth = np.partition(key, len(item_ids) - n, axis=1)[:, len(item_ids) - n]
        i, j = np.divmod(np.flatnonzero(key >= kth[:, None]), len(item_ids))
    else:
        i, j = np.divmod(np.arange(key.size), len(item_ids))
    if len(i) == n * len(factors) and (item_ids[1:] > item_ids[:-1]).all():  # no ties with the last
        order = np.argsort(-key[i, j].reshape(-1, n), axis=1, kind="stable") + n * np.arange(len(factors))[:, None]
        j = j[order.ravel()]
        return i, np.tile(np.arange(1, n + 1), len(factors)), j, score[i, j]
    order = np.lexsort((item_ids[j], -key[i, j], i))
    i, j = i[order], j[order]
    rank = np.arange(len(i)) - np.searchsorted(i, np.arange(len(factors)))[i] + 1
    use = rank <= n
    i, j = i[use], j[use]
    return i, rank[use], j, score[i, j]


_LISTED = "user long, item long, rank int, score double, label double"


def _label_blocks(n: int, pack: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None):
    """For tasks on pairs of blocks of users and of items: the labelled lists of
    each pair, or what ``pack`` makes of their batches ``(score, label)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, at, items, item_ids = (np.frombuffer(r[c], np.int64) for c in ("ids", "at", "items", "item_ids"))
                if not len(ids):
                    continue
                x, y = (np.frombuffer(r[c], np.float32).reshape(m, -1)
                        for c, m in (("factors", len(ids)), ("item_factors", len(item_ids))))
                by_item = np.argsort(item_ids)
                item_ids, y = item_ids[by_item], y[by_item]
                near = np.searchsorted(item_ids, items)
                here = np.flatnonzero(near < len(item_ids))
                here = here[item_ids[near[here]] == items[here]]
                at, column = at[here], near[here]  # held-out pairs of this block
                step = max(1, SCORES // len(item_ids))
                for start in range(0, len(ids), step):
                    i, rank, j, score = _best_items(x[start:start + step], item_ids, y, n)
                    own = (at >= start) & (at < start + step)
                    hit = np.zeros((min(step, len(ids) - start), len(item_ids)), bool)
                    hit[at[own] - start, column[own]] = True
                    columns = {"user": ids[i + start], "item": item_ids[j], "rank": rank.astype(np.int32),
                               "score": score.astype(float), "label": hit[i, j].astype(float)}
                    wanted = columns if pack is None else ("score", "label")
                    yield pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in wanted], names=list(wanted))

    return run if pack is None else lambda batches: pack(run(batches))


def labelled_lists(model: ALSModel, held_out: DataFrame, n: int) -> DataFrame:
    """W10 + J2 + J3: ``(user, item, rank, score, label)``, the ``n`` best items of
    every user of ``held_out (user, item)``, ``label = 1.0`` for a held-out one.

    A block of users carries its held-out items to every block of items, where
    all pairs are scored and a user's best are labelled: what is shuffled is
    one row for each user and each held-out pair, not each listed one.  Only
    where items fill several blocks are the blocks' lists shuffled and merged.
    Scores are summed in double precision, ties rank by item.  Users unknown to
    the model are absent.
    """
    ship(held_out.sparkSession)
    lists = _user_blocks(model, held_out).crossJoin(_item_blocks(model)).mapInArrow(_label_blocks(n), _LISTED)
    if getattr(model, "item_blocks", None) == 1:
        return lists
    return top_n_per_group(lists.drop("rank"), ["user"], [F.desc("score"), F.col("item")], n).select(
        "user", "item", "rank", "score", "label")


def lists_auc(model: ALSModel, held_out: DataFrame, n: int) -> float | None:
    """The AUC of :func:`labelled_lists`; where items are one block, a task
    packs its lists' scores to runs as they are made, and no list is handed on."""
    if getattr(model, "item_blocks", None) != 1:
        return packed_auc(labelled_lists(model, held_out, n))
    ship(held_out.sparkSession)
    pairs = _user_blocks(model, held_out).crossJoin(_item_blocks(model))
    return runs_auc(pairs.mapInArrow(_label_blocks(n, score_runs), RUN))


def recommend_top_n(model: ALSModel, users: DataFrame, n: int,
                    user_col: str = "user", method: str = "product") -> DataFrame:
    """``(user, rank, item, score)``, the ``n`` best items per user.

    ``method``: ``"product"`` is Spark's product of all users' and items'
    factors, in blocks; ``"blocks"`` searches blocks of item factors with
    bounds and scores only those that can hold one of a user's best (see
    :mod:`.innersearch`; ties by item).  Users unknown to the model are absent
    (no factors to score).
    """
    subset = users.select(F.col(user_col).cast("int").alias("user")).distinct()
    if method == "blocks":
        queries = model.userFactors.join(subset, F.col("id") == F.col("user"), "left_semi")
        found = innersearch.search(innersearch.blocks(model.itemFactors, "id", "features"), queries, n, "id", "features")
        return found.hits.select(F.col("query_id").alias(user_col), "rank", F.col("id").alias("item"), "score")
    recs = model.recommendForUserSubset(subset, n)
    return recs.select(
        F.col("user").cast("bigint").alias(user_col),
        F.posexplode("recommendations").alias("_pos", "_rec"),
    ).select(
        user_col,
        (F.col("_pos") + 1).alias("rank"),
        F.col("_rec.item").cast("bigint").alias("item"),
        F.col("_rec.rating").cast("double").alias("score"),
    )


def item_gram(model: ALSModel) -> DataFrame:
    """``(i, j, g)``: the Gram matrix of the item factors, a sum for each pair
    of components (``rank**2`` rows), added up by task before the shuffle."""
    f = F.transform("features", lambda x: x.cast("double"))
    rows = model.itemFactors.select(f.alias("f")).select(F.posexplode("f").alias("i", "x"), "f")
    return rows.select("i", F.posexplode("f").alias("j", "y"), "x").groupBy("i", "j").agg(
        F.sum(F.col("x") * F.col("y")).alias("g"))


def fold_in(model: ALSModel, rows: DataFrame, reg: float, alpha: float, user_col: str = "user",
            item_col: str = "item", rating_col: str = "rating") -> DataFrame:
    """R8 without retraining: ``(user, features)`` of users the model hasn't seen.

    One half-step of implicit ALS against the item factors: with confidence
    ``c = alpha |r|`` of a rating, ``(Y^T Y + sum c y y^T + reg n I) x = sum (1
    + c) y`` over the user's items with a factor, sums of positive ratings
    only on the right, and ``n`` counting those.  A user's own sums are
    ``rank**2 + rank`` numbers, added up by task, whatever the number of
    ratings; the systems are solved where they lie.  Users without any known
    item are absent.
    """
    spark = rows.sparkSession
    f = F.transform("features", lambda x: x.cast("double"))
    y = model.itemFactors.select(F.col("id").alias("_item"), f.alias("y"))
    r = F.col(rating_col).cast("double")
    known = rows.join(y, rows[item_col] == y["_item"]).select(
        F.col(user_col).alias("user"), (F.lit(alpha) * F.abs(r)).alias("c"), (r > 0).alias("liked"), "y")
    terms = known.select("user", "c", "liked", "y", F.posexplode("y").alias("i", "x"))
    right = terms.groupBy("user", "i").agg(
        F.sum(F.when(F.col("liked"), (1 + F.col("c")) * F.col("x")).otherwise(0.0)).alias("b"),
        F.sum(F.col("liked").cast("long")).alias("n"))
    left = terms.select("user", "i", "c", "x", F.posexplode("y").alias("j", "z")).groupBy("user", "i", "j").agg(
        F.sum(F.col("c") * F.col("x") * F.col("z")).alias("a"))
    system = left.join(item_gram(model), ["i", "j"]).groupBy("user").agg(
        F.sort_array(F.collect_list(F.struct("i", "j", (F.col("a") + F.col("g")).alias("v")))).alias("m"))  # rank**2 numbers
    side = right.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("i", "b"))).alias("b"), F.max("n").alias("n"))
    system = system.join(side, "user").select("user", F.col("m.v").alias("m"), F.col("b.b").alias("b"), "n")

    def solve(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for m, b, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                a = np.array(m).reshape(len(b), len(b)) + reg * n * np.eye(len(b))
                out.append(np.linalg.solve(a, np.array(b)).tolist() if n else [0.0] * len(b))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64()))], names=["user", "features"])

    ship(spark)
    return system.mapInArrow(solve, f"user {known.schema['user'].dataType.simpleString()}, features array<double>")


def top_n_of_factors(model: ALSModel, factors: DataFrame, n: int) -> DataFrame:
    """``(user, rank, item, score)``: the best items for ``(user, features)`` rows."""
    table = innersearch.blocks(model.itemFactors, "id", "features")
    hits = innersearch.search(table, factors, n, "user", "features").hits
    return hits.select(F.col("query_id").alias("user"), "rank", F.col("id").alias("item"), "score")


def als_predictions_labels(model: ALSModel, held_out: DataFrame, n: int = 50) -> DataFrame:
    """J2 + J3: top-``n`` lists of the held-out users, labelled by their held-out items
    (:func:`labelled_lists` does both in one pass, with scores of its own rounding)."""
    recs = recommend_top_n(model, held_out.select("user"), n)
    return label_by_membership(recs, held_out)


def als_auc(model: ALSModel, held_out: DataFrame, n: int = 50) -> DataFrame:
    """One row ``(auc)`` of the top-``n`` lists against held-out items."""
    return exact_auc(als_predictions_labels(model, held_out, n))


def als_confusion(model: ALSModel, held_out: DataFrame, n: int = 50) -> DataFrame:
    """A10 on the ALS lists (predicted positive: ``score > 0``)."""
    return confusion(als_predictions_labels(model, held_out, n))


def grid_search(
    assigned: DataFrame,
    ranks: tuple[int, ...] = (25, 50),
    regs: tuple[float, ...] = (1.0, 0.1, 0.01),
    alphas: tuple[float, ...] = (1.0,),
    k: int = 5,
    n: int = 50,
    max_iter: int = 5,
    parallelism: int = 1,
    blocks: int = ALS_BLOCKS,
    on_result: Callable[[DataFrame], None] | None = None,
    done: dict[tuple, float | None] | None = None,
) -> DataFrame:
    """Mean AUC over ``k`` folds for every parameter set.

    ``assigned`` carries ``fold`` (see ``kfold_assign``); fold ``i`` is
    validated against a model trained on the other folds.  The driver only
    loops over parameter sets and folds, holding one AUC per fit;
    ``parallelism`` fits run as concurrent Spark jobs.  ``on_result`` gets
    each evaluation row as a one-row DataFrame (e.g. to append it to a log
    table).  ``done`` holds evaluations from before, which aren't fitted
    again.  A fit's files are removed when it has been evaluated.  Returns
    ``(rank, reg, alpha, fold, auc)``.
    """
    spark = assigned.sparkSession
    assigned = assigned.select("user", "item", "rating", "fold").persist()
    packed = blockals.pack(als_rows(assigned.where(F.col("fold").isNotNull()), "user", "item", "rating", "fold"), blocks, F.col("fold"))
    # Appends to one output folder must not overlap (the file committer's
    # temporary folder is shared), so results are handed over one at a time.
    report_lock = threading.Lock()

    def evaluate(task):
        rank, reg, alpha, fold = task
        model = train_als(packed.without(fold), rank, reg, alpha, max_iter, blocks=blocks)
        auc = lists_auc(model, assigned.where(F.col("fold") == fold), n)
        release_model(model)
        del model
        collect_garbage(spark)
        row = spark.createDataFrame([(rank, float(reg), float(alpha), fold, auc)], EVAL_SCHEMA)
        if on_result is not None:
            with report_lock:
                on_result(row)
        return (rank, float(reg), float(alpha), fold, auc)

    before = {key: auc for key, auc in (done or {}).items()
              if key in {(a, float(b), float(c), f) for a, b, c, f in product(ranks, regs, alphas, range(k))}}
    tasks = [t for t in product(ranks, regs, alphas, range(k)) if (t[0], float(t[1]), float(t[2]), t[3]) not in before]
    try:
        if parallelism > 1:
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                results = list(pool.map(evaluate, tasks))
        else:
            results = [evaluate(t) for t in tasks]
    finally:
        packed.release()
        assigned.unpersist()
    results += [(*key, auc) for key, auc in before.items()]
    return spark.createDataFrame(sorted(results, key=lambda r: r[:4]), EVAL_SCHEMA)


EVAL_SCHEMA = "rank int, reg double, alpha double, fold int, auc double"
