"""Co-rated movie pairs and item-item adjusted cosine similarity.

Pairs are pruned before the self join: only ratings of own movies (``x``) are joined
with the ratings of the same user (``y``), under ``NOT y.is_own OR x.movie_id < y.movie_id``.
That yields each unordered pair with at least one own movie exactly once, with the own movie
(the smaller id when both are own) in ``own_id`` -- the pair set and roles of the all-pairs
formulation, at a cost of sum(n_u * own_u) instead of sum(n_u^2).

Users without an own rating form no pair; their ratings are left out before anything is
shuffled by user. The user mean is a hash aggregate (combined in every map task) and travels
with the own ratings, the small side. The pair join itself is a plain equi-join of two sides that
it shuffles itself, so adaptive execution splits a user who holds a large part of the rows. No
step deals rows out by movie: an own movie that half of the users rated is spread like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.functions.columns import safe_divide
from cinemetrics.operators.broadcast import broadcast_hint_for, broadcast_limit
from cinemetrics.session import ensure_checkpoint_dir

Hint = Callable[[DataFrame], DataFrame]

SIM_DIGITS = 9


def co_rated_pairs(ratings: DataFrame, my_movies: DataFrame, own_hint: Hint | None = None) -> DataFrame:
    """(user_id, own_id, pred_id, own_rating, pred_rating, user_avg)."""
    hint = own_hint or broadcast_hint_for(my_movies)
    ratings = ratings.select("user_id", "movie_id", "rating")
    mine = hint(my_movies.select(F.col("movie_id").alias("m_id")).distinct())
    # the ratings of own movies are written once: they give the raters, the own side and their size
    ensure_checkpoint_dir(ratings.sparkSession)
    own = ratings.join(mine, F.col("movie_id") == F.col("m_id"), "left_semi").checkpoint(eager=True)
    raters = own.select("user_id").distinct()
    # a mean is one more number for each rater; half the bound leaves room for it
    rater_hint = broadcast_hint_for(raters, broadcast_limit(raters) // 2)
    theirs = ratings.join(rater_hint(raters), "user_id", "left_semi")
    means = theirs.groupBy("user_id").agg(F.avg("rating").alias("user_avg"))
    x = own_side(own, means, rater_hint is F.broadcast)
    y = theirs.join(mine, F.col("movie_id") == F.col("m_id"), "left").select(
        F.col("user_id").alias("y_user"),
        F.col("movie_id").alias("pred_id"),
        F.col("rating").alias("pred_rating"),
        F.col("m_id").isNotNull().alias("pred_is_own"),
    )
    cond = (F.col("x_user") == F.col("y_user")) & (~F.col("pred_is_own") | (F.col("own_id") < F.col("pred_id")))
    return x.join(y, cond).select(
        F.col("x_user").alias("user_id"), "own_id", "pred_id", "own_rating", "pred_rating", "user_avg"
    )


def own_side(own: DataFrame, means: DataFrame, means_are_small: bool) -> DataFrame:
    """(x_user, own_id, own_rating, user_avg): the own ratings with the mean of their user.

    Not clustered by user, so that the pair join shuffles both of its sides itself, which is
    what lets adaptive execution split them: small means are broadcast; beyond that the joined
    rows are rebalanced, which deals them evenly whatever their user or movie.
    """
    named = [F.col("user_id").alias("x_user"), F.col("movie_id").alias("own_id"), F.col("rating").alias("own_rating"), "user_avg"]
    if means_are_small:
        return own.join(F.broadcast(means), "user_id").select(*named)
    return own.join(means, "user_id").select(*named).hint("rebalance")


def adjusted_cosine(pairs: DataFrame, digits: int = SIM_DIGITS) -> DataFrame:
    """(own_id, pred_id, co_raters, similarity).

    similarity = sum(dx*dy) / (sqrt(sum dx^2) * sqrt(sum dy^2)) with d = rating - user_avg,
    rounded to ``digits`` so float noise cannot flip a later ranking; NULL when undefined
    (a co-rater set whose deviations are all 0 on one side).
    """
    dx = F.col("own_rating") - F.col("user_avg")
    dy = F.col("pred_rating") - F.col("user_avg")
    sums = pairs.groupBy("own_id", "pred_id").agg(
        F.count(F.lit(1)).alias("co_raters"),
        F.sum(dx * dy).alias("_num"),
        F.sum(dx * dx).alias("_xx"),
        F.sum(dy * dy).alias("_yy"),
    )
    sim = F.round(safe_divide(F.col("_num"), F.sqrt("_xx") * F.sqrt("_yy")), digits)
    return sums.select("own_id", "pred_id", "co_raters", sim.alias("similarity"))


def item_similarity(ratings: DataFrame, my_movies: DataFrame, own_hint: Hint | None = None) -> DataFrame:
    """Adjusted cosine between every own movie and every movie co-rated with it."""
    return adjusted_cosine(co_rated_pairs(ratings, my_movies, own_hint))
