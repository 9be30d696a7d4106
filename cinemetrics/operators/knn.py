"""Nearest-neighbour rating prediction from own ratings.

For a predicted movie p every own movie m is a neighbour candidate: with its adjusted
cosine when the pair (m, p) has co-raters (NULL when undefined), else with -1.0. The
candidates are ordered undefined first, then similarity descending, then own id; the
first ``L = min(k, #own)`` give ``sum(s * my_rating) / sum(|s|)``, and -1000.0 when an
undefined similarity is among them or the sum of weights is 0.

The -1.0 candidates are not materialised as a product of movies x own list. Let G_p be
the pairs of p that are undefined or above -1 (at most L of them are used). Every other
own movie ranks at -1.0, ordered by id, so the remaining ``t = L - |top G_p|`` slots go
to the t smallest own ids outside G_p. Those lie among the first ``2L - 1`` own ids, a
head of at most 19 rows that is embedded as a literal array; the per-movie fill is a
higher-order ``filter``/``slice``/``aggregate`` on that array.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinemetrics.operators.broadcast import broadcast_hint_for
from cinemetrics.operators.topk import top_k, top_n

Hint = Callable[[DataFrame], DataFrame]

NEIGHBOURS = 10
TOP_PREDICTED = 50
PRED_DIGITS = 6
# the 2k - 1 smallest own ids are embedded in the plan, so k is bounded
MAX_NEIGHBOURS = 1000
# Fixed values of the prediction rule: weight of an own movie without a pair, and the
# value reported when the weighted mean is undefined.
MISSING_SIMILARITY = -1.0
UNDEFINED_PREDICTION = -1000.0


def _own_head(my_movies: DataFrame, size: int):
    """The ``size`` smallest own ids with their ratings (bounded: size <= 2k - 1)."""
    if size >= 2 * MAX_NEIGHBOURS:
        raise ValueError(f"at most {MAX_NEIGHBOURS} neighbours")
    rows = my_movies.select("movie_id", "my_rating").orderBy("movie_id").limit(size).collect()
    return [(int(r["movie_id"]), float(r["my_rating"])) for r in rows]


@dataclass(frozen=True)
class OwnList:
    """What the kNN steps need from the own ratings: the 2k - 1 smallest ids and a join hint."""

    head: list[tuple[int, float]]
    hint: Hint


def own_list(my_movies: DataFrame, k: int = NEIGHBOURS) -> OwnList:
    """One bounded read of the own list (per-partition top 2k - 1, then a merge).

    A head shorter than 2k - 1 rows is the whole list, which proves it small enough to
    broadcast; only a longer list needs a count.
    """
    head = _own_head(my_movies, 2 * k - 1)
    hint = F.broadcast if len(head) < 2 * k - 1 else broadcast_hint_for(my_movies)
    return OwnList(head, hint)


def knn_scores(
    similarity: DataFrame,
    my_movies: DataFrame,
    k: int = NEIGHBOURS,
    own_hint: Hint | None = None,
    own: OwnList | None = None,
) -> DataFrame:
    """(movie_id, prediction) for every movie that has a pair with an own movie."""
    # One bounded read gives both the head and the slot count: fewer than 2k - 1 rows
    # means the head is the whole own list.
    head = own.head if own is not None else _own_head(my_movies, 2 * k - 1)
    own_hint = own.hint if own is not None else own_hint
    if not head:
        return similarity.sparkSession.createDataFrame([], "movie_id long, prediction double")
    slots = min(k, len(head))

    undefined = F.col("similarity").isNull()
    strong = undefined | (F.col("similarity") > MISSING_SIMILARITY)
    ranked = top_k(
        similarity.withColumn("undefined", undefined).withColumn("strong", strong),
        ["pred_id"],
        [F.col("strong").desc(), F.col("undefined").desc(), F.col("similarity").desc(), F.col("own_id").asc()],
        slots,
    )
    mine = (own_hint or broadcast_hint_for(my_movies))(my_movies.select(F.col("movie_id").alias("own_id"), "my_rating"))
    on_strong = lambda c: F.when(F.col("strong"), c)
    per_movie = ranked.join(mine, "own_id").groupBy("pred_id").agg(
        F.max("undefined").alias("has_undefined"),
        F.count(on_strong(F.lit(1))).alias("n_strong"),
        F.coalesce(F.sum(on_strong(F.col("similarity") * F.col("my_rating"))), F.lit(0.0)).alias("num_strong"),
        F.coalesce(F.sum(on_strong(F.abs("similarity"))), F.lit(0.0)).alias("den_strong"),
        F.collect_list(on_strong(F.col("own_id"))).alias("strong_ids"),
    )

    head_type = T.ArrayType(
        T.StructType([T.StructField("movie_id", T.LongType()), T.StructField("my_rating", T.DoubleType())])
    )
    head_col = F.array(
        *[F.struct(F.lit(m).cast("long").alias("movie_id"), F.lit(r).alias("my_rating")) for m, r in head]
    ).cast(head_type)
    free = F.filter(head_col, lambda h: ~F.array_contains(F.col("strong_ids"), h["movie_id"]))
    fills = F.slice(free, 1, F.lit(slots) - F.col("n_strong"))
    fill_sum = F.aggregate(fills, F.lit(0.0), lambda acc, h: acc + h["my_rating"])
    fill_n = F.size(fills)

    num = F.col("num_strong") + F.lit(MISSING_SIMILARITY) * fill_sum
    den = F.col("den_strong") + F.lit(abs(MISSING_SIMILARITY)) * fill_n
    pred = F.when(F.col("has_undefined") | (den == 0), F.lit(UNDEFINED_PREDICTION)).otherwise(
        F.round(num / F.when(den != 0, den), PRED_DIGITS)
    )
    return per_movie.select(F.col("pred_id").alias("movie_id"), pred.alias("prediction"))


def unrated_movies(movies: DataFrame, my_movies: DataFrame, own_hint: Hint | None = None) -> DataFrame:
    """(movie_id, title) of movies without an own rating."""
    hint = own_hint or broadcast_hint_for(my_movies)
    return movies.select("movie_id", "title").join(hint(my_movies.select("movie_id")), "movie_id", "left_anti")


def _scored_with_titles(
    similarity: DataFrame, movies: DataFrame, my_movies: DataFrame, k: int, how: str, own: OwnList | None = None
) -> DataFrame:
    own = own or own_list(my_movies, k)
    title_hint = broadcast_hint_for(movies)  # unrated movies are a filter of movies
    titles = title_hint(unrated_movies(movies, my_movies, own.hint))
    return knn_scores(similarity, my_movies, k, own=own).join(titles, "movie_id", how).select(
        "movie_id", "title", "prediction"
    )


def knn_predictions(
    similarity: DataFrame, movies: DataFrame, my_movies: DataFrame, k: int = NEIGHBOURS, own: OwnList | None = None
) -> DataFrame:
    """(movie_id, title, prediction); own movies keep a NULL title (the title map omits them)."""
    return _scored_with_titles(similarity, movies, my_movies, k, "left", own)


def top_predicted(
    similarity: DataFrame,
    movies: DataFrame,
    my_movies: DataFrame,
    n: int = TOP_PREDICTED,
    k: int = NEIGHBOURS,
    include_own: bool = False,
    own: OwnList | None = None,
) -> DataFrame:
    """(movie_id, title, prediction): the n best predictions, id ascending on ties.

    Own movies are left out unless ``include_own``.
    """
    scored = _scored_with_titles(similarity, movies, my_movies, k, "left" if include_own else "inner", own)
    return top_n(scored, [F.col("prediction").desc(), F.col("movie_id").asc()], n)
