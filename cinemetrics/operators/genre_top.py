"""Top movies and top users per genre, and the per-user profile of the top users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.functions.columns import sorted_entries_by_value
from cinemetrics.operators.broadcast import broadcast_hint_for, broadcast_if_bounded
from cinemetrics.operators.genres import genre_ratings, movie_genres
from cinemetrics.operators.ranking import pages
from cinemetrics.operators.stats import genre_user_stats, movie_rating_count, user_profile
from cinemetrics.operators.topk import top_k
from cinemetrics.session import ensure_checkpoint_dir

TOP_K = 5
PAGE_SIZE = 1000


def genre_movie_counts(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """(genre, movie_id, title, rating_count): counts are aggregated before the genre join."""
    counts = movie_rating_count(ratings)
    mg = broadcast_if_bounded(movie_genres(movies))
    return counts.join(mg, "movie_id").select("genre", "movie_id", "title", "rating_count")


def genre_movie_pages(ratings: DataFrame, movies: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(genre, page, movies array<long>): each genre's movies by rating count (ties by id), in pages
    of ``page_size``. No task or row holds more than a page of a genre's list."""
    counts = genre_movie_counts(ratings, movies).select("genre", "movie_id", "rating_count")
    order = [F.col("rating_count").desc(), F.col("movie_id").asc()]
    return pages(counts, "genre", order, "movie_id", page_size).withColumnRenamed("items", "movies")


def genre_top_movies(ratings: DataFrame, movies: DataFrame, k: int = TOP_K) -> DataFrame:
    """(genre, rank, movie_id, title, rating_count): most rated movies per genre, id breaks ties."""
    ranked = top_k(
        genre_movie_counts(ratings, movies),
        ["genre"],
        [F.col("rating_count").desc(), F.col("movie_id").asc()],
        k,
    )
    return ranked.select("genre", "rank", "movie_id", "title", "rating_count")


def genre_top_users(ratings: DataFrame, movies: DataFrame, k: int = TOP_K) -> DataFrame:
    """(genre, rank, user_id, rating_count, avg_rating): users with most ratings in the genre.

    ``avg_rating`` is the user's average inside the genre.
    """
    stats = genre_user_stats(genre_ratings(ratings, movies))
    ranked = top_k(stats, ["genre"], [F.col("rating_count").desc(), F.col("user_id").asc()], k)
    return ranked.select("genre", "rank", "user_id", "rating_count", "avg_rating")


def genre_top_users_profile(ratings: DataFrame, movies: DataFrame, k: int = TOP_K) -> DataFrame:
    """(genre, rank, user_id, genre_ratings, genre_avg_rating, total_ratings, dataset_avg_rating).

    The top-k table (at most k rows per genre) is computed once and checkpointed into the
    shared checkpoint folder, so the genre aggregation is not run a second time for the
    user filter. Dataset-wide statistics are then aggregated only over the ratings of the
    top users: the ratings are semi-joined with the user list (broadcast after its size is
    checked), and Catalyst pushes that filter below the rating derivation. The checkpoint and
    the size checks run as jobs while the plan is built.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    top = genre_top_users(ratings, movies, k).checkpoint(eager=True)
    # measuring the checkpointed table is cheap; its bound covers both broadcast sides cut from it
    hint = broadcast_hint_for(top)
    users = hint(top.select("user_id").distinct())
    profile = user_profile(ratings.join(users, "user_id", "left_semi"))
    return hint(top).join(profile, "user_id").select(
        "genre",
        "rank",
        "user_id",
        F.col("rating_count").alias("genre_ratings"),
        F.col("avg_rating").alias("genre_avg_rating"),
        "total_ratings",
        "dataset_avg_rating",
    )


def genre_top_users_map(ratings: DataFrame, movies: DataFrame, k: int = TOP_K) -> DataFrame:
    """(genre, top_users map<user_id, rating_count>) in value-descending order (k entries at most)."""
    top = genre_top_users(ratings, movies, k)
    grouped = top.groupBy("genre").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("user_id").alias("key"), F.col("rating_count").alias("value")))).alias(
            "top_users"
        )
    )
    return grouped.select("genre", F.map_from_entries(sorted_entries_by_value("top_users")).alias("top_users"))
