"""Counts and averages per movie, user, genre and (genre, user).

All are hash aggregates with a partial (map-side) step, so a hot key is combined in
every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.functions.columns import rating_map


def movie_rating_count(ratings: DataFrame) -> DataFrame:
    """(movie_id, rating_count)."""
    return ratings.groupBy("movie_id").agg(F.count(F.lit(1)).alias("rating_count"))


def user_rating_count(ratings: DataFrame) -> DataFrame:
    """(user_id, rating_count)."""
    return ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("rating_count"))


def user_avg_rating(ratings: DataFrame) -> DataFrame:
    """(user_id, avg_rating) over all ratings of the user."""
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("avg_rating"))


def user_profile(ratings: DataFrame) -> DataFrame:
    """(user_id, total_ratings, dataset_avg_rating) in one aggregate."""
    return ratings.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_ratings"), F.avg("rating").alias("dataset_avg_rating")
    )


def genre_avg_rating(genre_ratings: DataFrame) -> DataFrame:
    """(genre, avg_rating, rating_count)."""
    return genre_ratings.groupBy("genre").agg(
        F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("rating_count")
    )


def genre_user_stats(genre_ratings: DataFrame) -> DataFrame:
    """(genre, user_id, rating_count, avg_rating) per (genre, user)."""
    return genre_ratings.groupBy("genre", "user_id").agg(
        F.count(F.lit(1)).alias("rating_count"), F.avg("rating").alias("avg_rating")
    )


def dataset_counts(ratings: DataFrame) -> DataFrame:
    """One row: (n_ratings, n_users, n_movies)."""
    return ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("movie_id").alias("n_movies"),
    )


def rating_map_projection(ratings: DataFrame) -> DataFrame:
    """(movie_id, user_rating map<user_id, rating>): one single-entry map per rating."""
    return ratings.select("movie_id", rating_map("user_id", "rating").alias("user_rating"))
