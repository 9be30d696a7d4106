"""Genre explode and the (genre, rating) join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.operators.broadcast import broadcast_if_bounded


def movie_genres(movies: DataFrame) -> DataFrame:
    """(movie_id, title, genre): one row per genre of a movie; movies without genres vanish."""
    return movies.select("movie_id", "title", F.explode("genres").alias("genre"))


def genre_ratings(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """(genre, user_id, movie_id, rating): every rating once per genre of its movie.

    The genre side is a dimension (movies x genres); it is broadcast after a size check
    so the ratings are not shuffled for this join.
    """
    mg = broadcast_if_bounded(movie_genres(movies).select("movie_id", "genre"))
    return ratings.select("user_id", "movie_id", "rating").join(mg, "movie_id").select(
        "genre", "user_id", "movie_id", "rating"
    )
