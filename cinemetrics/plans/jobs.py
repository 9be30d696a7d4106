"""The six batch jobs, end to end: CSV inputs in a folder -> named result folders.

Each job reads ``ratings.csv`` / ``movies.csv`` (and the own or personal ratings where it
needs them), runs the operators, and writes its results with ``write_result``; the
functions also return the result DataFrames. Paths may be local, HDFS or object storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetrics.operators import als, genre_top, knn, matrix, similarity, stats
from cinemetrics.operators.broadcast import broadcast_if_bounded
from cinemetrics.operators.genres import movie_genres
from cinemetrics.sources import csv as csv_src
from cinemetrics.sources.sinks import write_result

# Names of the result folders.
OUT_TOP5_BY_GENRE = "top5.by.genre"
OUT_TOTAL_BY_USER = "total.movies.by.user"
OUT_AVERAGE_BY_GENRE = "average.by.genre"
OUT_AVERAGE_BY_DATASET = "average.by.dataset"
OUT_TOP50_PREDICTED = "top50.predicted"
OUT_GENRE_TOP5_MOVIES = "genre.top5.movies.votingNumber.naive"
OUT_GENRE_AVG = "latest.rating.avg.per.genre"


def _path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def _inputs(spark: SparkSession, input_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        csv_src.read_ratings_csv(spark, _path(input_dir, "ratings.csv")),
        csv_src.read_movies_csv(spark, _path(input_dir, "movies.csv")),
    )


def genre_user_statistics(spark: SparkSession, input_dir: str, output_dir: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Top-5 users per genre with their count, genre average, total count and dataset average."""
    ratings, movies = _inputs(spark, input_dir)
    # five rows per genre, written once: the four outputs do not read the ratings again
    profile = genre_top.genre_top_users_profile(ratings, movies).checkpoint(eager=True)
    key = ["genre", "rank", "user_id"]
    outputs = {
        OUT_TOP5_BY_GENRE: profile.select(*key, F.col("genre_ratings").alias("rating_count")),
        OUT_TOTAL_BY_USER: profile.select(*key, "total_ratings"),
        OUT_AVERAGE_BY_GENRE: profile.select(*key, "genre_avg_rating"),
        OUT_AVERAGE_BY_DATASET: profile.select(*key, "dataset_avg_rating"),
    }
    for name, df in outputs.items():
        write_result(df, _path(output_dir, name), fmt=fmt, single_file=True)
    return outputs


def movie_prediction(
    spark: SparkSession, input_dir: str, my_movies_path: str, output_dir: str, fmt: str = "csv", include_own: bool = False
) -> DataFrame:
    """Adjusted cosine to the own ratings, 10-neighbour prediction, best 50 written."""
    ratings, movies = _inputs(spark, input_dir)
    mine = csv_src.read_my_movies_csv(spark, my_movies_path)
    own = knn.own_list(mine)
    sims = similarity.item_similarity(ratings, mine, own.hint)
    top = knn.top_predicted(sims, movies, mine, include_own=include_own, own=own)
    write_result(top, _path(output_dir, OUT_TOP50_PREDICTED), fmt=fmt, single_file=True)
    return top


def als_recommendation(
    spark: SparkSession, input_dir: str, personal_path: str, user_id: int = 0, quarantine: str | None = None, **grid
) -> dict[str, DataFrame]:
    """Split, grid search, test error and 50 recommendations for ``user_id`` (the person of the file).

    A bad line of the personal file fails the job; with ``quarantine``, a folder, such lines are
    written there with the reason and returned as "rejected", and the good ones are used.
    """
    ratings, movies = _inputs(spark, input_dir)
    parsed = csv_src.parse_personal_ratings_csv(spark, personal_path, quarantine) if quarantine else None
    personal = parsed.accepted if parsed else csv_src.read_personal_ratings_csv(spark, personal_path)
    result = als.grid_search(ratings, personal, **grid)
    return ({"rejected": parsed.rejected} if parsed else {}) | {
        "split_counts": spark.createDataFrame(list(result.counts.items()), "split string, n long"),
        "validation": als.grid_table(result),
        "test": als.test_error_table(result),
        "recommendations": als.recommend_for_user(result.best_model, movies, user_id=user_id),
    }


def genre_top_movies(spark: SparkSession, input_dir: str, output_dir: str, fmt: str = "csv") -> DataFrame:
    """Five most rated movies per genre."""
    ratings, movies = _inputs(spark, input_dir)
    top = genre_top.genre_top_movies(ratings, movies)
    write_result(top, _path(output_dir, OUT_GENRE_TOP5_MOVIES), fmt=fmt, single_file=True)
    return top


def genre_average(spark: SparkSession, input_dir: str, output_dir: str, fmt: str = "csv") -> DataFrame:
    """Average rating per genre; rating fields that do not parse are skipped."""
    ratings = csv_src.read_ratings_tolerant(spark, _path(input_dir, "ratings.csv"))
    movies = csv_src.read_movies_csv(spark, _path(input_dir, "movies.csv"))
    mg = broadcast_if_bounded(movie_genres(movies).select("movie_id", "genre"))
    avg = stats.genre_avg_rating(ratings.join(mg, "movie_id"))
    write_result(avg, _path(output_dir, OUT_GENRE_AVG), fmt=fmt, single_file=True)
    return avg


def matrix_statistics(spark: SparkSession, input_dir: str, threshold: int = matrix.POPULAR_AT) -> dict[str, DataFrame]:
    """Matrix shape and the movies with at least ``threshold`` ratings (id, title, count, mean)."""
    ratings, movies = _inputs(spark, input_dir)
    return {
        "shape": matrix.matrix_shape(ratings),
        "popular": matrix.popular_movies(ratings, movies, threshold),
    }
