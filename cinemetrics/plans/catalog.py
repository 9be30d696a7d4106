"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables.

Inputs come from the fixture adapter (``cinemetrics.sources.fixtures``). The scan keys read
the derived tables through the CSV sources: each is exported once per session and input, as
compressed CSV in the session's scratch folder, and the readers run over the whole of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetrics.operators import als, genre_top, genres, knn, matrix, similarity, stats
from cinemetrics.session import scratch_path
from cinemetrics.sources import csv as csv_src
from cinemetrics.sources import fixtures
from cinemetrics.sources.sinks import read_result, write_result
from cinemetrics.streaming import genre_stats

Query = Callable[[SparkSession, str], DataFrame]

# A second threshold for ``popular_movies``: the library default of 300 selects every movie
# of the test tables at sf0.01.
DENSE_THRESHOLD = 480
# A page size that cuts the genres of the test tables (the library default: one page each).
SHORT_PAGE = 3
# Ranges of movies that the blocked matrix statistics cut the columns into.
COLUMN_BLOCKS = 50
# Grid fits submitted at once; a speed setting only (each fit is itself distributed).
GRID_PARALLELISM_CONF = "cinemetrics.als.parallelism"
GRID_PARALLELISM = 1

_EXPORTS: dict[tuple[str, str, str], str] = {}


def _csv_export(spark: SparkSession, sf_dir: str, name: str, table: Query) -> str:
    """Path of the CSV export of a derived table, written at the first call of the session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _EXPORTS:
        path = scratch_path(spark, name)
        write_result(table(spark, sf_dir), path, fmt="csv", compression="gzip")
        _EXPORTS[key] = path
    return _EXPORTS[key]


# --- 1. sources and sinks -------------------------------------------------------------


def ratings_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_src.read_ratings_csv(spark, _csv_export(spark, sf_dir, "ratings.csv", fixtures.ratings))


def movies_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = csv_src.read_movies_csv(spark, _csv_export(spark, sf_dir, "movies.csv", fixtures.movies_text))
    genres = F.coalesce("genres", F.array().cast("array<string>"))
    return m.select("movie_id", "title", F.array_join(genres, "|").alias("genres"), F.size(genres).alias("n_genres"))


def my_movies_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_src.read_my_movies_csv(spark, _csv_export(spark, sf_dir, "my_movies.csv", fixtures.my_movies_lines))


def ratings_tolerant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_src.read_ratings_tolerant(spark, _csv_export(spark, sf_dir, "ratings_text.csv", fixtures.ratings_text))


def _parsed_ratings(spark: SparkSession, sf_dir: str) -> csv_src.ParsedFile:
    path = _csv_export(spark, sf_dir, "ratings_text.csv", fixtures.ratings_text)
    return csv_src.parse_ratings_csv(spark, path, scratch_path(spark, "ratings_parsed"))


def ratings_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the ratings file that do not parse, as they stand there, each with its reason."""
    bad = _parsed_ratings(spark, sf_dir).rejected
    return bad.select(F.col("user_id").cast("long"), F.col("movie_id").cast("long"), "rating", F.col("ts").cast("long"), "reason")


def ratings_parse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: rows accepted and rejected, as counted by the pass that wrote them."""
    parsed = _parsed_ratings(spark, sf_dir)
    return spark.createDataFrame([(parsed.n_accepted, parsed.n_rejected)], "n_accepted long, n_rejected long")


def rating_map_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = stats.rating_map_projection(fixtures.ratings(spark, sf_dir))
    return mapped.select("movie_id", F.explode("user_rating").alias("user_id", "rating"))


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = genre_avg_rating(spark, sf_dir)
    path = scratch_path(spark, "genre_avg_rating")
    write_result(result, path, fmt="csv", single_file=True)
    return read_result(spark, path, result.schema, fmt="csv")


# --- 2. genres and base aggregates ----------------------------------------------------


def movie_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genres.movie_genres(fixtures.movies(spark, sf_dir)).select("movie_id", "genre")


def genre_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return genres.genre_ratings(t.ratings, t.movies)


def movie_rating_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.movie_rating_count(fixtures.ratings(spark, sf_dir))


def user_rating_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.user_rating_count(fixtures.ratings(spark, sf_dir))


def user_avg_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.user_avg_rating(fixtures.ratings(spark, sf_dir))


def genre_avg_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.genre_avg_rating(genre_ratings(spark, sf_dir))


def genre_user_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.genre_user_stats(genre_ratings(spark, sf_dir)).select("genre", "user_id", "rating_count")


def dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dataset_counts(fixtures.ratings(spark, sf_dir))


def genre_avg_rating_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """genre_avg_rating maintained by a streaming query over the ratings written as files."""
    folder = _csv_export(spark, sf_dir, "ratings.csv", fixtures.ratings)
    result = scratch_path(spark, "genre_avg_stream")
    query = genre_stats.start_genre_avg(
        spark,
        folder,
        fixtures.movies(spark, sf_dir),
        result,
        scratch_path(spark, "genre_avg_stream-state"),
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"streaming query failed: {query.exception()}")
    return spark.read.parquet(result)


# --- 3. top-k per genre ---------------------------------------------------------------


def genre_top5_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return genre_top.genre_top_movies(t.ratings, t.movies)


def genre_movie_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return genre_top.genre_movie_counts(t.ratings, t.movies)


def _genre_pages(spark: SparkSession, sf_dir: str, page_size: int) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    found = genre_top.genre_movie_pages(t.ratings, t.movies, page_size)
    listed = F.array_join(F.transform("movies", lambda m: m.cast("string")), ",").alias("movies")
    return found.select("genre", "page", F.size("movies").cast("long").alias("n_movies"), listed)


def genre_movie_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each genre's movies by rating count, in pages of the default size."""
    return _genre_pages(spark, sf_dir, genre_top.PAGE_SIZE)


def genre_movie_pages_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in pages so short that genres of the test tables have several."""
    return _genre_pages(spark, sf_dir, SHORT_PAGE)


def genre_top5_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return genre_top.genre_top_users(t.ratings, t.movies).select("genre", "rank", "user_id", "rating_count")


def genre_top5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return genre_top.genre_top_users_profile(t.ratings, t.movies)


def genre_top5_users_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_top5_profile(spark, sf_dir).select("genre", "rank", "user_id", "total_ratings")


def genre_top5_users_genre_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    top = genre_top.genre_top_users(t.ratings, t.movies)
    return top.select("genre", "rank", "user_id", F.col("avg_rating").alias("genre_avg_rating"))


def genre_top5_users_dataset_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_top5_profile(spark, sf_dir).select("genre", "rank", "user_id", "dataset_avg_rating")


def map_sort_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    m = genre_top.genre_top_users_map(t.ratings, t.movies)
    return m.select("genre", F.posexplode(F.map_entries("top_users")).alias("pos", "e")).select(
        "genre",
        (F.col("pos") + 1).alias("position"),
        F.col("e.key").alias("user_id"),
        F.col("e.value").alias("rating_count"),
    )


# --- 4. matrix statistics -------------------------------------------------------------


def matrix_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.matrix_shape(fixtures.ratings(spark, sf_dir))


def movie_column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.movie_column_stats(fixtures.ratings(spark, sf_dir))


def movie_column_stats_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movie_column_stats over sparse blocks of the matrix."""
    return matrix.blocked_column_stats(fixtures.ratings(spark, sf_dir), COLUMN_BLOCKS)


def popular_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return matrix.popular_movies(t.ratings, t.movies)


def popular_movies_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return matrix.popular_movies(t.ratings, t.movies, DENSE_THRESHOLD)


# --- 5. similarity and prediction -----------------------------------------------------


def unrated_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load_person(spark, sf_dir)
    return knn.unrated_movies(t.movies, t.my_movies)


def co_rated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load_person(spark, sf_dir)
    return similarity.co_rated_pairs(t.ratings, t.my_movies).drop("user_avg")


def adjusted_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load_person(spark, sf_dir)
    return similarity.item_similarity(t.ratings, t.my_movies)


def knn_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load_person(spark, sf_dir)
    own = knn.own_list(t.my_movies)
    sims = similarity.item_similarity(t.ratings, t.my_movies, own.hint)
    return knn.knn_predictions(sims, t.movies, t.my_movies, own=own)


def top50_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load_person(spark, sf_dir)
    own = knn.own_list(t.my_movies)
    sims = similarity.item_similarity(t.ratings, t.my_movies, own.hint)
    return knn.top_predicted(sims, t.movies, t.my_movies, own=own)


def top50_predicted_with_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant that keeps own movies among the 50 (without a title, as their title is not looked up)."""
    t = fixtures.load_person(spark, sf_dir)
    own = knn.own_list(t.my_movies)
    sims = similarity.item_similarity(t.ratings, t.my_movies, own.hint)
    return knn.top_predicted(sims, t.movies, t.my_movies, include_own=True, own=own)


# --- 6. ALS ---------------------------------------------------------------------------


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return als.split_counts(fixtures.ratings(spark, sf_dir))


def als_scorable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load_person(spark, sf_dir)
    return als.scorable_counts(t.ratings, t.personal)


def user_mean_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error measures of the ALS models, for a predictor that SQL can express too."""
    t = fixtures.load_person(spark, sf_dir)
    sizes = als.split_counts(t.ratings).where(F.col("split") != "training")
    error = als.prediction_error(als.user_mean_scores(t.ratings, t.personal), sizes)
    rounded = [F.round(c, 6).alias(c) for c in ("sse", "mse", "rmse", "mse_ref")]
    return error.select("split", "n_split", "n_predicted", *rounded)


def als_half_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User factors at rank 2 from the start factors of the movies, over the training set."""
    t = fixtures.load_person(spark, sf_dir)
    train = als.training_set(t.ratings, t.personal)
    users = als.half_step(train, als.start_factors(train, "movie_id"), "user_id", "movie_id")
    return users.select("user_id", *[F.round(c, 6).alias(c) for c in ("f1", "f2")])


def als_half_step_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half: movie factors from those user factors."""
    t = fixtures.load_person(spark, sf_dir)
    _, movies = als.rank2_iterations(als.training_set(t.ratings, t.personal), 1)
    return movies.select("movie_id", *[F.round(c, 6).alias(c) for c in ("f1", "f2")])


def als_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training split plus the personal ratings, read back through the personal-ratings reader."""
    t = fixtures.load_person(spark, sf_dir)
    path = scratch_path(spark, "personal.csv")
    write_result(t.personal, path, fmt="csv", header=False)
    personal = csv_src.read_personal_ratings_csv(spark, path)
    return als.training_set(t.ratings, personal)


def _grid(spark: SparkSession, sf_dir: str) -> als.GridResult:
    t = fixtures.load_person(spark, sf_dir)
    parallelism = int(spark.conf.get(GRID_PARALLELISM_CONF, str(GRID_PARALLELISM)))
    return als.grid_search(t.ratings, t.personal, parallelism=parallelism)


def als_validation_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return als.grid_table(_grid(spark, sf_dir))


def als_test_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return als.test_error_table(_grid(spark, sf_dir))


def als_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return als.recommend_for_user(_grid(spark, sf_dir).best_model, fixtures.part_movies(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "ratings_scan": ratings_scan,
    "movies_scan": movies_scan,
    "my_movies_scan": my_movies_scan,
    "ratings_tolerant_parse": ratings_tolerant_parse,
    "ratings_rejected": ratings_rejected,
    "ratings_parse_counts": ratings_parse_counts,
    "rating_map_projection": rating_map_projection,
    "sink_roundtrip": sink_roundtrip,
    "movie_genres": movie_genres,
    "genre_ratings": genre_ratings,
    "movie_rating_count": movie_rating_count,
    "user_rating_count": user_rating_count,
    "user_avg_rating": user_avg_rating,
    "genre_avg_rating": genre_avg_rating,
    "genre_user_count": genre_user_count,
    "genre_avg_rating_stream": genre_avg_rating_stream,
    "dataset_counts": dataset_counts,
    "genre_top5_movies": genre_top5_movies,
    "genre_movie_list": genre_movie_list,
    "genre_movie_pages": genre_movie_pages,
    "genre_movie_pages_short": genre_movie_pages_short,
    "genre_top5_users": genre_top5_users,
    "genre_top5_users_total": genre_top5_users_total,
    "genre_top5_users_genre_avg": genre_top5_users_genre_avg,
    "genre_top5_users_dataset_avg": genre_top5_users_dataset_avg,
    "genre_top5_profile": genre_top5_profile,
    "map_sort_by_value": map_sort_by_value,
    "matrix_shape": matrix_shape,
    "movie_column_stats": movie_column_stats,
    "movie_column_stats_blocked": movie_column_stats_blocked,
    "popular_movies": popular_movies,
    "popular_movies_dense": popular_movies_dense,
    "unrated_movies": unrated_movies,
    "co_rated_pairs": co_rated_pairs,
    "adjusted_cosine": adjusted_cosine,
    "knn_predictions": knn_predictions,
    "top50_predicted": top50_predicted,
    "top50_predicted_with_own": top50_predicted_with_own,
    "split_counts": split_counts,
    "als_scorable_counts": als_scorable_counts,
    "user_mean_error": user_mean_error,
    "als_training_set": als_training_set,
    "als_half_step": als_half_step,
    "als_half_step_movies": als_half_step_movies,
    "als_validation_error": als_validation_error,
    "als_test_error": als_test_error,
    "als_recommendations": als_recommendations,
}
