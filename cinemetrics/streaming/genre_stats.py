"""Per-genre rating statistics maintained over ratings files that arrive in a folder.

The reference computes the average rating per genre in batch. The same aggregate runs
here as a Structured Streaming query: new ratings CSV files are read incrementally, joined
with the (static, broadcast after a size check) genre dimension, and folded into a
stateful ``groupBy(genre)``; state and progress live in the checkpoint location, so a
restarted query resumes where it stopped. Each micro-batch replaces the result table
(one row per genre) through ``foreachBatch``, which keeps the sink idempotent per epoch; the
table is written beside the old one and swapped in when complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinemetrics.operators.broadcast import broadcast_if_bounded
from cinemetrics.operators.genres import movie_genres
from cinemetrics.sources.csv import stream_ratings_csv
from cinemetrics.sources.sinks import write_result


def ratings_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over ratings CSV files (header line) dropped into ``folder``; as in the
    batch reader a malformed row fails the query, whichever of its fields is bad."""
    return stream_ratings_csv(spark, folder, max_files_per_trigger)


def genre_running_stats(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Streaming (genre, rating_sum, rating_count) over every rating seen so far."""
    mg = broadcast_if_bounded(movie_genres(movies).select("movie_id", "genre"))
    return (
        ratings.select("movie_id", "rating")
        .join(mg, "movie_id")
        .groupBy("genre")
        .agg(F.sum("rating").alias("rating_sum"), F.count(F.lit(1)).alias("rating_count"))
    )


def start_genre_avg(
    spark: SparkSession,
    ratings_folder: str,
    movies: DataFrame,
    result_path: str,
    checkpoint_location: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the incremental (genre, avg_rating, rating_count) query.

    ``available_now`` processes what is in the folder (in several micro-batches when
    ``max_files_per_trigger`` is set) and stops; otherwise it keeps polling.
    """
    stats = genre_running_stats(ratings_stream(spark, ratings_folder, max_files_per_trigger), movies)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        out = batch.select(
            "genre", (F.col("rating_sum") / F.col("rating_count")).alias("avg_rating"), "rating_count"
        )
        write_result(out, result_path)

    writer = (
        stats.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_location)
        .foreachBatch(publish)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
