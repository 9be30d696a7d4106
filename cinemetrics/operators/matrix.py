"""Statistics of the user x movie rating matrix: in long form (one row per cell), and cut into
blocks of sparse rows (users x a range of movies), where no row is ever as wide as the matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.operators.broadcast import broadcast_if_bounded

POPULAR_AT = 300


def matrix_shape(ratings: DataFrame) -> DataFrame:
    """One row: (num_rows = users with a rating, num_cols = largest movie id + 1)."""
    return ratings.agg(
        F.countDistinct("user_id").alias("num_rows"),
        (F.max("movie_id") + 1).alias("num_cols"),
    )


def movie_column_stats(ratings: DataFrame) -> DataFrame:
    """(movie_id, num_nonzeros, norm_l1) per movie column."""
    return ratings.groupBy("movie_id").agg(
        F.count_if(F.col("rating") != 0).alias("num_nonzeros"),
        F.sum(F.abs("rating")).alias("norm_l1"),
    )


def sparse_blocks(ratings: DataFrame, users_per_block: int, movies_per_block: int) -> DataFrame:
    """(user_block, movie_block, user_id, indices, values): the sparse rows of every block.

    A block holds the cells of ``users_per_block`` consecutive user ids and ``movies_per_block``
    consecutive movie ids; a row is one user's cells in it, as places inside the block (ascending)
    and their ratings, so it has ``movies_per_block`` entries at most however many movies the
    user rated. Rows are grouped by (user, movie block), a key without hot values.
    """
    if users_per_block < 1 or movies_per_block < 1:
        raise ValueError("a block has one row and one column at least")
    cell = F.struct(F.pmod("movie_id", F.lit(movies_per_block)).cast("int").alias("i"), F.col("rating").alias("x"))
    placed = ratings.select(
        "user_id",
        F.floor(F.col("user_id") / users_per_block).alias("user_block"),
        F.expr(f"(movie_id - pmod(movie_id, {int(movies_per_block)})) div {int(movies_per_block)}").alias("movie_block"),
        cell.alias("cell"),
    )
    rows = placed.groupBy("user_block", "movie_block", "user_id").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    return rows.select(
        "user_block", "movie_block", "user_id", F.col("cells.i").alias("indices"), F.col("cells.x").alias("values")
    )


def block_column_stats(blocks: DataFrame, movies_per_block: int) -> DataFrame:
    """(movie_id, num_nonzeros, norm_l1) of the columns of ``sparse_blocks``.

    Every block's columns are summed inside the map tasks first; per column and task one row
    is shuffled.
    """
    entry = F.inline(F.arrays_zip(F.col("indices").alias("i"), F.col("values").alias("x")))
    cells = blocks.select("movie_block", entry)
    sums = cells.groupBy("movie_block", "i").agg(
        F.count_if(F.col("x") != 0).alias("num_nonzeros"), F.sum(F.abs("x")).alias("norm_l1")
    )
    movie = (F.col("movie_block") * movies_per_block + F.col("i")).alias("movie_id")
    return sums.select(movie, "num_nonzeros", "norm_l1")


def blocked_column_stats(ratings: DataFrame, column_blocks: int, users_per_block: int = 1_000_000) -> DataFrame:
    """``movie_column_stats`` over sparse blocks, with the movies cut into ``column_blocks`` ranges."""
    columns = matrix_shape(ratings).first()["num_cols"] or 1
    width = max(1, -(-columns // column_blocks))
    return block_column_stats(sparse_blocks(ratings, users_per_block, width), width)


def popular_movies(ratings: DataFrame, movies: DataFrame, threshold: int = POPULAR_AT) -> DataFrame:
    """(movie_id, title, num_nonzeros, mean_rating) of movies with at least ``threshold`` ratings."""
    stats = movie_column_stats(ratings).where(F.col("num_nonzeros") >= threshold)
    titles = broadcast_if_bounded(movies.select("movie_id", "title"))
    return stats.join(titles, "movie_id").select(
        "movie_id",
        "title",
        "num_nonzeros",
        (F.col("norm_l1") / F.col("num_nonzeros")).alias("mean_rating"),
    )
