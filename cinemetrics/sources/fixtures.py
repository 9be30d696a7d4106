"""Ratings, movies and own ratings derived from the driver's star-schema tables.

Users are customers. Two sets of movies: suppliers (few, with many ratings each; genres from
region, nation and a balance class) for the genre and matrix statistics, and parts (many, with
few ratings each) for similarity, prediction and recommendation, where movies without a common
rater and movies with a single one must occur. The same definitions, as SQL text, prefix every
oracle statement (``cinemetrics.plans.oracle.FIXTURE_CTE``).

Ratings: one row per (customer, movie) cell of ``lineitem JOIN orders``; the rating is
``0.5 * (1 + sum(quantity) % 10)``, 0 in every thirteenth cell (0 .. 5.0, exact in binary, so
sums do not depend on order) and the timestamp is the latest ship day in seconds plus a
key-derived second of the day, so the last digit (the split key) is spread.

Titles hold commas and quotes in places, some movies have an empty genre field, some rating
texts do not parse and own movies are listed twice, so that the rules for them show.

The person with own ratings is the customer with most rated parts (the smallest id on ties):
the own list is all of that customer's ratings and grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetrics.functions.columns import parse_genres
from cinemetrics.session import scratch_path
from cinemetrics.sources.tables import read_table, write_bucketed_table

# Fixed values of the fixture mapping.
SECONDS_PER_DAY = 86400
USER_SECOND_FACTOR = 31
MOVIE_SECOND_FACTOR = 17
HIGH_BALANCE_GENRE = "HIGH_BALANCE"
HIGH_BALANCE_AT = 5000
ZERO_RATING_EVERY = 13
NO_GENRE_EVERY, NO_GENRE_REMAINDER = 11, 4
COMMA_TITLE_EVERY, COMMA_TITLE_REMAINDER = 5, 1
QUOTE_TITLE_EVERY, QUOTE_TITLE_REMAINDER = 7, 2
BAD_RATING_EVERY = 17
PERSONAL_USER_ID = -1


_TABLES: dict[tuple[str, str], DataFrame] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; its DataFrame (file listing, footer schema) is made once per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


# Session options: write the derived ratings once per session into the shared checkpoint
# folder and read them back (the way ratings.csv sits on shared storage); with a bucket
# count, as a table bucketed by user_id (see ``cinemetrics.sources.tables``).
MATERIALIZE_CONF = "cinemetrics.fixtures.materialize"
BUCKETS_CONF = "cinemetrics.fixtures.buckets"
# ``lineitem`` rows for one task of the derivation and of the per-user steps that follow in it
TASK_ROWS = 250_000
_ROWS: dict[tuple[str, str], int] = {}
_MATERIALIZED: dict[tuple, tuple[str, str]] = {}


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id long, movie_id long, rating double, ts long), one row per cell."""
    if spark.conf.get(MATERIALIZE_CONF, "false").lower() != "true":
        return derive_ratings(spark, sf_dir)
    buckets = int(spark.conf.get(BUCKETS_CONF, "0"))
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), buckets)
    if key not in _MATERIALIZED:
        path = scratch_path(spark, "ratings")
        derived = derive_ratings(spark, sf_dir, partitions=buckets or None)
        if buckets > 0:
            _MATERIALIZED[key] = ("table", write_bucketed_table(derived, path, buckets))
        else:
            derived.write.mode("overwrite").parquet(path)
            _MATERIALIZED[key] = ("parquet", path)
    kind, where = _MATERIALIZED[key]
    return read_table(spark, where) if kind == "table" else spark.read.parquet(where)


def _task_count(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions of ``TASK_ROWS`` rows each for the derivation; None where a share per core is less.

    Adaptive execution merges shuffle partitions down to one per core, so that the hash tables of
    a task grow with the input. The rows are counted once per session, from the file footers.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _ROWS:
        _ROWS[key] = _table(spark, sf_dir, "lineitem").count()
    rows = _ROWS[key]
    return -(-rows // TASK_ROWS) if rows > TASK_ROWS * spark.sparkContext.defaultParallelism else None


def derive_ratings(spark: SparkSession, sf_dir: str, partitions: int | None = None, movie: str = "l_suppkey") -> DataFrame:
    """The ratings computed from ``lineitem JOIN orders`` (no materialisation).

    With ``partitions``, the joined rows are hash-partitioned by customer into that many
    partitions before the per-cell aggregate: the aggregate needs no exchange of its own,
    and a following bucketing by user_id with the same count reuses the partitioning, so
    one shuffle serves both, and a (genre, user) aggregate too. Without it, large inputs get
    as many as keep a task's share bounded, here and in the join.
    """
    tasks = _task_count(spark, sf_dir)
    partitions = partitions or tasks
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", movie, "l_quantity", "l_shipdate")
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    if tasks:
        li, od = li.repartition(tasks, "l_orderkey"), od.repartition(tasks, "o_orderkey")
    joined = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    if partitions:
        joined = joined.repartition(partitions, "o_custkey")
    cells = (
        joined
        .groupBy(F.col("o_custkey").alias("user_id"), F.col(movie).alias("movie_id"))
        .agg(
            F.sum(F.col("l_quantity").cast("long")).alias("_qty"),
            F.max(days).alias("_day"),
        )
    )
    second = (F.col("user_id") * USER_SECOND_FACTOR + F.col("movie_id") * MOVIE_SECOND_FACTOR) % SECONDS_PER_DAY
    rating = (((F.col("_qty") % 10) + 1).cast("double") * 0.5)
    return cells.select(
        "user_id",
        "movie_id",
        F.when((F.col("user_id") + F.col("movie_id")) % ZERO_RATING_EVERY == 0, F.lit(0.0)).otherwise(rating).alias("rating"),
        (F.col("_day") * SECONDS_PER_DAY + second).alias("ts"),
    )


def part_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings with parts as movies, one row per (customer, part) cell."""
    return derive_ratings(spark, sf_dir, movie="l_partkey")


def ratings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings with the rating as text, which does not parse in every seventeenth cell."""
    bad = (F.col("user_id") + F.col("movie_id")) % BAD_RATING_EVERY == 0
    r = ratings(spark, sf_dir)
    return r.withColumn("rating", F.when(bad, F.lit("n/a")).otherwise(F.col("rating").cast("string")))


def _titled(name: Column, key: Column) -> Column:
    quoted = F.concat(F.lit('The "'), name, F.lit('"'))
    return (
        F.when(key % COMMA_TITLE_EVERY == COMMA_TITLE_REMAINDER, F.concat(name, F.lit(", The")))
        .when(key % QUOTE_TITLE_EVERY == QUOTE_TITLE_REMAINDER, quoted)
        .otherwise(name)
    )


def movies_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movie_id, title, genres) with genres as pipe-separated text, as in movies.csv."""
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    balance = F.when(F.col("s_acctbal") >= HIGH_BALANCE_AT, F.lit(HIGH_BALANCE_GENRE))
    none = F.col("s_suppkey") % NO_GENRE_EVERY == NO_GENRE_REMAINDER
    return (
        s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("movie_id"),
            _titled(F.col("s_name"), F.col("s_suppkey")).alias("title"),
            F.when(none, F.lit("")).otherwise(F.concat_ws("|", "r_name", "n_name", balance)).alias("genres"),
        )
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movie_id long, title string, genres array<string>)."""
    m = movies_text(spark, sf_dir)
    return m.select("movie_id", "title", parse_genres("genres").alias("genres"))


def part_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movie_id long, title string, genres array<string>) of the parts."""
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return p.select(
        F.col("p_partkey").alias("movie_id"),
        _titled(F.col("p_name"), F.col("p_partkey")).alias("title"),
        F.array("p_type").alias("genres"),
    )


def written_part_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part_ratings``, derived once by this call and written to the session's scratch folder."""
    path = scratch_path(spark, "part_ratings")
    part_ratings(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def person(ratings: DataFrame) -> DataFrame:
    """One row (user_id): the customer with most rated parts, the smallest id on ties."""
    counts = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "user_id").limit(1).select("user_id")


def my_movies(ratings: DataFrame) -> DataFrame:
    """(movie_id long, my_rating double): all ratings of the person."""
    own = ratings.join(F.broadcast(person(ratings)), "user_id")  # one row
    return own.select("movie_id", F.col("rating").alias("my_rating"))


def my_movies_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movie_id, my_rating) as listed: every own movie twice, the rating that counts later.

    The lines are range-partitioned, and the files of a write are named by partition: a later
    line is in a later file, or further down in the same one.
    """
    line = F.explode(F.sequence(F.lit(0), F.lit(1))).alias("line")
    listed = my_movies(written_part_ratings(spark, sf_dir)).select("movie_id", "my_rating", line)
    first = F.when(F.col("line") == 0, F.lit(5.0) - F.col("my_rating")).otherwise(F.col("my_rating"))
    lines = listed.select("line", "movie_id", first.alias("my_rating"))
    return lines.repartitionByRange("line", "movie_id").sortWithinPartitions("line", "movie_id").select("movie_id", "my_rating")


def personal_ratings(ratings: DataFrame) -> DataFrame:
    """(user_id, movie_id, rating) of the person, under a user id no customer has."""
    return _as_personal(my_movies(ratings))


def _as_personal(mine: DataFrame) -> DataFrame:
    return mine.select(
        F.lit(PERSONAL_USER_ID).cast("long").alias("user_id"),
        "movie_id",
        F.col("my_rating").alias("rating"),
    )


@dataclass(frozen=True)
class Tables:
    """The logical inputs of the genre and matrix operators, lazily defined."""

    ratings: DataFrame
    movies: DataFrame


@dataclass(frozen=True)
class PersonTables:
    """The logical inputs of similarity, prediction and recommendation, lazily defined."""

    ratings: DataFrame
    movies: DataFrame
    my_movies: DataFrame
    personal: DataFrame


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(ratings=ratings(spark, sf_dir), movies=movies(spark, sf_dir))


def load_person(spark: SparkSession, sf_dir: str) -> PersonTables:
    """The ratings, and the own list found in them, are derived and written once; everything else
    of a query reads them from there."""
    ratings = written_part_ratings(spark, sf_dir)
    path = scratch_path(spark, "my_movies")
    my_movies(ratings).write.parquet(path)
    mine = spark.read.parquet(path)
    return PersonTables(
        ratings=ratings,
        movies=part_movies(spark, sf_dir),
        my_movies=mine,
        personal=_as_personal(mine),
    )
