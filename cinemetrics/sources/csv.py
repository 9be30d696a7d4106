"""CSV sources for the ratings layouts (header line, quoted titles, pipe-separated genres).

Schemas are given, never inferred. Titles with commas are quoted and doubled quotes
are unescaped by the reader itself, so the title comes back as written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinemetrics.functions.columns import parse_genres, tolerant_double
from cinemetrics.sources import files

RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("movie_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("ts", T.LongType()),
    ]
)
RATINGS_TEXT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("movie_id", T.LongType()),
        T.StructField("rating", T.StringType()),
        T.StructField("ts", T.StringType()),
    ]
)
MOVIES_SCHEMA = T.StructType(
    [
        T.StructField("movie_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)
MY_MOVIES_SCHEMA = T.StructType(
    [
        T.StructField("movie_id", T.LongType()),
        T.StructField("my_rating", T.DoubleType()),
    ]
)
PERSONAL_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("movie_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
    ]
)


CORRUPT = "_corrupt_record"


def _options(reader, schema: T.StructType, header: bool, mode: str):
    return (
        reader.schema(schema)
        .option("header", str(header).lower())
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", mode)
    )


def _reader(spark: SparkSession, schema: T.StructType, header: bool, mode: str):
    return _options(spark.read, schema, header, mode)


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])


def _raw(reader, path: str, schema: T.StructType, header: bool) -> DataFrame:
    """All fields as text, and the whole line where the number of fields is wrong."""
    return _options(reader, _as_text(schema), header, "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def _reason(schema: T.StructType, required: list[str]) -> Column:
    """What is wrong with a row of text fields, null if nothing is."""
    found = [F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields"))]
    for f in schema.fields:
        if f.name in required:
            found.append(F.when(F.col(f.name).isNull(), F.lit(f"{f.name} is missing")))
        bad = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        found.append(F.when(bad, F.lit(f"{f.name} does not parse")))
    return F.coalesce(*found)


def _cast(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _typed(spark: SparkSession, path: str, schema: T.StructType, header: bool, mode: str, required: list[str]) -> DataFrame:
    """CSV rows with the fields of ``schema``, each row checked as a whole.

    Spark's own FAILFAST looks at the fields that a query uses, so a count would pass over
    malformed rows. Here all fields are read as text and a filter over all of them decides:
    the row has the right number of fields, the ``required`` ones are there, and every field
    converts. FAILFAST raises at the first row that fails, DROPMALFORMED leaves it out,
    PERMISSIVE keeps it with nulls.
    """
    if mode not in ("FAILFAST", "DROPMALFORMED", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode!r}")
    raw = _raw(spark.read, path, schema, header)
    if mode == "FAILFAST":
        raw = _refuse_bad(raw, schema, required)
    elif mode == "DROPMALFORMED":
        raw = raw.where(_reason(schema, required).isNull())
    return _cast(raw, schema)


def _refuse_bad(raw: DataFrame, schema: T.StructType, required: list[str]) -> DataFrame:
    seen = F.concat_ws(",", *[f.name for f in schema.fields])
    refused = F.raise_error(F.concat(F.lit("malformed CSV row: "), seen)).cast("boolean")
    return raw.where(F.when(_reason(schema, required).isNull(), F.lit(True)).otherwise(refused))


@dataclass(frozen=True)
class ParsedFile:
    """The rows of a file sorted into two folders: ``accepted`` has the types of the schema,
    ``rejected`` the fields as text, the whole line where the number of fields is wrong, and
    the ``reason``. The counts were taken by the pass that wrote them."""

    accepted: DataFrame
    rejected: DataFrame
    n_accepted: int
    n_rejected: int


def parse_csv(
    spark: SparkSession, path: str, schema: T.StructType, out: str, header: bool = True, required: list[str] | None = None
) -> ParsedFile:
    """Read a CSV file once and write its rows to ``out``, by what became of them.

    A row is rejected, never silently dropped, when its number of fields is wrong, a
    ``required`` field (default: all) is missing or any field does not convert. One job parses,
    writes both parts (``status=accepted``, ``status=rejected``) and counts them; ``out`` is
    replaced when it is complete.
    """
    required = [f.name for f in schema.fields] if required is None else required
    reason = _reason(schema, required)
    status = F.when(reason.isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    raw = _raw(spark.read, path, schema, header).withColumn("reason", reason).withColumn("status", status)
    seen = Observation()
    counted = raw.observe(
        seen, F.count_if(F.col("reason").isNull()).alias("accepted"), F.count_if(F.col("reason").isNotNull()).alias("rejected")
    )
    files.replace(spark, out, counted.write.partitionBy("status").parquet)
    counts = seen.get
    stored = spark.read.schema(raw.schema).parquet(out)
    text = [f.name for f in schema.fields]
    rejected = stored.where(F.col("status") == "rejected").select(*text, F.col(CORRUPT).alias("line"), "reason")
    accepted = _cast(stored.where(F.col("status") == "accepted"), schema)
    return ParsedFile(accepted, rejected, counts["accepted"], counts["rejected"])


def parse_ratings_csv(spark: SparkSession, path: str, out: str) -> ParsedFile:
    """ratings.csv sorted into accepted and rejected rows, all fields required."""
    return parse_csv(spark, path, RATINGS_SCHEMA, out)


def parse_personal_ratings_csv(spark: SparkSession, path: str, out: str) -> ParsedFile:
    """Personal ratings without header sorted into accepted and rejected rows."""
    return parse_csv(spark, path, PERSONAL_SCHEMA, out, header=False)


def stream_ratings_csv(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Ratings CSV files that arrive in ``folder``, each row checked as ``read_ratings_csv`` does."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = _raw(reader, folder, RATINGS_SCHEMA, True)
    return _cast(_refuse_bad(raw, RATINGS_SCHEMA, [f.name for f in RATINGS_SCHEMA.fields]), RATINGS_SCHEMA)


def read_ratings_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """ratings.csv -> (user_id, movie_id, rating, ts); by default a malformed row fails the
    job, also one whose bad field the query does not use."""
    return _typed(spark, path, RATINGS_SCHEMA, True, mode, ["user_id", "movie_id", "rating", "ts"])


def read_ratings_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """ratings.csv -> (movie_id, rating); rows whose rating does not parse are dropped."""
    raw = _reader(spark, RATINGS_TEXT_SCHEMA, True, "PERMISSIVE").csv(path)
    parsed = raw.select("movie_id", tolerant_double("rating").alias("rating"))
    return parsed.where(F.col("movie_id").isNotNull() & F.col("rating").isNotNull())


def read_movies_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """movies.csv -> (movie_id, title, genres array<string>); title and genres may be empty."""
    raw = _typed(spark, path, MOVIES_SCHEMA, True, mode, ["movie_id"])
    return raw.select("movie_id", "title", parse_genres("genres").alias("genres"))


def read_my_movies_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """my_movies.csv -> (movie_id, my_rating), one row per movie; a later line wins.

    Later means: in a file whose path sorts later, or further down in the same file.
    """
    raw = _typed(spark, path, MY_MOVIES_SCHEMA, True, mode, ["movie_id", "my_rating"])
    line = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return raw.withColumn("_line", line).groupBy("movie_id").agg(F.max_by("my_rating", "_line").alias("my_rating"))


def read_personal_ratings_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Personal ratings without header -> (user_id, movie_id, rating).

    ``mode="DROPMALFORMED"`` skips bad lines instead of failing.
    """
    return _typed(spark, path, PERSONAL_SCHEMA, False, mode, ["user_id", "movie_id", "rating"])
