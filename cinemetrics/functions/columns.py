"""Scalar column expressions shared by the operators.

Each returns a ``Column`` made of built-in functions, so it runs in the JVM. Those with
higher-order functions are evaluated outside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the ratings split: the last digit of the timestamp (ts % 10, sign of
# the dividend) picks the set: below 6 training, 6 to 8 validation, above 8 test.
TRAIN_BELOW = 6
VALIDATION_UP_TO = 8


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_genres(genres: Column | str) -> Column:
    """Pipe-separated genre text -> array<string> without empty parts.

    A NULL or empty field gives NULL / an empty array, so an explode yields no row.
    """
    return F.filter(F.split(_col(genres), r"\|"), lambda g: g != F.lit(""))


def tolerant_double(text: Column | str) -> Column:
    """Parse text as double; a malformed value becomes NULL instead of failing the job."""
    return _col(text).try_cast("double")


def rating_map(key: Column | str, value: Column | str) -> Column:
    """Single-entry map {key: value} (one user's rating of a movie)."""
    return F.create_map(_col(key), _col(value))


def sorted_entries_by_value(m: Column | str) -> Column:
    """Entries of a map as array<struct<key,value>>, value descending, key ascending on ties."""

    def cmp(a: Column, b: Column) -> Column:
        return (
            F.when(a["value"] > b["value"], F.lit(-1))
            .when(a["value"] < b["value"], F.lit(1))
            .when(a["key"] < b["key"], F.lit(-1))
            .when(a["key"] > b["key"], F.lit(1))
            .otherwise(F.lit(0))
        )

    return F.array_sort(F.map_entries(_col(m)), cmp)


def map_sort_by_value(m: Column | str) -> Column:
    """Map re-built in value-descending order (Spark maps keep entry order)."""
    return F.map_from_entries(sorted_entries_by_value(m))


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode raises on 0/0)."""
    return F.try_divide(_col(num), _col(den))


def digit_split(ts: Column | str) -> Column:
    """'training' / 'validation' / 'test' by the last digit of an epoch-seconds timestamp."""
    digit = _col(ts) % F.lit(10)
    return (
        F.when(digit < TRAIN_BELOW, F.lit("training"))
        .when(digit <= VALIDATION_UP_TO, F.lit("validation"))
        .otherwise(F.lit("test"))
    )
