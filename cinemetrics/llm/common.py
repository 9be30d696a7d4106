"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetrics.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# the blank and the control characters U+0009..U+000D
ASCII_SPACE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there.

    Cuts the lineage of iterations, and lets several passes read one fixed set of rows: a
    lost executor never makes a pass see other rows than the pass before it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_or_empty(col: str | Column = "text") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def hash128(col: Column) -> tuple[Column, Column]:
    """Two independently seeded 64-bit hashes: at 10^12 values a collision of both is below 10^-14."""
    return F.xxhash64(col), F.xxhash64(F.lit(1), col)


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id written as text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def chunks_by_size(items: Iterable[tuple], size_of, limit: int) -> Iterator[list[tuple]]:
    """Consecutive items in lists of at most ``limit`` in total size (one larger item goes alone)."""
    out: list[tuple] = []
    total = 0
    for item in items:
        n = size_of(item)
        if out and total + n > limit:
            yield out
            out, total = [], 0
        out.append(item)
        total += n
    if out:
        yield out
