"""Result sinks: a DataFrame written as csv / parquet / json, replacing an earlier result by default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinemetrics.sources import files

FORMATS = ("csv", "parquet", "json")


def write_result(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    single_file: bool = False,
    mode: str = "overwrite",
    header: bool = True,
    compression: str | None = None,
) -> str:
    """Write ``df`` to ``path``.

    With ``overwrite`` the result is written beside ``path`` and takes its place when it is
    complete: a failing job leaves the earlier result as it was, and ``df`` may read it.

    ``single_file`` is meant for small final results (top-k reports): the rows are shuffled
    into one partition, so the stages before keep their parallelism. Large outputs keep their
    partitions so every executor writes.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; use one of {FORMATS}")
    out = df.repartition(1) if single_file else df
    writer = out.write.mode("error" if mode == "overwrite" else mode)
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer = writer.option("header", str(header).lower()).option("quote", '"').option("escape", '"')
    save = getattr(writer, fmt)
    if mode == "overwrite":
        files.replace(df.sparkSession, path, save)
    else:
        save(path)
    return path


def read_result(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Read back what ``write_result`` wrote, with the schema it was written with."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("quote", '"').option("escape", '"')
    return getattr(reader, fmt)(path)
