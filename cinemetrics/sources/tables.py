"""Ratings stored as a table bucketed by user.

Most per-user work -- the user mean, the pair self join, the statistics of top users and
the (genre, user) aggregate -- needs rows clustered by ``user_id``. A table bucketed by
``user_id`` is read with that hash partitioning already in place, so those steps run
without shuffling the ratings; the one shuffle is paid when the table is written.

Size ``buckets`` so a bucket stays near 256 MB: a bucketed scan reads a bucket in one
task. The write repartitions by the bucket key first, so each bucket is one file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_bucketed_table(df: DataFrame, path: str, buckets: int, key: str = "user_id", table: str | None = None) -> str:
    """Write ``df`` as an external parquet table at ``path``, bucketed by ``key``.

    Buckets are not sorted: Spark does not use a bucket's sort order unless a legacy
    option is set, so sorting would only add a sort of every bucket to the write.

    Returns the table name registered in the session catalog.
    """
    name = table or f"cinemetrics_{key}_{uuid.uuid4().hex[:12]}"
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .option("path", path)
        .format("parquet")
        .saveAsTable(name)
    )
    return name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
