"""Fitted ALS models and their errors on shared storage, so that a grid is fitted once.

A model lies in the folder of its input (a digest of the rows) under a name made of its
parameters. Model and error are written beside their place and swapped in; the error goes
last and marks the entry as complete. A driver that is lost in the middle of a grid leaves
complete entries, which the next one reads instead of fitting again.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetrics.session import CHECKPOINT_CONF, ensure_checkpoint_dir
from cinemetrics.sources import files

STORE_CONF = "cinemetrics.als.store"
_FOLDER = "als-models"
# part of every digest: raise it when a change of the code changes the models
VERSION = 1


def default_folder(spark: SparkSession) -> str:
    """``cinemetrics.als.store`` where set, else a folder in the shared checkpoint folder, the same for
    every driver that is given that folder (a local session's own folder ends with the session)."""
    set_ = spark.conf.get(STORE_CONF, None)
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    return set_ or f"{(root or ensure_checkpoint_dir(spark)).rstrip('/')}/{_FOLDER}"


def input_summary(labelled: DataFrame) -> tuple[dict[str, int], str]:
    """(rows by label, digest of all rows) of rows (split, user_id, movie_id, rating), in one pass.

    The digest is made of counts and sums of row hashes by label: it does not depend on the
    order or the partitions of the rows.
    """
    h, again = F.xxhash64("user_id", "movie_id", "rating"), F.xxhash64(F.lit(1), "user_id", "movie_id", "rating")
    halves = [part for x in (h, again) for part in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32))]
    sums = [F.sum(x.cast("decimal(38,0)")).alias(f"h{n}") for n, x in enumerate(halves)]
    rows = labelled.groupBy("split").agg(F.count(F.lit(1)).alias("n"), *sums).collect()  # one row a label
    told = sorted((r["split"], r["n"], *[str(r[f"h{n}"]) for n in range(len(sums))]) for r in rows)
    return {r["split"]: r["n"] for r in rows}, hashlib.sha256(repr((VERSION, told)).encode()).hexdigest()


class ModelStore:
    """The models of one input. ``read`` and ``write`` of an error take (sse, n_predicted, n_split)."""

    _ERROR = "sse double, n_predicted long, n_split long"

    def __init__(self, spark: SparkSession, folder: str, digest: str):
        self.spark = spark
        self.folder = f"{folder.rstrip('/')}/{digest[:32]}"

    def _path(self, name: str, what: str) -> str:
        return f"{self.folder}/{name}/{what}"

    def error(self, name: str, split: str) -> tuple[float, int, int] | None:
        path = self._path(name, f"{split}-error")
        if not files.exists(self.spark, path):
            return None
        return tuple(self.spark.read.schema(self._ERROR).parquet(path).first())

    def save_error(self, name: str, split: str, error: tuple[float, int, int]) -> None:
        row = self.spark.createDataFrame([error], self._ERROR).coalesce(1)
        files.replace(self.spark, self._path(name, f"{split}-error"), row.write.parquet)

    def save_model(self, name: str, model: ALSModel) -> None:
        files.replace(self.spark, self._path(name, "model"), lambda path: model.write().save(path))

    def model(self, name: str) -> ALSModel:
        return ALSModel.load(self._path(name, "model"))
