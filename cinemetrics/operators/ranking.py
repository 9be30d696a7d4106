"""Row numbers inside large groups, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinemetrics.operators.broadcast import broadcast_if_bounded
from cinemetrics.session import ensure_checkpoint_dir

_ROW_BITS = 33  # of monotonically_increasing_id: the row's number in its partition


def numbered(df: DataFrame, group: str, order: list[Column], number: str = "row_number") -> DataFrame:
    """``df`` with the place (from 0) of each row in its ``group`` by ``order``, which must be total.

    Rows are range-partitioned by (group, order) and numbered by each task on its own; the
    offsets of the tasks are sums over one row per (partition, group). A group of any size is
    spread over many tasks. The partitioned rows are written to the checkpoint folder, so that
    numbers and offsets are taken from the same rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by = [F.col(group).asc(), *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    placed = placed.withColumn("_part", F.shiftright("_at", _ROW_BITS))
    parts = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    offsets = parts.select(F.col(group).alias("_group"), F.col("_part").alias("_of"), shift)
    on = placed[group].eqNullSafe(offsets["_group"]) & (placed["_part"] == offsets["_of"])
    known = placed.join(broadcast_if_bounded(offsets), on)
    return known.withColumn(number, F.col("_at") + F.col("_shift")).drop("_group", "_of", "_shift", "_at", "_part")


def pages(df: DataFrame, group: str, order: list[Column], item: str, page_size: int) -> DataFrame:
    """(group, page from 0, items array of at most ``page_size`` in order): a group's list in pages."""
    if page_size < 1:
        raise ValueError("a page has one item at least")
    rows = numbered(df.select("*"), group, order, "_n").withColumn("page", F.expr(f"_n div {page_size}"))
    entries = F.array_sort(F.collect_list(F.struct("_n", F.col(item).alias("_item"))))
    return rows.groupBy(group, "page").agg(entries.alias("_items")).select(group, "page", F.col("_items._item").alias("items"))
