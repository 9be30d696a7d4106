"""Exact top-k per group.

``row_number() <= k`` over a window is planned by Catalyst with a partial
WindowGroupLimit before the exchange and a final one after it, so each map task ships
at most k rows per group: a hot group cannot pile up in one task. Ties are broken by
the extra order columns (ids ascending), which makes the cut deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column | str],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Rows ranked 1..k within each group by ``order_cols``, with the rank in ``rank_col``."""
    if k < 1:
        raise ValueError("k must be positive")
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def top_n(df: DataFrame, order_cols: Sequence[Column | str], n: int) -> DataFrame:
    """Global top-n (TakeOrderedAndProject: per-partition top-n, then one merge of n rows each)."""
    return df.orderBy(*order_cols).limit(n)
