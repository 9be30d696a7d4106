"""Broadcast behind a size check.

A side is broadcast only after a distributed aggregate has measured that its rows take at
most ``max_bytes``; beyond that the join stays a shuffle join (adaptive execution may still
demote it to a broadcast from runtime statistics, and splits skewed partitions).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BYTES_CONF = "cinemetrics.broadcast.maxBytes"
DEFAULT_MAX_BYTES = 128 << 20
# width of a fixed-size field, and what a row costs beside its fields (header, hash table entry)
FIELD_BYTES = 8
ROW_BYTES = 48

# measured sizes of this session's dimensions, by plan; bounded, oldest out first
_MEASURED: dict[tuple[str, int], int] = {}
_REMEMBERED = 64


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get(MAX_BYTES_CONF, None)
    return int(conf) if conf else DEFAULT_MAX_BYTES


def _width(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 2 * FIELD_BYTES
    if isinstance(kind, T.ArrayType):
        each = F.transform(col, lambda x: _width(x, kind.elementType).cast("long"))
        return F.coalesce(F.aggregate(each, F.lit(0).cast("long"), lambda n, x: n + x), F.lit(0)) + 3 * FIELD_BYTES
    if isinstance(kind, (T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(col)), F.lit(0)) * 2
    return F.lit(FIELD_BYTES)


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take in memory: counted and added up in the tasks, one
    number per task reaches the final step; measured once per plan and session."""
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash())
    if key not in _MEASURED:
        row = F.lit(ROW_BYTES).cast("long")
        for f in df.schema.fields:
            row = row + _width(F.col(f"`{f.name}`"), f.dataType)
        while len(_MEASURED) >= _REMEMBERED:
            _MEASURED.pop(next(iter(_MEASURED)))
        _MEASURED[key] = df.agg(F.sum(row)).first()[0] or 0
    return _MEASURED[key]


def broadcast_if_bounded(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when its size is measured to be small, else ``df`` unchanged."""
    return broadcast_hint_for(df, max_bytes)(df)


def broadcast_hint_for(df: DataFrame, max_bytes: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """Measure ``df`` once; return ``F.broadcast`` when it is small, else the identity.

    Apply the returned hint only to projections and filters of ``df`` (never larger than
    ``df``), so one measurement serves every join side cut from the same input.
    """
    bound = broadcast_limit(df) if max_bytes is None else max_bytes
    return F.broadcast if measured_bytes(df) <= bound else _identity


def _identity(df: DataFrame) -> DataFrame:
    return df
