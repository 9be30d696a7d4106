"""Sharding by sampled splitters: shards of nearly equal bytes, without moving any text.

The sort key is the hash of the text, the hash of the id, and a row number, so copies of a
text lie together and any range of rows can be cut. Keys are drawn with probability in
proportion to their size, weighted quantiles of the sample are the boundaries of many more
ranges than shards, and each record is assigned to its range. Ranges that come out overfull
are subdivided by another sample drawn inside them. Exact totals per range then give every
range its place, one window per range gives every record its place, and shards are cut at
equal shares of the bytes.

The driver holds sampled keys, boundaries and totals of at most ``MAX_RANGES`` ranges.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle, text_or_empty

SHARDS = 16
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 250_000
MAX_RANGES = 65_536
# sampled keys per range (expected)
SAMPLE_PER_RANGE = 32
# a range with this many times its share of bytes or rows is subdivided
OVERFULL = 3.0
KEY_BYTES = 24


def _hex64(h: Column) -> Column:
    return F.lpad(F.hex(h), 16, "0")


def _keyed(docs: DataFrame, carry: list[str]) -> DataFrame:
    """doc_id, size, text_crc32, carried columns and the unique sort key, settled once."""
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.concat(_hex64(F.xxhash64(text)), _hex64(F.xxhash64("doc_id")), _hex64(F.monotonically_increasing_id()))).alias("_key"),
        *[F.col(f"`{c}`").alias(f"_carry_{c}") for c in carry],
    )
    return settle(rows)


def _range_of(boundaries: list[bytes]):
    splitters = np.array(boundaries, dtype=f"S{KEY_BYTES}")

    @F.pandas_udf("int")
    def range_number(keys: pd.Series) -> pd.Series:
        at = np.searchsorted(splitters, np.array(list(keys), dtype=f"S{KEY_BYTES}"), side="right")
        return pd.Series(at.astype("int32"))

    return range_number(F.col("_key"))


def _sample(rows: DataFrame, keys_per_byte: Column, salt: int) -> list[tuple[bytes, float]]:
    """Sampled (key, weight), by key: drawn with probability min(1, size * keys_per_byte)."""
    expected = F.col("size") * keys_per_byte
    draw = F.pmod(F.xxhash64("_key", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where(draw < expected).select("_key", F.greatest(expected, F.lit(1.0)).alias("w")).collect()
    return sorted((bytes(r["_key"]), r["w"]) for r in drawn)


def _quantiles(sample: list[tuple[bytes, float]], ranges: int) -> list[bytes]:
    total, seen, cut, out = sum(w for _, w in sample), 0.0, 1, []
    for key, w in sample:
        seen += w
        if cut < ranges and seen >= total * cut / ranges:
            out.append(key)
            while cut < ranges and seen >= total * cut / ranges:
                cut += 1
    return out


def _totals(rows: DataFrame, boundaries: list[bytes]) -> dict[int, tuple[int, int]]:
    ranged = rows.select(_range_of(boundaries).alias("_range"), "size")
    sums = ranged.groupBy("_range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    return {r["_range"]: (r["b"], r["n"]) for r in sums}


def assign_shards(docs: DataFrame, shards: int = SHARDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard[, carried columns]), one row per
    row of ``docs`` (doc_id, text).

    law is ``bytes``: size is the UTF-8 length of the text plus 1, and the shards' sizes differ
    by little more than the largest record. slot counts a shard's records gapless from 0 in key
    order. grown_shard is null (it belongs to another law).

    Null text counts as empty. Null and repeated ids, and repeated rows, are placed row by row.
    Empty table: empty result. Fewer rows than shards leave shards empty. ``carry`` names
    further columns to keep (not the names above).
    """
    rows = _keyed(docs, list(carry))
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 1
    ranges = min(MAX_RANGES, max(shards * RANGES_PER_SHARD, -(-count // ROWS_PER_RANGE)))
    boundaries = _quantiles(_sample(rows, F.lit(ranges * SAMPLE_PER_RANGE / total), 0), ranges)
    totals = _totals(rows, boundaries)
    for salt in range(1, 9):
        full = {
            r: max(b * ranges / total, n * ranges / count)
            for r, (b, n) in totals.items()
            if n > 1 and max(b * ranges / total, n * ranges / count) > OVERFULL
        }
        if not full or len(boundaries) >= 4 * MAX_RANGES:
            break
        # inside an overfull range, rows are drawn evenly: it may be rows that it has too many of
        ranged = rows.withColumn("_range", _range_of(boundaries))
        share = F.create_map(*[F.lit(x) for r, over in full.items() for x in (r, min(1.0, SAMPLE_PER_RANGE * over / totals[r][1]))])
        inside = ranged.where(F.col("_range").isin(*full)).withColumn("_share", share[F.col("_range")])
        draw = F.pmod(F.xxhash64("_key", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
        found: dict[int, list[bytes]] = {}
        for r in inside.where(draw < F.col("_share")).select("_range", "_key").collect():
            found.setdefault(r["_range"], []).append(bytes(r["_key"]))
        more = {k for r, keys in found.items() for k in _quantiles([(k, 1.0) for k in sorted(keys)], int(full[r]) + 1)}
        if more <= set(boundaries):
            break
        boundaries = sorted(more | set(boundaries))
        totals = _totals(rows, boundaries)

    spark = docs.sparkSession
    places, before_b, before_n = [], 0, 0
    for r in sorted(totals):
        places.append((r, before_b, before_n))
        before_b, before_n = before_b + totals[r][0], before_n + totals[r][1]
    place = spark.createDataFrame(places, "_range int, _bytes_before long, _rows_before long")
    order = Window.partitionBy("_range").orderBy("_key")
    placed = rows.withColumn("_range", _range_of(boundaries)).join(F.broadcast(place), "_range")
    start = F.col("_bytes_before") + F.sum("size").over(order) - F.col("size")
    row = F.col("_rows_before") + F.row_number().over(order) - 1
    middle = (2 * start + F.col("size")) * shards
    cut = settle(
        placed.select(
            *rows.columns, row.alias("_row"), F.least(F.call_function("div", middle, F.lit(2 * total)), F.lit(shards - 1)).cast("int").alias("shard")
        )
    )
    first = cut.groupBy("shard").agg(F.min("_row").alias("_first"))  # as many rows as shards
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_carry_{c}").alias(c) for c in carry],
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write doc_id and text of every row as Parquet, one folder per shard, rows by slot."""
    placed = assign_shards(docs, shards, carry=("text",))
    ranged = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.select("shard", "slot", "doc_id", "text").write.mode("overwrite").partitionBy("shard").parquet(path)
