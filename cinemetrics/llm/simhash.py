"""SimHash near-dedup: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint is cut into five blocks. Two fingerprints that differ in at most two bits
agree on at least three whole blocks, so they share one of the ten choices of three blocks:
fingerprints are grouped on each choice and compared inside the group only.

Equal fingerprints are one node from the start, so exact copies never make pairs. A group
that holds many different fingerprints (a large family of near copies) is not compared pair
by pair: its fingerprints emit themselves and their 64 one-bit neighbours instead, and those
that meet at one value are within two bits of each other; conversely any two within two bits
meet at some value. That is exact, linear in the fingerprints, and at most 65 meet at a value.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle, unused
from cinemetrics.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
# bit offsets and widths of the five blocks of a 64-bit fingerprint
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
# groups with more different fingerprints than this take the neighbour path
PAIRWISE_LIMIT = 32
HASH_SEED = 42


def simhash64(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of one text (A-Z lower-cased, split at ASCII white space)."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, HASH_SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(col: str | Column, words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash64(t, words) for t in texts], dtype="int64")

    return simhash(col)


def _block_keys(fp: Column) -> Column:
    """The ten (choice, bits of the three chosen blocks) keys of a fingerprint."""
    keys = []
    for n, chosen in enumerate(combinations(BLOCKS, 3)):
        mask = sum(((1 << width) - 1) << offset for offset, width in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).alias("_choice"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("_bits")))
    return F.inline(F.array(*keys))


def close_pairs(fingerprints: DataFrame, max_bits: int = MAX_BITS, limit: int = PAIRWISE_LIMIT) -> DataFrame:
    """(a, b): links between different fingerprints (column ``fp``, distinct) that connect
    exactly those at ``max_bits`` (at most 2) or fewer differing bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("five blocks and one-bit neighbours serve at most two differing bits")
    keyed = fingerprints.select("fp", _block_keys(F.col("fp")))
    sizes = keyed.groupBy("_choice", "_bits").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    shared = settle(keyed.join(sizes, ["_choice", "_bits"]))

    groups = shared.where(F.col("_n") <= limit).groupBy("_choice", "_bits").agg(F.collect_list("fp").alias("_fps"))
    pairs = F.flatten(
        F.transform(
            "_fps",
            lambda x: F.transform(
                F.filter("_fps", lambda y: (x < y) & (F.bit_count(x.bitwiseXOR(y)) <= max_bits)),
                lambda y: F.struct(x.alias("a"), y.alias("b")),
            ),
        )
    )
    direct = groups.select(F.inline(pairs))

    crowded = shared.where(F.col("_n") > limit).select("fp").distinct()
    if max_bits == 0:
        return direct.distinct()
    flips = F.array(*[F.lit((1 << i) if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    around = crowded.select("fp", F.explode(F.transform(flips, lambda m: m.bitwiseXOR(F.col("fp")))).alias("_at"))
    met = around.unionByName(crowded.select("fp", F.col("fp").alias("_at")))
    if max_bits == 1:
        met = met.join(crowded.select(F.col("fp").alias("_at")), "_at")
        through = met.where(F.col("fp") < F.col("_at")).select(F.col("fp").alias("a"), F.col("_at").alias("b"))
    else:
        near = met.groupBy("_at").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("_fps"))
        through = near.where(F.size("_fps") > 1).select("a", F.explode("_fps").alias("b")).where(F.col("a") < F.col("b"))
    return direct.unionByName(through).distinct()


def simhash_components(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id among the documents reachable over links of
    ``max_bits`` or fewer differing bits. Null and empty texts have fingerprint 0 and are
    linked like any other. A text with fewer words than ``words`` is one shingle. Null ids
    are never the smallest; a component with null ids only has a null component_id. Rows
    that repeat an id keep one row each. Other columns of ``docs`` are not read.
    """
    prints = settle(docs.select("doc_id", fingerprint("text", words).alias("fp")))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    component = connected_components(close_pairs(nodes.select("fp"), max_bits), "a", "b")
    named = nodes.join(component, nodes["fp"] == component["node"], "left").select(
        "fp", "_least", F.coalesce("component", "fp").alias("_root")
    )
    roots = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    labels = named.join(roots, "_root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(labels, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def simhash_dedup(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Of rows that repeat the kept id one stays (the smallest text); in a component without
    any id one row of each fingerprint stays.
    """
    groups = simhash_components(docs, words, max_bits)
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # an id kept once needs no further choice; only repeated and null ids are grouped by whole rows
    ids = stay.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    ids = ids.withColumnRenamed("doc_id", "_stay")
    kept = docs.join(ids, docs["doc_id"] == ids["_stay"])
    columns = [docs[f"`{c}`"] for c in docs.columns]
    single = kept.where(ids["_rows"] == 1).select(*columns)
    repeated = kept.where(ids["_rows"] > 1).select(*columns)
    named, row, fp = [F.col(f"`{c}`") for c in docs.columns], unused(docs, "_row"), unused(docs, "_fp")
    least = F.min_by(F.struct(*named), F.struct("text", F.xxhash64(*named))).alias(row)
    chosen = repeated.groupBy("doc_id").agg(least).select(f"{row}.*")
    prints = stay.where(F.col("doc_id").isNull()).select(F.col("fp").alias(fp)).distinct()
    nameless = docs.where(F.col("doc_id").isNull()).withColumn(fp, fingerprint("text", words)).join(prints, fp)
    nameless = nameless.groupBy(fp).agg(least).select(f"{row}.*")
    return single.unionByName(chosen).unionByName(nameless)
