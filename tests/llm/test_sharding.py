"""Sharding: near-equal bytes, gapless slots, overfull ranges, defined results."""

import random
import zlib
from collections import defaultdict

import pytest

from cinemetrics.llm import sharding


def check(rows, found, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None
    )
    assert len(found) == len(rows)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if rows:
        share, largest = sum(sizes.values()) / shards, max(r.size for r in found)
        assert all(abs(sizes[k] - share) <= largest + 1 for k in range(shards))


@pytest.mark.parametrize("shards", [3, 16])
def test_random_sizes(spark, shards):
    rnd = random.Random(shards)
    rows = [(i, "x" * int(rnd.paretovariate(1.1) * 20) + str(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(rows, sharding.assign_shards(df, shards).collect(), shards)


def test_a_third_of_the_rows_are_one_text_and_a_third_one_row(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLE_PER_RANGE", 1)  # poor first boundaries
    rows = [(i, "the same text") for i in range(1000)] + [(7, "one row")] * 1000 + [(5000 + i, f"text {i}" * 9) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sharding.assign_shards(df, 16).collect()
    check(rows, found, 16)
    assert len({r.shard for r in found if r.text_crc32 == zlib.crc32(b"one row")}) > 1


def test_one_huge_record_nulls_and_few_rows(spark):
    rows = [(1, "y" * 500_000), (2, None), (3, ""), (None, "no id"), (None, None), (4, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.assign_shards(df, 16).collect()
    check(rows, found, 16)
    assert {(r.doc_id, r.size) for r in found} == {(1, 500_001), (2, 1), (3, 1), (None, 6), (None, 1), (4, 3)}


def test_empty_table(spark):
    assert sharding.assign_shards(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_written_shards(spark, tmp_path):
    rows = [(i, f"text {i}" * (i % 9)) for i in range(200)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    sharding.write_shards(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.doc_id, r.text) for r in back) == rows and {r.shard for r in back} == {0, 1, 2, 3}
