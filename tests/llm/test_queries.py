"""The registered queries: SQL side by side where there is SQL, the pipeline stage by stage."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cinemetrics.llm import decontaminate, line_dedup, simhash
from cinemetrics.llm.queries import ORACLE_SQL, QUERIES
from conftest import SF_SMALL
from oracle_compare import compare, duck


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing",
    ]


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key):
    ok, message = compare(spark, SF_SMALL, key, QUERIES[key], ORACLE_SQL[key], duck(SF_SMALL))
    assert ok, message


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    extra = spark.createDataFrame([(90001, "12 34 !!", "en", "s", 8), (90002, None, None, "s", None)], docs.schema)
    stage = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    kept = stage["language_id"](spark, docs.unionByName(extra), SF_SMALL).cache()
    assert kept.columns == columns
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))

    lines = stage["line_dedup"](spark, kept, SF_SMALL).cache()
    want = {r.doc_id: r.text for r in line_dedup.line_dedup(kept).collect()}
    assert lines.columns == columns and {r.doc_id: r.text for r in lines.collect()} == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    near = stage["simhash_near_dedup"](spark, lines, SF_SMALL).cache()
    groups = simhash.simhash_components(lines).collect()
    assert near.columns == columns
    assert sorted(r.doc_id for r in near.collect()) == sorted({r.component_id for r in groups})

    clean = stage["benchmark_decontamination"](spark, near, SF_SMALL).cache()
    bad = {r.doc_id for r in decontaminate.contaminated(near, bench).collect()}
    assert clean.columns == columns and bad
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in near.collect()} - bad

    packed = stage["best_fit_packing"](spark, clean, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}
    assert sum(r.length for r in packed) == sum(len(r.ids) for r in packed)

    whole = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)
