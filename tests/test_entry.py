"""Driver contract: entry smoke, registry, and every SQL-checked key against DuckDB at sf0.001."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as entry_mod
from cinemetrics.plans import catalog, oracle

ROWS_ONLY = {"als_validation_error", "als_test_error", "als_recommendations"}


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == [
        "genre", "rank", "user_id", "genre_ratings", "genre_avg_rating", "total_ratings", "dataset_avg_rating",
    ]
    assert len(rows) > 0


def test_registry_has_oracle_for_relational_keys():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert set(catalog.QUERIES) - set(oracle.oracle_sql()) == ROWS_ONLY


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, SF_SMALL, key, entry_mod.queries()[key], entry_mod.oracle_sql()[key], con)
    assert ok, msg


def _keys_without(blocked):
    """The registered keys when ``blocked`` cannot be imported."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry_mod.__file__))
    code = f"""
import sys; sys.path.insert(0, {root!r})
sys.modules.update(dict.fromkeys({blocked!r}))  # None there makes the import fail
import __spark_entry__ as e
print("KEYS", *sorted(e.queries()))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    return set(next(x for x in out.stdout.splitlines() if x.startswith("KEYS")).split()[1:])


def test_keys_of_the_library_survive_failing_imports():
    library = set(catalog.QUERIES)
    assert _keys_without(["ahocorasick"]) >= library
    assert _keys_without(["cinemetrics.llm"]) == library
    assert _keys_without(["corpus_pipeline"]) == set(entry_mod.queries()) - {"pipeline"}
