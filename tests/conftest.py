import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cinemetrics.session import local_session

    s = local_session("*", shuffle_partitions=8, app="cinemetrics-tests")
    yield s
    s.stop()


def ratings_df(spark, rows):
    """rows: (user_id, movie_id, rating[, ts])"""
    rows = [tuple(r) + (0,) * (4 - len(r)) for r in rows]
    return spark.createDataFrame(
        [(int(u), int(m), float(r), int(t)) for u, m, r, t in rows],
        "user_id long, movie_id long, rating double, ts long",
    )


def my_movies_df(spark, rows):
    return spark.createDataFrame([(int(m), float(r)) for m, r in rows], "movie_id long, my_rating double")


def movies_df(spark, rows):
    """rows: (movie_id, title, [genres])"""
    return spark.createDataFrame(rows, "movie_id long, title string, genres array<string>")
