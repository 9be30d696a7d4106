"""The six jobs end to end on CSV inputs written from the sf0.001 tables."""

import os

import pytest

from cinemetrics.plans import catalog, jobs
from cinemetrics.sources import fixtures
from cinemetrics.sources.sinks import write_result

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("ml")
    write_result(fixtures.ratings(spark, SF_SMALL), str(d / "ratings.csv"), fmt="csv", single_file=True)
    write_result(fixtures.movies_text(spark, SF_SMALL), str(d / "movies.csv"), fmt="csv", single_file=True)
    write_result(fixtures.part_ratings(spark, SF_SMALL), str(d / "parts" / "ratings.csv"), fmt="csv", single_file=True)
    parts = fixtures.part_movies(spark, SF_SMALL).selectExpr("movie_id", "title", "array_join(genres, '|') AS genres")
    write_result(parts, str(d / "parts" / "movies.csv"), fmt="csv", single_file=True)
    write_result(fixtures.my_movies_lines(spark, SF_SMALL), str(d / "my_movies.csv"), fmt="csv")
    personal = fixtures.personal_ratings(fixtures.part_ratings(spark, SF_SMALL)).selectExpr("0L AS user_id", "movie_id", "rating")
    personal.coalesce(1).write.mode("overwrite").csv(str(d / "personal"))
    return d


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_genre_user_statistics(spark, inputs, tmp_path):
    out = jobs.genre_user_statistics(spark, str(inputs), str(tmp_path))
    for name in (jobs.OUT_TOP5_BY_GENRE, jobs.OUT_TOTAL_BY_USER, jobs.OUT_AVERAGE_BY_GENRE, jobs.OUT_AVERAGE_BY_DATASET):
        assert os.path.isdir(tmp_path / name)
    want = _rows(catalog.genre_top5_users_total(spark, SF_SMALL))
    assert _rows(out[jobs.OUT_TOTAL_BY_USER]) == want


def test_movie_prediction(spark, inputs, tmp_path):
    top = jobs.movie_prediction(spark, str(inputs / "parts"), str(inputs / "my_movies.csv"), str(tmp_path))
    assert _rows(top) == _rows(catalog.top50_predicted(spark, SF_SMALL))
    assert os.path.isdir(tmp_path / jobs.OUT_TOP50_PREDICTED)


def test_genre_jobs(spark, inputs, tmp_path):
    assert _rows(jobs.genre_top_movies(spark, str(inputs), str(tmp_path))) == _rows(catalog.genre_top5_movies(spark, SF_SMALL))
    assert _rows(jobs.genre_average(spark, str(inputs), str(tmp_path))) == _rows(catalog.genre_avg_rating(spark, SF_SMALL))


def test_matrix_statistics(spark, inputs):
    out = jobs.matrix_statistics(spark, str(inputs), threshold=130)
    assert _rows(out["shape"]) == _rows(catalog.matrix_shape(spark, SF_SMALL))
    assert out["popular"].count() > 0


def test_als_recommendation(spark, inputs):
    out = jobs.als_recommendation(spark, str(inputs / "parts"), str(inputs / "personal"), ranks=(4,), reg_params=(0.1,), max_iters=(5,))
    assert out["validation"].count() == 1
    recs = out["recommendations"].collect()
    assert 0 < len(recs) <= 50
