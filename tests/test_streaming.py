"""Streaming genre statistics: incremental over arriving files, resumes from its checkpoint."""

from cinemetrics.operators import stats
from cinemetrics.operators.genres import genre_ratings
from cinemetrics.streaming.genre_stats import start_genre_avg

from conftest import movies_df, ratings_df


def _drop(tmp_path, name, rows):
    text = "userId,movieId,rating,timestamp\n" + "".join(f"{u},{m},{r},{t}\n" for u, m, r, t in rows)
    (tmp_path / "in" / name).write_text(text)


def test_incremental_and_resume(spark, tmp_path):
    (tmp_path / "in").mkdir()
    movies = movies_df(spark, [(1, "a", ["X", "Y"]), (2, "b", ["Y"]), (3, "c", ["Z"])])
    batches = [
        [(1, 1, 4.0, 10), (2, 1, 2.0, 11)],
        [(1, 2, 5.0, 12), (3, 3, 1.5, 13)],
        [(4, 1, 3.5, 14), (4, 2, 0.5, 15), (5, 9, 5.0, 16)],  # movie 9 has no genre
    ]
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    _drop(tmp_path, "a.csv", batches[0])
    _drop(tmp_path, "b.csv", batches[1])
    q = start_genre_avg(spark, str(tmp_path / "in"), movies, out, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    first = {r.genre: (r.avg_rating, r.rating_count) for r in spark.read.parquet(out).collect()}
    assert first == {"X": (3.0, 2), "Y": (11.0 / 3, 3), "Z": (1.5, 1)}

    _drop(tmp_path, "c.csv", batches[2])
    q = start_genre_avg(spark, str(tmp_path / "in"), movies, out, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    got = {r.genre: (r.avg_rating, r.rating_count) for r in spark.read.parquet(out).collect()}

    everything = ratings_df(spark, [row for b in batches for row in b])
    want = {r.genre: (r.avg_rating, r.rating_count) for r in stats.genre_avg_rating(genre_ratings(everything, movies)).collect()}
    assert got == want


def test_a_malformed_row_fails_the_stream_and_leaves_the_result(spark, tmp_path):
    import pytest

    (tmp_path / "in").mkdir()
    movies = movies_df(spark, [(1, "a", ["X"])])
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    _drop(tmp_path, "a.csv", [(1, 1, 4.0, 10)])
    start_genre_avg(spark, str(tmp_path / "in"), movies, out, ckpt).awaitTermination()
    _drop(tmp_path, "b.csv", [("who", 1, 2.0, "when")])  # neither field is used by the query
    q = start_genre_avg(spark, str(tmp_path / "in"), movies, out, ckpt)
    with pytest.raises(Exception, match="malformed CSV row"):
        q.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("X", 4.0, 1)]
