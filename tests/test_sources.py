"""CSV sources and sinks on inline rows (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from cinemetrics.sources import csv as csv_src
from cinemetrics.sources.sinks import read_result, write_result


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


MOVIES = (
    "movieId,title,genres\n"
    "1,Plain Title (2001),One|Two|Three|Four|Five\n"
    '70123,"Quiet Harbour, A (2003)",Two|Six\n'
    '3,"A ""Q"" B",(no genres listed)\n'
    "4,NoGenre,\n"
    "5,Trail,A|\n"
)


def test_movies_csv_quotes_and_genres(spark, tmp_path):
    path = _write(tmp_path, "movies.csv", MOVIES)
    rows = {r.movie_id: r for r in csv_src.read_movies_csv(spark, path).collect()}
    assert rows[1].genres == ["One", "Two", "Three", "Four", "Five"]
    assert rows[70123].title == "Quiet Harbour, A (2003)"
    assert rows[70123].genres == ["Two", "Six"]
    assert rows[3].title == 'A "Q" B'
    assert rows[3].genres == ["(no genres listed)"]
    assert not rows[4].genres  # NULL field: no genre row after explode
    assert rows[5].genres == ["A"]


def test_movie_genres_explode_drops_empty(spark, tmp_path):
    from cinemetrics.operators.genres import movie_genres

    path = _write(tmp_path, "movies.csv", MOVIES)
    mg = movie_genres(csv_src.read_movies_csv(spark, path))
    per_movie = {r.movie_id: r.n for r in mg.groupBy("movie_id").agg(F.count("*").alias("n")).collect()}
    assert per_movie == {1: 5, 70123: 2, 3: 1, 5: 1}


def test_ratings_csv_strict_and_tolerant(spark, tmp_path):
    text = "userId,movieId,rating,timestamp\n1,88,3.5,1000000018\n1,89,x,1000000019\n2,88,4.5,1000000020\n"
    path = _write(tmp_path, "ratings.csv", text)
    tolerant = sorted(tuple(r) for r in csv_src.read_ratings_tolerant(spark, path).collect())
    assert tolerant == [(88, 3.5), (88, 4.5)]
    with pytest.raises(Exception):
        csv_src.read_ratings_csv(spark, path).collect()
    good = _write(tmp_path, "good.csv", "userId,movieId,rating,timestamp\n1,88,3.5,1000000018\n")
    r = csv_src.read_ratings_csv(spark, good).first()
    assert (r.user_id, r.movie_id, r.rating, r.ts) == (1, 88, 3.5, 1000000018)
    assert r.ts % 10 == 8


def test_my_movies_one_row_per_movie_last_wins(spark, tmp_path):
    path = _write(tmp_path, "my_movies.csv", "movieId,rating\n10,4.0\n11,2.0\n10,5.0\n")
    rows = dict(tuple(r) for r in csv_src.read_my_movies_csv(spark, path).collect())
    assert rows == {10: 5.0, 11: 2.0}


def test_my_movies_over_several_files(spark, tmp_path):
    folder = tmp_path / "my_movies"
    folder.mkdir()
    _write(folder, "a.csv", "movieId,rating\n10,1.0\n")
    _write(folder, "b.csv", "movieId,rating\n" + "".join(f"{i},2.0\n" for i in range(100, 400)) + "10,5.0\n")
    rows = dict(tuple(r) for r in csv_src.read_my_movies_csv(spark, str(folder)).collect())
    assert rows[10] == 5.0 and len(rows) == 301


@pytest.mark.parametrize("bad", ["1,88,x,1000000018", "1,88", "1,88,3.5,1000000018,9", ",88,3.5,1000000018"])
def test_strict_reading_fails_whatever_the_query_uses(spark, tmp_path, bad):
    path = _write(tmp_path, "ratings.csv", f"userId,movieId,rating,timestamp\n3,4,5.0,1000000018\n{bad}\n")
    strict = csv_src.read_ratings_csv(spark, path)
    for query in (strict, strict.select("movie_id"), strict.groupBy("movie_id").count()):
        with pytest.raises(Exception, match="malformed CSV row"):
            query.collect()
    with pytest.raises(Exception, match="malformed CSV row"):
        strict.count()
    assert csv_src.read_ratings_csv(spark, path, mode="DROPMALFORMED").count() == 1


def test_exports_are_written_once_and_scratch_goes_with_the_session(tmp_path):
    import os
    import subprocess
    import sys

    code = """
import sys; sys.path.insert(0, %r)
from cinemetrics.session import local_session
from cinemetrics.plans import catalog
spark = local_session(2)
sf = "/root/testdata/sf0.001"
a = catalog._csv_export(spark, sf, "x", catalog.fixtures.ratings)
b = catalog._csv_export(spark, sf, "x", catalog.fixtures.ratings)
assert a == b and catalog.ratings_scan(spark, sf).count() == catalog.ratings_scan(spark, sf).count()
print("FOLDER", a)
spark.stop()
""" % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    folder = [x.split(" ", 1)[1] for x in out.stdout.splitlines() if x.startswith("FOLDER")]
    assert folder, out.stderr[-2000:]
    scratch = os.path.dirname(folder[0].removeprefix("file:"))
    assert os.path.basename(scratch).startswith("scratch-") and not os.path.exists(scratch)


def test_personal_ratings_modes(spark, tmp_path):
    path = _write(tmp_path, "personal.txt", "0,1,4.0\n0,2,bad\n0,3,2.5\n")
    with pytest.raises(Exception):
        csv_src.read_personal_ratings_csv(spark, path).collect()
    rows = sorted(tuple(r) for r in csv_src.read_personal_ratings_csv(spark, path, mode="DROPMALFORMED").collect())
    assert rows == [(0, 1, 4.0), (0, 3, 2.5)]


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_sink_roundtrip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("Crime", 3.25, 4), ("Drama, Old", 2.0, 1)], "genre string, avg_rating double, n long")
    path = str(tmp_path / f"out_{fmt}")
    write_result(df, path, fmt=fmt, single_file=True)
    back = read_result(spark, path, df.schema, fmt=fmt)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    write_result(df.limit(1), path, fmt=fmt)  # overwrite
    assert read_result(spark, path, df.schema, fmt=fmt).count() == 1


def test_sink_rejects_unknown_format(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(ValueError):
        write_result(df, str(tmp_path / "x"), fmt="xml")


BAD = (
    "userId,movieId,rating,timestamp\n"
    "1,88,3.5,100\n1,89,x,101\n,90,4.0,102\n2,91,4.5\n3,92,1.0,103,9\n4,93,,104\n5,abc,2.0,1.5\n6,94,0.5,105\n"
)


def test_rejected_rows_with_reason_and_counts(spark, tmp_path):
    path, out = _write(tmp_path, "ratings.csv", BAD), str(tmp_path / "parsed")
    parsed = csv_src.parse_ratings_csv(spark, path, out)
    assert (parsed.n_accepted, parsed.n_rejected) == (2, 6)
    assert sorted(map(tuple, parsed.accepted.collect())) == [(1, 88, 3.5, 100), (6, 94, 0.5, 105)]
    assert parsed.accepted.schema.simpleString() == csv_src.RATINGS_SCHEMA.simpleString()
    got = {(r.movie_id, r.rating): r.reason for r in parsed.rejected.collect()}
    assert got[("89", "x")] == "rating does not parse"
    assert got[("90", "4.0")] == "user_id is missing"
    assert got[("93", None)] == "rating is missing"
    assert got[("abc", "2.0")] == "movie_id does not parse"
    short = [r for r in parsed.rejected.collect() if r.reason == "wrong number of fields"]
    assert sorted(r.line for r in short) == ["2,91,4.5", "3,92,1.0,103,9"]
    lenient = csv_src.parse_csv(spark, path, csv_src.RATINGS_SCHEMA, str(tmp_path / "lenient"), required=["movie_id"])
    assert (lenient.n_accepted, lenient.n_rejected) == (4, 4)


def test_parsed_files_without_rows_of_one_kind(spark, tmp_path):
    good = _write(tmp_path, "good.csv", "1,88,3.5\n2,89,4.0\n")
    parsed = csv_src.parse_personal_ratings_csv(spark, good, str(tmp_path / "a"))
    assert (parsed.n_accepted, parsed.n_rejected, parsed.accepted.count(), parsed.rejected.count()) == (2, 0, 2, 0)
    bad = _write(tmp_path, "bad.csv", "1;88;3.5\n")
    parsed = csv_src.parse_personal_ratings_csv(spark, bad, str(tmp_path / "a"))  # replaces the first
    assert (parsed.n_accepted, parsed.n_rejected, parsed.accepted.count(), parsed.rejected.count()) == (0, 1, 0, 1)
    empty = csv_src.parse_personal_ratings_csv(spark, _write(tmp_path, "none.csv", ""), str(tmp_path / "b"))
    assert (empty.n_accepted, empty.n_rejected, empty.accepted.count()) == (0, 0, 0)


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_failing_job_leaves_the_earlier_result(spark, tmp_path, fmt):
    path = str(tmp_path / "result")
    first = spark.range(100).withColumn("x", F.col("id") * 2)
    write_result(first, path, fmt=fmt)
    fails = F.when(F.col("id") == 977, F.raise_error(F.lit("midway"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="midway"):
        write_result(spark.range(0, 1000, 1, 8).withColumn("x", fails.cast("long")), path, fmt=fmt)
    assert read_result(spark, path, first.schema, fmt=fmt).count() == 100
    assert [p.name for p in tmp_path.iterdir()] == ["result"]


def test_a_result_may_replace_its_own_input(spark, tmp_path):
    path = str(tmp_path / "deep" / "result")
    write_result(spark.range(10), path)
    write_result(spark.read.parquet(path).where("id < 4"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3]
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["result"]


def test_own_lines_listed_twice_need_no_single_task(spark, tmp_path):
    from cinemetrics.sources import fixtures

    from conftest import SF_SMALL

    lines = fixtures.my_movies_lines(spark, SF_SMALL)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "Repartition 1," not in plan
    path = str(tmp_path / "mine.csv")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_result(lines, path, fmt="csv")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {r.movie_id: r.my_rating for r in fixtures.my_movies(fixtures.part_ratings(spark, SF_SMALL)).collect()}
    assert len(list((tmp_path / "mine.csv").glob("part-*"))) > 1
    assert {r.movie_id: r.my_rating for r in csv_src.read_my_movies_csv(spark, path).collect()} == want
