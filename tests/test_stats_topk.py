"""Aggregates, exact top-k per group, map sort, matrix statistics."""

import random

import pandas as pd
from pyspark.sql import functions as F

from cinemetrics.functions.columns import map_sort_by_value, sorted_entries_by_value
from cinemetrics.operators import genre_top, matrix, stats
from cinemetrics.operators.genres import genre_ratings
from cinemetrics.operators.topk import top_k

from conftest import movies_df, ratings_df


def _random_ratings(seed, users=40, movies=25, density=0.4):
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        for m in range(movies):
            if rnd.random() < density:
                rows.append((u, m, rnd.randint(1, 10) * 0.5, rnd.randint(0, 10**9)))
    return rows


def _movies(n=25):
    genres = ["Drama", "Comedy", "Crime", "Horror"]
    return [(m, f"Movie {m}", [genres[m % 4]] + (["Drama"] if m % 3 == 0 and m % 4 else [])) for m in range(n)]


def test_top_k_matches_naive(spark):
    rows = _random_ratings(1)
    df = ratings_df(spark, rows).groupBy("movie_id").agg(F.count("*").alias("n"))
    got = {(r.movie_id, r["rank"]) for r in top_k(df.withColumn("g", F.col("movie_id") % 3), ["g"], [F.desc("n"), "movie_id"], 3).collect()}
    pdf = pd.DataFrame(rows, columns=["u", "m", "r", "t"]).groupby("m").size().rename("n").reset_index()
    pdf["g"] = pdf.m % 3
    pdf = pdf.sort_values(["g", "n", "m"], ascending=[True, False, True])
    pdf["rank"] = pdf.groupby("g").cumcount() + 1
    want = {(int(r.m), int(r["rank"])) for _, r in pdf[pdf["rank"] <= 3].iterrows()}
    assert got == want


def test_top5_ties_lower_id_wins(spark):
    # genre X: users 1..7 with 2 ratings each except user 9 with 3: ranks 9, then 1..4
    rows = [(9, 100, 4.0), (9, 101, 4.0), (9, 102, 4.0)]
    rows += [(u, m, 3.0) for u in range(1, 8) for m in (100, 101)]
    r = ratings_df(spark, rows)
    mv = movies_df(spark, [(100, "a", ["X"]), (101, "b", ["X"]), (102, "c", ["X"])])
    top = genre_top.genre_top_users(r, mv).orderBy("rank").collect()
    assert [t.user_id for t in top] == [9, 1, 2, 3, 4]
    assert [t.rating_count for t in top] == [3, 2, 2, 2, 2]


def test_profile_matches_pandas(spark):
    rows = _random_ratings(2)
    r = ratings_df(spark, rows)
    mv = movies_df(spark, _movies())
    got = {(p.genre, p.user_id): p for p in genre_top.genre_top_users_profile(r, mv).collect()}
    pr = pd.DataFrame(rows, columns=["user_id", "movie_id", "rating", "ts"])
    pm = pd.DataFrame(_movies(), columns=["movie_id", "title", "genres"]).explode("genres").rename(columns={"genres": "genre"})
    gr = pr.merge(pm, on="movie_id")
    gu = gr.groupby(["genre", "user_id"]).rating.agg(["count", "mean"]).reset_index()
    gu = gu.sort_values(["genre", "count", "user_id"], ascending=[True, False, True])
    gu["rank"] = gu.groupby("genre").cumcount() + 1
    gu = gu[gu["rank"] <= 5]
    us = pr.groupby("user_id").rating.agg(["count", "mean"])
    assert len(got) == len(gu)
    for _, w in gu.iterrows():
        g = got[(w.genre, w.user_id)]
        assert g["rank"] == w["rank"] and g.genre_ratings == w["count"]
        assert abs(g.genre_avg_rating - w["mean"]) < 1e-12
        assert g.total_ratings == us.loc[w.user_id, "count"]
        assert abs(g.dataset_avg_rating - us.loc[w.user_id, "mean"]) < 1e-12


def test_genre_counts_sum_to_genre_ratings(spark):
    r = ratings_df(spark, _random_ratings(3))
    mv = movies_df(spark, _movies())
    gr = genre_ratings(r, mv)
    total = stats.genre_avg_rating(gr).agg(F.sum("rating_count")).first()[0]
    assert total == gr.count()


def test_genre_top_movies_order(spark):
    rows = [(u, 1, 4.0) for u in range(5)] + [(u, 2, 4.0) for u in range(5)] + [(u, 3, 4.0) for u in range(2)]
    r = ratings_df(spark, rows)
    mv = movies_df(spark, [(1, "a", ["X"]), (2, "b", ["X"]), (3, "c", ["X", "Y"]), (4, "unrated", ["X"])])
    got = [(t.genre, t["rank"], t.movie_id, t.rating_count) for t in genre_top.genre_top_movies(r, mv).orderBy("genre", "rank").collect()]
    assert got == [("X", 1, 1, 5), ("X", 2, 2, 5), ("X", 3, 3, 2), ("Y", 1, 3, 2)]


def test_map_sort_by_value(spark):
    df = spark.createDataFrame([({"b": 2.0, "a": 2.0, "c": 5.0, "d": 1.0},)], "m map<string,double>")
    row = df.select(
        sorted_entries_by_value("m").alias("e"), F.map_keys(map_sort_by_value("m")).alias("keys")
    ).first()
    assert [(e.key, e.value) for e in row.e] == [("c", 5.0), ("a", 2.0), ("b", 2.0), ("d", 1.0)]
    assert row["keys"] == ["c", "a", "b", "d"]  # Spark keeps entry order; collect() to a dict would not


def test_rating_map_projection(spark):
    r = ratings_df(spark, [(1, 10, 3.0), (2, 10, 4.5)])
    rows = stats.rating_map_projection(r).collect()
    assert sorted((x.movie_id, tuple(x.user_rating.items())) for x in rows) == [(10, ((1, 3.0),)), (10, ((2, 4.5),))]


def test_dataset_counts(spark):
    r = ratings_df(spark, [(1, 10, 3.0), (2, 10, 4.5), (2, 11, 1.0)])
    assert tuple(stats.dataset_counts(r).first()) == (3, 2, 2)


def test_matrix_stats(spark):
    r = ratings_df(spark, [(1, 10, 3.0), (2, 10, 4.5), (2, 11, 1.0), (3, 4, 2.0)])
    assert tuple(matrix.matrix_shape(r).first()) == (3, 12)
    cols = {x.movie_id: (x.num_nonzeros, x.norm_l1) for x in matrix.movie_column_stats(r).collect()}
    assert cols == {10: (2, 7.5), 11: (1, 1.0), 4: (1, 2.0)}
    mv = movies_df(spark, [(10, "Ten", ["X"]), (11, "Eleven", ["X"])])
    pop = [tuple(x) for x in matrix.popular_movies(r, mv, threshold=2).collect()]
    assert pop == [(10, "Ten", 2, 3.75)]


def test_unknown_movie_and_unrated_movie_leave_joins(spark):
    r = ratings_df(spark, [(1, 10, 3.0), (2, 99, 4.5)])  # movie 99 is not in movies
    mv = movies_df(spark, [(10, "Ten", ["X"]), (11, "Unrated", ["X"])])
    gr = [tuple(x) for x in genre_ratings(r, mv).collect()]
    assert gr == [("X", 1, 10, 3.0)]
    assert [x.movie_id for x in genre_top.genre_movie_counts(r, mv).collect()] == [10]


def test_movies_without_genres(spark):
    r = ratings_df(spark, [(1, 10, 3.0), (2, 11, 4.5)])
    mv = movies_df(spark, [(10, "Ten", []), (11, "Eleven", None)])
    assert genre_ratings(r, mv).count() == 0
    assert genre_top.genre_top_users_profile(r, mv).count() == 0
    assert genre_top.genre_top_movies(r, mv).count() == 0
