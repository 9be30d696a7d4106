"""Adjusted cosine and kNN prediction against a brute force of the stated rules.

The brute force below builds all user pairs, assigns roles, computes the similarity per
pair and, per predicted movie, fills every own movie without a pair with -1.0, sorts
undefined (NaN) first, takes 10 and forms the weighted mean (NaN -> -1000).
"""

import math
import random
from collections import defaultdict

import pytest

from cinemetrics.operators import knn, similarity

from conftest import movies_df, my_movies_df, ratings_df


def brute_force(ratings, mine, k=10):
    by_user = defaultdict(list)
    for u, m, r in ratings:
        by_user[u].append((m, r))
    avg = {u: sum(r for _, r in v) / len(v) for u, v in by_user.items()}
    groups = defaultdict(list)
    for u, items in by_user.items():
        for m1, r1 in items:
            for m2, r2 in items:
                if m1 < m2 and (m1 in mine or m2 in mine):
                    own, pred, ro, rp = (m1, m2, r1, r2) if m1 in mine else (m2, m1, r2, r1)
                    groups[(own, pred)].append((u, ro, rp))
    sims = {}
    for key, lst in groups.items():
        num = a = b = 0.0
        for u, ro, rp in lst:
            dx, dy = ro - avg[u], rp - avg[u]
            num += dx * dy
            a += dx * dx
            b += dy * dy
        den = math.sqrt(a) * math.sqrt(b)
        sims[key] = round(num / den, 9) if den != 0 else float("nan")
    preds = {}
    for pred in {p for _, p in sims}:
        cand = [(m, sims.get((m, pred), -1.0)) for m in mine]
        cand.sort(key=lambda c: (0, 0.0, c[0]) if math.isnan(c[1]) else (1, -c[1], c[0]))
        top = cand[:k]
        num = sum(s * mine[m] for m, s in top)
        den = sum(abs(s) for _, s in top)
        p = num / den if den != 0 else float("nan")
        preds[pred] = -1000.0 if math.isnan(p) else p
    return groups, sims, preds


def _random_case(seed, users, movies, own, density):
    rnd = random.Random(seed)
    ratings = [
        (u, m, rnd.randint(1, 10) * 0.5) for u in range(users) for m in range(movies) if rnd.random() < density
    ]
    own_ids = sorted(rnd.sample(range(movies), own))
    mine = {m: rnd.randint(1, 10) * 0.5 for m in own_ids}
    return ratings, mine


def _run(spark, ratings, mine, parts=None):
    r = ratings_df(spark, ratings)
    if parts:
        r = r.repartition(parts)
    mm = my_movies_df(spark, list(mine.items()))
    sims = similarity.item_similarity(r, mm)
    return r, mm, sims


@pytest.mark.parametrize(
    "seed,users,movies,own,density",
    [(1, 30, 20, 3, 0.5), (2, 40, 30, 12, 0.4), (3, 25, 30, 25, 0.3), (4, 60, 15, 11, 0.2), (5, 8, 40, 14, 0.6)],
)
def test_against_brute_force(spark, seed, users, movies, own, density):
    ratings, mine = _random_case(seed, users, movies, own, density)
    groups, want_sims, want_preds = brute_force(ratings, mine)
    _, mm, sims = _run(spark, ratings, mine)

    got_sims = {(r.own_id, r.pred_id): r for r in sims.collect()}
    assert set(got_sims) == set(want_sims)
    for key, s in want_sims.items():
        g = got_sims[key]
        assert g.co_raters == len(groups[key])
        if math.isnan(s):
            assert g.similarity is None
        else:
            assert abs(g.similarity - s) < 1e-9

    got = {r.movie_id: r.prediction for r in knn.knn_scores(sims, mm).collect()}
    assert set(got) == set(want_preds)
    for m, p in want_preds.items():
        assert abs(got[m] - p) < 1e-6, (m, got[m], p)


def test_invariant_under_repartition(spark):
    ratings, mine = _random_case(7, 50, 25, 9, 0.4)
    outs = []
    for parts in (1, 7):
        _, mm, sims = _run(spark, ratings, mine, parts)
        outs.append(sorted(tuple(r) for r in knn.knn_scores(sims, mm).collect()))
    assert outs[0] == outs[1]


def test_inline_rules(spark):
    mine = {10: 5.0, 11: 2.0}
    ratings = [
        (1, 10, 4.0), (1, 20, 2.0),  # one co-rater, deviations +1 / -1: similarity -1
        (2, 11, 3.0), (2, 50, 3.0),  # deviations 0: undefined similarity -> -1000
        (4, 10, 4.0), (4, 11, 1.0), (4, 60, 2.0),  # two own movies: own = 10, predicted = 11
    ]
    r = ratings_df(spark, ratings)
    mm = my_movies_df(spark, list(mine.items()))
    pairs = {(p.user_id, p.own_id, p.pred_id) for p in similarity.co_rated_pairs(r, mm).collect()}
    assert (4, 10, 11) in pairs and (4, 11, 10) not in pairs
    assert pairs == {(1, 10, 20), (2, 11, 50), (4, 10, 11), (4, 10, 60), (4, 11, 60)}

    sims = similarity.item_similarity(r, mm)
    s = {(x.own_id, x.pred_id): x.similarity for x in sims.collect()}
    assert s[(10, 20)] == -1.0
    assert s[(11, 50)] is None

    preds = {x.movie_id: x.prediction for x in knn.knn_scores(sims, mm).collect()}
    # 20: sim(10)=-1 and 11 filled with -1 -> (-5 - 2) / 2
    assert preds[20] == -3.5
    assert preds[50] == -1000.0
    _, _, want = brute_force(ratings, mine)
    assert preds == pytest.approx(want)

    mv = movies_df(spark, [(m, f"M{m}", ["X"]) for m in (10, 11, 20, 50, 60)])
    full = {x.movie_id: x for x in knn.knn_predictions(sims, mv, mm).collect()}
    assert full[11].title is None  # own movie: no title
    assert full[20].title == "M20"
    top = [x.movie_id for x in knn.top_predicted(sims, mv, mm, n=2).collect()]
    assert 11 not in top and len(top) == 2
    with_own = {x.movie_id for x in knn.top_predicted(sims, mv, mm, n=10, include_own=True).collect()}
    assert 11 in with_own


def test_top_predicted_ties_lower_id(spark):
    mine = {1: 4.0}
    # every predicted movie gets similarity -1 from one co-rater -> equal predictions
    ratings = []
    for m in range(10, 16):
        ratings += [(m, 1, 4.0), (m, m, 2.0)]
    r = ratings_df(spark, ratings)
    mm = my_movies_df(spark, list(mine.items()))
    sims = similarity.item_similarity(r, mm)
    mv = movies_df(spark, [(m, f"M{m}", ["X"]) for m in range(1, 16)])
    top = [x.movie_id for x in knn.top_predicted(sims, mv, mm, n=3).collect()]
    assert top == [10, 11, 12]


def test_tie_at_neighbour_ten(spark):
    # 12 own movies, each with similarity +1 to movie 100 from its own co-rater: the
    # 10 lowest own ids are the neighbours
    mine = {m: float(m % 4 + 1) for m in range(1, 13)}
    ratings = []
    for m in range(1, 13):
        u = 1000 + m
        ratings += [(u, m, 4.0), (u, 100, 4.0), (u, 200, 1.0)]
    r = ratings_df(spark, ratings)
    mm = my_movies_df(spark, list(mine.items()))
    sims = similarity.item_similarity(r, mm)
    assert {x.similarity for x in sims.where("pred_id = 100").collect()} == {1.0}
    preds = {x.movie_id: x.prediction for x in knn.knn_scores(sims, mm).collect()}
    assert preds[100] == round(sum(mine[m] for m in range(1, 11)) / 10, 6)
    _, _, want = brute_force(ratings, mine)
    assert preds == pytest.approx(want)


def test_empty_own_list(spark):
    r = ratings_df(spark, [(1, 10, 4.0), (1, 20, 2.0)])
    mm = my_movies_df(spark, [])
    mv = movies_df(spark, [(10, "a", ["X"]), (20, "b", ["X"])])
    sims = similarity.item_similarity(r, mm)
    assert sims.count() == 0
    assert knn.knn_scores(sims, mm).count() == 0
    assert knn.top_predicted(sims, mv, mm).count() == 0


def test_a_user_with_half_of_the_rows(spark):
    ratings, mine = _random_case(9, 60, 25, 6, 0.5)
    # a heavy user who rated every movie many times (beyond one rating per cell)
    hot = [(999, m, 1.0 + (m * k) % 9 * 0.5) for m in range(25) for k in range(30)]
    ratings += hot
    r = ratings_df(spark, ratings).repartition(5)
    mm = my_movies_df(spark, list(mine.items()))
    pairs = similarity.co_rated_pairs(r, mm)
    n_own = sum(1 for _, m, _ in hot if m in mine)
    n_two = sum(30 * 30 for a in mine for b in mine if a < b)
    assert pairs.where("user_id = 999").count() == n_own * (25 - len(mine)) * 30 + n_two
    groups, want_sims, _ = brute_force(ratings, mine)
    got = {(x.own_id, x.pred_id): x for x in similarity.item_similarity(r, mm).collect()}
    assert {k: x.co_raters for k, x in got.items()} == {k: len(v) for k, v in groups.items()}
    assert all(abs(got[k].similarity - s) < 1e-9 for k, s in want_sims.items() if not math.isnan(s))


def test_every_rule_occurs_in_the_test_tables(spark):
    from cinemetrics.plans import catalog

    sf = "/root/testdata/sf0.01"
    sims = catalog.adjusted_cosine(spark, sf).cache()
    own = catalog.my_movies_scan(spark, sf).count()
    predicted = sims.select("pred_id").distinct().count()
    one = sims.where("co_raters = 1")
    assert sims.count() < own * predicted  # own movies without a pair are filled with -1
    assert one.where("similarity = 1").count() > 100 and one.where("similarity = -1").count() > 100
    assert sims.where("similarity IS NULL").count() > 100
    predictions = catalog.knn_predictions(spark, sf).cache()
    assert predictions.where("prediction = -1000").count() > 10 and predictions.where("prediction > 0").count() > 10


def test_own_list_hint(spark):
    from pyspark.sql import functions as F

    short = knn.own_list(my_movies_df(spark, [(m, 3.0) for m in range(5)]))
    assert short.hint is F.broadcast and len(short.head) == 5
    many = my_movies_df(spark, [(m, 3.0) for m in range(25)])
    spark.conf.set("cinemetrics.broadcast.maxBytes", "10")
    try:
        long_list = knn.own_list(many)  # head is full (19 rows), so the measured size decides
    finally:
        spark.conf.unset("cinemetrics.broadcast.maxBytes")
    assert len(long_list.head) == 19 and long_list.hint is not F.broadcast
    assert [m for m, _ in long_list.head] == list(range(19))
