"""ALS: split, training set, grid selection, errors and recommendations."""

import random

from pyspark.sql import functions as F

from cinemetrics.operators import als
from cinemetrics.session import scratch_path

from conftest import SF_SMALL, movies_df, ratings_df


def _ratings(spark, seed=5, users=60, movies=30):
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        bias = rnd.uniform(-1, 1)
        for m in range(movies):
            if rnd.random() < 0.5:
                r = min(5.0, max(0.5, round((3 + bias + (m % 5 - 2) * 0.4 + rnd.gauss(0, 0.3)) * 2) / 2))
                rows.append((u, m, r, rnd.randint(0, 10**9)))
    return ratings_df(spark, rows)


def test_split_is_a_partition(spark):
    r = _ratings(spark)
    s = als.split_ratings(r)
    counts = {x.split: x.n for x in als.split_counts(r).collect()}
    assert set(counts) == {"training", "validation", "test"}
    assert sum(counts.values()) == r.count()
    digits = {x.split: sorted({d.d for d in s.where(F.col("split") == x.split).select((F.col("ts") % 10).alias("d")).collect()}) for x in s.select("split").distinct().collect()}
    assert digits == {"training": [0, 1, 2, 3, 4, 5], "validation": [6, 7, 8], "test": [9]}


def test_training_set_adds_personal(spark):
    r = _ratings(spark)
    personal = ratings_df(spark, [(-1, 1, 5.0), (-1, 2, 1.0)]).select("user_id", "movie_id", "rating")
    t = als.training_set(r, personal)
    n_train = als.split_ratings(r).where("split = 'training'").count()
    assert t.count() == n_train + 2
    assert t.where("user_id = -1").count() == 2


def test_grid_search_and_recommendations(spark):
    r = _ratings(spark)
    personal = ratings_df(spark, [(-1, m, 5.0 if m % 5 == 4 else 1.0) for m in range(0, 30, 3)]).select(
        "user_id", "movie_id", "rating"
    )
    res = als.grid_search(r, personal, ranks=(2, 3), reg_params=(0.1,), max_iters=(5,))
    table = als.grid_table(res).collect()
    assert len(table) == 2 and sum(x.is_best for x in table) == 1
    best = min(table, key=lambda x: x.mse_ref)
    assert best.is_best and (best["rank"], best.reg_param, best.max_iter) == res.best_params
    for x in table:
        assert 0 <= x.mse_ref <= x.mse + 1e-12  # mse_ref divides by the whole split
        assert abs(x.rmse ** 2 - x.mse) < 1e-9
        assert x.mse < 2.0  # a fitted model beats a constant guess on this data
    again = als.grid_search(r, personal, ranks=(2, 3), reg_params=(0.1,), max_iters=(5,), store=scratch_path(spark, "models"))
    assert [x[:6] for x in again.rows] == [x[:6] for x in res.rows]  # fixed seed

    test = als.test_error_table(res).first()
    assert test.n_test == als.split_ratings(r).where("split = 'test'").count()

    mv = movies_df(spark, [(m, f"M{m}", ["X"]) for m in range(30)])
    recs = als.recommend_for_user(res.best_model, mv, n=10).orderBy("rank").collect()
    assert [x["rank"] for x in recs] == list(range(1, 11))
    preds = [x.predicted_rating for x in recs]
    assert preds == sorted(preds, reverse=True)
    assert all(x.title == f"M{x.movie_id}" for x in recs)


def _fit(spark, parallelism):
    r = _ratings(spark)
    personal = ratings_df(spark, [(-1, m, 4.0) for m in range(0, 30, 3)]).select("user_id", "movie_id", "rating")
    store = scratch_path(spark, "models")  # fitted anew, not read back
    res = als.grid_search(r, personal, ranks=(2, 3), reg_params=(0.1,), max_iters=(4,), parallelism=parallelism, store=store)
    mv = movies_df(spark, [(m, f"M{m}", ["X"]) for m in range(30)])
    recs = als.recommend_for_user(res.best_model, mv, n=50).orderBy("rank").collect()
    return res, recs


def test_parallelism_is_a_speed_setting_only(spark):
    one, recs_one = _fit(spark, 1)
    four, recs_four = _fit(spark, 4)
    assert one.rows == four.rows and one.test_error == four.test_error and recs_one == recs_four


def test_number_of_cores_does_not_change_the_models():
    import os
    import subprocess
    import sys

    here = os.path.dirname(os.path.abspath(__file__))
    code = """
import sys; sys.path[:0] = [%r, %r]
from cinemetrics.session import local_session
import test_als
spark = local_session(sys.argv[1])
res, recs = test_als._fit(spark, 1)
print("RESULT", res.rows, res.test_error, [(r.movie_id, r.predicted_rating) for r in recs])
""" % (os.path.dirname(here), here)
    found = []
    for cores in ("2", "4"):
        out = subprocess.run([sys.executable, "-c", code, cores], capture_output=True, text=True, timeout=400)
        found.append([x for x in out.stdout.splitlines() if x.startswith("RESULT")])
        assert found[-1], out.stderr[-2000:]
    assert found[0] == found[1]


def test_recommendations_are_the_largest_dot_products(spark):
    res, recs = _fit(spark, 1)
    user = next(r.features for r in res.best_model.userFactors.collect() if r.id == -1)
    scores = {r.id: sum(a * b for a, b in zip(user, r.features)) for r in res.best_model.itemFactors.collect()}
    best = sorted(scores.items(), key=lambda x: -x[1])[:50]
    assert len(recs) == len(best)
    for r, (_, score) in zip(recs, best):
        assert abs(r.predicted_rating - score) < 1e-5 and abs(scores[r.movie_id] - score) < 1e-5


def test_prediction_error_by_hand(spark):
    rows = [("a", 3.0, 1.0), ("a", 2.0, None), ("a", 1.0, 2.0)]
    scored = spark.createDataFrame(rows, "split string, rating double, prediction double")
    sizes = spark.createDataFrame([("a", 4), ("b", 2)], "split string, n long")
    got = {r.split: r for r in als.prediction_error(scored, sizes).collect()}
    assert (got["a"].n_split, got["a"].n_predicted, got["a"].sse, got["a"].mse, got["a"].mse_ref) == (4, 2, 5.0, 2.5, 1.25)
    assert abs(got["a"].rmse**2 - 2.5) < 1e-12
    assert (got["b"].n_predicted, got["b"].sse, got["b"].mse, got["b"].mse_ref) == (0, 0.0, None, None)


def test_als_predicts_exactly_the_scorable_rows(spark):
    r = _ratings(spark, users=200, movies=15).where("rand(3) < 0.08")
    r = spark.createDataFrame(r.collect(), r.schema)
    personal = ratings_df(spark, [(-1, 1, 4.0)]).select("user_id", "movie_id", "rating")
    counts = {x.split: x for x in als.scorable_counts(r, personal).collect()}
    res = als.grid_search(r, personal, ranks=(2,), reg_params=(0.1,), max_iters=(2,))
    assert res.rows[0][-1] == counts["validation"].n_scorable < counts["validation"].n_split
    assert res.test_error.n_predicted == counts["test"].n_scorable


def test_catalog_training_set_on_tables(spark):
    from cinemetrics.plans import catalog

    t = catalog.als_training_set(spark, SF_SMALL)
    assert t.where("user_id = -1").count() == catalog.my_movies_scan(spark, SF_SMALL).count() > 1
    assert set(t.columns) == {"user_id", "movie_id", "rating"}


def _personal(spark):
    return ratings_df(spark, [(-1, m, 4.0) for m in range(0, 30, 3)]).select("user_id", "movie_id", "rating")


GRID = {"ranks": (2, 3), "reg_params": (0.1, 0.2), "max_iters": (2,)}


def _count_fits(monkeypatch):
    made = []
    make = als.make_als
    monkeypatch.setattr(als, "make_als", lambda *a: made.append(a) or make(*a))
    return made


def test_a_grid_is_fitted_once_for_the_same_rows(spark, monkeypatch):
    made, store = _count_fits(monkeypatch), scratch_path(spark, "models")
    r, personal = _ratings(spark), _personal(spark)
    first = als.grid_search(r, personal, **GRID, store=store)
    assert len(made) == 4
    again = als.grid_search(r.repartition(7), personal, **GRID, store=store, parallelism=2)
    assert len(made) == 4 and (again.rows, again.best_params, again.test_error) == (first.rows, first.best_params, first.test_error)
    wider = als.grid_search(r, personal, ranks=(2, 3), reg_params=(0.1, 0.2), max_iters=(2, 3), store=store)
    assert len(made) == 8 and [x for x in wider.rows if x[2] == 2] == first.rows
    als.grid_search(r.where("movie_id <> 5 OR user_id <> 3"), personal, **GRID, store=store)
    assert len(made) == 12  # other rows, other models
    factors = [sorted((x.id, tuple(x.features)) for x in m.best_model.userFactors.collect()) for m in (first, again)]
    assert factors[0] == factors[1]


def test_a_half_written_entry_is_fitted_again(spark, monkeypatch):
    made, store = _count_fits(monkeypatch), scratch_path(spark, "models")
    r, personal = _ratings(spark), _personal(spark)

    def lost(*args):
        raise RuntimeError("lost")

    save = als.ModelStore.save_error
    monkeypatch.setattr(als.ModelStore, "save_error", lost)
    try:
        als.grid_search(r, personal, **GRID, store=store)
        raise AssertionError("the failure was swallowed")
    except RuntimeError:
        pass
    monkeypatch.setattr(als.ModelStore, "save_error", save)
    res = als.grid_search(r, personal, **GRID, store=store)
    assert len(made) > 4 and len(res.rows) == 4


def test_a_grid_goes_on_after_its_driver_was_killed(spark, tmp_path, monkeypatch):
    import os
    import subprocess
    import sys

    here = os.path.dirname(os.path.abspath(__file__))
    code = """
import os, sys; sys.path[:0] = [%r, %r]
from cinemetrics.session import local_session
from cinemetrics.operators import als
import test_als
made, make = [], als.make_als
def counted(*a):
    if len(made) == 3:
        os.kill(os.getpid(), 9)
    made.append(a)
    return make(*a)
als.make_als = counted
spark = local_session(4)
als.grid_search(test_als._ratings(spark), test_als._personal(spark), **test_als.GRID, store=sys.argv[1])
""" % (os.path.dirname(here), here)
    store = str(tmp_path / "models")
    out = subprocess.run([sys.executable, "-c", code, store], capture_output=True, text=True, timeout=400)
    assert out.returncode == -9, out.stderr[-2000:]
    made = _count_fits(monkeypatch)
    r, personal = _ratings(spark), _personal(spark)
    resumed = als.grid_search(r, personal, **GRID, store=store)
    assert len(made) == 1
    whole = als.grid_search(r, personal, **GRID, store=scratch_path(spark, "models"))
    assert len(made) == 5 and (resumed.rows, resumed.test_error) == (whole.rows, whole.test_error)


def test_shuffles_of_the_fits_do_not_pile_up_on_disk(spark, monkeypatch):
    import os
    import time

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffles():
        names = [x for top in folders for _, _, files in os.walk(top) for x in files]
        return {x.split("_")[1] for x in names if x.startswith("shuffle_") and x.endswith(".data")}

    def settled(before, most):
        until = time.time() + 5  # Spark removes files in the background
        while len(shuffles() - before) > most and time.time() < until:
            time.sleep(0.1)
        return len(shuffles() - before)

    before, in_fit, after_fit = shuffles(), [], []
    save_model, save_error = als.ModelStore.save_model, als.ModelStore.save_error

    def saved_model(*args):
        in_fit.append(settled(before, 12))
        return save_model(*args)

    def saved_error(*args):
        after_fit.append(settled(before, 12))
        return save_error(*args)

    monkeypatch.setattr(als.ModelStore, "save_model", saved_model)
    monkeypatch.setattr(als.ModelStore, "save_error", saved_error)
    als.grid_search(_ratings(spark), _personal(spark), ranks=(2, 3), reg_params=(0.1,), max_iters=(10,), store=scratch_path(spark, "models"))
    assert len(in_fit) == 2 and max(in_fit) <= 12, in_fit  # of 20 half steps and those that set up the fit
    assert len(after_fit) == 3 and max(after_fit) <= 12, after_fit  # no fit's, but those that score it


def test_checkpoints_do_not_change_a_model(spark, monkeypatch):
    found = []
    for every in (10, 1):
        monkeypatch.setattr(als, "CHECKPOINT_EVERY", every)
        model = als.make_als(3, 0.1, 12).fit(als._als_input(_ratings(spark)).repartition(4, "user_id").sortWithinPartitions("user_id", "movie_id"))
        found.append([sorted((x.id, tuple(x.features)) for x in f.collect()) for f in (model.userFactors, model.itemFactors)])
    assert found[0] == found[1]


def test_blocks_follow_the_training_rows():
    assert [als.block_count(n) for n in (0, 35_794, 2_500_000, 2_500_001, 3_579_400)] == [10, 10, 10, 11, 15]
    assert als.block_count(10**13) == als.MAX_BLOCKS


def test_more_rows_more_blocks(spark, monkeypatch):
    monkeypatch.setattr(als, "BLOCK_ROWS", 50)
    made = _count_fits(monkeypatch)
    res = als.grid_search(_ratings(spark), _personal(spark), ranks=(2,), reg_params=(0.1,), max_iters=(1,), store=scratch_path(spark, "m"))
    assert made[0][3] == als.block_count(res.counts["training"]) > 10


def test_half_steps_solve_the_ridge_problems(spark):
    import numpy as np

    r = _ratings(spark).select("user_id", "movie_id", "rating")
    rows = [tuple(x) for x in r.collect()]
    start = {x.movie_id: np.array([x.f1, x.f2]) for x in als.start_factors(r, "movie_id").collect()}
    assert all(0 < f.min() and f.max() < 1 for f in start.values()) and len({tuple(f) for f in start.values()}) == len(start)

    def solve(rows, factors, reg):
        out = {}
        for i in {x[0] for x in rows}:
            y = np.array([factors[j] for k, j, _ in rows if k == i])
            v = np.array([x for k, _, x in rows if k == i])
            out[i] = np.linalg.solve(y.T @ y + reg * len(v) * np.eye(2), y.T @ v)
        return out

    users = solve(rows, start, 0.3)
    movies = solve([(j, i, x) for i, j, x in rows], users, 0.3)
    got_users, got_movies = als.rank2_iterations(r, 1, 0.3)
    for got, want, key in ((got_users, users, "user_id"), (got_movies, movies, "movie_id")):
        got = {x[key]: (x.f1, x.f2) for x in got.collect()}
        assert set(got) == set(want) and all(np.allclose(got[i], want[i]) for i in want)

    def loss(users, movies, reg):
        fit = sum((x - users[i] @ movies[j]) ** 2 for i, j, x in rows)
        return fit + reg * sum(users[i] @ users[i] + movies[j] @ movies[j] for i, j, _ in rows)

    def factors(df, key):
        return {x[key]: np.array([x.f1, x.f2]) for x in df.collect()}

    losses = []
    for n in (1, 2, 4):
        u, m = als.rank2_iterations(r, n)
        losses.append(loss(factors(u, "user_id"), factors(m, "movie_id"), 0.1))
    assert losses[0] > losses[1] > losses[2]


def test_half_step_leaves_out_what_it_does_not_know(spark):
    r = ratings_df(spark, [(1, 1, 4.0), (1, 2, 2.0), (2, 9, 5.0)])
    y = spark.createDataFrame([(1, 0.5, 0.25), (2, 1.0, 0.0)], "movie_id long, f1 double, f2 double")
    assert [x.user_id for x in als.half_step(r, y, "user_id", "movie_id").collect()] == [1]
