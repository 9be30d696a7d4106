"""ALS fits over blocks: the models of Spark's ALS, whatever the blocks, with each step done once."""

import random

import numpy as np
import pytest

from cinemetrics.operators import als, als_blocks
from cinemetrics.session import scratch_path

from conftest import ratings_df


def _triples(users=40, movies=25, seed=3):
    rnd = random.Random(seed)
    rows = [(u, m, rnd.randint(0, 10) / 2) for u in range(-1, users) for m in range(movies) if rnd.random() < 0.4]
    rows += [(1000 + u, 3, 4.0) for u in range(60)]  # one movie with far more ratings than the others
    return rows + rows[:30] + [(u, m, 5.0 - r) for u, m, r in rows[:10]]  # and rows that come twice, the same and otherwise


def _frame(spark, rows):
    return spark.createDataFrame(rows, "user_id int, movie_id int, rating double")


def _factors(model):
    return [{x.id: np.array(x.features) for x in f.collect()} for f in (model.userFactors, model.itemFactors)]


def _close(got, want):
    return all(set(g) == set(w) and all(np.allclose(g[i], w[i], rtol=1e-5, atol=1e-6) for i in w) for g, w in zip(got, want))


@pytest.mark.parametrize("layout_rows", [1_000_000, 70])
def test_models_are_those_of_sparks_als(spark, monkeypatch, layout_rows):
    monkeypatch.setattr(als_blocks, "LAYOUT_ROWS", layout_rows)
    monkeypatch.setattr(als_blocks, "BATCH_ROWS", 16)  # the ratings of one movie in several pieces
    rows = _triples()
    df = _frame(spark, rows)
    laid_out = als_blocks.RatingBlocks(df, len(rows))
    assert laid_out.blocks == max(1, -(-len(rows) // layout_rows))
    try:
        for rank, reg, iters in ((3, 0.1, 6), (2, 0.2, 1), (2, 0.1, 0)):
            wanted = als.make_als(rank, reg, iters, 7)
            with laid_out.fitted(wanted) as model:
                assert _close(_factors(model), _factors(wanted.fit(df))), (rank, reg, iters)
                assert model.rank == rank and model.transform(df).count() == len(rows)
    finally:
        laid_out.close()


def test_blocks_do_not_change_a_model(spark, monkeypatch):
    rows, found = _triples(), []
    for layout_rows, frame in ((1_000_000, _frame(spark, rows)), (50, _frame(spark, rows[::-1]).repartition(5))):
        monkeypatch.setattr(als_blocks, "LAYOUT_ROWS", layout_rows)
        laid_out = als_blocks.RatingBlocks(frame, len(rows))
        with laid_out.fitted(als.make_als(3, 0.1, 8)) as model:
            found.append([{i: tuple(x) for i, x in f.items()} for f in _factors(model)])
        laid_out.close()
    assert found[0] == found[1]


def test_large_batches_are_solved_in_parts(monkeypatch):
    rnd = np.random.default_rng(1)
    solve, given = rnd.integers(0, 50, 2000).astype(np.int32), rnd.integers(0, 80, 2000).astype(np.int32)
    rating = rnd.integers(0, 11, 2000).astype(np.float32) / 2
    fields, needs = als_blocks._layout(solve, given, rating, 4)
    layout = als_blocks._Layout(*fields)
    ids = np.concatenate(list(needs.values()))
    factors = rnd.standard_normal((80, 4)).astype(np.float32)
    whole = layout.solve(factors[ids], 0.3)
    monkeypatch.setattr(als_blocks, "BATCH_NUMBERS", 100)  # four problems at a time
    assert np.array_equal(layout.solve(factors[ids], 0.3), whole)
    for i, x in zip(layout.ids, whole):
        y, r = factors[given[solve == i]].astype(float), rating[solve == i]
        assert np.allclose(x, np.linalg.solve(y.T @ y + 0.3 * len(r) * np.eye(4), y.T @ r), rtol=1e-4, atol=1e-6)


def _grid_input(spark):
    rnd = random.Random(7)
    rows = [(u, m, rnd.randint(1, 10) / 2, rnd.randint(0, 10**9)) for u in range(40) for m in range(20) if rnd.random() < 0.5]
    return ratings_df(spark, rows), ratings_df(spark, [(-1, m, 4.0) for m in range(5)]).select("user_id", "movie_id", "rating")


def test_a_grid_lays_out_its_ratings_once_and_iterates_once(spark, monkeypatch):
    solved, laid_out = [], []
    solve, lay_out = als_blocks.RatingBlocks._solved, als_blocks.RatingBlocks.__init__
    monkeypatch.setattr(als_blocks.RatingBlocks, "_solved", lambda *a: solved.append(a) or solve(*a))
    monkeypatch.setattr(als_blocks.RatingBlocks, "__init__", lambda *a: laid_out.append(a) or lay_out(*a))
    ratings, personal = _grid_input(spark)
    grid = {"ranks": (2, 3), "reg_params": (0.1,)}
    store = scratch_path(spark, "models")
    both = als.grid_search(ratings, personal, **grid, max_iters=(5, 2), store=store)
    assert len(laid_out) == 1
    assert len(solved) == 2 * 2 * 5  # two half steps an iteration, two chains of five iterations: those of two are among them
    alone = als.grid_search(ratings, personal, **grid, max_iters=(5,), store=scratch_path(spark, "models"))
    assert [x for x in both.rows if x[2] == 5] == alone.rows and [x[2] for x in both.rows] == [5, 2, 5, 2]
    solved.clear()
    longer = als.grid_search(ratings, personal, **grid, max_iters=(2, 5, 6), parallelism=2, store=store)
    assert len(solved) == 2 * 2 and sorted(x for x in longer.rows if x[2] < 6) == sorted(both.rows)  # from those kept


def test_blocks_of_the_layout_follow_the_training_rows():
    assert [als_blocks.layout_blocks(n) for n in (1, 250_000, 250_001, 2_000_000, 24_000_000, 24_000_001)] == [1, 1, 2, 8, 8, 9]
    assert als_blocks.layout_blocks(10**13) == als_blocks.MAX_LAYOUT_BLOCKS


def test_what_a_fit_keeps_is_given_back(spark):
    import os

    ratings, personal = _grid_input(spark)
    kept = spark.sparkContext._jsc.getPersistentRDDs
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(kept().keySet()), {x for x in os.listdir(top) if x.startswith("rdd-")}
    als.grid_search(ratings, personal, ranks=(2,), reg_params=(0.1,), max_iters=(3,), store=scratch_path(spark, "models"))
    written = {x for x in os.listdir(top) if x.startswith("rdd-")}
    assert written == before[1]
    frames = [x.name() for i, x in dict(kept()).items() if i not in before[0]]
    assert not any(name and "Python" in name for name in frames), frames


def test_what_als_refuses_is_refused(spark):
    rows = [(1, 1, 3.0), (2, 1, 4.0), (2, 2, 1.0)]
    for bad, said in (
        ((None, 1, 2.0), "user_id Ids MUST NOT be Null"),
        ((1, None, 2.0), "movie_id Ids MUST NOT be Null"),
        ((1, 2, None), "Ratings MUST NOT be Null or NaN"),
        ((1, 2, float("nan")), "Ratings MUST NOT be Null or NaN"),
        ((1, 2, float("-inf")), "Ratings MUST NOT be Infinity, but got -Infinity"),
    ):
        df = _frame(spark, rows + [bad])
        with pytest.raises(Exception, match=said):
            als.make_als(2, 0.1, 1).fit(df)
        with pytest.raises(Exception, match=said):
            als_blocks.RatingBlocks(df, 4)
    with pytest.raises(ValueError):
        als_blocks.RatingBlocks(_frame(spark, []), 0)
