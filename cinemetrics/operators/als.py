"""ALS recommendation with a timestamp-digit split and a grid search.

Training is the iteration of ``pyspark.ml.recommendation.ALS`` over blocks of ratings that are laid
out once for the grid (``als_blocks``). The split is a column expression, the held-out sets are
persisted once around the grid loop, and each fit is distributed; only one error row per model
comes back to the driver. Fitted models and
their errors are kept on shared storage (``model_store``): a grid over the same rows is fitted
once, and goes on where a lost driver left it.

The reported error follows the reference: ``mse_ref`` is the sum of squared errors over
the predicted rows divided by the size of the whole split (rows without a prediction
count in the divisor). ``mse`` and ``rmse`` divide by the predicted rows only.
"""

from __future__ import annotations

import gc
import itertools
import math
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetrics.functions.columns import digit_split
from cinemetrics.operators.als_blocks import RatingBlocks
from cinemetrics.operators.broadcast import broadcast_if_bounded
from cinemetrics.operators.model_store import ModelStore, default_folder, input_summary
from cinemetrics.session import ensure_checkpoint_dir

# Fixed values of the grid search.
RANKS = (8, 10)
REG_PARAMS = (0.1, 0.2)
MAX_ITERS = (10, 20)
SEED = 42
RECOMMEND_N = 50
PERSONAL_USER_ID = -1
# start factors of the verifiable steps: ((id mod m) * factor + shift) mod m, scaled into (0, 1)
START_MODULUS = 997
START_FIRST, START_SECOND = (31, 7), (53, 11)
# ALS draws its start factors per block, so the number of blocks is part of the model. It follows
# from the training rows alone: as many blocks on any cluster, more for more data.
BLOCK_ROWS = 250_000
MIN_BLOCKS = 10
MAX_BLOCKS = 20_000
# iterations between two checkpoints of the factors, and between two releases of their shuffles
CHECKPOINT_EVERY = 1
RELEASE_EVERY = 1
# seconds after which the JVM knows what Python has dropped (py4j looks every second)
TOLD_AFTER_S = 1.1


def block_count(training_rows: int) -> int:
    """Blocks of users and of items for so many training rows: ``BLOCK_ROWS`` ratings each, within bounds."""
    return min(MAX_BLOCKS, max(MIN_BLOCKS, -(-training_rows // BLOCK_ROWS)))


def release_shuffles(spark: SparkSession, all_dropped: bool = False) -> None:
    """Have Spark remove the shuffle files and persisted blocks that nothing refers to any more.

    Spark removes them once the driver's JVM has collected their owners, which a driver with
    little to do may leave for the half hour of ``spark.cleaner.periodicGC.interval``. With
    ``all_dropped`` those too whose owners Python has dropped just now: it tells the JVM within a second.
    """
    gc.collect()  # the Python side holds its JVM objects
    if all_dropped:
        time.sleep(TOLD_AFTER_S)
    spark._jvm.System.gc()


def split_ratings(ratings: DataFrame) -> DataFrame:
    """ratings + ``split`` in {training, validation, test} by the timestamp's last digit."""
    return ratings.withColumn("split", digit_split("ts"))


def split_counts(ratings: DataFrame) -> DataFrame:
    """(split, n)."""
    return split_ratings(ratings).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def _triples(df: DataFrame) -> DataFrame:
    return df.select("user_id", "movie_id", "rating")


def training_set(ratings: DataFrame, personal: DataFrame) -> DataFrame:
    """Training split plus the personal ratings (bag union)."""
    train = _triples(split_ratings(ratings).where(F.col("split") == "training"))
    return train.unionByName(_triples(personal))


def _als_input(df: DataFrame) -> DataFrame:
    """ALS takes int ids; ANSI casts fail loudly on ids beyond the int range."""
    return df.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.col("movie_id").cast("int").alias("movie_id"),
        F.col("rating").cast("double").alias("rating"),
    )


def make_als(rank: int, reg_param: float, max_iter: int, blocks: int = MIN_BLOCKS, seed: int = SEED) -> ALS:
    """Explicit-feedback ALS; unknown users/items are dropped when scoring (like an inner join).

    ``checkpointInterval`` writes the factors of one side to the checkpoint folder. It is required, not
    only a guard against lost executors: without it the lineage of a 20-iteration fit grows until
    task deserialisation overflows the stack. Every shuffle since the last one stays on disk, and
    each half of an iteration shuffles a copy of a factor for every block that needs it, which is
    more than the ratings take. It does not change a model.
    """
    return ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        userCol="user_id",
        itemCol="movie_id",
        ratingCol="rating",
        seed=seed,
        coldStartStrategy="drop",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=CHECKPOINT_EVERY,
    )


@dataclass(frozen=True)
class ModelError:
    sse: float
    n_predicted: int
    n_split: int

    @property
    def mse(self) -> float:
        return self.sse / self.n_predicted if self.n_predicted else float("nan")

    @property
    def rmse(self) -> float:
        return math.sqrt(self.mse) if self.n_predicted else float("nan")

    @property
    def mse_ref(self) -> float:
        return self.sse / self.n_split if self.n_split else float("nan")


def prediction_error(scored: DataFrame, split_sizes: DataFrame) -> DataFrame:
    """(split, n_split, n_predicted, sse, mse, rmse, mse_ref) from rows (split, rating,
    prediction) and the size of each split (split, n).

    Rows without a prediction do not count as predicted, but do in ``n_split``, by which
    ``mse_ref`` divides. A split without any prediction has sse 0 and null errors.
    """
    error = F.col("rating") - F.col("prediction")
    sums = scored.where(F.col("prediction").isNotNull()).groupBy("split").agg(
        F.sum(error * error).alias("sse"), F.count(F.lit(1)).alias("n_predicted")
    )
    both = split_sizes.withColumnRenamed("n", "n_split").join(sums, "split", "left")
    sse, n = F.coalesce("sse", F.lit(0.0)), F.coalesce("n_predicted", F.lit(0))
    some = F.when(n > 0, n)
    return both.select(
        "split", "n_split", n.cast("long").alias("n_predicted"), sse.alias("sse"),
        (sse / some).alias("mse"), F.sqrt(sse / some).alias("rmse"),
        (sse / F.when((n > 0) & (F.col("n_split") > 0), F.col("n_split"))).alias("mse_ref"),
    )


def user_mean_scores(ratings: DataFrame, personal: DataFrame) -> DataFrame:
    """(split, rating, prediction) of the validation and test ratings, predicted by the mean of
    the user's training ratings; users without a training rating get no row (inner join)."""
    means = training_set(ratings, personal).groupBy("user_id").agg(F.avg("rating").alias("prediction"))
    held = split_ratings(ratings).where(F.col("split") != "training")
    return held.join(means, "user_id").select("split", "rating", "prediction")


def scorable_counts(ratings: DataFrame, personal: DataFrame) -> DataFrame:
    """(split, n_split, n_scorable): ratings whose user and movie both occur in the training
    set, which are those that ALS can predict."""
    train = training_set(ratings, personal)
    users = train.select("user_id").distinct().withColumn("_user", F.lit(True))
    movies = train.select("movie_id").distinct().withColumn("_movie", F.lit(True))
    held = split_ratings(ratings).where(F.col("split") != "training")
    known = held.join(users, "user_id", "left").join(movies, "movie_id", "left")
    return known.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_split"), F.count_if(F.col("_user") & F.col("_movie")).alias("n_scorable")
    )


def model_error(model: ALSModel, data: DataFrame, n_split: int) -> ModelError:
    """Squared error of ``model`` on ``data`` (one aggregate row to the driver)."""
    scored = model.transform(data).select(F.lit("data").alias("split"), "rating", "prediction")
    sizes = data.sparkSession.createDataFrame([("data", n_split)], "split string, n long")
    row = prediction_error(scored, sizes).first()
    return ModelError(float(row["sse"]), int(row["n_predicted"]), n_split)


@dataclass
class GridResult:
    rows: list[tuple]
    best_model: ALSModel
    best_params: tuple[int, float, int]
    test_error: ModelError
    counts: dict[str, int]


def grid_search(
    ratings: DataFrame,
    personal: DataFrame,
    ranks=RANKS,
    reg_params=REG_PARAMS,
    max_iters=MAX_ITERS,
    seed: int = SEED,
    blocks: int | None = None,
    parallelism: int = 1,
    store: str | None = None,
) -> GridResult:
    """Fit every (rank, reg_param, max_iter); keep the strictly smallest ``mse_ref`` (first wins ties).

    Each fit is a distributed job over the ratings that ``RatingBlocks`` lays out once. The fits of
    one (rank, reg_param) are a chain: a model of more iterations goes on from the kept one of fewer,
    whose factors are those that it would have after as many. ``parallelism`` chains are submitted at
    once from driver threads (as ``pyspark.ml.tuning`` does). It is a speed setting only: the start blocks follow
    from the training rows (``block_count``), so that neither it nor the number of cores changes a
    model. The choice is made in grid order.

    Every model and error is written to ``store`` (default: ``model_store.default_folder``) as soon
    as it is known, under a digest of the rows and its parameters; what is there already is read
    and not fitted again. A call over an unchanged input costs one pass for the digest.
    """
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    grid = list(itertools.product(ranks, reg_params, max_iters))
    if not grid:
        raise ValueError("empty grid")
    split = split_ratings(ratings)
    training = training_set(ratings, personal)
    held = {name: split.where(F.col("split") == name) for name in ("validation", "test")}

    labelled = training.withColumn("split", F.lit("training"))
    for name, df in held.items():
        labelled = labelled.unionByName(_triples(df).withColumn("split", F.lit(name)))
    found, digest = input_summary(labelled)
    counts = {name: found.get(name, 0) for name in ("training", "validation", "test")}
    blocks = block_count(counts["training"]) if blocks is None else blocks
    models = ModelStore(spark, store or default_folder(spark), digest)

    def name_of(place: int) -> str:
        rank, reg, iters = grid[place]
        return f"rank={rank},reg={float(reg)},iterations={iters},blocks={blocks},seed={seed}"

    def known(place: int, what: str) -> ModelError | None:
        error = models.error(name_of(place), what)
        return ModelError(*error) if error else None

    persisted: dict[str, DataFrame] = {}
    laid_out: list[RatingBlocks] = []
    lock = threading.Lock()

    def rows_of(name: str) -> DataFrame:
        with lock:
            if name not in persisted:
                dealt = _als_input(held[name]).repartition(blocks, "user_id")
                dealt = dealt.sortWithinPartitions("user_id", "movie_id", "rating")
                persisted[name] = dealt.persist(StorageLevel.MEMORY_AND_DISK)
            return persisted[name]

    def training_blocks() -> RatingBlocks:
        with lock:
            if not laid_out:
                laid_out.append(RatingBlocks(_als_input(training), counts["training"]))
            return laid_out[0]

    def measured(place: int, what: str, model: ALSModel) -> ModelError:
        error = model_error(model, rows_of(what), counts[what])
        models.save_error(name_of(place), what, (error.sse, error.n_predicted, error.n_split))
        return error

    def released(n: int) -> None:
        if n % RELEASE_EVERY == 0:
            release_shuffles(spark)

    def fit(place: int, before: int | None) -> ModelError:
        """``before``: the place of a kept model with fewer iterations."""
        error = known(place, "validation")
        if error is None:
            rank, reg, iters = grid[place]
            release_shuffles(spark)  # of the input, or of the errors of the model before
            start = None if before is None else (grid[before][2], models.model(name_of(before)))
            with training_blocks().fitted(make_als(rank, reg, iters, blocks, seed), start, released) as model:
                release_shuffles(spark, all_dropped=True)  # of the last iterations, before the model is written
                models.save_model(name_of(place), model)
            release_shuffles(spark)  # of the fit, before the model is scored
            error = measured(place, "validation", models.model(name_of(place)))
        return error

    def fit_chain(places: list[int]) -> dict[int, ModelError]:
        found: dict[int, ModelError] = {}
        before = None
        for place in sorted(places, key=lambda p: grid[p][2]):
            found[place] = fit(place, before if before is not None and grid[before][2] > 0 else None)
            before = place
        return found

    chains: dict[tuple, list[int]] = {}
    for place, (rank, reg, _) in enumerate(grid):
        chains.setdefault((rank, float(reg)), []).append(place)
    try:
        errors: dict[int, ModelError] = {}
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(chains)))) as pool:
            for found in pool.map(fit_chain, chains.values()):
                errors |= found
        rows = [
            (rank, float(reg), iters, err.mse, err.rmse, err.mse_ref, err.n_predicted)
            for (rank, reg, iters), err in ((grid[p], errors[p]) for p in range(len(grid)))
        ]
        place = min(range(len(grid)), key=lambda p: (errors[p].mse_ref, p))
        rank, reg, iters = grid[place]
        model = models.model(name_of(place))
        test_err = known(place, "test") or measured(place, "test", model)
        return GridResult(rows, model, (rank, float(reg), iters), test_err, counts)
    finally:
        for df in persisted.values():
            df.unpersist()
        for laid in laid_out:
            laid.close()


def start_factors(ids: DataFrame, column: str) -> DataFrame:
    """(``column``, f1, f2): two start factors between 0 and 1 for every id, a fixed function of the id."""

    def drawn(factor: int, shift: int) -> Column:
        return (F.pmod(F.pmod(F.col(column), F.lit(START_MODULUS)) * factor + shift, F.lit(START_MODULUS)) + 1) / (START_MODULUS + 1)

    return ids.select(column).distinct().select(column, drawn(*START_FIRST).alias("f1"), drawn(*START_SECOND).alias("f2"))


def half_step(ratings: DataFrame, factors: DataFrame, solve: str, given: str, reg_param: float = REG_PARAMS[0]) -> DataFrame:
    """One half of an ALS iteration at rank 2: (``solve``, f1, f2) from the factors of the other side.

    For every ``solve`` id the ridge problem min sum (r - x.y)^2 + reg * n * |x|^2 over its n
    ratings r with factors y. Its normal equations are sums of outer products, so they are a
    grouped aggregate, combined in every map task: an id with any number of ratings sends
    six numbers per task. The 2 x 2 system is solved in closed form. Ratings whose ``given`` id has no
    factors take no part; an id without any is left out.
    """
    if reg_param <= 0:
        raise ValueError("the regularisation must be positive")
    y = broadcast_if_bounded(factors.select(given, "f1", "f2"))
    r, y1, y2 = F.col("rating"), F.col("f1"), F.col("f2")
    sums = ratings.select(solve, given, "rating").join(y, given).groupBy(solve).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y1 * y1).alias("a"), F.sum(y1 * y2).alias("b"), F.sum(y2 * y2).alias("c"),
        F.sum(r * y1).alias("p"), F.sum(r * y2).alias("q"),
    )
    ridge = F.lit(float(reg_param)) * F.col("n")
    a, b, c = F.col("a") + ridge, F.col("b"), F.col("c") + ridge
    det = a * c - b * b  # positive: the ridge makes the matrix definite
    return sums.select(
        solve, ((c * F.col("p") - b * F.col("q")) / det).alias("f1"), ((a * F.col("q") - b * F.col("p")) / det).alias("f2")
    )


def rank2_iterations(ratings: DataFrame, iterations: int, reg_param: float = REG_PARAMS[0]) -> tuple[DataFrame, DataFrame]:
    """(user factors, movie factors) after whole ALS iterations at rank 2 from ``start_factors`` of the
    movies; each side is written to the checkpoint folder before the other is solved."""
    if iterations < 1:
        raise ValueError("one iteration at least")
    ensure_checkpoint_dir(ratings.sparkSession)
    movies = start_factors(ratings, "movie_id")
    users = movies.limit(0)
    for _ in range(iterations):
        users = half_step(ratings, movies, "user_id", "movie_id", reg_param).checkpoint(eager=True)
        movies = half_step(ratings, users, "movie_id", "user_id", reg_param).checkpoint(eager=True)
    return users, movies


def grid_table(result: GridResult) -> DataFrame:
    """(rank, reg_param, max_iter, mse, rmse, mse_ref, n_predicted, is_best): one row per model."""
    spark = result.best_model.userFactors.sparkSession
    best = result.best_params
    rows = [r + ((r[0], r[1], r[2]) == best,) for r in result.rows]
    schema = (
        "rank int, reg_param double, max_iter int, mse double, rmse double, mse_ref double, "
        "n_predicted long, is_best boolean"
    )
    return spark.createDataFrame(rows, schema)


def test_error_table(result: GridResult) -> DataFrame:
    """One row: best parameters and their error on the test split."""
    spark = result.best_model.userFactors.sparkSession
    rank, reg, iters = result.best_params
    e = result.test_error
    schema = "rank int, reg_param double, max_iter int, mse double, rmse double, mse_ref double, n_test long"
    return spark.createDataFrame([(rank, reg, iters, e.mse, e.rmse, e.mse_ref, e.n_split)], schema)


def recommend_for_user(
    model: ALSModel, movies: DataFrame, user_id: int = PERSONAL_USER_ID, n: int = RECOMMEND_N
) -> DataFrame:
    """(rank, movie_id, title, predicted_rating): the n best movies of one user; rated ones stay in."""
    spark = model.userFactors.sparkSession
    users = spark.createDataFrame([(user_id,)], "user_id int")
    recs = model.recommendForUserSubset(users, n)
    flat = recs.select("user_id", F.posexplode("recommendations").alias("pos", "rec")).select(
        (F.col("pos") + 1).alias("rank"),
        F.col("rec.movie_id").cast("long").alias("movie_id"),
        F.col("rec.rating").cast("double").alias("predicted_rating"),
    )
    titles = broadcast_if_bounded(movies.select("movie_id", "title"))
    return flat.join(titles, "movie_id", "left").select("rank", "movie_id", "title", "predicted_rating")
