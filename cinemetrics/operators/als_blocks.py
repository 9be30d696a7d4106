"""ALS fits over blocks of ratings that are laid out once for all models of a grid.

The iteration is that of ``pyspark.ml.recommendation.ALS`` for explicit ratings: from start factors
that Spark's ALS draws, every item's ridge problem is solved from the user factors, then every
user's from the item factors, in double precision with factors kept as floats. What differs is the
work around it. Spark's ALS deals the ratings into blocks for every fit, holds a block for every
block of the start factors, so that a factor goes to nearly as many blocks as its id has ratings,
and solves the item factors twice where they are checkpointed. Here the ratings are dealt once, by
user and by item, into blocks of ``LAYOUT_ROWS`` ratings whatever the number of start blocks; a half
step is one shuffle of the factors that another block needs, once each, and batched matrix products over the
ids of equal rating counts; and a fit goes on from a model of the same chain with fewer iterations.

All ratings of one id are in one block of its side, as in Spark's ALS; the longest runs are
added up in pieces. A factor depends on its own ratings only, in a fixed order: neither the
number of blocks nor that of cores changes a model.
"""

from __future__ import annotations

import sys
import threading
from collections import defaultdict
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetrics.sources import files

# the workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ratings of one block of a side: a factor goes to as many blocks as its id has ratings in, at most all
# of them, so fewer and larger blocks shuffle less; smaller inputs get some blocks to work on at once
LAYOUT_ROWS = 3_000_000
LEAST_ROWS, SOME_BLOCKS = 250_000, 8
MAX_LAYOUT_BLOCKS = 20_000
# rows that a task gathers before it hands them to the blocks
PACK_ROWS = 500_000
# ratings, and numbers of the normal equations, that a batch of problems holds
BATCH_ROWS = 8_192
BATCH_NUMBERS = 250_000
_HASH = np.uint64(0x9E3779B97F4A7C15)
_HASH_BITS = np.uint64(40)


def layout_blocks(training_rows: int) -> int:
    """Blocks of a side for so many training rows."""
    some = min(SOME_BLOCKS, -(-training_rows // LEAST_ROWS))
    return min(MAX_LAYOUT_BLOCKS, max(1, some, -(-training_rows // LAYOUT_ROWS)))


def _block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    mixed = ids.astype(np.int64).view(np.uint64) * _HASH
    return ((mixed >> _HASH_BITS) % np.uint64(blocks)).astype(np.int64)


def _itself(key: int) -> int:
    return key


def _split_by(values: np.ndarray, blocks: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order, [(block, from, to)]): the places of ``values`` sorted by block, and each block's run."""
    block = _block_of(values, blocks)
    order = np.argsort(block, kind="stable")
    found, first = np.unique(block[order], return_index=True)
    return order, list(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(values)]))


def _checked(training: DataFrame) -> DataFrame:
    """Rows (user_id, movie_id, rating float); what ALS refuses is refused with its words."""

    def refuse(bad: Column, said: Column, value: Column) -> Column:
        return F.when(bad, F.raise_error(said)).otherwise(value)

    r = F.col("rating")
    rating = refuse(r.isNull() | F.isnan(r), F.lit("Ratings MUST NOT be Null or NaN"), r)
    for infinite, name in ((float("inf"), "Infinity"), (float("-inf"), "-Infinity")):
        rating = refuse(r == infinite, F.lit(f"Ratings MUST NOT be Infinity, but got {name}"), rating)
    ids = [refuse(F.col(c).isNull(), F.lit(f"{c} Ids MUST NOT be Null"), F.col(c)).alias(c) for c in ("user_id", "movie_id")]
    return training.select(*ids, rating.cast("float").alias("rating"))


def _pack_ratings(blocks: int):
    """Batches (user, item, rating) -> rows (side, block, three arrays as bytes), every rating once for the
    block of its user and once for that of its item, whose ids come first."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held):
            users, items, rating = (np.concatenate([b.column(n).to_numpy(zero_copy_only=False) for b in held]) for n in range(3))
            rows = []
            for side, solve, given in (("users", users, items), ("items", items, users)):
                order, runs = _split_by(solve, blocks)
                columns = solve[order], given[order], rating[order]
                rows += [(side, b, *(c[x:y].tobytes() for c in columns)) for b, x, y in runs]
            names = ["side", "block", "solve", "given", "rating"]
            types = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= PACK_ROWS:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    return pack


def _pack_factors(blocks: int):
    """Batches (id, features) -> rows (block, ids and rows as bytes)."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            features = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            order, runs = _split_by(ids, blocks)
            rows = [(b, ids[order[x:y]].tobytes(), features[order[x:y]].tobytes()) for b, x, y in runs]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.binary(), pa.binary()])]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "ids", "features"])

    return pack


def _unpack_factors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, features in zip(batch.column(0), batch.column(1)):
            ids, features = pa.array(np.frombuffer(ids.as_py(), np.int32)), np.frombuffer(features.as_py(), np.float32)
            ends = np.arange(len(ids) + 1, dtype=np.int32) * (len(features) // len(ids))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(features))], ["id", "features"])


def _layout(solve: np.ndarray, given: np.ndarray, rating: np.ndarray, blocks: int) -> tuple:
    """The fields of a ``_Layout`` of these ratings, and the ids whose factors it needs by their block."""
    order = np.lexsort((rating, given, solve))
    solve, given, rating = solve[order], given[order], rating[order]
    ids, counts = np.unique(solve, return_counts=True)
    by_count = np.argsort(np.repeat(counts, counts), kind="stable")
    places = np.argsort(counts, kind="stable")
    needed, at = np.unique(given[by_count], return_inverse=True)
    sorted_by_block, runs = _split_by(needed, blocks)
    place = np.empty(len(needed), np.int32)
    place[sorted_by_block] = np.arange(len(needed), dtype=np.int32)
    needs = {b: needed[sorted_by_block[x:y]] for b, x, y in runs}
    return (ids[places], counts[places], rating[by_count], place[at], list(needs)), needs


class _Layout:
    """The ratings of one block of a side.

    ``ids`` are sorted by their number of ratings and then by id, so that those of equal ``counts`` are
    neighbours; ``at`` has the place of each rating's factor among the factors needed of other blocks,
    ``needs`` by number, one block after the other.
    """

    def __init__(self, ids: np.ndarray, counts: np.ndarray, rating: np.ndarray, at: np.ndarray, needs: list[int]):
        self.ids, self.counts, self.rating, self.at, self.needs = ids, counts, rating, at, needs

    def places_of(self, ids: np.ndarray) -> np.ndarray:
        sorter = np.argsort(self.ids)
        found = sorter[np.searchsorted(self.ids, ids, sorter=sorter).clip(max=len(sorter) - 1)]
        if not np.array_equal(self.ids[found], ids):
            raise ValueError("a factor of an id without ratings was asked for")
        return found.astype(np.int32)

    def solve(self, given: np.ndarray, reg_param: float) -> np.ndarray:
        """The factors of ``ids`` as floats, from those of the ``needs`` in their order."""
        rank = given.shape[1]
        out = np.empty((len(self.ids), rank), np.float32)
        ends = np.cumsum(self.counts)
        found, first = np.unique(self.counts, return_index=True)
        most = max(1, BATCH_NUMBERS // (rank + 1) ** 2)
        sums, done = np.empty((min(most, len(self.ids)), rank + 1, rank + 1)), 0
        held = 0

        def flush():
            nonlocal done, held
            reg = reg_param * self.counts[done : done + held]
            out[done : done + held] = _solve_ridge(sums[:held], reg)
            done, held = done + held, 0

        for count, x, y in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(self.ids)]):
            step = max(1, BATCH_ROWS // count)
            while x < y:
                n = min(step, y - x, most - held)
                a, b = int(ends[x]) - count, int(ends[x + n - 1])
                sums[held : held + n] = self._sums(given, a, b, n)
                x, held = x + n, held + n
                if held == most:
                    flush()
        flush()
        return out

    def _sums(self, given: np.ndarray, a: int, b: int, n: int) -> np.ndarray:
        """The normal equations of ``n`` problems over the ratings ``a`` to ``b``: of each, the products of
        the factors, with the rating as one more, added up."""
        total = None
        step = b - a if n > 1 else BATCH_ROWS
        for x in range(a, b, step):
            y = min(b, x + step)
            rows = np.empty((y - x, given.shape[1] + 1))
            rows[:, :-1] = np.take(given, self.at[x:y], axis=0, mode="clip")  # faster than with the bounds checked again
            rows[:, -1] = self.rating[x:y]
            rows = rows.reshape(n, -1, rows.shape[1])
            part = np.matmul(rows.transpose(0, 2, 1), rows)
            total = part if total is None else total + part
        return total


def _solve_ridge(sums: np.ndarray, reg: np.ndarray) -> np.ndarray:
    """Cholesky solutions of ``n`` systems at once; the last row and column are the right side."""
    both = np.ascontiguousarray(sums.transpose(1, 2, 0))
    rank = len(both) - 1
    low, x = both[:rank, :rank], both[:rank, rank]
    for j in range(rank):
        low[j, j] += reg
    for j in range(rank):
        low[j:, j] -= np.einsum("ikn,kn->in", low[j:, :j], low[j, :j])
        if (low[j, j] <= 0).any():
            raise ValueError("a ridge problem is not positive definite")
        low[j, j] = np.sqrt(low[j, j])
        low[j + 1 :, j] /= low[j, j]
    for j in range(rank):
        x[j] = (x[j] - np.einsum("kn,kn->n", low[j, :j], x[:j])) / low[j, j]
    for j in reversed(range(rank)):
        x[j] = (x[j] - np.einsum("kn,kn->n", low[j + 1 :, j], x[j + 1 :])) / low[j, j]
    with np.errstate(over="ignore"):
        return x.T.astype(np.float32)


def _by_block(items: Iterable[tuple]) -> dict[int, dict[str, list]]:
    found: dict[int, dict[str, list]] = defaultdict(lambda: defaultdict(list))
    for block, (kind, *rest) in items:
        found[block][kind].append(rest)
    return found


def _lay_out(blocks: int):
    def lay_out(items):
        for block, sides in _by_block(items).items():
            for side, chunks in sides.items():
                types = (np.int32, np.int32, np.float32)
                columns = [np.concatenate([np.frombuffer(c[n], t) for c in chunks]) for n, t in enumerate(types)]
                yield block, (side, *_layout(*columns, blocks))

    return lay_out


def _layouts(side: str):
    return lambda items: ((block, ("layout", *fields)) for block, (of, fields, _) in items if of == side)


def _needs(side: str):
    return lambda item: [(other, ("need", item[0], ids)) for other, ids in item[1][2].items()] if item[1][0] == side else []


def _sends(items):
    for block, found in _by_block(items).items():
        if found["need"]:
            layout = _Layout(*found["layout"][0])
            yield block, ("sends", [(other, layout.places_of(ids)) for other, ids in found["need"]])


def _start(items):
    for block, found in _by_block(items).items():
        layout = _Layout(*found["layout"][0])
        ids = np.concatenate([np.frombuffer(x, np.int32) for x, _ in found["factors"]])
        features = np.concatenate([np.frombuffer(y, np.float32).reshape(len(x) // 4, -1) for x, y in found["factors"]])
        order = np.argsort(ids, kind="stable")
        places = np.searchsorted(ids, layout.ids, sorter=order).clip(max=len(ids) - 1)
        if not np.array_equal(ids[order[places]], layout.ids):
            raise ValueError("an id without start factors")
        yield block, ("factors", features[order[places]])


def _messages(items):
    for block, found in _by_block(items).items():
        (factors,) = found["factors"][0]
        for sends, in found["sends"]:
            for other, places in sends:
                yield other, ("rows", block, factors[places])


def _solve(reg_param: float):
    def solve(items):
        for block, found in _by_block(items).items():
            layout = _Layout(*found["layout"][0])
            rows = dict(found["rows"])
            yield block, ("factors", layout.solve(np.concatenate([rows[other] for other in layout.needs]), reg_param))

    return solve


def _rows(items):
    for _, found in _by_block(items).items():
        layout, (factors,) = _Layout(*found["layout"][0]), found["factors"][0]
        yield layout.ids.tobytes(), np.ascontiguousarray(factors).tobytes()


class RatingBlocks:
    """The training rows (user_id int, movie_id int, rating double) dealt by user and by item, for any
    number of fits; ``close`` gives back what they take."""

    def __init__(self, training: DataFrame, rows: int):
        self.spark = training.sparkSession
        self.training = training
        self.blocks = layout_blocks(rows)
        self._starts: dict[tuple, RDD] = {}
        self._lock = threading.Lock()
        self._kept: list[RDD] = []
        if not rows:
            raise ValueError("no ratings to fit a model to")
        packed = _checked(training).mapInArrow(
            _pack_ratings(self.blocks), "side string, block int, solve binary, given binary, rating binary"
        )
        dealt = self._dealt(packed.rdd.map(lambda r: (r[1], (r[0], bytes(r[2]), bytes(r[3]), bytes(r[4])))))
        laid_out = dealt.mapPartitions(_lay_out(self.blocks), preservesPartitioning=True)
        laid_out.persist(StorageLevel.MEMORY_AND_DISK)
        self._users, self._items = (
            self._persisted(laid_out.mapPartitions(_layouts(side), preservesPartitioning=True)) for side in ("users", "items")
        )
        self._user_sends, self._item_sends = (
            self._persisted(
                side.union(self._dealt(laid_out.flatMap(_needs(other)))).mapPartitions(_sends, preservesPartitioning=True)
            )
            for side, other in ((self._users, "items"), (self._items, "users"))
        )
        for rdd in self._kept:
            rdd.count()
        laid_out.unpersist()

    def _persisted(self, rdd: RDD) -> RDD:
        self._kept.append(rdd.persist(StorageLevel.MEMORY_AND_DISK))
        return rdd

    def _dealt(self, rdd: RDD) -> RDD:
        dealt = rdd.partitionBy(self.blocks, _itself)
        # it reads these rows too, and a union of equally written RDDs does not write them anew
        dealt._jrdd_deserializer = self.spark.sparkContext.serializer
        return dealt

    def _cut(self, rdd: RDD) -> RDD:
        """``rdd`` persisted, written to the checkpoint folder, and without what it was made from: an RDD in
        Python holds those before it, and so their shuffles."""
        rdd.persist(StorageLevel.MEMORY_AND_DISK).checkpoint()
        rdd.count()
        cut = RDD(rdd._jrdd, rdd.ctx, rdd._jrdd_deserializer)
        cut.partitioner = rdd.partitioner
        return cut

    def _factors(self, frame: DataFrame) -> RDD:
        packed = frame.select("id", "features").mapInArrow(_pack_factors(self.blocks), "block int, ids binary, features binary")
        dealt = self._dealt(packed.rdd.map(lambda r: (r[0], ("factors", bytes(r[1]), bytes(r[2])))))
        return self._users.union(dealt).mapPartitions(_start, preservesPartitioning=True)

    def _drawn(self, als: ALS) -> RDD:
        """The start factors of the users as Spark's ALS draws them: by block of users and the order of
        the ids in it, whatever they rated, so one rating of each is enough to have them drawn."""
        key = (als.getRank(), als.getNumUserBlocks(), als.getNumItemBlocks(), als.getSeed())
        with self._lock:
            if key not in self._starts:
                one = self.training.groupBy("user_id").agg(F.min("movie_id").alias("movie_id"), F.lit(0.0).alias("rating"))
                drawn = als.copy({als.maxIter: 0}).fit(one)
                self._starts[key] = self._cut(self._factors(drawn.userFactors))
            return self._starts[key]

    def _solved(self, side: RDD, factors: RDD, sends: RDD, reg_param: float) -> RDD:
        messages = self._dealt(factors.union(sends).mapPartitions(_messages))
        return side.union(messages).mapPartitions(_solve(reg_param), preservesPartitioning=True)

    def _frame(self, side: RDD, factors: RDD) -> DataFrame:
        rows = side.union(factors).mapPartitions(_rows)
        return self.spark.createDataFrame(rows, "ids binary, features binary").mapInArrow(_unpack_factors, "id int, features array<float>")

    @contextmanager
    def fitted(self, als: ALS, before: tuple[int, ALSModel] | None = None, after_iteration=lambda n: None) -> Iterator[ALSModel]:
        """The model of ``als``; ``before`` is one with the same parameters but fewer iterations (their number, the
        model) to go on from. The factors are kept while the context is open."""
        if als.getMaxIter() < 1:
            yield als.fit(self.training)
            return
        done = before[0] if before else 0
        users = self._factors(before[1].userFactors) if before else self._drawn(als)
        items, kept, written = None, [], []
        try:
            for n in range(done, als.getMaxIter()):
                items = self._solved(self._items, users, self._user_sends, als.getRegParam()).persist(StorageLevel.MEMORY_AND_DISK)
                users = self._solved(self._users, items, self._item_sends, als.getRegParam()).persist(StorageLevel.MEMORY_AND_DISK)
                if (n + 1) % als.getCheckpointInterval() == 0:
                    users = self._cut(users)
                    written.append(users)
                else:
                    users.count()
                kept += [items, users]
                for rdd in kept[:-3]:  # the items of this iteration are made again from the users before it
                    rdd.unpersist()
                self._remove_checkpoints(written[:-2])
                kept, written = kept[-3:], written[-2:]
                after_iteration(n + 1)
            made = self.spark._jvm.org.apache.spark.ml.recommendation.ALSModel(
                als.uid, als.getRank(), self._frame(self._users, users)._jdf, self._frame(self._items, items)._jdf
            )
            yield als._copyValues(ALSModel(made))
        finally:
            for rdd in kept:
                rdd.unpersist()
            self._remove_checkpoints(written)

    def _remove_checkpoints(self, rdds: Iterable[RDD]) -> None:
        for rdd in rdds:
            files.remove(self.spark, rdd.getCheckpointFile())

    def close(self) -> None:
        for rdd in [*self._kept, *self._starts.values()]:
            rdd.unpersist()
        self._remove_checkpoints(self._starts.values())
        self._kept, self._starts = [], {}
