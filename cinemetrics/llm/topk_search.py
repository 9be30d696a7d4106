"""Exact top-k inner-product search with an impact-ordered, score-at-a-time index.

Vectors are dealt into blocks of bounded size. A block's index has a posting segment for every
level of quantised impact (the magnitude of a component, in powers of four): the vectors and
dimensions with such components, and their values. A batch of queries processes the segments
by descending impact and adds up the scores of all vectors of the block at once.

Every query starts with a threshold: its k-th best score among the vectors of a bounded head,
found in a pass before. After a segment, what is missing from the score of query q and vector v
is at most |q| * |rest(v)|, rest(v) being v's components in the segments not yet processed. A
vector whose score and missing part stay under the threshold is proven not to be among the k
best. A query stops when few vectors are left that could be, and rescores those exactly; if it
never does, all segments are processed.

Sums are exact: while |q| * |v| < 2^53 all partial sums are whole numbers that doubles hold
without rounding, in any order. Beyond that the pair of block and batch is scored with 64-bit
integers, or with Python's where even these could overflow, and nothing is pruned.

Every batch meets every block (a fixed query set against all rows, in blocks); the index of a
block is built once for a batch of ``BATCH_ROWS`` queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle

SCALE = 64
K = 20
QUERY_MODULUS = 20
# vectors of a block, and numbers in it at most (a single vector may have more)
BLOCK_ROWS = 4096
BLOCK_VALUES = 1 << 21
BATCH_ROWS = 1024
# queries whose scores are added up at a time
STEP = 256
# a query stops once at most this many vectors of the block can still be among its best
RESCORE = 200
# integer sums up to this are exact in doubles, and in 64-bit integers
EXACT_DOUBLE = 2.0**53 * 0.999
EXACT_LONG = 2.0**63 * 0.999

_PACKED = "_block long, _kind string, _width int, _rows binary, _ids binary, _values binary"


def usable_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<double>) of the vectors that take part: not null, no null or non-finite
    component, an id. Rows that repeat an id stay rows of their own."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The vectors of a list column as rows; shorter ones end in zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    lengths = np.diff(lists.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _pack_rows(table: pa.Table) -> pa.Table:
    x = _matrix(table.column("x"))
    with np.errstate(over="ignore"):
        v = np.floor(x * SCALE)
    most = np.abs(v).max(initial=0)
    # whole numbers where they are small, else the components as they are
    kind, values = ("<i2", v) if most < 1 << 15 else ("<i4", v) if most < 1 << 31 else ("<f8", x)

    def binary(a: np.ndarray) -> pa.Array:
        return pa.array([a.tobytes()], pa.binary())

    return pa.table(
        {
            "_block": pa.array([table.column("_block")[0].as_py()], pa.int64()),
            "_kind": pa.array([kind]),
            "_width": pa.array([x.shape[1]], pa.int32()),
            "_rows": binary(table.column("_row").to_numpy().astype("<i8")),
            "_ids": binary(table.column("vec_id").to_numpy().astype("<i8")),
            "_values": binary(values.astype(kind)),
        }
    )


def _packed(vectors: DataFrame, rows: int, per_row: int) -> DataFrame:
    """One row of packed numbers for about every ``per_row`` vectors."""
    blocks = max(1, -(-rows // per_row))
    dealt = vectors.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    return dealt.groupBy("_block").applyInArrow(_pack_rows, _PACKED)


class Vectors:
    """Packed vectors: row numbers, ids, and the components times 64, rounded down."""

    def __init__(self, kind: str, width: int, rows: bytes, ids: bytes, values: bytes):
        self.rows, self.ids = np.frombuffer(rows, "<i8"), np.frombuffer(ids, "<i8")
        given = np.frombuffer(values, kind).reshape(len(self.rows), width).astype(np.float64)
        self.unscaled = given if kind == "<f8" else None
        with np.errstate(over="ignore"):
            self.values = given if self.unscaled is None else np.floor(given * SCALE)
            self.norm = np.sqrt((self.values**2).sum(axis=1))

    def whole(self, width: int) -> np.ndarray:
        """The first ``width`` components as Python integers."""
        if self.unscaled is None:
            return self.values[:, :width].astype(np.int64).astype(object)
        # a component too large for doubles when scaled is a whole number itself
        exact = [int(v) if np.isfinite(v) else int(x) * SCALE for v, x in zip(self.values.flat, self.unscaled.flat)]
        return np.array(exact, dtype=object).reshape(self.values.shape)[:, :width]


def kth_best(queries: Vectors, head: Vectors, k: int) -> np.ndarray:
    """For each query a score that k vectors of the head other than its own reach (or -infinity)."""
    out = np.full(len(queries.rows), -np.inf)
    width = min(queries.values.shape[1], head.values.shape[1])
    if not _fits(queries, head, EXACT_DOUBLE):
        return out
    for at in range(0, len(out), STEP):
        part = slice(at, at + STEP)
        score = queries.values[part, :width] @ head.values[:, :width].T
        score[queries.rows[part, None] == head.rows[None, :]] = -np.inf
        if score.shape[1] >= k:
            out[part] = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
    return out


def _fits(a: Vectors, b: Vectors, limit: float) -> bool:
    """Whether the products of any two vectors, added up in any order, stay under ``limit``."""
    return bool(a.norm.max(initial=0) * b.norm.max(initial=0) < limit)


class ImpactIndex:
    """Posting segments of one block by descending impact: (vectors, dimensions, values), and the
    norm of what is left of every vector after each."""

    def __init__(self, block: Vectors):
        self.block = block
        values = block.values
        level = (np.frexp(np.abs(values))[1] + 1) >> 1  # 0: zero, n: magnitude in [4^(n-1) / 2, 4^n / 2)
        left = values**2
        self.segments, self.rest = [], []
        for n in np.unique(level[values != 0])[::-1]:
            here = (level == n) & (values != 0)
            at, dims = np.flatnonzero(here.any(axis=1)), np.flatnonzero(here.any(axis=0))
            cut = np.ix_(at, dims)
            self.segments.append((at, dims, np.where(here[cut], values[cut], 0.0)))
            left[here] = 0.0
            self.rest.append(np.sqrt(left.sum(axis=1)))

    def possible(self, queries: np.ndarray, norms: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(query, vectors that can have ``least`` or more with it), each query once."""
        n = len(self.block.rows)
        active = np.arange(len(queries))
        score = np.zeros((n, len(active)))
        for (at, dims, values), rest in zip(self.segments, self.rest):
            if not len(active):
                return
            known = dims < queries.shape[1]
            gain = values[:, known] @ queries[active][:, dims[known]].T
            if len(at) == n:
                score += gain
            else:
                score[at] += gain
            # the bound is rounded up: norms have relative errors far below 1e-9
            may = score + (rest * (1 + 1e-9))[:, None] * norms[active] >= least[active]
            few = np.count_nonzero(may, axis=0) <= RESCORE
            for c in np.flatnonzero(few):
                yield int(active[c]), np.flatnonzero(may[:, c])
            if few.any():
                active, score = active[~few], score[:, ~few]
        for c, q in enumerate(active):
            yield int(q), np.flatnonzero(score[:, c] >= least[q])


def _best(exact: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if exact.dtype == object:
        return np.array(sorted(range(len(exact)), key=lambda i: (-exact[i], ids[i]))[:k], dtype=np.int64)
    return np.lexsort((ids, -exact))[:k]


def search(index: ImpactIndex, queries: Vectors, least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, vectors, exact scores): the k best of the block that reach ``least``."""
    block = index.block
    width = min(block.values.shape[1], queries.values.shape[1])
    if not _fits(block, queries, EXACT_DOUBLE):
        longs = _fits(block, queries, EXACT_LONG)
        v = block.values[:, :width].astype(np.int64) if longs else block.whole(width)
        q = queries.values[:, :width].astype(np.int64) if longs else queries.whole(width)
        for i in range(len(queries.rows)):
            at = np.flatnonzero(block.rows != queries.rows[i])
            exact = v[at] @ q[i] if width else np.zeros(len(at), dtype=np.int64)
            best = _best(exact, block.ids[at], k)
            yield i, at[best], exact[best]
        return
    for start in range(0, len(queries.rows), STEP):
        part = slice(start, start + STEP)
        for i, at in index.possible(queries.values[part, :width], queries.norm[part], least[part]):
            i += start
            at = at[block.rows[at] != queries.rows[i]]
            exact = block.values[at, :width] @ queries.values[i, :width]
            best = _best(exact, block.ids[at], k)
            yield i, at[best], exact[best].astype(np.int64)


_FIELDS = ("_kind", "_width", "_rows", "_ids", "_values")


def _unpack(row: dict, prefix: str) -> Vectors:
    return Vectors(*[row[prefix + f] for f in _FIELDS])


def _seed_batches(shared, k: int):
    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Vectors(*shared.value)
        for batch in batches:
            least = [kth_best(_unpack(r, "_q"), head, k).tobytes() for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.binary())], names=[*batch.schema.names, "_least"])

    return seed


def _search_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                queries, index = _unpack(row, "_q"), ImpactIndex(_unpack(row, ""))
                found = list(search(index, queries, np.frombuffer(row["_least"]), k))
                times = [len(at) for _, at, _ in found]
                query = np.repeat(np.array([i for i, _, _ in found], dtype=np.int64), times)
                none = [np.empty(0, dtype=np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(queries.rows[query]),
                        pa.array(queries.ids[query]),
                        pa.array(index.block.ids[np.concatenate([at for _, at, _ in found] + none)]),
                        # a score that does not fit a long is an error here
                        pa.array([int(s) for _, _, scores in found for s in scores], pa.int64()),
                    ],
                    names=["_row", "query_id", "vec_id", "score"],
                )

    return run


def top_k(
    vectors: DataFrame,
    k: int = K,
    modulus: int = QUERY_MODULUS,
    block_rows: int = BLOCK_ROWS,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``vectors`` (vec_id, embedding): for each row whose
    id is divisible by ``modulus`` the ``k`` other rows with the largest integer inner product,
    ties to the smaller vec_id; fewer if there are fewer.

    What takes part is stated at ``usable_vectors``. Rows that repeat an id are candidates and queries
    each, a query's own row being left out alone. Vectors of different length are compared
    as if the shorter ended in zeros. Components of any finite size are exact; only a score
    among the best that does not fit a long raises an error. Empty table or no query: empty
    result. Other columns are not read.
    """
    if k < 1:
        raise ValueError("k must be positive")
    usable = settle(usable_vectors(vectors)).withColumn("_row", F.monotonically_increasing_id())
    is_query = F.pmod(F.col("vec_id"), F.lit(modulus)) == 0
    n, n_queries, width = usable.agg(F.count(F.lit(1)), F.count_if(is_query), F.max(F.size("x"))).first()
    narrow = max(1, BLOCK_VALUES // max(width or 1, 1))
    block_rows, batch_rows = min(block_rows, narrow), min(batch_rows, narrow)
    blocks, batches = max(1, -(-n // block_rows)), max(1, -(-n_queries // batch_rows))
    index = _packed(usable, n, block_rows)
    batch = _packed(usable.where(is_query), n_queries, batch_rows)
    batch = batch.select(F.col("_block").alias("_batch"), *[F.col(c).alias("_q" + c) for c in _FIELDS])

    # the head: about one block's worth of vectors (16 MB at most), whatever their number
    in_head = F.pmod(F.xxhash64(F.lit(1), "_row"), F.lit(blocks)) == 0
    head = usable.where(in_head).withColumn("_block", F.lit(0).cast("long")).groupBy("_block").applyInArrow(_pack_rows, _PACKED).first()
    packed = tuple(bytes(head[c]) if c[1:] in ("rows", "ids", "values") else head[c] for c in _FIELDS) if head else ("<i2", 0, b"", b"", b"")
    shared = vectors.sparkSession.sparkContext.broadcast(packed)
    schema = f"_batch long, {', '.join(f'_q{c} {t}' for c, t in zip(_FIELDS, ('string', 'int', 'binary', 'binary', 'binary')))}, _least binary"
    seeded = batch.mapInArrow(_seed_batches(shared, k), schema)

    everywhere = seeded.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pairs = everywhere.join(index, "_block").repartition(min(blocks * batches, 20_000), "_block", "_batch")
    found = pairs.drop("_block", "_batch").mapInArrow(_search_batches(k), "_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
