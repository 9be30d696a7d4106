"""N-gram Jaccard join: vertical partitioning of the n-gram order, partial overlaps, sums per pair.

The global order of all n-grams is that of their 64-bit hashes. It is cut into fragments, and a
document's set into one segment per fragment, twice:

* Candidates. Two sets of a and b n-grams with Jaccard similarity t or more differ in at most
  d = (a + b) * (1 - t) / (1 + t) n-grams. With m > d fragments at least m - d segments of the two
  are equal. A set puts forward the hashes of its d + 1 largest segments only, and still no
  pair is lost: of the equal segments the largest is among the d + 1 largest of either set, since
  fewer than d + 1 fragments are left beside the equal ones. m follows from the size class of the
  set (each half as large again as the one before; a set close to the next class puts itself
  forward there too). Sets that share a segment hash form families, by connected components.
* Counts. Inside a family the members' n-grams are cut into fragments again; the overlaps of
  all pairs are counted fragment by fragment (a product of two 0/1 matrices) and added up.

Equal sets are one node from the start, so exact copies make no pairs. A family of more than
``BLOCK_SETS`` sets or ``BLOCK_SHINGLES`` n-grams is dealt into size classes and, inside these,
into blocks by a hash; every block meets those whose sizes it can be similar to, two blocks to
a task. A task gives one row for each of its sets, not its pairs: the set's representative among
the sets that links inside the task connect, and its number of links. So rows and shuffles
grow with the blocks of a family, not with its pairs.

Set hashes are 64 bits wide: in a pair of sets two different n-grams fall together once in
2^64 / (a * b) pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle
from cinemetrics.llm.components import connected_components
from cinemetrics.operators.broadcast import broadcast_if_bounded

SHINGLE_WORDS = 3
MIN_PERCENT = 90
BLOCK_SETS = 512
BLOCK_SHINGLES = 300_000
# columns of one 0/1 matrix: the n-grams of a fragment
FRAGMENT_SHINGLES = 4096

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text (A-Z lower-cased); a text of fewer
    words is one n-gram, a text without words has none."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, dtype=_U)
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=_U, count=len(tokens))
    length = min(words, len(tokens))
    out = np.full(len(h) - length + 1, length, dtype=_U)
    for k in range(length):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[k : len(h) - length + 1 + k])
    return np.unique(out)


def _most_different(size: int, percent: int) -> int:
    """The most n-grams in which a set of this size and a similar one can differ."""
    return (size + 100 * size // percent) * (100 - percent) // (100 + percent)


@cache
def _classes(percent: int) -> tuple[np.ndarray, tuple[int, ...]]:
    """(smallest size of each class, fragments of each class); smaller sets link to equal ones only."""
    if percent >= 100:
        return np.array([1 << 62]), (1,)
    least = [next(s for s in range(1, 1 << 20) if _most_different(s, percent))]
    while least[-1] < 1 << 40:
        least.append(least[-1] * 3 // 2 + 1)
    fragments = tuple(5 * (_most_different(end - 1, percent) + 1) // 4 + 1 for end in least[1:])
    return np.array(least), fragments


def segment_hashes(shingles: np.ndarray, percent: int = MIN_PERCENT) -> np.ndarray:
    """Hashes of (class, fragment, segment) that any similar, different set shares one of."""
    size = len(shingles)
    least, fragments = _classes(percent)
    if size < least[0]:
        return np.empty(0, dtype=_U)
    forward = _most_different(size, percent) + 1
    own = int(np.searchsorted(least, size, side="right")) - 1
    sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(_mix(shingles + _U(1)), dtype=_U)])
    out = []
    for k in (own, own + 1) if 100 * size // percent >= least[own + 1] else (own,):
        m = fragments[k]
        fragment = (((shingles >> _U(32)) * _U(m)) >> _U(32)).astype(np.int64)
        sizes = np.bincount(fragment, minlength=m)
        ends = np.cumsum(sizes)
        segments = sums[ends] - sums[ends - sizes]
        largest = np.lexsort((np.arange(m), sizes))[m - forward :]
        out.append(_mix(segments[largest] + _mix((largest + (k << 40)).astype(_U))))
    return np.concatenate(out)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two longs."""
    a = np.add.reduce(_mix(shingles + _U(2)), dtype=_U).astype(np.int64)
    b = np.bitwise_xor.reduce(_mix(shingles + _U(3)), dtype=_U).astype(np.int64)
    return int(a), int(b)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for t in batch.column("text"):
        yield t.as_buffer().to_pybytes() if t.is_valid else b""


def _print_batches(id_type: pa.DataType, words: int, percent: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, words) for t in _texts(batch)]
            hashes = [segment_hashes(s, percent).astype(np.int64) for s in sets]
            keys = np.array([set_key(s) for s in sets], dtype=np.int64).reshape(-1, 2)
            offsets = np.cumsum([0, *map(len, hashes)], dtype=np.int32)
            flat = np.concatenate([*hashes, np.empty(0, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(id_type), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]),
                    pa.array(keys[:, 1]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["doc_id", "n_shingles", "_k1", "_k2", "_segments"],
            )

    return prints


def _set_batches(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, words) for t in _texts(batch)]
            keys = np.array([set_key(s) for s in found], dtype=np.int64).reshape(-1, 2)
            packed = [s.astype("<u8").tobytes() for s in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(packed, pa.binary())], names=["_k1", "_k2", "_set"]
            )

    return sets


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common n-grams of every left and every right set, summed over fragments."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    row_a = np.repeat(np.arange(len(left)), [len(s) for s in left])
    row_b = np.repeat(np.arange(len(right)), [len(s) for s in right])
    common = np.intersect1d(a, b)
    if not len(common):
        return out
    at_a, at_b = np.searchsorted(common, a), np.searchsorted(common, b)
    in_a = common[np.minimum(at_a, len(common) - 1)] == a
    in_b = common[np.minimum(at_b, len(common) - 1)] == b
    at_a, row_a, at_b, row_b = at_a[in_a], row_a[in_a], at_b[in_b], row_b[in_b]
    for first in range(0, len(common), FRAGMENT_SHINGLES):
        width = min(FRAGMENT_SHINGLES, len(common) - first)
        x, y = np.zeros((len(left), width), dtype=np.float32), np.zeros((len(right), width), dtype=np.float32)
        of = (at_a >= first) & (at_a < first + width)
        x[row_a[of], at_a[of] - first] = 1
        of = (at_b >= first) & (at_b < first + width)
        y[row_b[of], at_b[of] - first] = 1
        out += (x @ y.T).astype(np.int64)
    return out


def _similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    common = overlaps(left, right)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - common
    return 100 * common >= percent * union


def _representatives(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the first row that its links reach."""
    out = np.full(len(linked), -1)
    for i in range(len(linked)):
        if out[i] < 0:
            edge = np.zeros(len(linked), dtype=bool)
            edge[i] = True
            seen = edge.copy()
            while edge.any():
                edge = linked[edge].any(axis=0) & ~seen
                seen |= edge
            out[seen] = i
    return out


def _link_block(percent: int):
    def link(table: pa.Table) -> pa.Table:
        nodes = table.column("_node").to_numpy()
        copies = table.column("_copies").to_numpy()
        sets = [np.frombuffer(s, dtype="<u8") for s in table.column("_set").to_pylist()]
        second = table.column("_second").to_numpy().astype(bool)
        a = np.flatnonzero(~second)
        linked = np.zeros((len(nodes), len(nodes)), dtype=bool)
        if second.any() and len(a):
            b = np.flatnonzero(second)
            met = _similar([sets[i] for i in a], [sets[i] for i in b], percent)
            linked[np.ix_(a, b)] = met
            linked[np.ix_(b, a)] = met.T
        elif len(a) > 1:
            linked = _similar(sets, sets, percent)
            np.fill_diagonal(linked, False)
        some = np.flatnonzero(linked.any(axis=1))
        first = _representatives(linked)
        return pa.table(
            {
                "_node": pa.array(nodes[some], pa.int64()),
                "_to": pa.array(nodes[first[some]], pa.int64()),
                "_links": pa.array((linked @ copies)[some], pa.int64()),
            }
        )

    return link


def _meetings(members: DataFrame, percent: int, block_sets: int, block_shingles: int) -> DataFrame:
    """``members`` (_family, _node, _size, ...) once for each task they take part in: _task, _second."""

    def blocks(n, size):
        return F.greatest(F.ceil(n / block_sets), F.ceil(size / block_shingles)).cast("int")

    # similar sizes lie in one class or in neighbouring ones
    ratio = F.log(F.lit(100 / percent)) if percent < 100 else F.lit(1.0)
    band = F.floor(F.log(F.greatest("_size", F.lit(1)).cast("double")) / ratio * 0.999999).cast("int")
    counted = members.groupBy("_family", band.alias("_band")).agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_total"))
    # from here on a family is a row for each of its size classes; only families of several blocks go on
    family = Window.partitionBy("_family")
    near = family.orderBy("_band")
    alone = blocks(F.col("_n"), F.col("_total"))
    cells = counted.select(
        F.col("_family").alias("_of"), F.col("_band").alias("_at"), alone.alias("_blocks"),
        F.max(alone).over(near.rangeBetween(1, 1)).alias("_above"), F.max(alone).over(near.rangeBetween(-1, -1)).alias("_below"),
        blocks(F.sum("_n").over(family), F.sum("_total").over(family)).alias("_whole"),
    ).where(F.col("_whole") > 1)
    # joined on a hash of both: adaptive execution can split the rows of a large family
    key = (F.xxhash64("_family", band) == F.xxhash64("_of", "_at")) & (F.col("_family").bitwiseXOR(F.col("_of")) == 0) & (band - F.col("_at") == 0)
    dealt = members.join(broadcast_if_bounded(cells), key, "left")
    dealt = dealt.withColumn("_band", F.coalesce("_at", F.lit(0))).withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
    own, band_ = F.col("_block"), F.col("_band")

    def task(band_a, block_a, band_b, block_b, second):
        return F.struct(F.struct(band_a.alias("a"), block_a.alias("i"), band_b.alias("b"), block_b.alias("j")).alias("_task"), second.alias("_second"))

    def upto(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    none = F.lit(False)
    with_own = F.transform(upto("_blocks"), lambda j: task(band_, F.least(own, j), band_, F.greatest(own, j), own > j))
    with_above = F.transform(upto("_above"), lambda j: task(band_, own, band_ + 1, j, none))
    with_below = F.transform(upto("_below"), lambda j: task(band_ - 1, j, band_, own, ~none))
    empty = F.slice(with_own, F.lit(1), F.lit(0))
    every = F.concat(with_own, F.coalesce(with_above, empty), F.coalesce(with_below, empty))
    return dealt.select(*members.columns, F.inline(every))


def jaccard_components(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    percent: int = MIN_PERCENT,
    block_sets: int = BLOCK_SETS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per row of ``docs`` (doc_id, text).

    Two rows are linked when 100 * |intersection| >= percent * |union| of their n-gram sets;
    ``n_links`` counts the rows a row is linked with. component_id is the smallest doc_id
    reachable by links, itself included. Null and empty texts and those without words have an empty
    set and no links; their component is their own id. Null ids are never the smallest; a component
    of null ids only has a null component_id. Rows that repeat an id keep one row each. Other
    columns are not read. ``percent`` is 70 to 100.
    """
    if not 70 <= percent <= 100 or words < 1:
        raise ValueError("percent is 70 to 100, words 1 at least")
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema["doc_id"].dataType
    texts = docs.select("doc_id", "text")
    schema = f"doc_id {id_type.simpleString()}, n_shingles long, _k1 long, _k2 long, _segments array<long>"
    prints = settle(texts.mapInArrow(_print_batches(to_arrow_type(id_type), words, percent), schema))
    sets = prints.where(F.col("n_shingles") > 0).groupBy("_k1", "_k2", "n_shingles").agg(
        F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_copies"), F.first("_segments").alias("_segments")
    )
    nodes = settle(sets.withColumnRenamed("n_shingles", "_size").withColumn("_node", F.monotonically_increasing_id()))

    keyed = nodes.select("_node", F.explode("_segments").alias("_segment"))
    families = connected_components(_stars(keyed), "a", "b").select(F.col("node").alias("_node"), F.col("component").alias("_family"))
    members = settle(nodes.drop("_segments").join(families, "_node"))

    ids = broadcast_if_bounded(members.select(F.col("_least").alias("_id")).distinct())
    again = texts.join(ids, texts["doc_id"].eqNullSafe(ids["_id"]), "left_semi")
    packed = again.mapInArrow(_set_batches(words), "_k1 long, _k2 long, _set binary").dropDuplicates(["_k1", "_k2"])
    narrow = _meetings(members.select("_family", "_node", "_size", "_copies", "_k1", "_k2"), percent, block_sets, block_shingles)
    tasks = narrow.join(packed, ["_k1", "_k2"]).select("_family", "_task", "_second", "_node", "_copies", "_set")
    links = settle(tasks.groupBy("_family", "_task").applyInArrow(_link_block(percent), "_node long, _to long, _links long"))

    component = connected_components(links, "_node", "_to")
    degree = links.groupBy("_node").agg(F.sum("_links").alias("_links"))
    named = (
        nodes.drop("_segments")
        .join(component.withColumnRenamed("node", "_node"), "_node", "left")
        .join(degree, "_node", "left")
        .withColumn("_root", F.coalesce("component", "_node"))
    )
    roots = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    n_links = (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links")
    labels = named.join(roots, "_root").select("_k1", "_k2", F.col("_size").alias("n_shingles"), "component_id", n_links)
    linked = prints.where(F.col("n_shingles") > 0).drop("_segments").join(labels, ["_k1", "_k2", "n_shingles"])
    empty = prints.where(F.col("n_shingles") == 0)
    return linked.select("doc_id", "n_shingles", "component_id", "n_links").unionByName(
        empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    )


def _stars(keyed: DataFrame) -> DataFrame:
    """(a, b): the nodes (_node) that share a segment hash (_segment), each with the least of them."""
    # grouped by the hash and a part of it, joined on the hash: both sides are then shuffled for the
    # join itself, and adaptive execution can split a segment that a third of the sets hold
    least = (
        keyed.groupBy("_segment", F.shiftright("_segment", 32).alias("_part"))
        .agg(F.min("_node").alias("b"), F.max("_node").alias("_last"))
        .where(F.col("b") != F.col("_last"))
        .select(F.col("_segment").alias("_shared"), "b")
    )
    pairs = keyed.join(least, F.col("_segment") == F.col("_shared"))
    return pairs.select(F.col("_node").alias("a"), "b").where(F.col("a") != F.col("b"))
