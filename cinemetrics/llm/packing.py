"""Best-fit packing of tokenized documents into sequences, by swap-based local search.

Documents are cut into pieces of at most ``SEQUENCE`` tokens, which are dealt to groups of about
``GROUP_PIECES`` by a hash, so that the packing does not depend on how the input was split. In a
group the pieces are first put into bins as they come (first fit among a few open bins). The local
search then raises the sum of squared fills step by step: the fullest underfull bin takes, from
any less full one, the piece that fills it best by a move, a one-for-one exchange or an exchange
of two of its pieces for one, until no step raises the sum; then the next bin does, in sweeps
until none finds a step. Bins that become empty are gone. The few bins that stay badly filled (at most ``LOOSE`` full) are packed
again together with those of the other groups, in rounds, until one group holds them.

Only row numbers and lengths go through the search; a task holds one group at a time.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle
from cinemetrics.llm.word_bpe import WordBpe

SEQUENCE = 2048
SEPARATOR_ID = 0
GROUP_PIECES = 8192
# bins at most this full are packed again with those of other groups
LOOSE = 0.9
# bins that the opening keeps open
OPEN_BINS = 8


def opening(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of piece indexes) in order of arrival: each piece into the first open bin that holds it."""
    bins: list[list[int]] = []
    room: list[int] = []
    open_bins: list[int] = []
    for i, n in enumerate(lengths):
        b = next((b for b in open_bins if room[b] >= n), None)
        if b is None:
            b = len(bins)
            bins.append([])
            room.append(capacity)
            open_bins = [*open_bins[-OPEN_BINS + 1 :], b]
        bins[b].append(i)
        room[b] -= n
    return bins


class LocalSearch:
    """Bins of pieces and the steps between them. ``step`` is one move or exchange; every step
    raises the sum of squared fills."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.capacity = [list(b) for b in bins], lengths, capacity
        self.fill = [sum(lengths[i] for i in b) for b in self.bins]
        self.where = {i: b for b, members in enumerate(self.bins) for i in members}
        self.many = len(lengths) + 1
        # pieces that may be taken, by length: one number each
        self.pool = sorted(self._key(i) for b, f in enumerate(self.fill) if f < capacity for i in self.bins[b])

    def _key(self, i: int) -> int:
        return self.lengths[i] * self.many + i

    def _withdraw(self, i: int) -> None:
        self.pool.pop(bisect_left(self.pool, self._key(i)))

    def step(self, b: int) -> int | None:
        """Give bin b (its pieces not in the pool) the piece that fills it best, and of several the
        longest: the bin that gave it, or None if no step raises the sum.

        Shifting s > 0 tokens from fill x to fill y changes the sum by 2s(y - x + s).
        """
        mine, lengths = self.bins[b], self.lengths
        room = self.capacity - self.fill[b]
        best, chosen = (0, 0), None
        outs = [(), *((j,) for j in mine), *((j, k) for n, j in enumerate(mine) for k in mine[n + 1 :])]
        for out in outs:
            back = sum(lengths[j] for j in out)
            at = bisect_right(self.pool, (room + back) * self.many + self.many - 1) - 1
            if at < 0:
                continue
            length, i = divmod(self.pool[at], self.many)
            shift = length - back
            if shift > 0 and (shift, length) > best and self.fill[b] - self.fill[self.where[i]] + shift > 0:
                best, chosen = (shift, length), (out, i)
        if chosen is None:
            return None
        out, i = chosen
        giver = self.where[i]
        self._withdraw(i)
        self.bins[giver].remove(i)
        mine.append(i)
        self.where[i] = b
        for j in out:
            mine.remove(j)
            self.bins[giver].append(j)
            self.where[j] = giver
            insort(self.pool, self._key(j))
        self.fill[b] += best[0]
        self.fill[giver] -= best[0]
        return giver

    def sweep(self) -> bool:
        """Fill the underfull bins in turn, the fullest first; whether any step was taken."""
        self.pool = sorted(self._key(i) for b, f in enumerate(self.fill) if f < self.capacity for i in self.bins[b])
        waiting = [(-f, b) for b, f in enumerate(self.fill) if f < self.capacity]
        heapq.heapify(waiting)
        closed: set[int] = set()
        moved = False
        while waiting:
            fill, b = heapq.heappop(waiting)
            if b in closed or -fill != self.fill[b]:
                continue
            closed.add(b)
            for i in self.bins[b]:
                self._withdraw(i)
            while self.bins[b] and self.fill[b] < self.capacity:
                giver = self.step(b)
                if giver is None:
                    break
                moved = True
                heapq.heappush(waiting, (-self.fill[giver], giver))
        return moved

    def run(self) -> list[list[int]]:
        """Sweep until no step raises the sum; the bins that are left."""
        while self.sweep():
            pass
        return [b for b in self.bins if b]


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """``bins`` after the search; never more bins than before."""
    return LocalSearch(bins, lengths, capacity).run()


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins: pieces by decreasing length, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    open_bins: list[tuple[int, int]] = []  # (room, bin), sorted
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(open_bins, (lengths[i], -1))
        room, b = open_bins.pop(at) if at < len(open_bins) else (capacity, len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
        if room > lengths[i]:
            insort(open_bins, (room - lengths[i], b))
    return bins


def pack(lengths: list[int], capacity: int = SEQUENCE) -> list[list[int]]:
    """Search from the pieces in order of arrival. Where that stays above the fewest bins that could
    hold them (as in small groups), search from best fit too, and take the better."""
    found = local_search(opening(lengths, capacity), lengths, capacity)
    if len(found) > -(-sum(lengths) // capacity):
        found = min(found, local_search(best_fit(lengths, capacity), lengths, capacity), key=len)
    return found


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACE = "_row long, sequence_id long, offset long, _loose boolean"


def _place_group(first_id: int, capacity: int, loose_fill: float):
    def place(table: pa.Table) -> pa.Table:
        rows, lengths = table.column("_row").to_numpy(), table.column("length").to_pylist()
        next_id = first_id + (table.column("_group")[0].as_py() << 32)
        at, sequence, offset, loose = [], [], [], []
        for n, members in enumerate(pack(lengths, capacity)):
            end = 0
            for i in members:
                at.append(i)
                sequence.append(next_id + n)
                offset.append(end)
                end += lengths[i]
            loose += [end <= loose_fill * capacity] * len(members)
        return pa.table(
            {
                "_row": pa.array(rows[at], pa.int64()), "sequence_id": pa.array(sequence, pa.int64()),
                "offset": pa.array(offset, pa.int64()), "_loose": pa.array(loose, pa.bool_()),
            }
        )

    return place


def _placed(pieces: DataFrame, capacity: int, group_pieces: int) -> DataFrame:
    """(_row, sequence_id, offset) of pieces (_row, length)."""
    left, done = pieces, None
    round_no, before = 0, None
    while True:
        waiting = left.count()
        groups = -(-waiting // group_pieces)
        # one group is the last round; so is a round that closes no more bins
        last = groups <= 1 or waiting == before
        dealt = left.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(round_no)), F.lit(max(groups, 1))))
        fill = -1.0 if last else LOOSE
        place = _place_group(-(round_no << 56), capacity, fill)
        placed = settle(dealt.select("_group", "_row", "length").groupBy("_group").applyInArrow(place, _PLACE))
        closed = placed.where(~F.col("_loose"))
        done = closed if done is None else done.unionByName(closed)
        if last:
            return done.drop("_loose")
        left = pieces.join(placed.where("_loose").select("_row"), "_row")
        round_no, before = round_no + 1, waiting


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = SEQUENCE,
    separator: int = SEPARATOR_ID,
    include_ids: bool = False,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]), one row per piece
    of every row of ``docs`` (doc_id, text).

    A document is the token ids of its text followed by ``separator``; only documents longer
    than ``capacity`` are cut, every ``capacity`` tokens. ``start`` counts the document's ids
    before the piece; ids_crc32 is the crc32 of its ids as little-endian unsigned 32-bit
    numbers; pieces of one sequence_id lie gapless from offset 0 and hold at most ``capacity``
    tokens. ``include_ids`` adds the ids (array<int>).

    Null text: as empty text, one piece with the separator alone. Null and repeated doc_ids
    are kept as they are, a row each. Empty table: empty result. Other columns are not read.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if include_ids else []))

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(tokenizer_path)
        end = np.array([separator], dtype="<u4").tobytes()
        waiting: list[tuple] = []
        for batch in batches:
            ids_column, texts = batch.column(0), batch.column(1)
            for n in range(batch.num_rows):
                ids = bpe.ids(texts[n].as_py() or "") + end
                doc_id = ids_column[n].as_py()
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))
                    waiting.append((*row, np.frombuffer(part, dtype="<i4")) if include_ids else row)
                if len(waiting) >= 2048:
                    yield emit(waiting)
                    waiting = []
        if waiting:
            yield emit(waiting)

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    pieces = settle(base.mapInArrow(tokenize, _PIECE + (", ids array<int>" if include_ids else "")))
    pieces = pieces.withColumn("_row", F.monotonically_increasing_id())
    places = _placed(pieces.select("_row", "length"), capacity, group_pieces)
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + (["ids"] if include_ids else [])
    return pieces.join(places, "_row").select(*out)
