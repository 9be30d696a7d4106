"""Periodic run detection: difference-cover LCE and a harmonic grid of anchors.

A run is a stretch of words with smallest period q, at least ``MIN_EXPONENT`` periods and
``MIN_LENGTH`` words long, that neither neighbour extends. Where words q apart are equal over
[s, e), the run is [s, e + q).

Grid: a run of period p has max(24 - p, 2 * p) or more consecutive places x with word x equal
to word x + p, so for each p the places at multiples of that number meet every run. The number
of anchors is a harmonic sum: words times the logarithm of the words.

Extension: the longest common extension (LCE) of two places is found by comparing a few words,
until both places lie in a difference cover modulo ``MODULUS`` (31 residues, 6 in the cover, at
most 30 words away), and from there by the least common prefix in a sparse table over the
sorted suffixes. Only suffixes that start in the cover are sorted: by their first 31 words,
then by doubling. Backward extensions use the same index over the reversed words. Documents
none of whose anchors gets as far as a synchronised place need no index.

Each document is one row and is handled where it is read; nothing is shuffled. Documents go
through numpy in chunks of bounded size (a longer one alone), with a symbol of its own between
any two, so that no extension leaves a document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cinemetrics.llm.common import chunks_by_size

MIN_LENGTH = 24
MIN_EXPONENT = 3
# fixed values: differences of these residues give every residue modulo 31
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
CHUNK_CHARS = 2_000_000


def _shifts() -> np.ndarray:
    """[a, b]: how many places on two places of these residues are both in the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    step = np.arange(MODULUS)
    a, b = step[:, None, None], step[None, :, None]
    both = inside[(a + step) % MODULUS] & inside[(b + step) % MODULUS]
    return both.argmax(axis=2)


SHIFT = _shifts()


def _compare(words: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(equal words from i and j on, whether a difference ended them) up to the synchronised place."""
    far = SHIFT[i % MODULUS, j % MODULUS]
    equal, ended = far.copy(), np.zeros(len(i), dtype=bool)
    alive = np.arange(len(i))
    for t in range(MODULUS):
        alive = alive[far[alive] > t]
        if not len(alive):
            break
        differ = words[i[alive] + t] != words[j[alive] + t]
        equal[alive[differ]] = t
        ended[alive[differ]] = True
        alive = alive[~differ]
    return equal, ended


class CoverIndex:
    """Longest common extensions over one array of word numbers.

    The last word must occur nowhere else; two places asked for are such that the comparison
    meets a difference at that word at the latest.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = words
        at = np.arange(n)
        pos = at[np.isin(at % MODULUS, COVER)]
        place = np.full(n, -1, dtype=np.int64)
        place[pos] = np.arange(len(pos))

        # rank by the first MODULUS words, several of which are packed into one key
        padded = np.concatenate([words + 1, np.zeros(MODULUS, dtype=np.int64)])
        bits = max(1, int(padded.max()).bit_length())
        per_key = max(1, 63 // bits)
        keys = []
        for t in range(0, MODULUS, per_key):
            key = np.zeros(len(pos), dtype=np.int64)
            for u in range(t, min(t + per_key, MODULUS)):
                key = (key << bits) | padded[pos + u]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(pos), dtype=bool)
        for key in keys:
            k = key[order]
            new[1:] |= k[1:] != k[:-1]
        rank = np.empty(len(pos), dtype=np.int64)
        rank[order] = np.cumsum(new)

        ranks, step = [rank], MODULUS
        while len(pos) and int(rank.max()) + 1 < len(pos):
            on = pos + step
            second = np.where(on < n, rank[place[np.minimum(on, n - 1)]] + 1, 0)
            rank = np.unique(rank * (len(pos) + 1) + second, return_inverse=True)[1]
            ranks.append(rank)
            step *= 2
        self.place, self.rank = place, rank

        ordered = np.empty(len(pos), dtype=np.int64)
        ordered[rank] = pos
        a, b = ordered[:-1].copy(), ordered[1:].copy()
        common = np.zeros(len(a), dtype=np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = inside.copy()
            same[inside] = ranks[level][place[a[inside]]] == ranks[level][place[b[inside]]]
            gain = same * (MODULUS << level)
            common += gain
            a += gain
            b += gain
        alive = np.arange(len(a))
        for _ in range(MODULUS):
            alive = alive[(a[alive] < n) & (b[alive] < n)]
            alive = alive[words[a[alive]] == words[b[alive]]]
            common[alive] += 1
            a[alive] += 1
            b[alive] += 1
        self.least = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.least[-1]
            self.least.append(np.minimum(last[: len(last) - width], last[width:]))
            width *= 2

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and j on (i != j)."""
        equal, ended = _compare(self.words, i, j)
        open_ = np.flatnonzero(~ended)
        ri = self.rank[self.place[i[open_] + equal[open_]]]
        rj = self.rank[self.place[j[open_] + equal[open_]]]
        low, high = np.minimum(ri, rj), np.maximum(ri, rj)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            table = self.least[k]
            least = np.minimum(table[low[of]], table[high[of] - (1 << int(k))])
            equal[open_[of]] += least
        return equal


def _joined(parts: list[np.ndarray], first: int) -> tuple[np.ndarray, np.ndarray]:
    """(the parts with a number of its own, from ``first`` on, before, between and after them; where each starts)"""
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.cumsum(np.concatenate([[1], lengths[:-1] + 1])) if len(parts) else np.empty(0, dtype=np.int64)
    whole = np.empty(int(lengths.sum()) + len(parts) + 1, dtype=np.int64)
    whole[0] = first
    for n, (at, part) in enumerate(zip(starts, parts)):
        whole[at : at + len(part)] = part
        whole[at + len(part)] = first + n + 1
    return whole, starts


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n repeated counts[n] times, 0 .. counts[n] - 1 for each n)"""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def find_runs(parts: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple]]:
    """For each array of word numbers its runs (start, length, period), by start, then period.

    ``min_exponent`` is a whole number, 2 at least.
    """
    found: list[list[tuple]] = [[] for _ in parts]
    top = max((int(p.max()) for p in parts if len(p)), default=0) + 1
    words, starts = _joined(parts, top)
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    doc, period = _spread(np.where(lengths >= min_length, lengths // min_exponent, 0))
    period += 1
    need = np.maximum(min_length - period, (min_exponent - 1) * period)
    which, k = _spread(-(-(lengths[doc] - period) // need))
    x = k * need[which]
    at = starts[doc[which]] + x
    met = np.flatnonzero(words[at] == words[at + period[which]])
    doc, period, need, x, at = doc[which[met]], period[which[met]], need[which[met]], x[met], at[met]

    back = len(words) - 1
    reverse = words[::-1]
    ahead, ended = _compare(words, at, at + period)
    behind, begun = _compare(reverse, back - (at - 1), back - (at + period - 1))
    keep = ~(ended & begun) | (ahead + behind >= need)
    doc, period, need, x = doc[keep], period[keep], need[keep], x[keep]
    if not len(doc):
        return found

    some, number = np.unique(doc, return_inverse=True)
    words, starts = _joined([parts[n] for n in some], top)
    at = starts[number] + x
    back = len(words) - 1
    ahead = CoverIndex(words).extension(at, at + period)
    behind = CoverIndex(np.ascontiguousarray(words[::-1])).extension(back - (at - 1), back - (at + period - 1))
    long = ahead + behind >= need
    runs = np.stack([doc, x - behind, ahead + behind + period, period], axis=1)[long]
    runs = np.unique(runs, axis=0)
    # of one stretch only the smallest period counts; the others are its multiples
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[first]
    for d, start, length, q in runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))].tolist():
        found[d].append((start, length, q))
    return found


def collapse(words: list, runs: list[tuple]) -> list:
    """``words`` without those that some run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), dtype=bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return [words[n] for n in np.flatnonzero(kept)]


def _run_batches(id_type: pa.DataType, min_length: int, min_exponent: int):
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1))
            for chunk in chunks_by_size(rows, lambda r: len(r[1].as_buffer() or b"") if r[1].is_valid else 0, CHUNK_CHARS):
                numbers: defaultdict = defaultdict()
                numbers.default_factory = numbers.__len__
                split = [(t.as_buffer().to_pybytes() if t.is_valid else b"").split() for _, t in chunk]
                parts = [np.fromiter(map(numbers.__getitem__, w), dtype=np.int64, count=len(w)) for w in split]
                runs = find_runs(parts, min_length, min_exponent)
                kept = [b" ".join(collapse(w, r)) for w, r in zip(split, runs)]
                as_rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in chunk], id_type),
                        pa.array([len(w) for w in split], pa.int64()),
                        pa.array(as_rows, run_type),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "text"],
                )

    return detect


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, text), one row per row of ``docs``
    (doc_id, text).

    Words are runs of anything but blank and U+0009..U+000D, numbered from 0; ``runs`` is ordered
    by start, then period; ``text`` is the words left when each run keeps its first period only,
    joined by one blank. Null and empty texts have no words, no runs and an empty text. Ids are
    carried as they are, null and repeated ones too; other columns are not read. Memory is
    proportional to a chunk, or to the longest document times the logarithm of its words.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema["doc_id"].dataType
    out = f"doc_id {id_type.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
    return docs.select("doc_id", "text").mapInArrow(_run_batches(to_arrow_type(id_type), min_length, min_exponent), out)
