"""Exact substring dedup: repeated windows of words are removed wherever they start later.

A text is a sequence of words. Every window of ``WINDOW`` words has a minimiser, the smallest
hash among its runs of ``MINIMISER`` words; consecutive windows mostly share it. Such windows
travel together, as one packed string of their words (a super-k-mer), to the bucket of the
minimiser. Equal windows have equal minimisers, so each bucket finds all occurrences of its
windows by sorting, and tells every occurrence but the earliest.

Sorting uses a 64-bit hash of the words; windows with equal hashes are compared word for word.

Hot passages: a task sends a super-k-mer once. A later occurrence in the same task (larger
document, or later in the document) is known to repeat and stays home. A bucket is read as a
stream, and again keeps only the earliest of equal super-k-mers, so its memory follows its
different texts and not the number of copies. Buckets are many more than tasks.

Hot minimisers: a run of words that is the minimiser of very many different windows would fill
one bucket. A first pass adds up the bytes that every bucket would get. Windows of an overfull
bucket travel one by one, to the bucket of a hash of the whole window: equal windows still meet,
and different ones are spread. Which buckets these are follows from all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle, text_or_empty

WINDOW = 20
MINIMISER = 3
# text handled at a time by a task, and expected packed text per bucket
CHUNK_BYTES = 5 << 20
BUCKET_BYTES = 4 << 20
# buckets of more packed text than this are dealt again by whole windows; at most ``MAX_HOT``
# buckets can be (their numbers go to every task, 8 bytes each)
HOT_BYTES = 32 << 20
MAX_HOT = 1_000_000
# packed text per task, before compression
TASK_BYTES = 128 << 20
# super-k-mers a task remembers before it starts anew
SEEN = 100_000
MAX_ID, MIN_LONG = (1 << 63) - 1, -(1 << 63)

_BASE = 0x9E3779B97F4A7C15 | 1
_M64 = (1 << 64) - 1
_PACKED = "bucket long, ids binary, starts binary, texts binary"
_SPANS = "doc_id long, text_hash long, start long, length long"


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, from two short tables each."""

    STEP = 4096

    def __init__(self):
        self.up = self._table(_BASE, self.STEP)
        self.down = self._table(pow(_BASE, -1, 1 << 64), self.STEP)
        self.up_steps = self.down_steps = np.ones(1, dtype=np.uint64)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        out = np.full(n, base & _M64, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def prefix_sums(self, raw: np.ndarray) -> np.ndarray:
        """prefix[i]: sum of (byte + 1) * base^place over the first i bytes."""
        steps = -(-len(raw) // self.STEP)
        if len(self.up_steps) <= steps:
            self.up_steps = self._table(pow(_BASE, self.STEP, 1 << 64), steps + 1)
            self.down_steps = self._table(pow(_BASE, -self.STEP, 1 << 64), steps + 1)
        out = np.zeros(steps * self.STEP + 1, dtype=np.uint64)
        np.add(raw, np.uint64(1), out=out[1 : len(raw) + 1])
        terms = out[1:].reshape(steps, self.STEP)
        terms *= self.up
        terms *= self.up_steps[:steps, None]
        return np.cumsum(out, out=out)

    def inverse(self, places: np.ndarray) -> np.ndarray:
        return self.down[places % self.STEP] * self.down_steps[places // self.STEP]


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """Word places in a buffer of lines; words are parted by one blank, lines by one newline."""

    def __init__(self, buffer: bytes, powers: _Powers):
        self.buffer = buffer
        raw = np.frombuffer(buffer, dtype=np.uint8)
        ends = np.flatnonzero((raw == 32) | (raw == 10))
        self.end = ends
        self.start = np.concatenate([np.zeros(1, dtype=np.int64), ends[:-1] + 1]) if len(ends) else ends
        self.last = raw[ends] == 10
        self.line = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(self.last)[:-1]]) if len(ends) else ends
        self.powers, self.prefix = powers, powers.prefix_sums(raw)

    def hashes(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each word on (only those inside one line make sense)."""
        starts, ends = self.start[: len(self.start) - n + 1], self.end[n - 1 :]
        return self.spans(starts, ends)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((self.prefix[ends] - self.prefix[starts]) * self.powers.inverse(starts))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values."""
    n, have = len(x) - w + 1, 1
    while have * 2 <= w:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[w - have : w - have + n])


def super_kmers(words: Words, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of windows, minimiser) of each run of windows with one minimiser."""
    n = len(words.start) - window + 1
    if n <= 0:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty.astype(np.uint64)
    low = _sliding_min(words.hashes(minimiser), window - minimiser + 1)
    inside = words.line[:n] == words.line[window - 1 :]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (low[1:] != low[:-1]) | ~inside[:-1]
    first = np.flatnonzero(fresh & inside)
    stop = np.append(np.flatnonzero(fresh | ~inside), n)
    after = stop[np.searchsorted(stop, first, side="right")]
    return first, after - first, low[first]


def _normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def _bucket(low: np.ndarray, buckets: int) -> np.ndarray:
    return (low % np.uint64(buckets)).astype(np.int64)


def _apart(words: Words, first, count, bucket, hot: np.ndarray, window: int, buckets: int):
    """Super-k-mers of hot buckets as single windows, each in the bucket of its own hash."""
    is_hot = np.isin(bucket, hot)
    if not is_hot.any():
        return first, count, bucket
    n = count[is_hot]
    single = np.repeat(first[is_hot] - np.cumsum(n) + n, n) + np.arange(n.sum())
    own = words.spans(words.start[single], words.end[single + window - 1])
    # mixed once more: the hash of a window is not to fall in with that of a minimiser
    dealt = (
        np.concatenate([first[~is_hot], single]),
        np.concatenate([count[~is_hot], np.ones(len(single), dtype=count.dtype)]),
        np.concatenate([bucket[~is_hot], _bucket(_mix(own ^ np.uint64(_BASE)), buckets)]),
    )
    order = np.argsort(dealt[0], kind="stable")
    return tuple(x[order] for x in dealt)


def _chunks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Documents (id, name, words joined by one blank) long enough for a window, some at a time."""
    waiting: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in batches:
        ids, names, texts = batch.columns
        for n in range(batch.num_rows):
            text = _normal(texts[n].as_py())
            if text.count(b" ") < window - 1:
                continue
            if waiting and size + len(text) > CHUNK_BYTES:
                yield waiting
                waiting, size = [], 0
            waiting.append((ids[n].as_py(), names[n].as_py(), text))
            size += len(text)
    if waiting:
        yield waiting


def _bucket_bytes(buckets: int, window: int, minimiser: int):
    """Bytes of text that the super-k-mers of a chunk of documents bring to each bucket; equal
    super-k-mers of the chunk count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for docs in _chunks(batches, window):
            words = Words(b"".join([text + b"\n" for _, _, text in docs]), powers)
            first, windows, low = super_kmers(words, window, minimiser)
            start, end = words.start[first], words.end[first + windows + window - 2]
            _, once = np.unique(words.spans(start, end), return_index=True)
            names, at = np.unique(_bucket(low[once], buckets), return_inverse=True)
            total = np.bincount(at, weights=(end - start)[once], minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(total, pa.int64())], names=["bucket", "bytes"])

    return count


def hot_buckets(named: DataFrame, buckets: int, window: int, minimiser: int) -> list[int]:
    """Buckets that would get more than ``HOT_BYTES`` of text; at most ``MAX_HOT`` can."""
    brought = named.mapInArrow(_bucket_bytes(buckets, window, minimiser), "bucket long, bytes long")
    brought = brought.groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    heavy = settle(brought.where(F.col("bytes") > HOT_BYTES))
    total = heavy.agg(F.sum("bytes")).first()[0] or 0
    # fewer than MAX_HOT buckets can each hold more than this share of what the heavy ones hold
    return [r[0] for r in heavy.where(F.col("bytes") > total // MAX_HOT).select("bucket").collect()]


def _pack(buckets: int, window: int, minimiser: int, shared):
    """Documents -> packed super-k-mers per bucket (bucket >= 0), and windows already known to
    repeat (bucket -1, same layout with the number of words in place of the text)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, powers = zstandard.ZstdCompressor(level=6), _Powers()
        seen: dict[bytes, tuple] = {}
        hot = np.array(shared.value, dtype=np.int64)

        def chunk(docs: list[tuple[int, int, bytes]]) -> pa.RecordBatch | None:
            words = Words(b"".join([text + b"\n" for _, _, text in docs]), powers)
            first, count, low = super_kmers(words, window, minimiser)
            if not len(first):
                return None
            first, count, bucket = _apart(words, first, count, _bucket(low, buckets), hot, window, buckets)
            line = words.line[first]
            line_word = np.concatenate([np.zeros(1, dtype=np.int64), np.flatnonzero(words.last) + 1])
            columns = (
                line, first - line_word[line], words.start[first], words.end[first + count + window - 2],
                count + window - 1, bucket,
            )
            sent: dict[int, list] = {}
            home: list[list] = []
            buffer = words.buffer
            for n, at, s, e, length, bucket in zip(*(c.tolist() for c in columns)):
                place, text = (docs[n][0], docs[n][1], at), buffer[s:e]
                known = seen.get(text)
                if known is not None and known <= place:
                    if known != place:
                        if home and home[-1][0][:2] == place[:2] and at <= home[-1][0][2] + home[-1][1]:
                            home[-1][1] = at + length - home[-1][0][2]
                        else:
                            home.append([place, length])
                    continue
                seen[text] = place
                sent.setdefault(bucket, []).append((place, text))
            if home:
                sent[-1] = [(place, b"%d" % length) for place, length in home]
            if len(seen) > SEEN:
                seen.clear()
            return _packed_batch(sent, squeeze)

        for docs in _chunks(batches, window):
            if (out := chunk(docs)) is not None:
                yield out

    return pack


def _packed_batch(sent: dict[int, list], squeeze) -> pa.RecordBatch:
    names, ids, starts, texts = [], [], [], []
    for bucket, found in sent.items():
        names.append(bucket)
        ids.append(squeeze.compress(np.array([p[:2] for p, _ in found], dtype="<i8").tobytes()))
        starts.append(np.array([p[2] for p, _ in found], dtype="<u4").tobytes())
        texts.append(squeeze.compress(b"\n".join(t for _, t in found)))
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(ids, pa.binary()), pa.array(starts, pa.binary()), pa.array(texts, pa.binary())],
        names=["bucket", "ids", "starts", "texts"],
    )


def _unpack(batch: pa.RecordBatch, n: int, expand) -> Iterator[tuple[tuple, bytes]]:
    _, ids, starts, texts = (c[n].as_py() for c in batch.columns)
    ids = np.frombuffer(expand.decompress(ids), "<i8").reshape(-1, 2)
    starts = np.frombuffer(starts, "<u4")
    for (doc, name), start, text in zip(ids.tolist(), starts.tolist(), expand.decompress(texts).split(b"\n")):
        yield (doc, name, start), text


def repeated_windows(found: dict[bytes, tuple], window: int, powers: _Powers) -> list[tuple[int, int, int, int]]:
    """Spans (doc_id, text_hash, first word, words) covered by windows that also start earlier,
    among super-k-mers (text -> place of its earliest occurrence)."""
    texts = list(found)
    words = Words(b"".join([t + b"\n" for t in texts]), powers)
    n = len(words.start) - window + 1
    if n <= 0:
        return []
    at = np.flatnonzero(words.line[:n] == words.line[window - 1 :])
    line = words.line[at]
    first_word = np.concatenate([np.zeros(1, dtype=np.int64), np.flatnonzero(words.last) + 1])
    places = list(found.values())
    doc = np.array([p[0] for p in places], dtype=np.int64)[line]
    name = np.array([p[1] for p in places], dtype=np.int64)[line]
    word = np.array([p[2] for p in places], dtype=np.int64)[line] + at - first_word[line]
    s, e = words.start[at], words.end[at + window - 1]
    h = words.spans(s, e)
    order = np.lexsort((word, name, doc, h))
    hs = h[order]
    same = np.flatnonzero(hs[1:] == hs[:-1]) + 1
    repeats = []
    buffer = words.buffer
    # equal hashes are compared word for word; the first of each different text is the earliest
    head, group = -1, {}
    for k in same.tolist():
        if k - 1 != head:
            i = order[k - 1]
            group = {buffer[s[i] : e[i]]: (int(doc[i]), int(name[i]), int(word[i]))}
        head = k
        i = order[k]
        text, place = buffer[s[i] : e[i]], (int(doc[i]), int(name[i]), int(word[i]))
        known = group.setdefault(text, place)
        if known < place:
            repeats.append(place)
    repeats.sort()
    spans: list[list[int]] = []
    for d, t, w in repeats:
        if spans and spans[-1][0] == d and spans[-1][1] == t and w <= spans[-1][2] + spans[-1][3]:
            spans[-1][3] = w + window - spans[-1][2]
        else:
            spans.append([d, t, w, window])
    return [tuple(x) for x in spans]


def _span_batch(spans: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*spans))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "text_hash", "start", "length"]
    )


def _find_repeats(window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, powers = zstandard.ZstdDecompressor(), _Powers()
        current, found, later = None, {}, []

        def finish() -> Iterator[pa.RecordBatch]:
            spans = later + (repeated_windows(found, window, powers) if found else [])
            for at in range(0, len(spans), 65536):
                yield _span_batch(spans[at : at + 65536])

        for batch in batches:
            for n, bucket in enumerate(batch.column(0).to_pylist()):
                if bucket == -1:
                    yield _span_batch([(*place, int(length)) for place, length in _unpack(batch, n, expand)])
                    continue
                if bucket != current:
                    yield from finish()
                    current, found, later = bucket, {}, []
                for place, text in _unpack(batch, n, expand):
                    known = found.setdefault(text, place)
                    if known != place:
                        # of equal super-k-mers the later one repeats as a whole
                        found[text] = min(known, place)
                        later.append((*max(known, place), text.count(b" ") + 1))
        yield from finish()

    return find


def _named(docs: DataFrame) -> DataFrame:
    """(_id, _name, text): the id, and what names a text among rows of one id.

    A null id takes the largest id; its names are not negative and all others are, so that it
    comes after that id and is told apart from it.
    """
    doc_id, name = F.col("doc_id").cast("long"), F.xxhash64(text_or_empty())
    signed = F.when(doc_id.isNull(), name.bitwiseAND(F.lit(MAX_ID))).otherwise(name.bitwiseOR(F.lit(MIN_LONG)))
    return docs.select(F.coalesce(doc_id, F.lit(MAX_ID)).alias("_id"), signed.alias("_name"), "text")


def repeated_spans(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """(doc_id, text_hash, start, length): word spans to remove; spans of a document may overlap."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # super-k-mers overlap: a window's words travel about three times; each partition gets
    # equally many buckets
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(partitions, -(-3 * size // TASK_BYTES))
    buckets = partitions * max(1, -(-3 * size // (BUCKET_BYTES * partitions)))
    named = _named(docs)
    hot = docs.sparkSession.sparkContext.broadcast(hot_buckets(named, buckets, window, minimiser))
    packed = named.mapInArrow(_pack(buckets, window, minimiser, hot), _PACKED)
    # repeats known at home are spread, buckets come together
    spread = F.pmod(F.xxhash64("ids", "starts"), F.lit(partitions))
    place = F.when(F.col("bucket") >= 0, F.col("bucket") % partitions).otherwise(spread).cast("int")
    dealt = packed.repartitionById(partitions, place).sortWithinPartitions("bucket")
    return dealt.mapInArrow(_find_repeats(window), _SPANS)


def _cut(texts, spans) -> Iterator[tuple[str, int, int]]:
    for text, found in zip(texts, spans):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        removed = np.zeros(len(words) + 1, dtype=np.int64)
        if found is not None:
            for span in found:
                removed[span["start"]] += 1
                removed[min(span["start"] + span["length"], len(words))] -= 1
        gone = np.cumsum(removed[:-1]) > 0
        n = int(gone.sum())
        kept = b" ".join([w for w, g in zip(words, gone) if not g]) if n else b" ".join(words)
        yield kept.decode("utf-8", "surrogatepass"), len(words), n


def _apply_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            kept, n_words, n_removed = zip(*_cut(part.column(1).to_pylist(), part.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                names=["doc_id", "text", "n_words", "n_removed"],
            )


def substring_dedup(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """(doc_id, text, n_words, n_removed), one row per row of ``docs`` (doc_id, text): the words
    (split at ASCII white space, unchanged) joined by one blank, without every word covered by
    a window of ``window`` words whose words also start earlier: in a smaller doc_id, or
    earlier in the same document. Windows are judged on the input.

    Null text: no words. Texts with fewer words than ``window`` lose none. A null doc_id comes
    after all others. Rows that repeat a doc_id with another text are ordered by a hash of the
    text; rows that repeat the text as well are one document, and each keeps its row. Empty
    table: empty result. Other columns are not read.
    """
    spans = repeated_spans(docs, window, minimiser)
    found = spans.groupBy(F.col("doc_id").alias("_sid"), F.col("text_hash").alias("_sname")).agg(
        F.collect_list(F.struct("start", "length")).alias("_spans")
    )
    texts = _named(docs)
    joined = texts.join(found, (texts["_id"] == found["_sid"]) & (texts["_name"] == found["_sname"]), "left")
    doc_id = F.when(F.col("_name") < 0, F.col("_id"))
    return joined.select(doc_id.alias("doc_id"), "text", "_spans").mapInArrow(
        _apply_spans, "doc_id long, text string, n_words long, n_removed long"
    )
