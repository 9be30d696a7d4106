"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

Words of a text are hashed. A fixed mask reads six of the word positions in a short span and
ignores the others, so a replaced word at an ignored position does not hide a match. Masked
hashes of the documents are joined with those of the benchmark; around every hit the two
word sequences are laid over each other and the overlap is verified word by word.

An overlap counts when some ``WINDOW`` consecutive aligned words differ in at most
``MAX_REPLACED`` of them. The two masks together hit every such window (13 words, any two
replaced), so the seeds lose none of them (``tests/llm`` tries all 79 patterns).

Items of fewer than ``WINDOW`` words have no such window: they overlap where all their words
stand in the document one after the other (``overlaps`` finds both sorts, ``contaminated``
the windows alone). In scripts written without blanks every letter or digit is a word.

Documents stream through: one row per word position is made, probed and verified inside one
stage; nothing but verified overlaps leaves it while the benchmark's seeds fit the broadcast
bound, one row per document and item after the partial aggregation of the task. Beyond the
bound the same join runs as a shuffle join of (document key, position, seed), and the words come
to the documents with hits by a join on the document key.

A hit is verified around its place: a window that counts holds all words of the seed that
found it, so only windows over the seed are tried, and the whole alignment is read only for a
hit that passes. Which documents overlap anything (``decontaminate``) is told without pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import hash128, settle, text_or_empty
from cinemetrics.operators.broadcast import broadcast_if_bounded

# fixed masks: word positions read by each seed
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 5, 8, 9))
WINDOW = 13
MAX_REPLACED = 2
# the seeds of the benchmark, or its short items, are broadcast up to the bytes of this many seeds
BROADCAST_SEEDS = 2_000_000
SEED_BYTES = 24

_NOT_WORD = r"[^\p{L}\p{N}]+"
# scripts without blanks between words (South East Asian, Yi, Han, kana)
NO_BLANKS = (
    r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{1950}-\x{19FF}\x{1A20}-\x{1AAF}\x{1B00}-\x{1B7F}"
    r"\x{2E80}-\x{2FDF}\x{3005}-\x{3007}\x{3021}-\x{312F}\x{31A0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{A48F}"
    r"\x{A980}-\x{A9FF}\x{AA60}-\x{AADF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{1AFF0}-\x{1B16F}\x{20000}-\x{3FFFF}]"
)
# the look ahead is one range, so that text of other scripts is passed over fast
_NO_BLANKS = r"(?=[^\x{0000}-\x{0DFF}])" + NO_BLANKS


def word_hashes(text: Column) -> Column:
    """array<long>: hashes of the lower-cased runs of letters and digits of a text; a letter or
    digit of a script without blanks is a word of its own."""
    apart = F.regexp_replace(F.lower(text_or_empty(text)), _NO_BLANKS, " $0 ")
    words = F.split(F.regexp_replace(apart, f"^{_NOT_WORD}", ""), _NOT_WORD)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(words: Column, at: Column, masks) -> Column:
    """Masked hashes at word position ``at``; null where the mask reaches past the last word."""
    out = []
    for n, mask in enumerate(masks):
        fits = at + mask[-1] < F.size(words)
        out.append(F.when(fits, F.xxhash64(F.lit(n), *[F.get(words, at + k) for k in mask])))
    return F.array(*out)


def _seed_rows(df: DataFrame, keep: list[str], masks) -> DataFrame:
    """keep columns + (_at, _seed): one row per word position and mask."""
    span = min(m[-1] for m in masks)
    placed = df.where(F.size("_words") > span).select(
        *keep, "_words", F.explode(F.sequence(F.lit(0), F.size("_words") - span - 1)).alias("_at")
    )
    return placed.select(*keep, "_words", "_at", F.explode(_seeds(F.col("_words"), F.col("_at"), masks)).alias("_seed"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    masks=MASKS,
    window: int = WINDOW,
    max_replaced: int = MAX_REPLACED,
) -> DataFrame:
    """(doc_id, _t1, _t2, item_id, n_equal, item_words, doc_word): one row per document and
    benchmark item (item_id, text) that overlap; no row for a clean document.

    n_equal is the number of equal words on the best alignment and doc_word the word position
    in the document at which the item's first word lies there (negative if the item's start is
    cut off); ties go to the smaller doc_word. _t1, _t2 is the 128-bit hash of the text.

    Null and empty texts and items of fewer than ``window`` words never overlap here
    (``overlaps`` finds such items too). Rows that repeat a document or an item give one row.
    A null doc_id or item_id is reported as null. Empty tables give an empty result. Other
    columns are not read.
    """
    return _best(_windows(_read_docs(docs), _read_items(benchmark), masks, window, max_replaced))


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """``contaminated``, and the items of 1 to ``window`` - 1 words that a document holds word
    for word: there n_equal is item_words and doc_word the first place. An item without any
    word is never found. Rows, ties and nulls as in ``contaminated``."""
    return _best(_places(docs, benchmark, window, **options))


def _places(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """(_id, _t1, _t2, _item, _item_words, _start, _n): verified places of all items, repeated ones too."""
    read, items = _read_docs(docs), _read_items(benchmark)
    short = items.where((F.size("_words") > 0) & (F.size("_words") < window))
    lengths = sorted(r[0] for r in short.select(F.size("_words")).distinct().collect())
    seen = _windows(read, items, options.get("masks", MASKS), window, options.get("max_replaced", MAX_REPLACED))
    return seen.unionByName(_whole_items(read, short, lengths)) if lengths else seen


def _read_docs(docs: DataFrame) -> DataFrame:
    t1, t2 = hash128(F.col("_text"))
    read = docs.select(F.col("doc_id").alias("_id"), text_or_empty().alias("_text"))
    return read.select("_id", t1.alias("_t1"), t2.alias("_t2"), word_hashes(F.col("_text")).alias("_words"))


def _read_items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").alias("_item"), word_hashes(F.col("text")).alias("_words")).distinct()


def _fits(side: DataFrame, row_bytes: Column) -> bool:
    """Whether the bytes of ``side`` keep to the bound of the benchmark's seeds."""
    bound = int(side.sparkSession.conf.get("cinemetrics.seeds.maxBroadcastRows", str(BROADCAST_SEEDS))) * SEED_BYTES
    return (side.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0) <= bound


def _word_bytes(words: str) -> Column:
    return SEED_BYTES + 8 * F.size(words)


def _whole_items(read: DataFrame, short: DataFrame, lengths: list[int]) -> DataFrame:
    """(_id, _t1, _t2, _item, _item_words, _start, _n): places where all words of a short item
    stand; ``lengths`` are the word counts that occur among the items."""
    at, n_words = F.col("_at"), F.size("_words")
    placed = read.where(n_words >= lengths[0]).select(
        "_id", "_t1", "_t2", "_words", F.explode(F.sequence(F.lit(0), n_words - lengths[0])).alias("_at")
    )
    runs = [F.when(at + n <= n_words, F.slice("_words", at + 1, n)) for n in lengths]
    placed = placed.select("_id", "_t1", "_t2", at.alias("_start"), F.explode(F.array(*runs)).alias("_run"))
    probe = short.select("_item", F.col("_words").alias("_item_hashes"))
    probe = F.broadcast(probe) if _fits(probe, _word_bytes("_item_hashes")) else probe
    return placed.join(probe, F.col("_run") == F.col("_item_hashes")).select(
        "_id", "_t1", "_t2", "_item", F.size("_run").alias("_item_words"), "_start", F.size("_run").alias("_n")
    )


def _windows(read: DataFrame, items: DataFrame, masks, window: int, max_replaced: int) -> DataFrame:
    """(_id, _t1, _t2, _item, _item_words, _start, _n): alignments with an overlap of ``window`` words."""
    read = read.where(F.size("_words") >= window - max_replaced)
    items = items.where(F.size("_words") >= window)

    train = _seed_rows(items, ["_item"], masks).where(F.col("_seed").isNotNull()).select(
        "_item", F.col("_at").alias("_item_at"), F.col("_seed").alias("_key"), F.size("_words").alias("_item_words")
    )
    sides = items.select(F.col("_item").alias("_item2"), F.col("_words").alias("_item_hashes"))
    small = _fits(train, F.lit(SEED_BYTES))
    test = _seed_rows(read, ["_id", "_t1", "_t2"], masks)
    place = ["_id", "_t1", "_t2", "_item", "_item_words"]
    start = (F.col("_at") - F.col("_item_at")).alias("_start")
    hits = test.join(F.broadcast(train) if small else train, F.col("_seed") == F.col("_key"))
    if not small:
        placed = hits.select(*place, "_item_at", start).distinct()
        texts = read.select(F.col("_id").alias("_id2"), F.col("_t1").alias("_u1"), F.col("_t2").alias("_u2"), "_words")
        same = (F.col("_t1") == F.col("_u1")) & (F.col("_t2") == F.col("_u2")) & F.col("_id").eqNullSafe(F.col("_id2"))
        hits, start = placed.join(texts, same), F.col("_start")
        small = _fits(sides, _word_bytes("_item_hashes"))
    # an item has more bytes of seeds than of words: where the seeds are broadcast the words can be
    hits = hits.select(*place, "_item_at", start, "_words").join(
        F.broadcast(sides) if small else sides,
        F.col("_item").eqNullSafe(F.col("_item2")) & (F.size("_item_hashes") == F.col("_item_words")),
    )

    def equal(p: Column) -> Column:
        # false where the item sticks out of the document
        return F.coalesce(F.get("_words", F.col("_start") + p) == F.get("_item_hashes", p), F.lit(False)).cast("int")

    def summed(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda n, e: n + e)

    # first words of the windows over the seed
    span = min(m[-1] for m in masks) + 1
    low = F.greatest(F.col("_item_at") - (window - span), F.lit(0))
    high = F.least(F.col("_item_at"), F.col("_item_words") - window)
    around = F.array(F.transform(F.sequence(low, high + window - 1), equal))

    def enough(e: Column) -> Column:
        return F.exists(F.sequence(F.lit(1), high - low + 1), lambda s: summed(F.slice(e, s, window)) >= window - max_replaced)

    n_equal = summed(F.transform(F.sequence(F.lit(0), F.col("_item_words") - 1), equal))
    return hits.where(F.exists(around, enough)).select(*place, "_start", n_equal.alias("_n"))


def _best(seen: DataFrame) -> DataFrame:
    best = seen.groupBy("_id", "_t1", "_t2", "_item").agg(
        F.max(F.struct(F.col("_n").alias("n"), (-F.col("_start")).alias("s"), "_item_words")).alias("_best")
    )
    return best.select(
        F.col("_id").alias("doc_id"), "_t1", "_t2", F.col("_item").alias("item_id"),
        F.col("_best.n").cast("long").alias("n_equal"),
        F.col("_best._item_words").cast("long").alias("item_words"),
        (-F.col("_best.s")).cast("long").alias("doc_word"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that overlap a benchmark item (see ``overlaps``).

    The overlapping documents are written once; while their ids keep to the broadcast bound the
    texts of the others are not shuffled.
    """
    found = _places(docs, benchmark, **options)
    bad = broadcast_if_bounded(settle(found.select("_id", "_t1", "_t2").distinct()))
    t1, t2 = hash128(text_or_empty(docs["text"]))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (t1 == bad["_t1"]) & (t2 == bad["_t2"]), "left_anti")
