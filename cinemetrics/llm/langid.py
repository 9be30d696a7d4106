"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, runs of anything but letters become one blank, and all one- to
three-letter windows are hashed into 2^16 buckets. The matrix of log probabilities (buckets x
languages, half a MB for each language whatever the input) is broadcast in parts of
``PART_LANGS`` languages; each batch is scored in numpy by gathering the rows of the buckets that
occur and adding them up per document. Every language that occurs is learned.

The classifier is fitted on a bounded sample of the labelled rows (``MAX_TRAIN_PER_LANG``,
chosen by a hash of id and text, one row of each language at least); prediction covers every row.

A posterior over a whole text is near 1 whatever the text. Whether a text is like its
language at all is told by the mean log probability of its n-grams: the model keeps the least
mean among the training rows of each language, and ``reject_unknown`` turns away what is clearly
below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle, unused

ORDERS = (1, 2, 3)
BITS = 16
# fitting: expected number of labelled rows read per language
MAX_TRAIN_PER_LANG = 20_000
# languages in one part of the matrix
PART_LANGS = 64
# n-grams from which on a mean log probability says something, and how far below the training
# rows of its language a text may be
MIN_GRAMS = 50
MARGIN = 0.5
SMOOTHING = 0.5
UNDETERMINED = "und"
# characters scored at a time (a longer text goes alone)
CHUNK_CHARS = 1 << 18
# odd 32-bit multipliers of the n-gram hash
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def ngram_buckets(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, index of the text of each bucket, whether each text has a letter)."""
    lowered = [f" {t.lower()} " for t in texts]
    lengths = np.fromiter((len(t) for t in lowered), dtype=np.int64, count=len(lowered))
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    is_letter = letters[codes]
    has = np.bincount(owner[is_letter], minlength=len(texts)) > 0
    codes = np.where(is_letter, codes, np.uint32(32))
    stay = is_letter.copy()
    stay[1:] |= is_letter[:-1]
    stay[0] = True
    # a blank stays only after a letter or at the start of its text
    stay[1:] |= owner[1:] != owner[:-1]
    codes, owner = codes[stay], owner[stay]
    found, owners = [], []
    mult = [np.uint32(m) for m in MULTIPLIERS]
    for order in ORDERS:
        n = len(codes) - order + 1
        if n <= 0:
            continue
        h = np.full(n, np.uint32(order * 0x27D4EB2F & 0xFFFFFFFF), dtype=np.uint32)
        for k in range(order):
            h = (h ^ codes[k : k + n]) * mult[k]
            h ^= h >> np.uint32(15)
        inside = owner[:n] == owner[order - 1 : order - 1 + n]
        if order == 1:
            inside &= codes[:n] != 32
        found.append((h[inside] >> np.uint32(32 - BITS)).astype(np.int32))
        owners.append(owner[:n][inside])
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int32), has
    return np.concatenate(found), np.concatenate(owners), has


def _text_chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > CHUNK_CHARS:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray  # (2^BITS, languages)
    least_mean: np.ndarray  # of the n-grams of a training row, for each language


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _training_sample(labelled: DataFrame, max_per_lang: int) -> tuple[DataFrame, dict[str, int]]:
    """(rows (text, lang) drawn for each language, rows of each language)."""
    has_id = [F.col("doc_id")] if "doc_id" in labelled.columns else []
    draw = F.pmod(F.xxhash64(*has_id, "text", F.lit(7)), F.lit(1_000_000)).alias("_draw")
    rows = labelled.select("text", "lang", draw).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("_draw").alias("least"))
    total = {r["lang"]: r["n"] for r in sizes.select("lang", "n").collect()}
    # the row with the least draw is always in: a language never goes without a row
    limit = F.greatest(F.least(F.lit(1.0), max_per_lang / F.col("n")) * 1_000_000, F.col("least") + 1)
    limits = sizes.select(F.col("lang").alias("_lang"), limit.alias("_limit"))
    drawn = rows.join(F.broadcast(limits), F.col("lang") == F.col("_lang")).where(F.col("_draw") < F.col("_limit"))
    return drawn.select("text", "lang"), total


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letters = _letters()
    sums: dict[str, np.ndarray] = {}

    def told() -> Iterator[pd.DataFrame]:
        for lang, into in sums.items():
            at = np.flatnonzero(into)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype("int32"), "n": into[at]})
        sums.clear()

    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            into = sums.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
            for _, part in _text_chunks(list(texts)):
                into += np.bincount(ngram_buckets(part, letters)[0], minlength=1 << BITS)
            if len(sums) > PART_LANGS:
                yield from told()
    yield from told()


def _pack_counts(table: pa.Table) -> pa.Table:
    """The counts of one language as one packed column."""
    n = np.zeros(1 << BITS, dtype="<i8")
    n[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return pa.table({"lang": table.column("lang").slice(0, 1), "counts": pa.array([n.tobytes()], pa.binary())})


def fit(labelled: DataFrame, max_per_lang: int = MAX_TRAIN_PER_LANG) -> LanguageModel:
    """Fit on (doc_id, text, lang) rows with text and lang present, a hash sample of about
    ``max_per_lang`` each and one row of every language at least (without a column doc_id equal
    texts are in or out together; rows that repeat id and text are, too).

    Counts are summed per task and then by a partial aggregate and packed by language; the
    driver receives one packed column (half a MB) and two numbers per language.
    """
    sample, total = _training_sample(labelled, max_per_lang)
    langs = tuple(sorted(total))
    if not langs:
        return LanguageModel((), np.zeros(0), np.zeros((1 << BITS, 0)), np.zeros(0))
    sample = settle(sample)
    summed = sample.mapInPandas(_count_batches, "lang string, bucket int, n long")
    summed = summed.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    columns = summed.groupBy("lang").applyInArrow(_pack_counts, "lang string, counts binary")
    log_prob = np.full((1 << BITS, len(langs)), SMOOTHING)
    place = {k: i for i, k in enumerate(langs)}
    for row in columns.toLocalIterator():
        log_prob[:, place[row["lang"]]] += np.frombuffer(row["counts"], "<i8")
    np.log(log_prob / log_prob.sum(axis=0), out=log_prob)
    rows_total = sum(total.values())
    prior = np.log(np.array([total[k] / rows_total for k in langs]))
    model = LanguageModel(langs, prior, log_prob, np.full(len(langs), -np.inf))
    fits = sample.select("lang", _scored(model, sample.sparkSession)(F.col("text")).alias("s"))
    own = fits.where((F.col("s.lang_pred") == F.col("lang")) & (F.col("s.n_grams") >= MIN_GRAMS))
    least = {r["lang"]: r["m"] for r in own.groupBy("lang").agg(F.min("s.mean").alias("m")).collect()}
    return replace(model, least_mean=np.array([least.get(k, -np.inf) for k in langs]))


def score_texts(
    model: LanguageModel, texts: list[str | None], letters: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """For each text the most probable language, its posterior probability, the mean log
    probability of the text's n-grams under it, and their number."""
    names: list[str] = []
    scores, means, counts = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
    plain = [t or "" for t in texts]
    n = len(model.langs)
    for start, part in _text_chunks(plain):
        bucket, owner, has = ngram_buckets(part, letters)
        grams = np.bincount(owner, minlength=len(part))
        sums = np.zeros((len(part), max(n, 1)))
        for j in range(n):
            sums[:, j] = model.log_prior[j] + np.bincount(owner, weights=model.log_prob[bucket, j], minlength=len(part))
        best = sums.argmax(axis=1)
        top = sums.max(axis=1)
        posterior = 1.0 / np.exp(sums - top[:, None]).sum(axis=1)
        known = has & (n > 0)
        names += [model.langs[b] if k else UNDETERMINED for b, k in zip(best, known)]
        here = slice(start, start + len(part))
        scores[here] = np.where(known, posterior, 0.0)
        if n:
            means[here] = (top - model.log_prior[best]) / np.maximum(grams, 1)
        counts[here] = grams
    return names, scores, means, counts


_SCORED = "lang_pred string, score double, mean double, n_grams long, like_it boolean"


def _scored(model: LanguageModel, spark):
    """UDF of a text: struct of ``score_texts``, and whether the mean is what the language's texts have."""
    # plain values: an executor need not have this package
    context = spark.sparkContext if hasattr(spark, "sparkContext") else spark
    rest = context.broadcast((model.langs, model.log_prior, model.least_mean))
    step = range(0, max(len(model.langs), 1), PART_LANGS)
    parts = [context.broadcast(np.ascontiguousarray(model.log_prob[:, k : k + PART_LANGS])) for k in step]

    @F.pandas_udf(_SCORED)
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = _letters()
        langs, prior, least = rest.value
        whole = parts[0].value if len(parts) == 1 else np.concatenate([p.value for p in parts], axis=1)
        known = LanguageModel(langs, prior, whole, least)
        place = {k: i for i, k in enumerate(langs)}
        for texts in batches:
            names, scores, means, counts = score_texts(known, list(texts), letters)
            floor = np.array([least[place[k]] if k in place else -np.inf for k in names])
            like = (counts < MIN_GRAMS) | (means >= floor - MARGIN)
            yield pd.DataFrame({"lang_pred": names, "score": scores, "mean": means, "n_grams": counts, "like_it": like})

    return language


def predict(model: LanguageModel, spark) -> Column:
    """struct<lang_pred string, score double, mean double, n_grams long, like_it boolean> of the column ``text``."""
    return _scored(model, spark)(F.col("text"))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (the posterior probability of lang_pred).

    A text that is null or without any letter, and every text under a model that has learned
    no language, is ``und`` with score 0. Texts are scored whole. Columns called lang_pred or
    score are replaced; rows are kept as they are, repeated ones too; an empty table stays
    empty.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    found = unused(docs, "_language")
    scored = docs.select("*", predict(model, docs.sparkSession).alias(found))
    return scored.select(*rest, f"{found}.lang_pred", f"{found}.score")


def reject_unknown(docs: DataFrame, model: LanguageModel, min_score: float = 0.5) -> DataFrame:
    """``docs`` without those whose language stays open: ``und``, a posterior under ``min_score``, or
    n-grams that are together clearly less probable than those of any training row of the language."""
    found = unused(docs, "_language")
    scored = docs.select("*", predict(model, docs.sparkSession).alias(found))
    sure = (F.col(f"{found}.lang_pred") != UNDETERMINED) & (F.col(f"{found}.score") >= min_score)
    return scored.where(sure & F.col(f"{found}.like_it")).select(*[F.col(f"`{c}`") for c in docs.columns])
