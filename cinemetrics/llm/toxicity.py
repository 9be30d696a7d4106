"""Toxicity: a weighted lexicon matched by Aho-Corasick, normalised by length.

Texts are folded first: compatibility forms and accents to plain letters, marks and invisible
characters away, lower case, homoglyphs and digit substitutions to the letters they stand for,
letters that stand alone in a row to one word, everything else to one blank. A sign with two
readings (``1`` for i or l, ``6`` for g or b) stays open until it is matched: it agrees with
either letter of a form, at each place by itself. The lexicon (whole words, and beginnings of words
for families of inflected forms) and its weights are learned from labelled documents: smoothed
log odds of a form in toxic against clean ones. So are exception phrases, pairs of words
around a lexicon form that occur in clean documents; a match inside one does not count.

A document's score is a logistic function of its summed weights divided by a power of its
number of words; the power and the logistic are fitted on the same labelled rows.

Fitting reads a bounded hash sample (``MAX_TRAIN_PER_CLASS``); scoring reads every text whole.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle, unused

# fitting: expected number of labelled rows read per class
MAX_TRAIN_PER_CLASS = 5_000
# shortest and longest beginning of a word that can become a lexicon form
PREFIX_CHARS = (4, 10)
# a form must occur in this many toxic training documents, and surely (``ERRORS``) be this much
# likelier there
MIN_TOXIC_DOCS = 3
MIN_LOG_ODDS = math.log(10)
# a form weighs its log odds less this many standard errors: rare forms count little
ERRORS = 1.0
# forms this common, against the rarest of the forms that cover the toxic documents, are kept too
COMMON_SHARE = 0.25
# a phrase must occur in this many clean training documents to be an exception
MIN_EXCEPTION_DOCS = 5
THRESHOLD = 0.3
LENGTH_POWERS = (0.25, 0.5, 1.0)

# fixed values: Latin letters by their look-alikes in other scripts, and by signs and digits
LOOKALIKES = {
    "a": "аαɑ@4", "b": "ʙв8", "c": "сϲ", "d": "ԁ", "e": "еεҽ3", "g": "ɡ9", "h": "һн", "i": "іιıɩ", "j": "ј",
    "k": "кκ", "l": "ӏ", "m": "м", "n": "ոп", "o": "оοօ0", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ5$", "t": "тτ7",
    "u": "υս", "v": "νѵ", "w": "ԝ", "x": "хχ", "y": "уγ", "z": "ᴢ2", "1": "!|",
}
# signs with two readings; the first is taken where no form decides
READINGS = {"1": "il", "6": "gb"}
_FOLD = {ord(c): letter for letter, like in LOOKALIKES.items() for c in like}
_FIRST = {ord(sign): letters[0] for sign, letters in READINGS.items()}
# letters that one sign can stand for are one class
_CLASS = {ord(c): sign for sign, letters in READINGS.items() for c in letters}
_NOT_LETTER = regex.compile(r"[[\W\d_]--[16]]+", regex.V1)
# signs that stand for letters only inside a word
_EDGE_SIGNS = re.compile(r"[!|$@]+(?!\w)")
_INVISIBLE = regex.compile(r"[\p{M}\p{Cf}]+")
_SPELLED = re.compile(r"(?<= )\w(?: \w){2,}(?= )")


def _joined(run: re.Match) -> str:
    """The word spelled by single letters; as its first letter can be a word ("a"), also the rest."""
    word = run.group().replace(" ", "")
    return f"{word} {word[1:]}" if len(word) > 3 else word


def fold_open(text: str | None) -> str:
    """Folded words with one blank around each, ' w1 w2 w3 ', signs of two readings left open."""
    plain = text or ""
    if not plain.isascii():
        plain = _INVISIBLE.sub("", unicodedata.normalize("NFKD", plain))
    plain = _EDGE_SIGNS.sub(" ", plain.lower())
    return _SPELLED.sub(_joined, f" {_NOT_LETTER.sub(' ', plain.translate(_FOLD)).strip()} ")


def fold(text: str | None) -> str:
    """Folded words with one blank around each, every sign in its first reading."""
    return fold_open(text).translate(_FIRST)


def _agrees(opened: str, form: str) -> bool:
    """Whether a stretch of open text can be read as ``form``."""
    return opened == form or all(c == f or f in READINGS.get(c, "") for c, f in zip(opened, form))


@dataclass
class Lexicon:
    """forms: ' word ' (whole word) or ' begin' (beginning) -> weight; exceptions: ' w1 w2 '."""

    forms: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    power: float = 0.5
    slope: float = 0.0
    intercept: float = math.log(0.01 / 0.99)

    def automaton(self):
        """Finds forms and exceptions by letter classes: class word -> [(form, weight or None)]."""
        known: dict[str, list[tuple[str, float | None]]] = {}
        for form, weight in [*self.forms.items(), *((phrase, None) for phrase in self.exceptions)]:
            known.setdefault(form.translate(_CLASS), []).append((form, weight))
        a = ahocorasick.Automaton()
        for word, forms in known.items():
            a.add_word(word, forms)
        if len(a):
            a.make_automaton()
        return a

    def score(self, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
        x = weight / np.maximum(words, 1) ** self.power
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * x + self.intercept, -30, 30)))


def matches(automaton, opened: str) -> list[tuple[int, str, float]]:
    """(start, form, weight) of the lexicon forms in a folded text (``fold`` or ``fold_open``),
    without those inside an exception phrase; of forms at one start the heaviest counts, of
    equally heavy ones the longest, then the first by alphabet."""
    if not len(automaton):
        return []
    best: dict[int, tuple[float, int, str]] = {}
    excused: list[tuple[int, int]] = []
    for end, forms in automaton.iter(opened.translate(_CLASS)):
        for form, weight in forms:
            start = end - len(form) + 1
            if not _agrees(opened[start : end + 1], form):
                continue
            if weight is None:
                excused.append((start, end))
            elif start not in best or (-weight, -len(form), form) < best[start]:
                best[start] = (-weight, -len(form), form)
    found = sorted((s, f, -w) for s, (w, _, f) in best.items())
    if excused:
        found = [m for m in found if not any(s <= m[0] and m[0] + len(m[1].rstrip()) - 1 <= e for s, e in excused)]
    return found


def _features(folded: str) -> set[str]:
    low, high = PREFIX_CHARS
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in range(low, min(high, len(w)) + 1))
    return out


def _choose(counts: pd.DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Forms to match: a beginning gives way to a longer form that is in nearly as many toxic
    documents, and a longer form to a beginning that stays and weighs nearly as much."""
    odds = np.log((counts["toxic"] + 0.5) / (toxic + 1)) - np.log((counts["clean"] + 0.5) / (clean + 1))
    odds -= ERRORS * np.sqrt(1 / (counts["toxic"] + 0.5) + 1 / (counts["clean"] + 0.5))
    docs = dict(zip(counts["feature"], counts["toxic"]))
    weight = dict(zip(counts["feature"], odds))

    def beginnings(form: str) -> list[str]:
        text = form.rstrip()
        longest = len(text) if form.endswith(" ") else len(text) - 1
        return [text[:n] for n in range(1 + PREFIX_CHARS[0], longest + 1) if text[:n] in weight]

    general = {b for f in weight for b in beginnings(f) if docs[f] >= 0.95 * docs[b]}
    stays = [f for f in weight if f not in general]
    chosen = set(stays)
    return {
        f: float(weight[f])
        for f in stays
        if not any(b in chosen and weight[b] >= weight[f] - 0.7 for b in beginnings(f))
    }


def _cover(weight: dict[str, float], found: list[list[str]]) -> dict[str, float]:
    """The telling ones of many forms (``found``: the forms in each toxic document). First a few
    that cover the documents: again and again the one that is in most documents not yet
    covered, times its weight, while there are ``MIN_TOXIC_DOCS`` of them. Then every other
    form that is about as common (``COMMON_SHARE`` of the rarest of these). Rare words that
    merely come along in some toxic texts stay out."""
    holders: dict[str, set[int]] = {}
    for n, forms in enumerate(found):
        for f in forms:
            holders.setdefault(f, set()).add(n)
    heap = [(-len(docs) * weight[f], f) for f, docs in holders.items()]
    heapq.heapify(heap)
    covered: set[int] = set()
    chosen: dict[str, float] = {}
    while heap:
        _, f = heapq.heappop(heap)
        gain = len(holders[f] - covered)
        if gain < MIN_TOXIC_DOCS:
            continue
        value = (-gain * weight[f], f)
        if heap and value > heap[0]:
            heapq.heappush(heap, value)
            continue
        chosen[f] = weight[f]
        covered |= holders[f]
    rarest = min((len(holders[f]) for f in chosen), default=0)
    enough = max(MIN_TOXIC_DOCS + 2, COMMON_SHARE * rarest)
    return chosen | {f: weight[f] for f, docs in holders.items() if len(docs) >= enough}


def _family(texts: pd.Series) -> pd.Series:
    """The smallest hash of the five-word shingles of a text: mostly the same for near copies."""
    out = []
    for text in texts:
        words = fold(text).split()
        shingles = (" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
        out.append(min(xxhash.xxh64_intdigest(s) for s in shingles) >> 1)
    return pd.Series(out, dtype="int64")


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float, float]:
    """(slope, intercept, weighted log loss) of a weighted logistic regression, by Newton steps."""
    scale = x.std() or 1.0
    z = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(2)
    ridge = np.diag([1e-6, 1e-6]) * w.sum()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (w * (p - y)) + ridge @ beta
        hess = (z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + ridge
        step = np.linalg.solve(hess, grad)
        beta = beta - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(z @ beta, -30, 30))), 1e-12, 1 - 1e-12)
    loss = -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum()
    return float(beta[0] / scale), float(beta[1]), float(loss)


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_TRAIN_PER_CLASS) -> Lexicon:
    """Learn from ``labels`` (doc_id, toxic 0/1) and the texts of ``docs`` (doc_id, text).

    About ``max_per_class`` labels of each class are drawn by a hash of the id; being bounded
    they are broadcast to the documents, so no text is shuffled. An id labelled twice counts
    as toxic if any of its labels says so; null ids and labels are ignored. Without a labelled
    document of both classes the lexicon is empty.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1))
    size = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return Lexicon()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
    share = {c: int(min(1.0, max_per_class / n) * 1_000_000) for c, n in size.items()}
    drawn = known.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "toxic")
    # near copies of one text count once (at most one row per family and class)
    family = F.pandas_udf(_family, "long")("text")
    sample = settle(rows.withColumn("family", family).dropDuplicates(["family", "toxic"]).drop("family"))
    seen = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = seen.get(1, 0), seen.get(0, 0)
    if not toxic or not clean:
        return Lexicon()

    def count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            by_class = (Counter(), Counter())
            for text, label in zip(batch["text"], batch["toxic"]):
                by_class[label].update(_features(fold(text)))
            names = list(by_class[0].keys() | by_class[1].keys())
            if names:
                yield pd.DataFrame(
                    {"feature": names, "toxic": [by_class[1][n] for n in names], "clean": [by_class[0][n] for n in names]}
                )

    sums = sample.mapInPandas(count_features, "feature string, toxic long, clean long")
    sums = sums.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    strong = sums.where((F.col("toxic") >= MIN_TOXIC_DOCS) & (F.log(ratio) - ERRORS * error >= MIN_LOG_ODDS))
    candidates = Lexicon(_choose(strong.toPandas(), toxic, clean))

    def find_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = candidates.automaton()
        for batch in batches:
            found = [sorted({f for _, f, _ in matches(automaton, fold(text))}) for text in batch["text"]]
            yield pd.DataFrame({"forms": found})

    in_toxic = sample.where("toxic = 1").select("text").mapInPandas(find_forms, "forms array<string>")
    lexicon = Lexicon(_cover(candidates.forms, [list(r["forms"]) for r in in_toxic.collect()]))

    def count_phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            by_class = (Counter(), Counter())
            for text, label in zip(batch["text"], batch["toxic"]):
                folded, phrases = fold(text), set()
                for start, _, _ in matches(automaton, folded):
                    end = folded.index(" ", start + 1)
                    after = folded.find(" ", end + 1)
                    if start > 0:
                        phrases.add(folded[folded.rindex(" ", 0, start) : end + 1])
                    if after > 0:
                        phrases.add(folded[start : after + 1])
                by_class[label].update(phrases)
            names = list(by_class[0].keys())
            if names:
                yield pd.DataFrame(
                    {"phrase": names, "toxic": [by_class[1][n] for n in names], "clean": [by_class[0][n] for n in names]}
                )

    phrases = sample.mapInPandas(count_phrases, "phrase string, toxic long, clean long")
    phrases = phrases.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    harmless = phrases.where((F.col("clean") >= MIN_EXCEPTION_DOCS) & (ratio < 1.0)).toPandas()
    lexicon.exceptions = frozenset(harmless["phrase"])

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            weight, words, _ = _weigh(automaton, batch["text"])
            yield pd.DataFrame({"weight": weight, "words": words, "toxic": batch["toxic"].to_numpy()})

    seen_rows = sample.mapInPandas(weigh, "weight double, words long, toxic int").toPandas()
    y = seen_rows["toxic"].to_numpy(float)
    # the sample holds equal shares of the classes; weigh them back to their true shares
    w = np.where(y == 1, size[1] / toxic, size[0] / clean)
    best = math.inf
    for power in LENGTH_POWERS:
        x = seen_rows["weight"].to_numpy() / np.maximum(seen_rows["words"].to_numpy(), 1) ** power
        slope, intercept, loss = _logistic(x, y, w)
        if slope >= 0 and loss < best:
            best, lexicon.power, lexicon.slope, lexicon.intercept = loss, power, slope, intercept
    return lexicon


def _weigh(automaton, texts) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    weight, words, terms = [], [], []
    for text in texts:
        opened = fold_open(text)
        found = matches(automaton, opened)
        weight.append(sum(w for _, _, w in found))
        words.append(opened.count(" ") - 1)
        terms.append([f.strip() for _, f, _ in found])
    return np.array(weight, dtype=float), np.array(words, dtype=np.int64), terms


def score_column(lexicon: Lexicon, spark) -> Column:
    """struct<score double, terms array<string>> of the column ``text``."""
    # plain values: an executor need not have this package
    shared = spark.sparkContext.broadcast(vars(lexicon))

    @F.pandas_udf("score double, terms array<string>")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Lexicon(**shared.value)
        automaton = known.automaton()
        for texts in batches:
            weight, words, terms = _weigh(automaton, texts)
            yield pd.DataFrame({"score": known.score(weight, words), "terms": terms})

    return toxicity(F.col("text"))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (text, any other columns) plus ``score`` (0 to 1), ``predicted`` (1 if the score
    is at least ``threshold``) and ``terms`` (the lexicon forms found, in text order).

    Null and empty texts have no terms and get the score of a text without any. Texts are
    scored whole. Columns called score, predicted or terms are replaced; rows are kept as they
    are, repeated ones too; an empty table stays empty.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted", "terms")]
    found = unused(docs, "_toxicity")
    scored = docs.select("*", score_column(lexicon, docs.sparkSession).alias(found))
    toxic = (F.col(f"{found}.score") >= threshold).cast("int")
    return scored.select(*rest, f"{found}.score", toxic.alias("predicted"), f"{found}.terms")
