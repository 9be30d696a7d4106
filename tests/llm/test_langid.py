"""Language ID: held-out accuracy, the batch scores against plain sums, defined results."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinemetrics.llm import langid
from cinemetrics.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the cat and the dog", "en"), ("the house on the hill", "en"), ("der hund und die katze", "de"), ("das haus am see", "de"), (None, "en"), ("x", None)]
    return langid.fit(spark.createDataFrame(rows, "text string, lang string"))


def grams(text):
    plain = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in plain:
        plain = plain.replace("  ", " ")
    return [plain[i : i + n] for n in (1, 2, 3) for i in range(len(plain) - n + 1) if plain[i : i + n] != " "]


def bucket(gram):
    h = len(gram) * 0x27D4EB2F & 0xFFFFFFFF
    for c, m in zip(gram, langid.MULTIPLIERS):
        h = (h ^ ord(c)) * m & 0xFFFFFFFF
        h ^= h >> 15
    return h >> (32 - langid.BITS)


@pytest.mark.parametrize("text", ["The  cat!", "a", "Straße 12 -- ÜBER", "x" * 50, "  .a. ", "日本 go"])
def test_buckets_are_those_of_the_letter_windows(text):
    found = langid.ngram_buckets(["first one", text, "last"], LETTERS)
    mine = found[0][found[1] == 1]
    assert Counter(mine.tolist()) == Counter(bucket(g) for g in grams(text))


def test_scores_are_naive_bayes_posteriors(model):
    texts = ["the dog", "die katze", "haus"]
    names, scores, means, counts = langid.score_texts(model, texts, LETTERS)
    for text, name, score, mean, n in zip(texts, names, scores, means, counts):
        sums = [model.log_prior[j] + sum(model.log_prob[bucket(g), j] for g in grams(text)) for j in range(2)]
        top = max(sums)
        assert name == model.langs[sums.index(top)]
        assert math.isclose(score, 1 / sum(math.exp(s - top) for s in sums))
        j = sums.index(top)
        assert n == len(grams(text)) and math.isclose(mean, (top - model.log_prior[j]) / n)


def test_defined_results(spark, model):
    rows = [(1, None, 1), (2, "", 2), (3, "12 !? 34", 3), (4, "the the", 4), (4, "the the", 4), (5, "der und " * 400_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _language int")
    out = langid.identify(df, model)
    assert out.columns == ["doc_id", "text", "_language", "lang_pred", "score"]
    found = sorted((r.doc_id, r.lang_pred) for r in out.collect())
    assert found == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de")]
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in out.collect())
    kept = langid.reject_unknown(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [4, 4, 5]
    assert langid.identify(df.limit(0), model).collect() == []


def test_nothing_learned(spark):
    empty = langid.fit(spark.createDataFrame([(None, "en")], "text string, lang string"))
    out = langid.identify(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), empty).first()
    assert (out.lang_pred, out.score) == ("und", 0.0)


def test_held_out_accuracy(spark):
    found = QUERIES["op7_language_id"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = found.where("held_out").join(truth, "doc_id")
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.98
    assert found.count() == truth.count()


def test_no_language_is_lost(spark):
    # one French text many times over, few English rows, and a bound far below either
    rows = [(i, "le chien et le chat dorment", "fr") for i in range(3000)] + [(5000 + i, f"the dog number {i}", "en") for i in range(50)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_per_lang=5)
    names, *_ = langid.score_texts(model, ["le chat dort", "the dog number"], LETTERS)
    assert model.langs == ("en", "fr") and names == ["fr", "en"]


def test_more_languages_than_one_part_holds(spark, monkeypatch):
    monkeypatch.setattr(langid, "PART_LANGS", 3)
    words = {f"l{k:03d}": "".join(chr(0x4E00 + 40 * k + j) for j in range(5)) for k in range(300)}
    df = spark.createDataFrame([(k, w, lang) for k, (lang, w) in enumerate(words.items())], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.langs) == 300
    assert [(r.lang, r.lang_pred) for r in langid.identify(df, model).collect() if r.lang != r.lang_pred] == []


def test_texts_unlike_their_language_are_rejected(spark):
    import random

    rnd = random.Random(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"))
    junk = [
        ("noise", " ".join("".join(rnd.choice("qxzjkvwbpf") for _ in range(7)) for _ in range(60))),
        ("polish", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. " * 2),
        ("greek", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. " * 3),
    ]
    rows = spark.createDataFrame([(900_000 + i, t) for i, (_, t) in enumerate(junk)], "doc_id long, text string")
    kept = {r.doc_id for r in langid.reject_unknown(rows, model).collect()}
    assert not kept, [junk[i - 900_000][0] for i in kept]
    assert langid.reject_unknown(docs, model).count() == docs.where("text rlike '[a-zA-Z]'").count()
