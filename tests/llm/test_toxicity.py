"""Toxicity: folding, matching, exceptions, learning, held-out separation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cinemetrics.llm import toxicity as tx
from cinemetrics.llm.queries import QUERIES


def test_fold():
    assert tx.fold("You 1D10T!!") == " you idiot "
    assert tx.fold("Mоrоn") == " moron "  # Cyrillic o
    assert tx.fold("$tup!d, $5") == " stupid ss "
    assert tx.fold(None) == tx.fold("") == tx.fold(" ?! ") == "  "


@pytest.mark.parametrize(
    "text", ["ïdïöt", "\uff49\uff44\uff49\uff4f\uff54", "i\u0336diot", "id\u200biot", "i d i o t", "I.D.I.O.T", "1D10T", "|diot"]
)
def test_fold_finds_the_plain_word(text):
    assert "idiot" in tx.fold(f"An {text}, no?").split()


def test_both_readings_of_a_sign():
    a = tx.Lexicon({" loser ": 2.0, " imbecile": 3.0, " bigot ": 4.0, " egg ": 5.0}).automaton()
    found = lambda text: [f.strip() for _, f, _ in tx.matches(a, tx.fold_open(text))]
    assert found("1oser |oser !oser loser") == ["loser"] * 4
    assert found("1mbeci1es imbeci1e") == ["imbecile"] * 2
    assert found("6i9ot big0t b1got bi60t e66 e99") == ["bigot"] * 4 + ["egg"] * 2
    # plain letters have one reading
    assert found("ioser lmbecile gigot bibot ebb") == []


def test_a_word_spelled_after_an_article():
    a = tx.Lexicon({" idiot ": 2.0}).automaton()
    for text in ("i d i o t", "you are a i d i o t", "u r i d i o t ."):
        assert len(tx.matches(a, tx.fold_open(text))) == (0 if text.startswith("u") else 1)
    assert tx.fold("a b c") == " abc " and tx.fold("a b") == " a b "


def _score_by_scan(lex, text):
    """Every form at every word of the folded text, letter by letter."""
    words = tx.fold_open(text)
    reads = lambda at, form: len(words) >= at + len(form) and all(
        f == c or (c == "1" and f in "il") or (c == "6" and f in "gb") for f, c in zip(form, words[at:])
    )
    total = 0.0
    excused = [(at, at + len(e)) for e in lex.exceptions for at in range(len(words)) if reads(at, e)]
    for at in range(len(words)):
        here = [(w, len(f), f) for f, w in lex.forms.items() if reads(at, f)]
        if here:
            heaviest = max(w for w, _, _ in here)
            longest = max(n for w, n, _ in here if w == heaviest)
            form = min(f for w, n, f in here if w == heaviest and n == longest)
            if not any(s <= at and at + len(form.rstrip()) <= e for s, e in excused):
                total += heaviest
    x = total / max(1, len(words.split())) ** lex.power
    return 1 / (1 + math.exp(-(lex.slope * x + lex.intercept)))


def test_score_against_a_scan(spark):
    lex = tx.Lexicon(
        {" bill ": 1.5, " big": 1.0, " bigi": 1.0, " gill ": 2.0, " lib": 0.5, " glib ": 0.5},
        frozenset({" a big ", " bill i "}), 0.5, 3.0, -2.0,
    )
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("bbiigllla1!6960  .\u0301\uff42") for _ in range(rnd.randrange(60))) for _ in range(2500)]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in tx.score_toxicity(df, lex).select("doc_id", "score").collect()}
    want = [_score_by_scan(lex, t) for t in texts]
    assert sum(w > min(want) for w in want) > 200
    for n, w in enumerate(want):
        assert got[n] == pytest.approx(w, abs=1e-12), texts[n]


def test_matches_whole_words_beginnings_and_exceptions():
    lex = tx.Lexicon({" bad ": 2.0, " vile": 3.0, " vileness ": 4.0}, frozenset({" not bad "}))
    a = lex.automaton()
    assert [f for _, f, _ in tx.matches(a, tx.fold("bad badly vilest vileness Bad"))] == [" bad ", " vile", " vileness ", " bad "]
    assert [f for _, f, _ in tx.matches(a, tx.fold("not bad, but bad"))] == [" bad "]
    assert tx.matches(tx.Lexicon().automaton(), " x ") == []


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rnd = random.Random(i)
        body = " ".join(f"w{rnd.randrange(50)}q" for _ in range(20 + i % 30)) + " and you are a fine"
        if toxic:
            body += [" idiot", " vexatious idiot", " vexation idiot", " vexing idiot"][i // 4 % 4]
        elif i % 20 == 1:
            body += " village idiot"
        docs.append((i, body))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (3, None), (5000, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    return tx.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_learns_forms_and_exceptions(learned):
    assert " village idiot " in learned.exceptions
    assert " idiot " in learned.forms
    assert all(not f.startswith(" w") for f in learned.forms)


def test_scores(spark, learned):
    rows = [(1, "what an 1D10T", 0), (2, "a calm day", 0), (3, None, 0), (4, "", 0), (4, "", 0), (5, "calm " * 200_000 + "idiot, idiot", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    out = tx.score_toxicity(df, learned)
    assert out.columns == ["doc_id", "text", "score", "predicted", "terms"]
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].predicted == 1 and got[1].terms and got[2].predicted == 0
    assert got[2].score == got[3].score == got[4].score < 0.3 and len(got[5].terms) == 2
    assert all(0 <= r.score <= 1 for r in got.values())
    assert tx.score_toxicity(df.limit(0), learned).collect() == []


def test_without_both_classes(spark):
    d = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for rows in ([], [(1, 0)], [(1, None)]):
        lex = tx.fit(d, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert lex.forms == {} and tx.score_toxicity(d, lex).first().predicted == 0


def test_held_out_rows_of_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op3_toxicity"](spark, sf)
    held = found.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    mean = {r["toxic"]: r["s"] for r in held.groupBy("toxic").agg(F.avg("score").alias("s")).collect()}
    assert mean[1] > 4 * mean[0]
    # a third of the few toxic rows here use words that no training row holds
    assert held.where("toxic = 0").agg(F.avg("predicted")).first()[0] < 0.05
