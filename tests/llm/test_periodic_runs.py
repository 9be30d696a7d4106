"""Runs against a direct enumeration of every period and place."""

import hashlib
import random
import re
import zlib

import numpy as np

from cinemetrics.llm import periodic_runs as pr
from cinemetrics.llm.queries import op11_periodic_runs


def all_runs(words, min_length=24, min_exponent=3):
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        x = 0
        while x + q < n:
            end = x
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end - x + q >= max(min_length, min_exponent * q) and end > x:
                found.setdefault((x, end - x + q), q)
            x = max(end, x + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def mixed(rnd, n, letters, repeats):
    words = [rnd.randrange(letters) for _ in range(n)]
    for _ in range(repeats if n > 30 else 0):
        s = rnd.randrange(n)
        q = rnd.randint(1, max(1, (n - s) // 3))
        for i in range(s + q, min(n, s + q * rnd.randint(2, 6) + rnd.randrange(q))):
            words[i] = words[i - q]
    return words


def test_cover_gives_every_difference():
    assert {(a - b) % pr.MODULUS for a in pr.COVER for b in pr.COVER} == set(range(pr.MODULUS))
    inside = np.isin(np.arange(pr.MODULUS), pr.COVER)
    for a in range(pr.MODULUS):
        for b in range(pr.MODULUS):
            k = pr.SHIFT[a, b]
            assert k < pr.MODULUS and inside[(a + k) % pr.MODULUS] and inside[(b + k) % pr.MODULUS]


def test_extensions_of_all_pairs():
    rnd = random.Random(2)
    for _ in range(20):
        words = np.array(mixed(rnd, rnd.choice([2, 40, 150, 300]), rnd.choice([1, 2, 4]), 3) + [99], dtype=np.int64)
        i, j = np.triu_indices(len(words), 1)
        want = []
        for a, b in zip(i, j):
            k = 0
            while words[a + k] == words[b + k]:
                k += 1
            want.append(k)
        assert pr.CoverIndex(words).extension(i, j).tolist() == want


def test_runs_of_random_documents():
    rnd, total = random.Random(5), 0
    for n in range(120):
        parts = [mixed(rnd, rnd.choice([0, 1, 23, 24, 25, 60, 200, 400]), rnd.choice([1, 2, 3, 50]), 3) for _ in range(rnd.randint(1, 6))]
        limits = [(24, 3), (24, 3), (6, 2), (2, 4)][n % 4]
        got = pr.find_runs([np.array(p, dtype=np.int64) for p in parts], *limits)
        for g, p in zip(got, parts):
            assert g == all_runs(p, *limits)
            total += len(g)
    assert total > 100


def test_long_document_of_one_word_and_with_a_long_period():
    assert pr.find_runs([np.zeros(60_000, dtype=np.int64)]) == [[(0, 60_000, 1)]]
    rnd = np.random.default_rng(1)
    words = rnd.integers(0, 10_000, 50_000)
    words[2_000:] = np.resize(words[2_000:17_000], 48_000)
    assert pr.find_runs([words]) == [[(2_000, 48_000, 15_000)]]


TEXTS = [
    None, "", " \n\t\x0b", "one", "a b " * 12, "a b " * 11 + "a", "x " * 23, "x " * 24, "x y x y　" * 30,
    "So it goes. " * 20 + "and then " * 30, "\n".join(["the same line again and again"] * 9), "word " * 9000,
    "a a a a b " * 10, ("p q r " * 9 + "z ") * 4, "\x1c \x85 " * 15,
]


def planted(doc_id, text):
    w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", text or "") if x]
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = all_runs(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    digest = sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
    kept = sha(" ".join(x for i, x in enumerate(w) if i not in gone))
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest, kept)


def test_query_against_direct_enumeration(spark, tmp_path):
    rows = [(i, TEXTS[i % len(TEXTS)] if i % 3 else " ".join("abcde"[(i * j * j) % 5] for j in range(i % 200)), i, "r", 0) for i in range(150)]
    rows += [(None, t, 0, "n", 1) for t in TEXTS] + [(7, TEXTS[9], 0, "again", 2)] * 3
    schema = "doc_id long, text string, start int, runs string, n_words int"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=str)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) and sum(g[1] > 0 for g in got) > 40


def test_output_text_and_empty_table(spark):
    schema = "doc_id string, text string"
    docs = spark.createDataFrame([("a", "go on " * 20 + "stop"), ("b", None)], schema)
    got = {r.doc_id: r for r in pr.periodic_runs(docs).collect()}
    assert got["a"].text == "go on stop" and [tuple(x) for x in got["a"].runs] == [(0, 40, 2)] and got["a"].n_words == 41
    assert (got["b"].text, got["b"].runs, got["b"].n_words) == ("", [], 0)
    assert pr.periodic_runs(spark.createDataFrame([], schema)).collect() == []
