"""SimHash fingerprints, links and components against brute force over all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from cinemetrics.llm import simhash
from cinemetrics.llm.components import connected_components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_equals_the_definition(spark):
    texts = ["", None, "one", "One two", "a b c", "A  b\tC\nd e", "x " * 500, "é ü ß Ö Ü", "a b a b a b a b", " \x0b\x0c "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.fp for r in df.select("doc_id", simhash.fingerprint("text").alias("fp")).collect()}
    assert found == {i: signed(plain_fingerprint(t)) for i, t in enumerate(texts)}


def test_spark_hash_is_the_same_function(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == signed(xxhash.xxh64_intdigest(b"a b c", 42))


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("limit", [2, 32])
def test_links_give_the_components_of_all_pairs(spark, max_bits, limit):
    rnd = random.Random(max_bits * 10 + limit)
    prints = set()
    for _ in range(12):  # families of fingerprints a few bits apart, chains among them
        x = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 25)):
            prints.add(signed(x))
            for _ in range(rnd.randint(0, 3)):
                x ^= 1 << rnd.randrange(64)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    pairs = [(r.a, r.b) for r in simhash.close_pairs(df, max_bits, limit).collect()]
    near = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1")
    assert all(near(a, b) <= max(2, max_bits) for a, b in pairs)
    want = groups(prints, lambda a, b: near(a, b) <= max_bits)
    linked = set(pairs) | {(b, a) for a, b in pairs}
    assert groups(prints, lambda a, b: (a, b) in linked) == want


def test_components_of_documents(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(300)) for _ in range(8)]
    rows = []
    for i in range(120):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(len(words))] = "zz"
        rows.append((1000 - i, " ".join(words)))
    rows += [(5, None), (7, ""), (3, "  "), (None, rows[0][1]), (6, "lone words here now"), (2000, rows[1][1]), (2000, rows[1][1])]
    found = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    prints = sorted({signed(plain_fingerprint(t)) for _, t in rows})
    root = groups(prints, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 2)
    least = {}
    for i, t in rows:
        if i is not None:
            r = root[signed(plain_fingerprint(t))]
            least[r] = min(least.get(r, i), i)
    want = sorted(((i, signed(plain_fingerprint(t)), least[root[signed(plain_fingerprint(t))]]) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found), key=str) == want


def test_dedup_keeps_one_row_of_each_component(spark):
    rows = [(1, "a b c d", 1), (2, "A b c d", 2), (2, "a b c d", 3), (4, "other words all the way", 4), (4, "other words all the way", 5),
            (None, "no id here at all", 6), (None, "no id here at all", 7), (None, "a b c d", 8)]
    kept = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == [(1, "a b c d"), (4, "other words all the way")]
    assert [r.text for r in kept if r.doc_id is None] == ["no id here at all"]
    assert kept[0].__fields__ == ["doc_id", "text", "fp"]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(df).collect() == []
    assert simhash.simhash_dedup(df).collect() == []


def test_connected_components_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, j) for j in range(1, 50)] + [(7, 7), (500, 400), (400, 500), (None, 3)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {i: 100 for i in range(100, 141)} | {j: 0 for j in range(50)} | {400: 400, 500: 400}
