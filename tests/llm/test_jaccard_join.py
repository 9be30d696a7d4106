"""The join against all pairs of documents; no link lost by segments, bands or blocks."""

import random

import numpy as np
import pytest

from cinemetrics.llm import jaccard_join as jj


def shingles(text, words=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    if not w:
        return set()
    return {tuple(w)} if len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def brute(rows, words=3, percent=90):
    sets = [shingles(t, words) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least.get(find(i)), links[i]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, _node int, _family string").repartition(4)
    out = jj.jaccard_components(df, **kw)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return words


def corpus(seed, families, size, most_edits):
    rnd = random.Random(seed)
    rows, doc = [], 0
    for _ in range(families):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([2, 3, 8, 11, 12, 13, 40, 120, 300]))]
        for _ in range(rnd.randint(1, size)):
            words = edited(rnd, base, rnd.randint(0, most_edits))
            words = words[: len(words) - rnd.randint(0, 2)] + ["end"] * rnd.randint(0, 1)
            rows.append((doc * 7 % 10_007, " ".join(words)))
            doc += 1
    return rows


EDGES = [
    (900_001, None), (900_002, ""), (900_003, " \n\t "), (900_004, None), (900_005, "One two"), (900_006, "one  TWO"),
    (900_007, "one"), (None, "one two"), (None, "alone here without an id"), (None, None), (900_008, "É two three four"),
    (900_009, "é two three four"), (900_010, "a b c " * 5000), (900_011, "A b c " * 4000), (900_005, "one two"), (900_005, "three"),
]


def test_against_all_pairs(spark):
    rows = corpus(1, 60, 8, 3) + EDGES
    want = brute(rows)
    assert got(spark, rows) == want
    assert len({w[2] for w in want}) < len(rows) - 30


@pytest.mark.parametrize("kw", [{"percent": 80}, {"percent": 100}, {"words": 1, "percent": 70}, {"words": 5, "percent": 95}])
def test_other_lengths_and_thresholds(spark, kw):
    rows = corpus(2, 25, 6, 3)
    assert got(spark, rows, **kw) == brute(rows, **kw)


def test_large_family_in_bands_and_blocks(spark):
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rnd, base[: 150 - i % 30], rnd.randint(0, 4)))) for i in range(260)]
    rows += [(1000 + i, " ".join(base)) for i in range(300)]  # exact copies are one node
    want = brute(rows)
    assert got(spark, rows, block_sets=20) == want
    assert got(spark, rows, block_shingles=2500) == want
    assert got(spark, rows) == want


def test_rows_of_the_blocks_do_not_follow_the_pairs(spark):
    members = spark.range(600).selectExpr("1L AS _family", "id AS _node", "100L + id % 20 AS _size")
    tasks = jj._meetings(members, 90, 50, 10**9)
    sizes = tasks.groupBy("_task").count().collect()
    assert max(r["count"] for r in sizes) <= 200 and sum(r["count"] for r in sizes) < 600 * 40
    met = {}
    for r in tasks.collect():
        met.setdefault(r._task, []).append(r._node)
    pairs = {(a, b) for nodes in met.values() for a in nodes for b in nodes if a < b}
    assert all((a, b) in pairs for a in range(600) for b in range(a + 1, 600) if 100 * min(100 + a % 20, 100 + b % 20) >= 90 * max(100 + a % 20, 100 + b % 20))


def test_similar_sets_share_a_segment():
    rnd = np.random.default_rng(3)
    for percent in (70, 80, 90, 95):
        for size in [9, 10, 13, 14, 20, 21, 33, 50, 51, 200, 1000, 5000]:
            for _ in range(20):
                a = rnd.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
                gone = rnd.integers(0, size * (100 - percent) // 100 + 1)
                more = rnd.integers(0, size * (100 - percent) // percent + 1)
                b = np.concatenate([a[gone:], rnd.integers(0, 1 << 63, more, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])
                if not (gone or more) or 100 * (size - gone) < percent * (size + more):
                    continue
                ha, hb = (set(jj.segment_hashes(np.sort(s), percent).tolist()) for s in (a, b))
                assert ha & hb, (percent, size, gone, more)


def test_overlaps_over_several_fragments(monkeypatch):
    monkeypatch.setattr(jj, "FRAGMENT_SHINGLES", 7)
    rnd = np.random.default_rng(1)
    a, b = ([np.unique(rnd.integers(0, 90, rnd.integers(0, 60)).astype(np.uint64)) for _ in range(n)] for n in (9, 12))
    assert jj.overlaps(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]


def test_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None)]) == [(1, 0, 1, 0)]


def test_stars_of_a_hot_segment(spark):
    keyed = spark.range(900).selectExpr("id AS _node", "explode(array(if(id < 300, 7L, id + 1000), id, id)) AS _segment")
    pairs = jj._stars(keyed)
    got = {tuple(r) for r in pairs.collect()}
    assert got == {(n, 0) for n in range(1, 300)}
    # no window over a segment, and both sides of the join are shuffled for the join itself
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("hashpartitioning(_segment") >= 2
