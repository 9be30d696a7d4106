"""Decontamination against all alignments; the masks; defined results."""

import itertools
import random
import re

from cinemetrics.llm import decontaminate as dc


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items, window=13, replaced=2):
    out = set()
    for i, t in docs:
        d = words(t)
        for j, u in items:
            b = words(u)
            best = None
            if len(b) < window:
                continue
            for start in range(-len(b) + 1, len(d)):
                equal = [0 <= start + p < len(d) and d[start + p] == b[p] for p in range(len(b))]
                if any(sum(equal[s : s + window]) >= window - replaced for s in range(len(b) - window + 1)):
                    best = max(best or (0, 0), (sum(equal), -start))
            if best:
                out.add((i, j, best[0], len(b), -best[1]))
    return out


def got(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = dc.contaminated(d, b).collect()
    assert len({(r.doc_id, r.item_id) for r in found}) == len(found) or len(docs) != len(set(docs))
    return {(r.doc_id, r.item_id, r.n_equal, r.item_words, r.doc_word) for r in found}


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(j, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 40)))) for j in range(12)]
    docs = []
    for i in range(60):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))]
        if rnd.random() < 0.6:
            part = rnd.choice(items)[1].split()
            part = part[rnd.randint(0, 3) : len(part) - rnd.randint(0, 3)]
            for _ in range(rnd.randint(0, 5)):
                if part:
                    part[rnd.randrange(len(part))] = "zz"
            at = rnd.randint(0, len(text))
            text[at:at] = part
        docs.append((i, ", ".join(w.upper() if rnd.random() < 0.2 else w for w in text)))
    return docs, items


def test_masks_hit_every_window_with_two_words_replaced():
    for k in range(dc.MAX_REPLACED + 1):
        for gone in itertools.combinations(range(dc.WINDOW), k):
            assert any(
                not any(at + p in gone for p in mask) for mask in dc.MASKS for at in range(dc.WINDOW - mask[-1])
            ), gone


def test_random_texts(spark):
    for seed in (1, 2, 3):
        docs, items = corpus(seed)
        want = brute(docs, items)
        assert got(spark, docs, items) == want and len(want) > 5


def test_shuffle_join_beyond_the_bound(spark):
    docs, items = corpus(4)
    spark.conf.set("cinemetrics.seeds.maxBroadcastRows", "0")
    try:
        assert got(spark, docs, items) == brute(docs, items)
    finally:
        spark.conf.unset("cinemetrics.seeds.maxBroadcastRows")


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    item = " ".join(f"x{k}" for k in range(20))
    docs = [(1, item), (1, item), (1, "clean"), (None, "before " + item), (2, None), (3, ""), (4, "?!")]
    items = [(7, item), (7, item), (None, item), (8, None), (9, "too short to tell")]
    rows = got(spark, docs, items)
    assert rows == {(1, 7, 20, 20, 0), (1, None, 20, 20, 0), (None, 7, 20, 20, 1), (None, None, 20, 20, 1)}
    assert got(spark, [], items) == set() and got(spark, docs, []) == set()
    d = spark.createDataFrame([(*r, 5, "a") for r in docs], "doc_id long, text string, _id int, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    kept = dc.decontaminate(d, b)
    assert kept.columns == d.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "clean", 5, "a"), (2, None, 5, "a"), (3, "", 5, "a"), (4, "?!", 5, "a")], key=str)


def test_very_long_document(spark):
    item = " ".join(f"x{k}" for k in range(30))
    docs = [(1, "word " * 50_000 + item + " word" * 50_000)]
    assert got(spark, docs, [(1, item)]) == {(1, 1, 30, 30, 50_000)}


def test_main_path_runs_no_python(spark):
    docs, items = corpus(1)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plan = dc.contaminated(d, b)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def brute_short(docs, items, window=13):
    out = set()
    for i, t in docs:
        d = words(t)
        for j, u in items:
            b = words(u)
            places = [k for k in range(len(d) - len(b) + 1) if d[k : k + len(b)] == b]
            if 0 < len(b) < window and places:
                out.add((i, j, len(b), len(b), places[0]))
    return out


def both(spark, docs, items):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, dc.overlaps(d, b).drop("_t1", "_t2").collect()), key=str)


def test_short_items_are_found_whole(spark):
    for seed, bound in ((3, "2000000"), (5, "2000000"), (6, "0")):
        docs, items = corpus(seed)
        items += [(100 + n, " ".join(docs[2 * n][1].split()[1 : 2 + n])) for n in range(12)]
        want = brute(docs, items) | brute_short(docs, items)
        spark.conf.set("cinemetrics.seeds.maxBroadcastRows", bound)
        try:
            assert both(spark, docs, items) == sorted(want, key=str) and len(brute_short(docs, items)) > 8
        finally:
            spark.conf.unset("cinemetrics.seeds.maxBroadcastRows")


def test_short_documents_scripts_without_blanks_and_dropped_rows(spark):
    long_item = " ".join(f"x{k}" for k in range(13))
    docs = [
        (1, "Q: what is two plus two?"), (2, "two plus three is what"), (3, " ".join(f"x{k}" for k in range(11))),
        (4, "请问中国的首都是哪里？谢谢"), (5, "เมืองหลวงของประเทศไทย"), (6, None), (None, "two plus two"),
    ]
    items = [(1, "two plus two"), (1, "two plus two"), (2, long_item), (3, "中国的首都是哪里"), (4, "ประเทศ"), (5, "?!"), (6, None)]
    found = both(spark, docs, items)
    assert {r[:2] for r in found} == {(1, 1), (3, 2), (4, 3), (5, 4), (None, 1)} and len(found) == 5
    assert (1, 1, 3, 3, 3) in found and (4, 3, 8, 8, 2) in found
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(r.doc_id for r in dc.decontaminate(d, b).collect()) == [2, 6]


def test_shuffle_join_carries_no_words(spark):
    docs, items = corpus(7)
    docs += [docs[0], (None, docs[1][1])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")

    def joins(node):
        below = [node.children().apply(k) for k in range(node.children().size())]
        return ([node] if node.nodeName() == "Join" else []) + [j for n in below for j in joins(n)]

    spark.conf.set("cinemetrics.seeds.maxBroadcastRows", "0")
    try:
        assert got(spark, docs, items) == brute(docs, items)
        plan = dc.contaminated(d, b)._jdf.queryExecution().optimizedPlan()
    finally:
        spark.conf.unset("cinemetrics.seeds.maxBroadcastRows")
    sides = [j.left().output().mkString(" ") for j in joins(plan) if "_seed#" in j.condition().toString()]
    assert len(sides) == 1 and "_at#" in sides[0] and "_words#" not in sides[0]


def test_a_template_that_all_documents_and_items_share(spark):
    template = " ".join(f"t{k}" for k in range(12))
    docs = [(i, f"d{i} e{i} {template} f{i} g{i}") for i in range(30)] + [(99, "d e " + " ".join(f"t{k}" for k in range(10)) + " f g h")]
    items = [(j, f"a{j} b{j} {template} c{j}") for j in range(30)]
    want = brute(docs, items)
    assert got(spark, docs, items) == want and len(want) == 900
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert [r.doc_id for r in dc.decontaminate(d, b).collect()] == [99]
    # places are verified before they are aggregated and shuffled, and carry no words from there on
    plan = dc.contaminated(d, b)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(n for n, line in enumerate(plan) if line.lstrip(" +-").startswith("Aggregate [_id#"))
    assert not re.search(r"(?<!_item)_words#|_item_hashes#", plan[at]) and "Project" in plan[at + 1]


def test_texts_are_not_shuffled_to_drop_few(spark):
    docs, items = corpus(2)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    kept = dc.decontaminate(d, b)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    bad = {w[0] for w in brute(docs, items)} | {w[0] for w in brute_short(docs, items)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in bad) and bad
