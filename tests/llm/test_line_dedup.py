"""Line dedup against a plain Python count of lines per document."""

import random
from collections import defaultdict

from cinemetrics.llm.line_dedup import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = lower(line.strip(SPACE))
            if len(k) >= min_chars:
                holders[k].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(lower(line.strip(SPACE)), ())
            low = [x for x in ids if x is not None]
            keeper = max(low) if low else None
            if not (len(ids) >= min_docs and i != keeper):
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup(df, **kw).collect()), key=str)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    shared = [f"shared line {k} " + "é" * rnd.randint(20, 40) for k in range(12)]
    rows = []
    for i in range(n):
        lines = [rnd.choice(shared) for _ in range(rnd.randint(0, 5))]
        lines += [f"own {i} {j} " + "x" * rnd.randint(0, 60) for j in range(rnd.randint(0, 4))]
        rnd.shuffle(lines)
        lines = [rnd.choice(["", " ", "\t", "\x0b"]) + (x.upper() if rnd.random() < 0.3 else x) + rnd.choice(["", "  ", "\r"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    return rows


def test_random_texts(spark):
    rows = corpus(1)
    assert got(spark, rows) == brute(rows)


def test_nulls_empty_repeats_and_null_ids(spark):
    line = "a line that is long enough to be counted, really"
    rows = [(i, f"{line}\nbody {i}") for i in range(5)]
    rows += [(9, None), (10, ""), (11, "\n\n"), (3, f"other\n{line}\n{line}"), (4, f"{line}\nbody 4"), (None, line), (None, None)]
    assert got(spark, rows) == brute(rows)
    # the largest id keeps all its lines, four distinct documents are not enough
    assert got(spark, rows[:4]) == brute(rows[:4])
    assert all(r[3] == 0 for r in got(spark, rows[:4]))


def test_threshold_counts_code_points_of_the_trimmed_key(spark):
    for n, gone in ((39, 0), (40, 1)):
        rows = [(i, "  " + "ü" * n + " \t") for i in range(5)]
        assert [r[3] for r in got(spark, rows)] == [gone] * 4 + [0]


def test_hot_line_and_long_text(spark):
    line = "one line in every document of the whole collection"
    long = "\n".join(f"row {j} of the very long document, {j * j}" for j in range(20000))
    rows = [(i, f"{line}\n{i}") for i in range(300)] + [(1000, long + "\n" + line)]
    assert got(spark, rows) == brute(rows)


def test_other_columns_stay_and_clashing_ones_are_replaced(spark):
    rows = [(1, "a", "x", 7, 8), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_lines int, _drop int")
    out = line_dedup(df)
    assert out.columns == ["doc_id", "lang", "_drop", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "x", 8, "a", 1, 0), (2, None, None, "", 1, 0)]


def test_empty_table(spark):
    assert got(spark, []) == []
