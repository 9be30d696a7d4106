"""Manifest and proofs against a tree built in plain Python."""

import hashlib
import zlib

import pytest

from cinemetrics.llm import merkle
from cinemetrics.llm.queries import op12_merkle_manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fan=8):
    """(last node, for each leaf its (left, right) pairs from the leaf upwards)"""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // fan * fan : i // fan * fan + fan]
            paths[k].append(("".join(run[: i % fan]), "".join(run[i % fan + 1 :])))
            at[k] = i // fan
        nodes = [sha("".join(nodes[i : i + fan])) for i in range(0, len(nodes), fan)]
    return nodes[0], paths


def by_hand(rows, fan=8):
    """rows: (group, order, digest) -> sorted (group, order, digest, subroot, root, path)"""
    groups = {}
    for g, o, d in rows:
        groups.setdefault(g, []).append((o, d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for g in names}
    trees = {g: tree([d for _, d in ordered[g]], fan) for g in names}
    root, tops = tree([trees[g][0] for g in names], fan)
    out = []
    for g, top in zip(names, tops):
        for (o, d), path in zip(ordered[g], trees[g][1]):
            out.append((g, o, d, trees[g][0], root, tuple(path + top)))
    return sorted(out, key=str)


def built(spark, rows, fan=8, wanted=None):
    df = spark.createDataFrame(rows, "_group string, _i long, digest string").repartition(5)
    m = merkle.build_manifest(df, "_group", "_i", "digest", ("_i",), fan)
    if wanted is not None:
        wanted = spark.createDataFrame(wanted, "group string, rank long")
    got = merkle.proofs(m, ("_i",), wanted).collect()
    return m, sorted(((r.group, r["_i"], r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in got), key=str)


def sample(sizes):
    return [(g, i * 3, sha(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]


@pytest.mark.parametrize(
    "sizes", [{"a": 1}, {"a": 8, "b": 9}, {None: 65, "é": 1, "z": 64, "a": 200}, {f"g{i}": 1 + i % 3 for i in range(70)}]
)
def test_proofs_of_all_leaves(spark, sizes):
    rows = sample(sizes)
    m, got = built(spark, rows)
    assert got == by_hand(rows)
    assert {len(r.children) <= 8 and r.digest == sha("".join(r.children)) for r in m.records().collect()} <= {True}


def test_other_fan_out_ties_and_repeated_rows(spark):
    rows = sample({"a": 20, None: 5}) + [("a", 6, sha("other"))] + [("b", None, sha("same"))] * 40 + [(None, 3, sha(f"t{i}")) for i in range(9)]
    for fan in (2, 3, 8):
        assert built(spark, rows, fan)[1] == by_hand(rows, fan)


def test_leaves_asked_for(spark):
    rows = sample({"a": 100, "b": 3, "c": 1})
    _, all_of_them = built(spark, rows)
    _, some = built(spark, rows, wanted=[("a", 0), ("a", 99), ("a", 50), ("a", 50), ("c", 0), ("a", 400), ("x", 0)])
    assert some == [r for r in all_of_them if (r[0], r[1]) in {("a", 0), ("a", 297), ("a", 150), ("c", 0)}]


def test_empty_table(spark):
    m, got = built(spark, [])
    assert m.root is None and got == [] and m.records().collect() == []


def test_query_against_plain_python(spark, tmp_path):
    langs = ["en", "en", "en", "en", None, "fr", "ß"]
    rows = [(i, f"Text Ä {i}" * (i % 4), langs[i % 7], "s", i) for i in range(150)]
    rows += [(500, None, None, None, None), (501, "", "en", None, 0), (502, "Ab" * 200_000, "zz", "s", 1), (503, "\n", "en", "-", -5)]
    rows += [(504, "Same", "en", "s", 4)] * 11 + [(None, "No Id", "en", "s", 1), (None, "No Id 2", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.selectExpr("*", "1 AS leaf", "2 AS _order").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")

    def crc(i):
        return zlib.crc32(("" if i is None else str(i)).encode())

    def low(t):
        return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    leaves = {(r[0], leaf_of((r[0], r[3], r[2], r[4], r[1]))): r for r in rows}
    plain = by_hand([(r[2], r[0], leaf_of((r[0], r[3], r[2], r[4], r[1]))) for r in rows])
    want = []
    for _, i, leaf, subroot, root, path in plain:
        r = leaves[i, leaf]
        node = leaf_of((r[0], r[3], r[2], r[4], low(r[1]) if crc(i) % 3 == 0 else r[1]))
        for left, right in path:
            node = sha(left + node + right)
        want.append((i, leaf, subroot, root, sha("".join(a + b for a, b in path)), node, node == root))
    got = op12_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in got.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {g[-1] for g in got} == {True, False}
