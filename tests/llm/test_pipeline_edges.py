"""The pipeline on small hand-made tables: empty, null, repeated, and with extra columns."""

import random

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _tables(spark, folder, docs, bench, extra=()):
    df = spark.createDataFrame(docs, DOCS)
    for name, value in extra:
        df = df.selectExpr("*", f"{value} AS `{name}`")
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def _text(rnd, n):
    return " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def _row(i, text, lang="en"):
    return (i, text, lang, "s", None if text is None else len(text))


def test_empty_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, _tables(spark, tmp_path, [], []))
    assert out.collect() == [] and {"doc_id", "piece", "ids", "sequence_id"} <= set(out.columns)


def test_decisions_nulls_repeats_and_extra_columns(spark, tmp_path):
    rnd = random.Random(3)
    shared = "this line of more than forty characters is shared by many documents"
    item = _text(rnd, 20)
    texts = {i: _text(rnd, 120) for i in range(1, 21)}
    docs = [_row(i, t + ("\n" + shared if i <= 6 else "")) for i, t in texts.items()]
    docs += [_row(100, texts[9]), _row(101, texts[9]), _row(102, texts[10] + " " + item + " " + texts[11][:200])]
    docs += [_row(103, None), _row(104, ""), _row(105, "12 34"), _row(None, _text(rnd, 80)), _row(7, texts[7]), _row(106, _text(rnd, 30_000), None)]
    extra = [("_id", "doc_id"), ("lang_pred", "'x'"), ("_words", "1"), ("n_lines", "2"), ("_fp", "3"), ("component_id", "4")]
    folder = _tables(spark, tmp_path, docs, [(1, item), (2, None), (3, "")], extra)
    stage = dict(corpus_pipeline.STAGES)
    table = spark.read.parquet(f"{folder}/documents.parquet")

    kept = stage["language_id"](spark, table, folder)
    assert kept.columns == table.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted((d[0] or 0) for d in docs if d[0] not in (103, 104, 105))

    lines = stage["line_dedup"](spark, kept, folder)
    assert lines.columns == table.columns
    got = {(r.doc_id, r.text): r.n_chars for r in lines.collect()}
    for i, t in texts.items():
        want = t + "\n" + shared if i == 6 else t
        assert got[i, want] == len(want), i

    near = stage["simhash_near_dedup"](spark, lines, folder)
    assert near.columns == table.columns
    ids = [r.doc_id for r in near.collect()]
    assert 9 in ids and 100 not in ids and 101 not in ids and ids.count(7) == 1

    clean = stage["benchmark_decontamination"](spark, near, folder)
    assert clean.columns == table.columns
    assert sorted(set(ids) - {r.doc_id for r in clean.collect()}, key=str) == [102]

    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}
    assert sum(r.doc_id == 106 for r in packed) > 10 and all(r.length == len(r.ids) <= 2048 for r in packed)
