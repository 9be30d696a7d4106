"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetrics.llm import (
    decontaminate,
    jaccard_join,
    langid,
    line_dedup,
    merkle,
    packing,
    periodic_runs,
    pii,
    sharding,
    simhash,
    substring_dedup,
    topk_search,
    toxicity,
)
from cinemetrics.llm.common import ASCII_SPACE, ascii_lower, id_crc, read_table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def toxicity_training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(id_crc() % 4 != 2)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, toxicity_training_labels(labels))
    scored = toxicity.score_toxicity(docs, lexicon)
    return scored.select("doc_id", (id_crc() % 4 == 2).alias("held_out"), "score", "predicted")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_equal", "item_words", "doc_word")


def language_training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(id_crc() % 5 != 0)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(language_training_rows(docs))
    scored = langid.identify(docs, model)
    return scored.select("doc_id", (id_crc() % 5 == 0).alias("held_out"), "lang_pred", "score")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf_dir, "documents"))
    base = [k.name for k in pii.KINDS if k.always]

    def written(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in base]
    kept = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *counts, F.sha2(written(kept), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"))


def periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` with the text of every tenth document (by the crc of its id) made periodic from
    some word on; its words are then joined by one blank."""
    g = F.floor(id_crc() / 10)
    n = F.greatest(F.size("_words"), F.lit(1)).cast("long")
    cut = docs.where(id_crc() % 10 == 0).withColumn("_words", F.filter(F.split("text", f"[{ASCII_SPACE}]+"), lambda w: w != ""))
    cut = cut.withColumn("_a", (g % n).cast("int")).withColumn("_n", n.cast("int"))
    cut = cut.withColumn("_p", (F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8)) + 1).cast("int"))
    period = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    times = F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), F.col("_n") - F.col("_a"))
    made = F.concat(F.slice("_words", F.lit(1), F.col("_a")), tail)
    cut = cut.withColumn("text", F.when(F.size("_words") > 0, F.array_join(made, " ")).otherwise(F.col("text")))
    return docs.where(id_crc() % 10 != 0).unionByName(cut.select(*docs.columns))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(periodic_tails(docs))

    def better(a, b):
        """-1 where run a goes before run b: a greater length/period, then an earlier start, then a shorter period."""
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        tie = F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(
            F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)
        )
        return F.when(left > right, -1).when(left < right, 1).otherwise(tie)

    found = found.withColumn("_best", F.get(F.array_sort("runs", better), F.lit(0)))
    best = [F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.expr("1000 * _best.length div _best.period").alias("exponent_milli")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent,
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    told = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    claimed = F.when(id_crc() % 3 == 0, ascii_lower(text)).otherwise(text)
    rows = docs.select(
        "doc_id", "lang", merkle.leaf_digest(*told, text).alias("leaf"), merkle.leaf_digest(*told, claimed).alias("claimed")
    )
    carry = ("doc_id", "claimed")
    manifest = merkle.build_manifest(rows, "lang", "doc_id", "leaf", carry)
    found = merkle.proofs(manifest, carry).withColumn("folded_root", merkle.fold(F.col("path"), F.col("claimed")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_toxicity": op3_toxicity,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_language_id": op7_language_id,
    "op8_sharding": op8_sharding,
    "op9_pii": op9_pii,
    "op10_exact_topk": op10_exact_topk,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_jaccard_join": op13_jaccard_join,
}

_OP1 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
),
keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
),
common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT y.doc_id, y.line, y.pos, (c.k IS NOT NULL AND y.doc_id <> c.keeper) AS gone
  FROM keyed y LEFT JOIN common c ON c.k = y.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP5 = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0b\\x0c\\r]+'), lambda x: x <> '') AS w
  FROM documents
),
windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)
),
repeats AS (
  SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM windows) WHERE n > 1
),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS places
  FROM (SELECT doc_id, unnest(range(p, p + 20)) AS p FROM repeats) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: places IS NULL OR NOT list_contains(places, i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

# every alignment with enough equal words, without any seeds; short items word for word
_NO_BLANKS = decontaminate.NO_BLANKS
_WORDS = (
    f"list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '({_NO_BLANKS})', ' \\1 ', 'g'), "
    "'[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
)
_OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
bw AS (SELECT item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM b),
equal AS (
  SELECT dw.doc_id, bw.item_id, bw.n, dw.p - bw.p AS start, bw.p
  FROM dw JOIN bw ON bw.word = dw.word
),
dense AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, start ORDER BY p RANGE BETWEEN 12 PRECEDING AND CURRENT ROW) AS near
  FROM equal
),
aligned AS (
  SELECT doc_id, item_id, start, any_value(n) AS n, count(*) AS n_equal
  FROM dense GROUP BY doc_id, item_id, start
  HAVING CASE WHEN any_value(n) >= 13 THEN max(near) >= 11 ELSE count(*) = any_value(n) END
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, start) AS r FROM aligned
)
SELECT doc_id, item_id, n_equal, n AS item_words, start AS doc_word FROM ranked WHERE r = 1
"""

_OP10 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r
  WHERE q.vec_id % 20 = 0
)
SELECT * EXCLUDE (r) FROM (
  SELECT r, query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
) WHERE rank <= 20
"""

# crc32 of a number written in decimal, bit by bit
_CRC = """(xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
  list_transform(range(1, length({0}::VARCHAR) + 1), lambda k: ascii(substr({0}::VARCHAR, k, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(0, 8)),
    lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))))"""

# every pair of equal words of a document, their distances, and stretches of them
_OP11 = f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0b\\x0c\\r]+'), lambda x: x <> '') AS w0,
         len(w0) AS n, {_CRC.format("doc_id")} AS h, h // 10 AS g,
         CASE WHEN n > 0 THEN g % n END AS a, CASE WHEN n > 0 THEN 1 + (n - a) // (3 + g % 8) END AS p
  FROM documents
),
e AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w0[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w0 END AS w
  FROM d
),
word AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM e),
met AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM word x JOIN word y ON y.doc_id = x.doc_id AND y.word = x.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM met)
  GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(24, 3 * q)
),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS r FROM runs)
  WHERE r = 1
),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
),
gone AS (
  SELECT doc_id, list(DISTINCT i) AS places
  FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM runs) GROUP BY doc_id
)
SELECT e.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(array_to_string(list_filter(w, lambda x, i: places IS NULL OR NOT list_contains(places, i - 1)), ' ')) AS collapsed_sha256
FROM e LEFT JOIN told USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN gone USING (doc_id)
"""


def _op12(leaf_levels: int = 8, group_levels: int = 4) -> str:
    """Both trees level by level, far beyond the heights of the tables; the siblings by a join of each run with itself."""

    def enc(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}::VARCHAR), ':', {c}::VARCHAR) END"

    told = ", ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""leaves AS (
  SELECT doc_id, lang, sha256(concat({told}, {enc("text")})) AS leaf,
         sha256(concat({told}, CASE WHEN {_CRC.format("doc_id")} % 3 = 0 THEN {enc(low)} ELSE {enc("text")} END)) AS claimed
  FROM documents
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS i FROM leaves),
a0 AS (SELECT lang AS g, i, count(*) OVER (PARTITION BY lang) AS n, leaf AS digest FROM ranked)"""]

    def tree(t: str, levels: int) -> None:
        for h in range(levels):
            parts.append(f"""{t}s{h} AS (
  SELECT x.g, x.i, coalesce(string_agg(y.digest, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS l,
         coalesce(string_agg(y.digest, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS r
  FROM {t}{h} x JOIN {t}{h} y ON y.g IS NOT DISTINCT FROM x.g AND y.i // 8 = x.i // 8 WHERE x.n > 1 GROUP BY x.g, x.i
),
{t}{h + 1} AS (
  SELECT g, up AS i, (n + 7) // 8 AS n,
         CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE any_value(digest) END AS digest
  FROM (SELECT *, i // 8 AS up FROM {t}{h}) GROUP BY g, up, n
)""")

    tree("a", leaf_levels)
    parts.append(f"""b0 AS (
  SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n, digest, g AS lang FROM a{leaf_levels}
)""")
    tree("b", group_levels)
    parts.append(f"c0 AS (SELECT r.doc_id, r.lang, r.leaf, r.i, b0.i AS gi, b0.digest AS subroot, '' AS proof, r.claimed AS node FROM ranked r JOIN b0 ON b0.lang IS NOT DISTINCT FROM r.lang)")
    step = 0
    for t, key, at, levels in (("a", "c.lang", "c.i", leaf_levels), ("b", "0", "c.gi", group_levels)):
        for h in range(levels):
            parts.append(f"""c{step + 1} AS (
  SELECT c.* REPLACE (concat(proof, l, r) AS proof, CASE WHEN l IS NULL THEN node ELSE sha256(concat(l, node, r)) END AS node)
  FROM c{step} c LEFT JOIN {t}s{h} s ON s.g IS NOT DISTINCT FROM {key} AND s.i = {at} // {8 ** h}
)""")
            step += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = digest AS verified
FROM c{step} JOIN b{group_levels} ON true
"""


# every pair of documents with a common shingle; n_links as the operator gives it
_OP13 = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[ \\t\\n\\x0b\\x0c\\r]+'), lambda x: x <> '') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS k
    FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id,
       (SELECT count(*) FROM link WHERE link.a = d.doc_id) AS n_links
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
"""


ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": _OP1,
    "op5_substring_dedup": _OP5,
    "op6_benchmark_decontamination": _OP6,
    "op10_exact_topk": _OP10,
    "op11_periodic_runs": _OP11,
    "op12_merkle_manifest": _op12(),
    "op13_jaccard_join": _OP13,
}
