"""Line dedup: lines that many documents share are dropped from all but one of them.

Lines are exploded, normalised and hashed (128 bits); the number of distinct documents per
hash is counted; lines over the threshold go, and each text is put together again from the
positions that stay. Only hashes and positions are shuffled for the decision. A line held
by a third of all documents is combined in every map task before its count is shuffled, and
the join back to the lines is a plain equi-join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import ASCII_SPACE, ascii_lower, hash128, text_or_empty, unused

MIN_CHARS = 40
MIN_DOCS = 5


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(_id, _t1, _t2, _drop): per document that loses lines, the positions it loses.

    A document is named by its id and the hash of its text, so rows that repeat an id with
    another text keep their own positions.
    """
    t1, t2 = hash128(F.col("_text"))
    lines = docs.select(F.col("doc_id").alias("_id"), text_or_empty().alias("_text")).select(
        "_id",
        t1.alias("_t1"),
        t2.alias("_t2"),
        F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"),
    )
    key = ascii_lower(F.btrim("_line", F.lit(ASCII_SPACE)))
    keys = lines.select("_id", "_t1", "_t2", "_pos", key.alias("_key")).where(F.char_length("_key") >= min_chars)
    h1, h2 = hash128(F.col("_key"))
    keys = keys.select("_id", "_t1", "_t2", "_pos", h1.alias("_h1"), h2.alias("_h2"))
    common = (
        keys.select("_h1", "_h2", F.struct("_id").alias("_doc"))
        .distinct()
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_doc").alias("_keeper"))
        .where(F.col("_docs") >= min_docs)
        .select(F.col("_h1").alias("_c1"), F.col("_h2").alias("_c2"), F.col("_keeper._id").alias("_keeper"))
    )
    # joined on one of the two hashes: both sides are then shuffled for the join itself, and
    # adaptive execution can split a line that a third of the documents hold
    same = (F.col("_h1") == F.col("_c1")) & (F.col("_h2").bitwiseXOR(F.col("_c2")) == 0)
    return (
        keys.join(common, same)
        .where(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_t1", "_t2")
        .agg(F.collect_set("_pos").alias("_drop"))
    )


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with shared lines taken out of ``text``,
    plus ``n_lines`` (before) and ``n_dropped``.

    Lines end at ``\\n``; a line's key is the line without blanks at both ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose all
    their lines except in the largest doc_id that holds them.

    Null text: one empty line. Empty table: empty result. Rows with a null doc_id count
    together as one document with an id below all others. Rows that repeat a doc_id count as
    one document and each keeps its own row. A column called n_lines or n_dropped is replaced.
    """
    drops = dropped_lines(docs, min_chars, min_docs)
    t1, t2 = hash128(text_or_empty(docs["text"]))
    joined = docs.join(
        drops, docs["doc_id"].eqNullSafe(drops["_id"]) & (t1 == drops["_t1"]) & (t2 == drops["_t2"]), "left"
    )
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    split, drop = unused(docs, "_lines"), unused(docs, "_drop")
    lines = joined.select(
        *[docs[f"`{c}`"] for c in others], F.split(text_or_empty(docs["text"]), "\n", -1).alias(split), drops["_drop"].alias(drop)
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(drop))
    kept = F.when(F.col(drop).isNull(), F.col(split)).otherwise(F.transform(stay, lambda i: F.get(F.col(split), i)))
    return lines.select(
        *[F.col(f"`{c}`") for c in others],
        F.array_join(kept, "\n").alias("text"),
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"),
    )
