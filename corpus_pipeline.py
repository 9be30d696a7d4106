"""A training-data pipeline over ``documents``: five stages, each one operator over all rows
that the stage before it kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents, extra
ones too, whatever their names. An empty table goes through as an empty one. Rows that repeat
a doc_id are rows of their own unless a stage says otherwise; null doc_ids stay null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinemetrics.llm import decontaminate, langid, line_dedup, packing, simhash
from cinemetrics.llm.common import read_table
from cinemetrics.llm.queries import language_training_rows, tokenizer_path
from cinemetrics.session import scratch_path

MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language stays open go: null and empty texts and others without a letter, those
    with no language ahead, and those unlike the training texts of the best language.

    Fitted on this stage's own input, on the rows that the query of the operator learns from.
    """
    model = langid.fit(language_training_rows(docs))
    return langid.reject_unknown(docs, model, MIN_LANGUAGE_SCORE)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share are cut out of the texts; n_chars follows the new text.

    A null text becomes an empty one. A shared line stays in the document with the largest id; of
    rows that repeat that id, in each. A text of shared lines only becomes empty and stays.
    """
    kept = line_dedup.line_dedup(docs)
    n_chars = F.when(kept["n_dropped"] > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id.

    Empty texts are one group. Of rows that repeat the kept id the smallest text stays; in a
    group without any id one row of each fingerprint.
    """
    return simhash.simhash_dedup(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; of rows that repeat an id only those whose
    text does. Empty texts and empty benchmark items hold nothing."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, each with its place in a sequence and its token ids. An empty
    text is one piece with the separator alone."""
    return packing.pack_documents(docs, tokenizer_path(), include_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", shared_lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_overlap),
    ("best_fit_packing", packed_sequences),
]

# the fingerprints (XXH64 of shingles) and the token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if n == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
