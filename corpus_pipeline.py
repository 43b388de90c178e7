"""Corpus pipeline: the stages a document table passes on its way to token ids.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` applies them to ``documents``, writing each stage's rows as Parquet in the
shared folder and rereading them as the next stage's input.

Odd rows. Null, empty and wordless texts go through every stage: the classifier scores them by its
intercept, line dedup leaves them, they link with nothing, mixing takes nothing of them. Rows
with a null doc_id are judged by their text. Repeated rows are scored and cleaned alike; of linked
rows, repeated ones included, one stays. Very long texts are rows like any other. Columns besides
``COLUMNS`` don't leave the second stage. Empty tables pass as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import bpe, line_dedup, mixing, ngram_join, quality, textkit

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, textkit.read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sources go, but for one occurrence."""
    return (line_dedup.clean_lines(docs.select(*COLUMNS))
            .withColumn("text", F.col("kept_text"))
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
                        .otherwise(F.col("n_chars"))).select(*COLUMNS))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 75 % of their word 5-grams one stays."""
    return ngram_join.keep_one(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is cut to, or repeated up to, its budget of words."""
    return mixing.mix(docs.select(*COLUMNS))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: their number and digest, and the digest of what they decode to."""
    return bpe.digests(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", token_stage),
]

#: the classifier's and the tokenizer's rows can't be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = textkit.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = textkit.stored(stage(spark, out, sf_dir), "stage")
    return out
