"""The corpus pipeline: quality rules, line dedup, near-dedup, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns what it kept, with the columns of ``docs``; the last returns
the places of the documents' tokens in sequences. Between stages the documents are written as
Parquet, so a lost executor costs one stage at most and no stage is computed twice.
Columns are found by name, others pass through, and a NULL id is an id that no other document has.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywire.llm import bin_completion, line_dedup, ngram_quality, simhash, suffix_dedup
from tallywire.llm.queries import trusted_ids
from tallywire.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or score below the threshold go."""
    return ngram_quality.judged(docs, trusted_ids(spark, sf_dir)).filter("kept").select("row.*")


def line_frequency(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; every document stays."""
    out = line_dedup.drop_boilerplate(docs, count_column=None).select(F.struct("*").alias("row"))
    return out.select(_columns(docs, "row", F.col("row")["text"]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that fingerprints link the one with the smallest id stays, once.

    Rows of one id and text are one document; rows that share an id with other texts are several. Rows without an id stay.
    """
    key = F.md5(F.concat_ws("\n", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).cast("binary"))
    named = docs.filter("doc_id IS NOT NULL")
    found = simhash.near_components(named.select(F.struct(F.col("doc_id").alias("id"), key.alias("key")).alias("name"), "text"), id_column="name")
    first = found.filter(F.col("name")["key"] == F.col("component_id")["key"]).select(F.col("name")["key"].alias("_first")).distinct()
    own = named.select(F.struct("*").alias("row"), key.alias("_key"))
    kept = own.join(first, F.col("_key") == F.col("_first"), "left_semi").dropDuplicates(["_key"]).select("row.*")
    return kept.unionByName(docs.filter("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that an earlier document already holds go, and what is left of characters cut at an edge."""
    out = suffix_dedup.remove_repeats(docs, as_text=True).select("row", F.col("kept").alias("text"))
    return out.select(_columns(docs, "row", F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = bin_completion.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return bin_completion.pack(pieces)


def _columns(docs: DataFrame, row: str, text: Column) -> list[Column]:
    """The columns of ``docs`` from the struct ``row``, with a new text and its length."""
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length(text), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return [new.get(c, F.col(row)[c]).alias(c) for c in docs.columns]


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_frequency), ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages), ("packing", packing),
]
#: Fingerprints, hashed n-grams and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
