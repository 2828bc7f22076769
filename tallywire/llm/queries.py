"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywire.llm import (
    bin_completion, importance, line_dedup, ngram_quality, piece_codec, sharding, simhash, suffix_dedup,
    token_counts, token_output, topk, toxicity, whitening,
)
from tallywire.llm.common import tables

Query = Callable[[SparkSession, str], DataFrame]
TOKEN_LIMIT = 1024
SHARDS = 8
NEIGHBOURS = 10
DRAWN_PERCENT = 10


def op1_packed_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.packed_matrix(
        tables(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=50256)


def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    out = sharding.shard_by_size(docs, SHARDS, key=crc, tie=F.col("doc_id"), size=size,
                                 columns={"doc_id": F.col("doc_id"), "size": size, "text_crc32": crc})
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "bytes_before")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.count_tokens(tables(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "n_chunks", "n_widened")


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = piece_codec.encode_documents(tables(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    span = F.aggregate(F.arrays_zip("begins", "ends"), F.lit(0).cast("bigint"), lambda a, x: a + x["ends"] - x["begins"])
    return out.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), span.alias("bytes_in_spans"),
    )


def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(tables(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(tables(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, NEIGHBOURS)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(tables(spark, sf_dir, "documents"))
    return out.select(
        F.col("row")["doc_id"].alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("begins").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = bin_completion.token_pieces(tables(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return bin_completion.pack(pieces)


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op9_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_quality.judged(tables(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))
    return out.select(F.col("row")["doc_id"].alias("doc_id"), *ngram_quality.COUNTS, "base_failed", "kept", "score")


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(tables(spark, sf_dir, "documents")).select("doc_id", "text", "n_dropped")


def op11_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.drawn(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark"), DRAWN_PERCENT)
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank", "n_words")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    held_out = lambda i: F.coalesce(F.crc32(i.cast("string").cast("binary")) % 3 == 1, F.lit(False))
    labels = tables(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    out = toxicity.scored(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out(F.col("doc_id"))})
    return out.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op13_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(tables(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_packed_matrix, op2_sampled_splitters, op3_token_counts, op4_piece_codec, op5_simhash_components, op6_exact_top_k,
    op7_suffix_dedup, op8_best_fit_packing, op9_ngram_quality, op10_site_lines,
    op11_importance_draw, op12_toxicity, op13_whitened_embeddings,
)}
ORACLES: dict[str, str] = {"op10_site_lines": line_dedup.ORACLE}
