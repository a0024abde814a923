"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.llm import bpe, brown, divergence, huffman, lines, neighbours, outliers, packing, pii, simhash, topk, toxicity, trie
from tallygrid.llm.storage import Scratch, import_on_workers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    import_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Stands for a secret; users pass their own.
KEY = "key of the registered query"


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(documents(spark, sf_dir), KEY).select("doc_id", "text", "n_found")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, places = packing.pieces_and_places(documents(spark, sf_dir), WORD_BPE)
    digests = pieces.select("piece_key", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digests.join(places, "piece_key").drop("piece_key")


def op3_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encoded(documents(spark, sf_dir), BYTE_BPE))


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(documents(spark, sf_dir)).select("doc_id", "text", "n_dropped")


def op5_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scored(documents(spark, sf_dir))


def op6_huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = huffman.write_corpus(documents(spark, sf_dir), BYTE_BPE)
    read = huffman.read_corpus(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "outliers")
    judged = outliers.judged(documents(spark, sf_dir), scratch)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *[f"counts.{name}" for name in counts], outliers.base_failed().alias("base_failed"), "kept", "distance"
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    classifier = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.scored(docs, classifier)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted, "threshold", "flagged")


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    import_on_workers(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    import_on_workers(spark)
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    import_on_workers(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    return {
        "op9_robust_outliers": (op9_robust_outliers, None),
        "op8_toxicity": (op8_toxicity, None),
        "op7_simhash": (op7_simhash, None),
        "op1_feistel_pseudonyms": (op1_feistel_pseudonyms, None),
        "op4_fuzzy_lines": (op4_fuzzy_lines, None),
        "op5_brown_classes": (op5_brown_classes, None),
        "op3_chunk_reuse_bpe": (op3_chunk_reuse_bpe, None),
        "op10_nn_descent": (op10_nn_descent, None),
        "op6_huffman_files": (op6_huffman_files, None),
        "op2_best_fit_packing": (op2_best_fit_packing, None),
        "op11_prefix_trie": (op11_prefix_trie, trie.SQL),
        "op12_term_at_a_time": (op12_term_at_a_time, topk.SQL),
        "op13_source_divergence": (op13_source_divergence, divergence.SQL),
    }
