"""The registered queries of the numbered operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm import bpe, conversation_trie, huffman, line_dedup, line_quality, mixing, packing, partenum, pii, quality_gbt, sketch, substring, whitening
from starlane.llm.common import documents, with_package


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_gbt.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gbt.scored(docs, model)


def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(spark, documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.join(spark, documents(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")).drop("tag")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.found(docs, pii.train(spark, docs))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.deduplicated(spark, documents(spark, sf_dir)))


def op7_document_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.against_next(spark, documents(spark, sf_dir))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.deduplicated(spark, documents(spark, sf_dir).select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return rows.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), kept)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality_rules(documents(spark, sf_dir))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.round_trip(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    f.__name__: with_package(f)
    for f in (
        op1_quality_gbt,
        op2_huffman_ids,
        op3_ngram_jaccard_join,
        op4_best_fit_packing,
        op5_personal_data,
        op6_substring_dedup,
        op7_document_sketch,
        op8_source_mixing,
        op9_line_dedup,
        op10_quality_rules,
        op11_bpe_codec,
        op12_conversation_trie,
        op13_embedding_whitening,
    )
}
