"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlehouse.llm import (
    conversation_trie, decontamination, html_text, language, lexical, neardup, packing, quality, sentencepiece_bpe, sharding, topk, toxicity,
    url_filter,
)
from candlehouse.llm.common import held_out, read

SHARDS = 40
RULES = [
    url_filter.Rule("allow", "org"), url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"), url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), RULES)
            .select("page_id", "host", "path", "rule", "verdict"))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = read(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0)
    net = quality.fit(docs, read(spark, sf_dir, "labels"), ~apart)
    return quality.score(docs, net, ["doc_id"]).select(
        "doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    return topk.top_k(vectors, F.col("id") % 20 == 0, 20)


def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = read(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 4, 2)
    return language.identify(docs, language.fit(docs, ~apart), ["doc_id"]).select(
        "doc_id", apart.alias("held_out"), "lang_pred", "score")


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def neardup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), n=3, percent=85)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = read(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0)
    machine = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~apart)
    return toxicity.score(docs, machine, ["doc_id"]).select(
        "doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def lexical_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), 50)


def sentencepiece_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepiece_bpe.encode(read(spark, sf_dir, "documents"), model, ["doc_id"])
    encoded = encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                             F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"))
    decoded = sentencepiece_bpe.decode(encoded, model, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(read(spark, sf_dir, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


QUERIES = {
    "op1_feistel_sharding": sharding_query,
    "op2_pu_quality": quality_query,
    "op3_norm_sorted_topk": topk_query,
    "op4_wrapper_induction": html_query,
    "op5_simhash_decontamination": decontamination_query,
    "op6_language_mixture": language_query,
    "op7_bottom_k_neardup": neardup_query,
    "op8_toxicity_fm": toxicity_query,
    "op9_url_filter": url_filter_query,
    "op10_pattern_packing": packing_query,
    "op11_accumulator_search": lexical_query,
    "op12_sentencepiece": sentencepiece_query,
    "op13_conversation_trie": trie_query,
}
