"""A training corpus from web documents: language, toxicity, near duplicates, benchmark leaks, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works on all documents that the stage before kept and
returns a DataFrame, which is written as Parquet and read again for the next one. All stages but the last return the
columns of ``documents``. Language, toxicity and benchmark models are fitted on the tables of ``sf_dir`` as they came, so a
stage's decisions on a document don't depend on what other stages removed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlehouse.llm import decontamination, language, neardup, packing, toxicity
from candlehouse.llm.common import checkpoint, held_out, read, small_batches
from candlehouse.session import scratch_path

#: Documents scoring this or more are toxic.
TOXIC = 0.5


def _carried(docs: DataFrame) -> DataFrame:
    """Each document as one ``row`` beside its text, so that no column of it clashes with an operator's; such rows hold texts twice."""
    small_batches(docs.sparkSession)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: texts that are null or without any letter go."""
    apart = held_out(F.col("doc_id"), 4, 2)
    model = language.fit(read(spark, sf_dir, "documents"), ~apart)
    found = language.identify(_carried(docs), model, ["row"])
    return found.where(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    apart = held_out(F.col("doc_id"), 5, 0)
    machine = toxicity.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ~apart)
    return toxicity.score(_carried(docs), machine, ["row"]).where(F.col("score") < TOXIC).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the one with the smallest id.

    Rows that repeat id and text are one document, of which one row stays. Rows that share an id but not the text are documents of
    their own, behind the others of a group: a row goes only if its own text, or a near copy, stays. Rows without an id are kept.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", F.col("doc_id").cast("bigint").alias("key"))
    without, whole = whole.where("key is null"), whole.where("key is not null")
    content = F.xxhash64("text", F.isnull("text"))
    several = checkpoint(whole.groupBy("key").agg(F.min(content).alias("least"), F.max(content).alias("most"))
                         .where("least <> most").select("key"))
    if not several.isEmpty():
        own = F.lit(1 << 62) + F.pmod(F.xxhash64("key", content), F.lit(1 << 61))
        whole = whole.join(several.withColumn("shared", F.lit(True)), "key", "left")
        whole = whole.withColumn("key", F.when(F.col("shared"), own).otherwise(F.col("key"))).drop("shared")
    found = neardup.near_duplicates(whole.select(F.col("key").alias("doc_id"), "text"), n=5, percent=80)
    stay = checkpoint(found.groupBy(F.col("doc_id").alias("key")).agg(F.bool_and("kept").alias("stays")).where("stays").select("key"))
    # rows move once: dropDuplicates finds them dealt and sorted by the join
    once = whole.select("row", "key").join(stay, "key", "left_semi").dropDuplicates(["key"])
    return once.select("row.*").unionByName(without.select("row.*"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Rows without an id are judged by their text."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    without = keyed.where("doc_id is null and text is not null").select(F.xxhash64("text").alias("doc_id"), "text")
    items = read(spark, sf_dir, "benchmark")
    leaks = decontamination.matches(keyed, items).select("doc_id").distinct()
    clean = docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
    if without.isEmpty():
        return clean
    bad = decontamination.matches(without, items).select(F.col("doc_id").alias("content")).distinct()
    rows = clean.withColumn("__content", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    return rows.join(bad, rows["__content"] == bad["content"], "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_languages),
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: The stages run models and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
