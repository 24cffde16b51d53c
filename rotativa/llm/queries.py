"""The checked queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotativa.llm import chat_tree, cover_tree, golay, hnsw, line_dedup, lockstep, mixing, prefix_counts, quality, randomness, runs, toxicity, unigram

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op10_mixing", mixing.ORACLE)
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sizes = mixing.document_sizes(table(spark, folder, "documents"))
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return unigram.encode_texts(table(spark, folder, "documents"), ("doc_id",))


@query("op8_quality")
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, folder, "labels")))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_counts.token_counts(table(spark, folder, "documents"), ("doc_id",))


@query("op5_simhash_golay")
def op5_simhash_golay(spark: SparkSession, folder: str) -> DataFrame:
    return golay.near_duplicates(table(spark, folder, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, folder, "labels")))


@query("op7_hnsw")
def op7_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.nearest(table(spark, folder, "embeddings"), "vec_id", "embedding", every=50)


@query("op3_cover_tree")
def op3_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, folder, "embeddings"), "vec_id", "embedding")


@query("op4_chat_tree")
def op4_chat_tree(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_tree.read_back(chat_tree.format_conversations(turns))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.without_repeats(table(spark, folder, "documents")).select(
        "doc.doc_id", "n_lines", "n_dropped", "text"
    )


@query("op13_word_runs")
def op13_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", runs.planted(F.col("text"), F.col("doc_id")).alias("text"))
    return runs.run_digests(runs.word_runs(docs, ("doc_id",)))


@query("op12_lockstep")
def op12_lockstep(spark: SparkSession, folder: str) -> DataFrame:
    return lockstep.counted_alignments(table(spark, folder, "documents"), ("doc_id",))


@query("op11_secret_scan", randomness.ORACLE)
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return randomness.span_digests(randomness.secret_spans(table(spark, folder, "documents"), ("doc_id",)))
