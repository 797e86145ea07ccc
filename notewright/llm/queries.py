"""The registered queries of this folder and, where SQL can express them, the SQL they are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from notewright.llm import (
    chat, decontaminate, jaccard, lm, packing, phrases, quality, repair, secrets, sharding, simhash, suffix, toxicity,
)
from notewright.llm.base import fold, table
from notewright.llm.oracles import OP12, OP13

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {"op12_phrase_graph": OP12, "op13_adaptive_jaccard": OP13}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.vocabulary(), capacity=2048)


@query
def op2_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.balanced_shards(table(spark, sf_dir, "documents"), n_shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3)
    return found.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op5_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False))
    scored = lm.train(docs.where(~held_out)).score(docs)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    said = r"\### Assistant: </turn> ok"
    marks = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select(*columns).unionByName(marks)
    return chat.read_back(chat.format_windows(rows))


@query
def op7_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = secrets.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.filter("_spans", lambda s: s.startswith(kind + ":"))
    base = F.filter("_spans", lambda s: ~s.startswith("novel:"))
    return marked.withColumn("_spans", F.array_remove(F.split("spans", ","), "")).select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"),
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in ("assign", "access", "hex", "novel")],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


@query
def op8_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    entries, weights = toxicity.train(docs, labels.where(~held_out))
    scored = toxicity.with_toxicity(docs, entries, weights)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality.quality_rules(docs.select("doc_id", "text"), labels)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    return found.select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"), *[F.col(f"quality.{c}").alias(c) for c in names]
    )


@query
def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(table(spark, sf_dir, "conversations"))


@query
def op12_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


@query
def op13_adaptive_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
