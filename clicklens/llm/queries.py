"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm import (decontaminate, jaccard, licenses, lm, minhash, periods, pieces, quality, repeats, secrets, spans, sql,
                            toxicity, trie)
from clicklens.llm.exchange import documents


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spans.dedup_spans(documents(spark, sf_dir), whole=True)
    return out.select("doc_id", "n_sentences", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                      F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256"))


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup_bytes(documents(spark, sf_dir)).drop("removed")


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir)).drop("found", "text_key")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir), unnamed=True)


def op5_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op6_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return licenses.scan(docs, licenses.train(docs))


def op7_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


def op9_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir), with_ids=False)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(periods.find_runs(periods.with_loops(documents(spark, sf_dir))))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("n_chars")


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def oracle_sql() -> dict[str, str]:
    return {"op3_secret_ownership": sql.SECRETS, "op7_prefix_decontamination": sql.DECONTAMINATION,
            "op12_prefix_trie": sql.TRIE, "op4_jaccard_join": sql.similar_sets(3, 90),
            "op13_minhash_dedup": sql.similar_sets(2, 80, ", doc_id = component_id AS kept")}
