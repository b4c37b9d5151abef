"""Corpus pipeline: five filters and transforms over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows it is given and
returns the columns of documents (the last returns the encoding). ``run``
writes each stage's result as Parquet in the shared checkpoint folder and reads
it back for the next, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm import decontaminate, jaccard, pieces, secrets, toxicity
from clicklens.llm.exchange import documents, stored

NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go. Null and empty texts get the model's base
    score and stay unless most labelled texts are toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8 or
    more, by links) the document with the smallest id stays. Rows without doc_id take
    part behind all others, under a number from their text's hash. Repeated rows are
    one document and stay or go together, as do all rows of one doc_id."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**62) + F.pmod(F.xxhash64("text"), F.lit(2**61)))
    groups = jaccard.jaccard_components(docs.select(number.alias("doc_id"), "text"), NEAR_WORDS, NEAR_PERCENT)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, number == F.col("gone_id"), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an occurrence of a benchmark window go; rows of one doc_id by
    their own texts, rows without doc_id too. Null and empty texts stay."""
    found = decontaminate.occurrences(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.with_found(docs, found.select("doc_id", "text_key").distinct(), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays, repeated rows too, and
    a null text stays null."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: the pieces' ids; a null text has none."""
    return pieces.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece_encoding", encode),
]
ORACLE_SQL = None  # trained toxicity scores cannot be written as SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
