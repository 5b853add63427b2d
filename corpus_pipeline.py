"""From raw documents to token ids: the stages of a training corpus, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import decontaminate, sentencepiece_codec, simhash, substring_dedup, toxicity
from feedloom.llm.common import stage, table
from feedloom.llm.queries import MODEL

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    docs = docs.select(*COLUMNS)
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs.select(*COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut from later ones."""
    return substring_dedup.dedup_texts(docs.select(*COLUMNS))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark windows are cut."""
    return decontaminate.remove_spans(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of the texts."""
    return sentencepiece_codec.encode_texts(docs, MODEL)


STAGES = [
    ("toxicity", drop_toxic), ("near-duplicates", drop_near_copies), ("substring-dedup", drop_repeated_passages),
    ("decontamination", drop_benchmark_passages), ("sentencepiece", encode),
]

#: SQL has neither the classifier nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
