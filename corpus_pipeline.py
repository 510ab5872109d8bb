"""A training corpus from raw documents, in stages that are stored one after another.

Each stage works on all that the one before it kept and, but for the last, returns the columns of
the documents.  Documents are known by ``doc_id``.  Null ids, null, empty and very long texts, repeated
rows, empty tables and further columns are treated as the operators state; further columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import decontaminate, packing, quality, simhash, suffixes
from sluicegate.llm.frames import passing, stored, table
from sluicegate.llm.queries import TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _fresh(docs: DataFrame, stem: str) -> str:
    """A column name that the documents do not have."""
    while stem in docs.columns:
        stem += "_"
    return stem


def _by_id(docs: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """Join documents with facts about their ids; a null id meets a null id."""
    key = _fresh(docs, "_fact_id")
    facts = facts.withColumnRenamed("doc_id", key)
    return docs.join(facts, docs["doc_id"].eqNullSafe(facts[key]), how).drop(key)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain limits and that the rules' votes call good.

    Of rows that share an id all go if any of them is rejected.
    """
    judged = quality.judge(docs)
    rejected = judged.where(F.col("base_failed") | ~F.col("good")).select("doc_id").distinct()
    return _by_id(docs, rejected, "left_anti")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of every component of near-duplicates.

    Fingerprints of 3-word shingles link at 2 or fewer differing bits.  Rows that share that id and fingerprint
    stay together.
    """
    placed = simhash.near_duplicates(docs, shingle=3, radius=2)
    dropped = placed.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return _by_id(docs, dropped, "left_anti")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur again, cut at whole characters."""
    text = _fresh(docs, "_kept_text")
    cut = suffixes.deduplicate(docs).where("n_removed > 0").select("doc_id", F.col("text").alias(text))
    # Rows that share an id keep what each of them has left, the longest first among equals.
    cut = cut.groupBy("doc_id").agg(F.max(text).alias(text))
    kept = F.when(F.col(text).isNotNull(), F.col(text)).otherwise(F.col("text"))
    return (
        _by_id(docs, cut, "left")
        .withColumn("text", kept)
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*docs.columns)
    )


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or with up to a fifth of its words edited."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return _by_id(docs, leaks.select("doc_id").distinct(), "left_anti")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # What a stage stores on its way goes when its own result is written.
        with passing(spark):
            docs = stored(stage(spark, docs, sf_dir), name, keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
