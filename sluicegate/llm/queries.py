"""The operators applied to the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import (
    decontaminate,
    html_text,
    language_model,
    licenses,
    packing,
    prefix_trie,
    quality,
    simhash,
    spelling,
    substrings,
    suffixes,
    token_counts,
    toxicity,
)
from sluicegate.llm.frames import id_remainder, table

TOKENIZER = "word_bpe_49k.json"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly supervised quality of all documents beside the plain limits."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("good")).alias("kept"),
        "quality",
    )


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without 20-word windows that stand earlier."""
    return substrings.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document, with up to a fifth of its words edited."""
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without 200-byte strings that occur again."""
    return suffixes.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from those whose id's remainder is not 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from those whose id's remainder is not 2."""
    held_out = F.coalesce(id_remainder("doc_id", 7) == 2, F.lit(False))
    return language_model.fit_and_score(table(spark, sf_dir, "documents"), ~held_out).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components by fingerprints of 3-word shingles, 2 bits or fewer apart."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License detections of all documents."""
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prefixes of the conversations, each begun with turns of the first of its hundred."""
    own = F.col("conv_id")
    steps = prefix_trie.steps_of(table(spark, sf_dir, "conversations"), own - own % 100)
    taken = F.crc32(F.col("id").cast("string").cast("binary")) % 6
    nodes = prefix_trie.prefix_nodes(prefix_trie.grafted(steps, taken, 5))
    return nodes.withColumnsRenamed({"n_members": "n_convs", "saved": "saved_tokens"})


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent words one edit away that they may stand for."""
    return spelling.variants(table(spark, sf_dir, "documents"), typo_divisor=97)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, and whether there are more than 2048."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


OP2_SQL = r"""
WITH split AS (
  SELECT doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), starts AS (
  SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS i FROM split
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY words[i:i + 19] ORDER BY doc_id, i) AS place FROM starts
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM ranked WHERE place > 1
), each_word AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS i FROM split
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM each_word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express on whole tables.

    The others go through methods it has no terms for (training, walks, trees, suffix order, token
    ids), so tests/llm compares them with plain Python.
    """
    return {"op2_substrings": OP2_SQL}
