"""Small documents for the tests: prose with copies and repeats, and awkward rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns that operators use inside must not clash with those of the input.
EXTRA = ("id", "tie", "hash", "words", "lines", "_text", "_page", "score", "shard", "fp", "quality", "_fact_id")
SCHEMA = "doc_id long, text string, " + ", ".join(f"`{name}` string" for name in EXTRA)


def prose(random_: random.Random, words: int) -> str:
    pool = ["der", "of", "the", "la", "naïve", "größe", "plain", "river", "stone", "walks", "It's", "x2"]
    made = ["".join(random_.choice("abcdefghijklmnop") for _ in range(random_.randint(2, 9))) for _ in range(400)]
    return " ".join(random_.choice(pool if random_.random() < 0.3 else made) for _ in range(words)) + "."


def corpus() -> list[tuple[int | None, str | None]]:
    """Texts with exact and near copies, shared passages, ties, nulls, empty and long ones."""
    r = random.Random(5)
    passage = prose(r, 70)
    texts: list[str | None] = [prose(r, r.randint(3, 160)) for _ in range(40)]
    texts += [texts[3], texts[3], texts[4], texts[4].replace("the", "THE", 1)]
    texts += [f"{prose(r, 30)} {passage}\n{prose(r, 10)}", f"{passage} {prose(r, 40)}", f"{prose(r, 5)}\t{passage}"]
    texts += [f"{passage} {passage}", "a b c " * 120, "x" * 900, "é" * 500, "é ﬁ İ ΣΑΣ 日本語 テスト。 <|endoftext|>"]
    texts += ["", "   \n\t ", "one", None, None, prose(r, 6000)]
    rows: list[tuple[int | None, str | None]] = [(i * 3, text) for i, text in enumerate(texts)]
    return [*rows, rows[2], rows[2], (None, texts[7]), (None, None)]


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """Documents with the further columns."""
    return spark.createDataFrame([(*row, *["z"] * len(EXTRA)) for row in rows], SCHEMA).repartition(3)


def save(spark: SparkSession, folder, **tables: DataFrame) -> str:
    """Write tables as a query reads them."""
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
