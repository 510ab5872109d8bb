"""One row per key, and how many rows it stands for."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions import Rule, passes_all

_RANK = "_rank_in_key"

# Columns of ``latest_and_counts`` beside the key's.
LATEST = "latest"
KEPT = "kept"
N_ROWS = "row_count"


@dataclass(frozen=True)
class Order:
    """A sort direction; nulls come last when descending and first when ascending."""

    column: str
    descending: bool = False

    def column_order(self) -> Column:
        value = F.col(self.column)
        return value.desc_nulls_last() if self.descending else value.asc_nulls_first()

    def rank(self, kind: T.DataType) -> Column:
        """A value that is least for the row that comes first, for types that can be turned round."""
        value = F.col(self.column)
        if not self.descending:
            return value
        if isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, T.DateType):
            value = F.unix_date(value)
        elif not isinstance(kind, T.IntegralType):
            raise ValueError(f"{self.column}: no descending rank of {kind.simpleString()}")
        return F.struct(value.isNull().alias("none"), F.bitwise_not(value).alias("least"))


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """The first row of each key under ``order``.

    Rows that agree on every ordering column are interchangeable, so ``order`` should
    end in enough columns to make the choice repeatable.

    Spark limits each key to its best row inside every map task before it shuffles
    (``WindowGroupLimit``, partial).  However hot a key is, it sends at most one row per
    map task to the task that decides, so no salting is needed.
    """
    best_first = Window.partitionBy(*key).orderBy(*(o.column_order() for o in order))
    ranked = rows.withColumn(_RANK, F.row_number().over(best_first))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_and_counts(
    rows: DataFrame,
    rules: Sequence[Rule],
    key: Sequence[str],
    order: Sequence[Order] = (),
    columns: Sequence[str] = (),
) -> DataFrame:
    """One row per key of the rows that pass, and one for all that fail, with their number ``row_count``.

    ``kept`` tells them apart.  Given an order, ``latest`` holds ``columns`` of the row that ``latest_per_key`` keeps.
    One exchange by key thus yields the latest rows and every count of the run: tasks reduce their own rows
    of a key to one first, however hot it is, and the rejected ones of all keys to a single one.
    """
    passed = F.col(KEPT)
    found = [F.count("*").alias(N_ROWS)]
    if order:
        ranks = (o.rank(rows.schema[o.column].dataType).alias(f"r{at}") for at, o in enumerate(order))
        row = F.when(passed, F.struct(*columns))
        found.append(F.min_by(row, F.when(passed, F.struct(*ranks))).alias(LATEST))
    return (
        rows.withColumn(KEPT, passes_all(rules))
        .groupBy(*(F.when(passed, F.col(k)).alias(k) for k in key), KEPT)
        .agg(*found)
    )
