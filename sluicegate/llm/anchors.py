"""Anchors: places chosen by content, at which equal stretches of different texts meet.

In every window of a text the unit (a short run of words or bytes) of the least hash is its anchor.  Equal windows have
equal anchors, and neighbouring windows mostly share theirs, so a few anchors stand for all windows
and only windows whose anchor occurs again can be repeated.

A row is known by its id and a hash of its text; rows equal in both are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.frames import covered, stored


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``tie`` and ``text``; null texts are empty."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """For each start the place of the least of ``width`` values, the leftmost of equals."""
    count = len(values) - width + 1
    if count <= 0:
        return np.empty(0, np.int64)
    place = np.arange(len(values))
    best = values
    span = 1

    def merged(place, best, shift):
        left, right = best[:-shift], best[shift:]
        take = left <= right
        return np.where(take, place[:-shift], place[shift:]), np.where(take, left, right)

    while span * 2 <= width:
        place, best = merged(place, best, span)
        span *= 2
    if span < width:
        place, best = merged(place, best, width - span)
    return place[:count]


PLACE_BITS = 26


def least_hash_in_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """``least_in_windows`` for 64-bit hashes, told apart by their high bits.

    A hash and its place make one number, so that a step is a single minimum.  Where hashes agree in all but
    their last bits the leftmost counts, in equal windows the same one.
    """
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.int64)
    bits = np.uint64(max(PLACE_BITS, len(hashes).bit_length()))
    best = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[: span - width], best[width - span :])
    return (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def whole_windows(first: np.ndarray, units: int, window: int) -> np.ndarray:
    """Starts of the windows that lie within one text."""
    inside = np.zeros(units + 1, np.int64)
    begin, end = first[:-1], np.maximum(first[:-1], first[1:] - window + 1)
    np.add.at(inside, begin, 1)
    np.add.at(inside, end, -1)
    return np.flatnonzero(np.cumsum(inside)[:units] > 0)


def repeated(rows: DataFrame, label: str) -> DataFrame:
    """Per document, the anchors (``pos``) whose ``hash`` occurs at least twice.

    Rows of a hash stand next to each other after a sort and stream past; none is held but
    the last one.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None
        told = False  # whether the last row has been given out
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            values = batch.column("hash").to_numpy()
            same = values[1:] == values[:-1]
            again = np.zeros(len(values), bool)
            again[1:] |= same
            again[:-1] |= same
            told_now = bool(again[-1])
            if last is not None and told:
                again[0] = False
            yield batch.filter(pa.array(again)).select(["id", "tie", "pos"])
            last = batch.slice(batch.num_rows - 1)
            # A lone last row may still find a partner in the next batch.
            told = told_now

    found = (
        rows.repartition("hash")
        .sortWithinPartitions("hash")
        .mapInArrow(run, f"id {kind}, tie long, pos int")
    )
    # Equal rows send equal anchors, which are one place.
    return stored(found.groupBy("id", "tie").agg(F.collect_set("pos").alias("places")), label)


def joined(texts: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """Texts with what is known about them.  The facts are the smaller side and are hashed."""
    facts = facts.withColumnsRenamed({"id": "_id", "tie": "_tie"}).hint("shuffle_hash")
    match = (F.col("tie") == F.col("_tie")) & F.col("id").eqNullSafe(F.col("_id"))
    return texts.join(facts, match, how).drop("_id", "_tie")


def per_document(
    texts: DataFrame, function: Callable[[bytes, tuple[np.ndarray, np.ndarray]], tuple], columns: str, id_column: str
) -> DataFrame:
    """Apply a function of a text and its spans (``begins``, ``ends``) to every row."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("text").cast(pa.large_binary())
            begins, ends = batch.column("begins"), batch.column("ends")
            rows = [
                function(text.as_py(), spans_of(b.values, e.values))
                for text, b, e in zip(data, begins, ends, strict=True)
            ]
            arrays = [pa.array(list(column)) for column in zip(*rows, strict=True)]
            names = [part.split()[0] for part in columns.split(",")]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], [id_column, *names])

    return texts.select("id", "text", "begins", "ends").mapInArrow(
        run, f"`{id_column}` {kind}, {columns}"
    )


def spans_of(begins, ends) -> tuple[np.ndarray, np.ndarray]:
    """The union of a document's spans, given as lists of lists."""
    if begins is None or not len(begins):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin = begins.flatten().to_numpy().astype(np.int64)
    end = ends.flatten().to_numpy().astype(np.int64)
    order = np.argsort(begin, kind="stable")
    return covered(begin[order], end[order])
