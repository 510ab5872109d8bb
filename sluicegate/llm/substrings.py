"""Repeated word windows, removed everywhere but where they stand first.

Level-wise doubling: windows of a quarter of the length are compared first; only windows around those that
are repeated are extended to twice that length, and again, up to the full length.  No longer
window removes a word more, so it ends there, or at the level where nothing is left.

* Quarter windows: of all that a full window holds, its anchor stands for it.  Their hashes are shuffled once.
* Half windows: full windows around a repeated anchor are anchored anew by their half windows.  Each
  is sent with the hashes of the full windows that it anchors.
* Full windows: among equal half windows, in order of id and place, a full window seen before is removed.

A window is told by the hash of its words and of the half window in it, 128 bits together.  Equal half windows stream
past in order, so a task holds the distinct windows of one of them.  Half windows of more than ``FREQUENT`` rows, as around a
passage in a third of all documents, are dealt by full window and a salt, so that no task holds or reads many of them; the
first places of a window's salted groups are then compared.

Null, empty, blank and short texts lose nothing.  Very long texts are handled whole.  Null ids come
first in order.  Rows equal in id and text are one document.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.anchors import (
    joined,
    keyed,
    least_hash_in_windows,
    per_document,
    repeated,
    whole_windows,
)
from sluicegate.llm.frames import (
    chunks,
    covered,
    mix,
    passing,
    stored,
    window_hashes,
    word_hashes,
)

# Rows beyond which a half window is dealt by full window and salt, and how many such half windows there can be: the driver
# sends their hashes to all tasks.
FREQUENT = 10_000
MOST_FREQUENT = 100_000
SALTS = 64
_DEALT = ["key", "salt", "id", "tie", "pos", "back", "full"]


def _quarter_anchors(codes: np.ndarray, first: np.ndarray, window: int):
    """Hash of each quarter window, starts of full windows, and the anchor of each."""
    quarter = window // 4
    hashes = window_hashes(codes, quarter, 1)
    starts = whole_windows(first, len(codes), window)
    return hashes, starts, least_hash_in_windows(hashes, window - quarter + 1)[starts]


def _send_quarters(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                begin, end, first = chunk.words()
                codes = word_hashes(chunk.data, begin, end)
                hashes, _, anchor = _quarter_anchors(codes, first, window)
                anchor = np.unique(anchor)
                text = np.searchsorted(first, anchor, "right") - 1
                rows = pa.array(text + chunk.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[anchor].view(np.int64)),
                        batch.column("id").take(rows),
                        batch.column("tie").take(rows),
                        pa.array((anchor - first[text]).astype(np.int32)),
                    ],
                    ["hash", "id", "tie", "pos"],
                )

    return run


def _send_halves(window: int):
    """Half windows that anchor candidates, each with its full windows: offsets, then hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                begin, end, first = chunk.words()
                codes = word_hashes(chunk.data, begin, end)
                _, starts, anchor = _quarter_anchors(codes, first, window)
                places = batch.column("places")[chunk.rows]
                lengths = np.diff(places.offsets.to_numpy())
                alive = np.zeros(len(codes) + 1, bool)
                alive[places.flatten().to_numpy() + np.repeat(first[:-1], lengths)] = True
                starts = starts[alive[anchor]]
                if not len(starts):
                    continue
                halves = window_hashes(codes, window // 2, 2)
                full = window_hashes(codes, window, 3)[starts]
                anchor = least_hash_in_windows(halves, window // 2 + 1)[starts]
                cut = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
                offsets = pa.array(np.append(cut, len(starts)).astype(np.int32))
                kept = anchor[cut]
                text = np.searchsorted(first, kept, "right") - 1
                rows = pa.array(text + chunk.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(halves[kept].view(np.int64)),
                        batch.column("id").take(rows),
                        batch.column("tie").take(rows),
                        pa.array((kept - first[text]).astype(np.int32)),
                        pa.ListArray.from_arrays(offsets, pa.array((anchor - starts).astype(np.int16))),
                        pa.ListArray.from_arrays(offsets, pa.array(full.view(np.int64))),
                    ],
                    ["hash", "id", "tie", "pos", "back", "full"],
                )

    return run


def _deal(frequent: np.ndarray):
    """Group key of every half window: its hash, or, where that is frequent, one for each full window and a salt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = np.isin(batch.column("hash").to_numpy(), frequent)
            few = batch.filter(pa.array(~many))
            keys, none = few.column("hash"), pa.array(np.full(few.num_rows, -1, np.int32))
            yield pa.RecordBatch.from_arrays([keys, none, *few.columns[1:-1]], _DEALT)
            rest = batch.filter(pa.array(many))
            if not rest.num_rows:
                continue
            lists = rest.column("full").offsets.to_numpy()
            full = rest.column("full").flatten().to_numpy()
            row = np.repeat(np.arange(rest.num_rows), np.diff(lists))
            key = mix(rest.column("hash").to_numpy()[row].view(np.uint64) + mix(full.view(np.uint64)))
            each = pa.array(np.arange(len(row) + 1, dtype=np.int32))
            take = pa.array(row)
            back = rest.column("back").flatten()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    rest.column("salt").take(take),
                    *(rest.column(c).take(take) for c in ("id", "tie", "pos")),
                    pa.ListArray.from_arrays(each, back),
                    pa.ListArray.from_arrays(each, pa.array(full)),
                ],
                _DEALT,
            )

    return run


def _without_repeats(batch: pa.RecordBatch, last: tuple | None) -> tuple[pa.RecordBatch, tuple | None]:
    """Leave out rows that are the row before them again, which one document in several rows sends."""
    names = ["key", "id", "tie", "pos"]
    same = np.ones(batch.num_rows, bool)
    for name in names:
        codes = batch.column(name).dictionary_encode(null_encoding="encode").indices.to_numpy()
        same[1:] &= codes[1:] == codes[:-1]
    same[0] = last == tuple(batch.column(name)[0].as_py() for name in names)
    end = batch.num_rows - 1
    return (
        batch.filter(pa.array(~same)) if same.any() else batch,
        tuple(batch.column(name)[end].as_py() for name in names),
    )


def _later_in_groups(window: int):
    """Spans of the windows that an earlier row of their group has; groups stream past in order.

    Of a frequent window the first place in its salted group comes too, with its key: another group may have an earlier one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = (None, None)
        seen = np.empty(0, np.int64)  # full windows of the group that the last batch ended in
        last_row = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch, last_row = _without_repeats(batch, last_row)
            if not batch.num_rows:
                continue
            key, salt = batch.column("key").to_numpy(), batch.column("salt").to_numpy()
            offsets = batch.column("full").offsets.to_numpy()
            row = np.repeat(np.arange(len(key)), np.diff(offsets))
            full = batch.column("full").flatten().to_numpy()
            # Number the groups; what was seen stands before the first row's.
            number = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))))
            carried = seen if group == (key[0], salt[0]) else seen[:0]
            owner = np.concatenate((np.zeros(len(carried), np.int64), number[row]))
            value = np.concatenate((carried, full))
            order = np.lexsort((value, owner))
            fresh = np.ones(len(value), bool)
            fresh[order[1:]] = (value[order[1:]] != value[order[:-1]]) | (
                owner[order[1:]] != owner[order[:-1]]
            )
            last = owner == number[-1]
            group, seen = (key[-1], salt[-1]), np.unique(value[last])
            fresh = fresh[len(carried) :]
            begin = batch.column("pos").to_numpy()[row] - batch.column("back").flatten().to_numpy()
            at = np.flatnonzero(fresh & (salt[row] >= 0))
            if len(at):
                one = np.arange(len(at) + 1, dtype=np.int32)
                yield _spans(batch, row[at], one, begin[at], begin[at] + window, key[row[at]], full[at])
            at = np.flatnonzero(~fresh)
            if len(at):
                # Spans of different rows are kept apart by a distance that no text has.
                apart = row[at].astype(np.int64) << 40
                low, high = covered(apart + begin[at], apart + begin[at] + window)
                mine = low >> 40
                rows, first = np.unique(mine, return_index=True)
                mask = (1 << 40) - 1
                yield _spans(batch, rows, np.append(first, len(mine)), low & mask, high & mask)

    return run


def _spans(batch, rows, cut, low, high, key=None, full=None) -> pa.RecordBatch:
    offsets = pa.array(np.asarray(cut, np.int32))
    take = pa.array(rows)
    facts = [pa.nulls(len(rows), pa.int64()) if x is None else pa.array(x, pa.int64()) for x in (key, full)]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id").take(take),
            batch.column("tie").take(take),
            *(pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (low, high)),
            *facts,
        ],
        ["id", "tie", "begins", "ends", "key", "full"],
    )


def _later_of_firsts(firsts: DataFrame) -> DataFrame:
    """Of the first places in a window's salted groups, at most ``SALTS``, all but the least."""
    place = F.struct("id", "tie", "begins", "ends")
    # Null ids are the least of structs.
    listed = firsts.groupBy("key", "full").agg(F.sort_array(F.collect_list(place)).alias("places"))
    return listed.where(F.size("places") > 1).select(F.inline(F.slice("places", 2, SALTS)))


def repeated_windows(texts: DataFrame, window: int, frequent: int = FREQUENT) -> DataFrame:
    """Per keyed document the word spans that stand earlier: lists of lists ``begins``, ``ends``."""
    if window % 4:
        raise ValueError("the window must be a multiple of four words")
    kind = texts.schema["id"].dataType.simpleString()
    row = f"id {kind}, tie long, pos int, back array<short>, full array<long>"
    with passing(texts.sparkSession):
        quarters = texts.mapInArrow(_send_quarters(window), f"hash long, id {kind}, tie long, pos int")
        places = repeated(quarters, "quarter-windows")
        sent = joined(texts, places, "inner").mapInArrow(_send_halves(window), f"hash long, {row}")
        halves = stored(sent, "half-windows")
        # At most MOST_FREQUENT half windows can have so many rows.
        least = max(frequent, halves.count() // MOST_FREQUENT)
        many = halves.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > least).select("hash").collect()
        salted = halves.withColumn("salt", F.pmod(F.xxhash64("id", "tie", "pos"), F.lit(SALTS)).cast("int"))
        dealt = salted.mapInArrow(_deal(np.array([r.hash for r in many], np.int64)), f"key long, salt int, {row}")
        spans = (
            dealt.repartition("key", "salt")
            .sortWithinPartitions("key", "salt", F.col("id").asc_nulls_first(), "tie", "pos")
            .mapInArrow(
                _later_in_groups(window),
                f"id {kind}, tie long, begins array<int>, ends array<int>, key long, full long",
            )
        )
        if many:
            spans = stored(spans, "window-spans")
            spans = spans.where("key is null").drop("key", "full").unionByName(_later_of_firsts(spans.where("key is not null")))
        lists = (F.collect_list(c).alias(c) for c in ("begins", "ends"))
        return stored(spans.groupBy("id", "tie").agg(*lists), "later-windows", keep=True)


def deduplicate(
    docs: DataFrame,
    *,
    window: int = 20,
    frequent: int = FREQUENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_removed``, and the ``text`` that is kept.

    Kept words are joined by one space.
    """

    def keep(text: bytes, spans: tuple[np.ndarray, np.ndarray]) -> tuple[int, int, str]:
        words = text.split()
        begin, end = spans
        left, at = [], 0
        for low, high in zip(begin.tolist(), end.tolist(), strict=True):
            left += words[at:low]
            at = high
        left += words[at:]
        return len(words), len(words) - len(left), b" ".join(left).decode()

    texts = keyed(docs, id_column, text_column)
    spans = repeated_windows(texts, window, frequent)
    return per_document(
        joined(texts, spans, "left"), keep, "n_words long, n_removed long, text string", id_column
    )

