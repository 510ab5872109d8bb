"""Byte strings that repeat anywhere in a corpus, removed by suffix arrays of its repeated parts.

Every byte goes that lies in a string of the given length that also starts somewhere else.

* Anchors: of each such string, the place of its least 32-byte hash.  Only strings whose anchor occurs
  again can repeat, so the others are left after one shuffle of anchor hashes.
* Segments: the strings that share an anchor are one stretch of text.  Stretches go to shards by the
  hash of the anchor, so equal strings always meet, and those of one shard need nothing of another.
* Suffix arrays: a task sorts the suffixes of its shard by external induced sorting (``induced``) and takes every
  suffix whose common prefix with a neighbour has the length.  Stretches that are equal as a whole
  enter once, for all who have them.

Shards are cut at anchors' boundaries and their arrays lie on disk where they are large.

Null and empty texts have no bytes and lose none; texts shorter than the length lose nothing.  Very long texts are
handled whole.  Rows equal in id and text are one document; null ids are ids like others.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
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
from sluicegate.llm.frames import BYTE_CODES, Chunk, chunks, stored, window_hashes
from sluicegate.llm.induced import Arena, suffix_order

UNIT = 32
# Text of a shard beyond which the next anchor begins another one.
SHARD_BYTES = 4 << 20
# Characters below the bytes: the end of the string, and the end of a segment.
END, CUT, FIRST_BYTE = 0, 1, 2


def _anchors(chunk: Chunk, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each unit, starts of strings within a text, and the anchor of each."""
    codes = BYTE_CODES[chunk.data]
    hashes = window_hashes(codes, UNIT)
    starts = whole_windows(chunk.starts, len(codes), length)
    return hashes, starts, least_hash_in_windows(hashes, length - UNIT + 1)[starts]


def _send_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), 1 << 20):
                hashes, _, anchor = _anchors(chunk, length)
                anchor = np.unique(anchor)
                text = np.searchsorted(chunk.starts, anchor, "right") - 1
                rows = pa.array(text + chunk.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[anchor].view(np.int64)),
                        batch.column("id").take(rows),
                        batch.column("tie").take(rows),
                        pa.array((anchor - chunk.starts[text]).astype(np.int32)),
                    ],
                    ["hash", "id", "tie", "pos"],
                )

    return run


def _send_segments(length: int):
    """The stretch of text around each repeated anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), 1 << 20):
                hashes, starts, anchor = _anchors(chunk, length)
                places = batch.column("places")[chunk.rows]
                lengths = np.diff(places.offsets.to_numpy())
                alive = np.zeros(len(chunk.data) + 1, bool)
                alive[places.flatten().to_numpy() + np.repeat(chunk.starts[:-1], lengths)] = True
                keep = alive[anchor]
                starts, anchor = starts[keep], anchor[keep]
                if not len(starts):
                    continue
                first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
                last = np.append(first[1:], len(starts)) - 1
                begin, end = starts[first], starts[last] + length
                text = np.searchsorted(chunk.starts, begin, "right") - 1
                rows = pa.array(text + chunk.rows.start)
                data = chunk.data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[anchor[first]].view(np.int64)),
                        pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()),
                        batch.column("id").take(rows),
                        batch.column("tie").take(rows),
                        pa.array((begin - chunk.starts[text]).astype(np.int32)),
                    ],
                    ["hash", "segment", "id", "tie", "begin"],
                )

    return run


class _Shard:
    """Distinct segments, and the rows that own them."""

    def __init__(self) -> None:
        self.segments: list[bytes] = []
        self.bytes = 0
        self.rows: list[pa.RecordBatch] = []  # id, tie, begin
        self.owned: list[np.ndarray] = []  # the segment of each row

    def spans(self, length: int) -> pa.RecordBatch | None:
        """The repeated spans of every row."""
        if not self.segments:
            return None
        rows = pa.Table.from_batches(self.rows).combine_chunks()
        owned = np.concatenate(self.owned)
        sizes = np.array([len(x) for x in self.segments], np.int64)
        bases = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        text = np.empty(int(sizes.sum()) + len(sizes) + 1, np.uint16)
        data = np.frombuffer(b"\0".join(self.segments) + b"\0", np.uint8)
        text[:-1] = data
        text[:-1] += FIRST_BYTE
        text[bases + sizes] = CUT
        text[-1] = END
        again = np.zeros(len(text), bool)
        with Arena() as arena:
            order, shared = suffix_order(text, length, arena)
            step = 1 << 20
            for low in range(1, len(order), step):
                at = np.flatnonzero(shared[low : low + step] >= length) + low
                again[order[at]] = True
                again[order[at - 1]] = True
        # A segment that several places own is repeated throughout.
        begin = rows.column("begin").to_numpy()
        tie = rows.column("tie").to_numpy()
        codes = rows.column("id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        # Equal rows of the input send equal rows, which are one place.
        order = np.lexsort((begin, tie, codes, owned))
        fresh = np.zeros(len(order), bool)
        for column in (owned, codes, tie, begin):
            fresh[1:] |= column[order[1:]] != column[order[:-1]]
        fresh[:1] = True
        once = order[fresh]
        rows, owned, begin = rows.take(pa.array(once)), owned[once], begin[once]
        many = np.bincount(owned, minlength=len(sizes)) > 1
        again[:-1] |= np.repeat(many, sizes + 1)
        marked = np.flatnonzero(again)
        segment = np.searchsorted(bases, marked, "right") - 1
        room = bases[segment] + sizes[segment] - marked >= length
        marked, segment = marked[room], segment[room]
        # Runs of repeated starts within a segment become spans of it.
        fresh = np.append(True, (np.diff(marked) > 1) | (np.diff(segment) > 0)) if len(marked) else []
        first = np.flatnonzero(fresh)
        if not len(first):
            return None
        last = np.append(first[1:], len(marked)) - 1
        owner = segment[first]
        low = marked[first] - bases[owner]
        high = marked[last] - bases[owner] + length
        # Every row gets the spans of its segment, moved to its place.
        cut = np.searchsorted(owner, np.arange(len(sizes) + 1))
        have = np.diff(cut)[owned]
        who = np.repeat(np.arange(len(owned)), have)
        at = np.repeat(cut[owned], have) + np.arange(have.sum()) - np.repeat(np.cumsum(have) - have, have)
        kept = np.flatnonzero(have)
        offsets = pa.array(np.append(0, np.cumsum(have[kept])).astype(np.int32))
        take = pa.array(kept)
        return pa.RecordBatch.from_arrays(
            [
                rows.column("id").combine_chunks().take(take),
                rows.column("tie").combine_chunks().take(take),
                pa.ListArray.from_arrays(offsets, pa.array((low[at] + begin[who]).astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array((high[at] + begin[who]).astype(np.int32))),
            ],
            ["id", "tie", "begin", "end"],
        )


def _sort_shards(length: int, shard_bytes: int):
    """Cut a sorted partition into shards at anchors' boundaries and sort each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        last_hash, last_segment = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes, segments = batch.column("hash").to_numpy(), batch.column("segment")
            rows = batch.select(["id", "tie", "begin"])
            # Where an anchor's rows begin, and where those of a segment do.
            anchor = np.append(hashes[0] != last_hash, hashes[1:] != hashes[:-1])
            fresh = anchor.copy()
            fresh[1:] |= pc.not_equal(segments[1:], segments[:-1]).to_numpy(zero_copy_only=False)
            fresh[0] |= segments[0].as_py() != last_segment
            sizes = np.where(fresh, pc.binary_length(segments).to_numpy(), 0)
            total = np.cumsum(sizes)
            cuts = np.flatnonzero(anchor)
            low = 0
            while low < batch.num_rows:
                # The shard closes at the first anchor before which it has its bytes.
                begin = cuts[cuts >= low]
                held = shard.bytes + np.where(begin > 0, total[begin - 1], 0) - (total[low - 1] if low else 0)
                full = np.flatnonzero(held >= shard_bytes)
                high = int(begin[full[0]]) if len(full) else batch.num_rows
                part = slice(low, high)
                shard.rows.append(rows.slice(low, high - low))
                shard.owned.append(len(shard.segments) - 1 + np.cumsum(fresh[part]))
                shard.segments += segments.slice(low, high - low).filter(pa.array(fresh[part])).to_pylist()
                shard.bytes += int(sizes[part].sum())
                if len(full):
                    found = shard.spans(length)
                    if found is not None:
                        yield found
                    shard = _Shard()
                low = high
            last_hash, last_segment = hashes[-1], segments[len(segments) - 1].as_py()
        found = shard.spans(length)
        if found is not None:
            yield found

    return run


def repeated_strings(texts: DataFrame, length: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per keyed document the byte spans that repeat: lists of lists ``begins``, ``ends``."""
    if not UNIT < length <= 255:
        raise ValueError(f"the length must be over {UNIT} and at most 255 bytes")
    kind = texts.schema["id"].dataType.simpleString()
    anchors = texts.mapInArrow(_send_anchors(length), f"hash long, id {kind}, tie long, pos int")
    places = repeated(anchors, "anchors")
    segments = joined(texts, places, "inner").mapInArrow(
        _send_segments(length), f"hash long, segment binary, id {kind}, tie long, begin int"
    )
    spans = (
        segments.repartition("hash")
        .sortWithinPartitions("hash", "segment")
        .mapInArrow(
            _sort_shards(length, shard_bytes), f"id {kind}, tie long, begin array<int>, end array<int>"
        )
    )
    return stored(
        spans.groupBy("id", "tie").agg(
            F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")
        ),
        "repeated-strings",
    )


def deduplicate(
    docs: DataFrame, *, length: int = 200, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: the id, ``n_bytes``, ``n_removed``, ``n_spans``, the bytes ``kept`` and a ``text``.

    The text leaves out characters that a span cut in two.
    """

    def keep(text: bytes, spans: tuple[np.ndarray, np.ndarray]) -> tuple[int, int, int, bytes, str]:
        begin, end = spans
        left, at = [], 0
        for low, high in zip(begin.tolist(), end.tolist(), strict=True):
            left.append(text[at:low])
            at = high
        left.append(text[at:])
        kept = b"".join(left)
        whole = "".join(piece.decode(errors="ignore") for piece in left)
        return len(text), len(text) - len(kept), len(begin), kept, whole

    texts = keyed(docs, id_column, text_column)
    spans = repeated_strings(texts, length)
    return per_document(
        joined(texts, spans, "left"),
        keep,
        "n_bytes long, n_removed long, n_spans long, kept binary, text string",
        id_column,
    )
