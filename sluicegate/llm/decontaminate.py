"""Benchmark items that stand in documents, exactly or with small edits.

Texts are words in lower case.  An item is leaked where some stretch of a document is within the allowed
word edit distance of it (a fifth of the item's words by default).

* Pieces: items beyond PIECE_WORDS are cut evenly.  With that few edits in an item, some piece has no larger share of them.
* Windows: a piece with that few edits keeps some run of three words intact (there are more runs than edits), so only
  piece-sized windows that hold such a run where some piece has it are embedded; no window within the bound is lost.
* Embedding: a CGK random walk reads the words of a window and, at each step, stays on
  its word or goes on, as a random function of step and word says.  Two sequences a few edits
  apart fall into step again, so their walks agree in many places: edit distance becomes Hamming distance.  As many steps
  are taken as there are words, so that no walk reads past its end, where any two would agree.
* Bit sampling: a hash table holds the pieces by a few sampled places of a walk, and windows are looked up in it by theirs.
  Several walks and tables make a window within the distance meet its piece with the target recall.
* Verification: the items met are aligned exactly with the words around; every stretch within the bound is reported,
  the nearest first where they overlap.

Items are held in blocks of bounded size, and the documents are read once per block.  Each document is
looked at where it lies: nothing is shuffled but the results.

Null, empty and blank texts leak nothing, and items without words are in nothing.  Very long texts are
handled in chunks of whole texts.  Repeated rows are reported each; a null id is reported as null.  An empty
table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.frames import Chunk, chunks, lowered, mix, span_hashes, word_hashes

SIMILARITY = 0.8
RECALL = 0.99
SEED_WORDS = 3
WALKS = 4
SAMPLED = 2
# Share of a walk's places in which pieces at the distance bound agree; rather too low than too high.
AGREEMENT = 0.35
# Items of a block, and the most words of a piece.
BLOCK_ITEMS = 5000
PIECE_WORDS = 32

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_codes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code, start and end of every word, and the first word of each text."""
    begin, end, first = chunk.words(_LETTER)
    return word_hashes(lowered(chunk.data), begin, end), begin, end, first


def edits_allowed(words: int, similarity: float) -> int:
    return int(math.floor(words * (1 - similarity) + 1e-9))


def seed_width(words: int, similarity: float) -> int:
    """Words of the run that some piece of the item keeps intact."""
    return min(SEED_WORDS, max(1, words // (edits_allowed(words, similarity) + 1)))


def walk(words: np.ndarray, seed: int) -> np.ndarray:
    """CGK walks over rows of word codes, one step a word."""
    rows, width = words.shape
    at = np.zeros(rows, np.int64)
    out = np.zeros((rows, width), np.uint64)
    every = np.arange(rows)
    for step in range(width):
        salt = mix(np.array([(seed << 32) + step + 1], np.uint64))[0]
        mixed = mix(words[every, at] ^ salt)
        out[:, step] = mixed
        at += (mixed & np.uint64(1)).astype(np.int64)
    return out


def tables_for(recall: float, walks: int = WALKS) -> int:
    """Tables per walk that reach the recall at the distance bound."""
    hit = AGREEMENT**SAMPLED
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit) / walks))


def align(item: np.ndarray, region: np.ndarray, edits: int) -> list[tuple[int, int, int]]:
    """The stretches of a region within so many edits of an item: distance, first word, and the word after.

    Dynamic programming over the region; a column at a time.  Each cell also carries where its
    stretch began.  Of stretches that overlap the nearest stays, or the earliest among equals.
    """
    size = len(item)
    steps = np.arange(size + 1)
    row = steps.copy()
    origin = np.zeros(size + 1, np.int64)
    near = []
    for at, word in enumerate(region):
        straight = row[:-1] + (item != word)
        skipped = row[1:] + 1
        cells = np.empty(size + 1, np.int64)
        start = np.empty(size + 1, np.int64)
        cells[0], start[0] = 0, at + 1
        take = straight <= skipped
        cells[1:] = np.where(take, straight, skipped)
        start[1:] = np.where(take, origin[:-1], origin[1:])
        # Words of the item that the region lacks: the best cell above, plus the steps down from it.
        lifted = cells - steps
        least = np.minimum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == least, steps, 0))
        row, origin = least + steps, start[source]
        if row[size] <= edits:
            near.append((int(row[size]), int(origin[size]), at + 1))
    found: list[tuple[int, int, int]] = []
    taken = np.zeros(len(region) + 1, bool)
    for distance, begin, end in sorted(near, key=lambda x: (x[0], x[2])):
        if begin < end and not taken[begin:end].any():
            taken[begin:end] = True
            found.append((distance, begin, end))
    return sorted(found, key=lambda x: x[1])


def pieces_of(words: int) -> list[tuple[int, int]]:
    """Even pieces of at most PIECE_WORDS words."""
    many = -(-words // PIECE_WORDS)
    edges = [words * at // many for at in range(many + 1)] if many else []
    return list(zip(edges, edges[1:], strict=False))


def _matches(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of a wanted key and a place among the sorted ones that hold it."""
    low = np.searchsorted(sorted_keys, wanted)
    many = np.searchsorted(sorted_keys, wanted, "right") - low
    asked = np.repeat(np.arange(len(wanted)), many)
    return asked, np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


@dataclass
class Items:
    """A block of items, with the runs of words that lead to windows and the tables of their pieces' walks."""

    ids: list
    codes: list[np.ndarray]
    similarity: float
    recall: float

    def __post_init__(self) -> None:
        self.sizes = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.array([edits_allowed(n, self.similarity) for n in self.sizes], np.int64)
        cut = [(at, low, high) for at, n in enumerate(self.sizes.tolist()) for low, high in pieces_of(n)]
        # Item, first word in it, and number of words of every piece.
        self.owner, self.offset, stop = np.array(cut, np.int64).reshape(-1, 3).T
        self.length = stop - self.offset
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        runs: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for item, low, high in cut:
            width = seed_width(high - low, self.similarity)
            starts = np.arange(low, high - width + 1)
            keys = span_hashes(self.codes[item], starts, starts + width)
            runs.setdefault(width, []).append((keys, starts - low, np.full(len(starts), high - low)))
        for width, parts in runs.items():
            key, place, length = (np.concatenate(x) for x in zip(*parts, strict=True))
            # Equal runs at the same place of pieces of the same size ask for the same window.
            order = np.lexsort((length, place, key))
            key, place, length = key[order], place[order], length[order]
            new = np.append(True, (key[1:] != key[:-1]) | (place[1:] != place[:-1]) | (length[1:] != length[:-1]))
            marks = np.zeros(1 << 20, bool)
            marks[key & np.uint64((1 << 20) - 1)] = True
            self.seeds[width] = key[new], place[new] * (PIECE_WORDS + 1) + length[new], marks
        padded = np.zeros((len(cut), PIECE_WORDS), np.uint64)
        for at, (item, low, high) in enumerate(cut):
            padded[at, : high - low] = self.codes[item][low:high]
        # The places a table samples are shares of a walk, so they fall inside walks of any length.
        random = np.random.Generator(np.random.PCG64(11))
        self.samples = random.random((WALKS, tables_for(self.recall), SAMPLED))
        self.tables = []
        for keys in self.keys(padded, self.length):
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], order))

    def keys(self, windows: np.ndarray, length: np.ndarray) -> Iterator[np.ndarray]:
        """The key of every window in one table after the other."""
        every = np.arange(len(windows))
        for w in range(WALKS):
            walked = walk(windows, w)
            for sample in self.samples[w]:
                key = length.astype(np.uint64)
                for share in sample:
                    key = mix(key ^ walked[every, (share * length).astype(np.int64)])
                yield key

    def windows(self, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where windows start that hold a run of some piece, the words that the text lacks before, and their sizes."""
        found = []
        for width, (keys, asked, marks) in self.seeds.items():
            if len(codes) < width:
                continue
            at = np.arange(len(codes) - width + 1)
            seen = span_hashes(codes, at, at + width)
            at = at[marks[seen & np.uint64((1 << 20) - 1)]]
            place, hit = _matches(keys, seen[at])
            at, (back, length) = at[place], np.divmod(asked[hit], PIECE_WORDS + 1)
            text = np.searchsorted(first, at, "right") - 1
            inside = at + width <= first[text + 1]
            at, back, length, text = at[inside], back[inside], length[inside], text[inside]
            # A window begins where the piece would without edits before the run; to the walk, words that edits
            # added or removed there are only a few more edits.
            start = np.maximum(at - back, first[text])
            found.append((start * 64 + (start - at + back)) * 64 + length)
        packed = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return packed >> 12, packed >> 6 & 63, packed & 63

    def met(self, windows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and the pieces that some table holds at their key."""
        found = []
        for (table, owners), keys in zip(self.tables, self.keys(windows, length), strict=True):
            window, place = _matches(table, keys)
            found.append(window * len(self.owner) + owners[place])
        return np.divmod(np.unique(np.concatenate(found)), max(1, len(self.owner)))

    def leaks(self, codes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Text, item, distance, and the stretch of words, for every leak in a chunk."""
        start, lacking, length = self.windows(codes, first)
        found = []
        for low in range(0, len(start), 20_000):
            part = slice(low, low + 20_000)
            text = np.searchsorted(first, start[part], "right") - 1
            inside = start[part][:, None] + np.arange(PIECE_WORDS)
            ended = inside >= np.minimum(first[text + 1], start[part] + length[part])[:, None]
            rows = np.where(ended, np.uint64(0), codes[np.minimum(inside, len(codes) - 1)])
            window, piece = self.met(rows, length[part])
            begin = start[part][window] - lacking[part][window] - self.offset[piece]
            found.append(np.stack([text[window], self.owner[piece], begin]))
        if not found:
            return []
        text, item, begin = np.unique(np.concatenate(found, axis=1), axis=1)
        out = []
        # Places of a text and item that touch are aligned together.
        spread = self.edits[item]
        low = np.clip(begin - spread, first[text], first[text + 1])
        high = np.clip(begin + self.sizes[item] + spread, low, first[text + 1])
        at = 0
        while at < len(text):
            to, end = at + 1, high[at]
            while to < len(text) and text[to] == text[at] and item[to] == item[at] and low[to] <= end:
                end = max(end, high[to])
                to += 1
            which, base = int(item[at]), int(low[at])
            for distance, left, right in align(self.codes[which], codes[base:end], int(self.edits[which])):
                out.append((int(text[at]), which, distance, base + left, base + right))
            at = to
        return out


def _blocks(items: DataFrame, id_column: str, text_column: str, block_items: int) -> Iterator[list]:
    """Items by hash in blocks of about ``block_items``, each small enough for the driver."""
    kept = items.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    count = kept.count()
    blocks = math.ceil(count / block_items)
    for block in range(blocks):
        yield kept.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    block_items: int = BLOCK_ITEMS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Every stretch of a document that leaks an item.

    Columns: both ids, ``similarity`` (1 less the edits by the item's words), ``first_word`` and ``n_words`` of
    the stretch, and its ``start`` and ``stop`` in UTF-8 bytes.
    """
    doc_kind = docs.schema[id_column].dataType.simpleString()
    item_kind = items.schema[item_column].dataType
    schema = (
        f"`{id_column}` {doc_kind}, `{item_column}` {item_kind.simpleString()}, similarity double, "
        "first_word long, n_words long, start long, stop long"
    )
    texts = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("_text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for rows in _blocks(items, item_column, item_text_column, block_items):
        codes = []
        for row in rows:
            (chunk,) = chunks(pa.array([row["text"]], pa.string()))
            codes.append(word_codes(chunk)[0])
        block = Items([row["id"] for row in rows], codes, similarity, recall)

        def run(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in chunks(batch.column(1)):
                    words, begin, end, first = word_codes(chunk)
                    leaks = block.leaks(words, first) if len(words) else []
                    if not leaks:
                        continue
                    text, item, distance, low, high = (np.array(x, np.int64) for x in zip(*leaks))
                    base = chunk.starts[text]
                    ids = batch.column(0)[chunk.rows].take(pa.array(text))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids,
                            pa.array([block.ids[i] for i in item], to_arrow(item_kind)),
                            pa.array(1 - distance / np.maximum(block.sizes[item], 1)),
                            pa.array(low - first[text]),
                            pa.array(high - low),
                            pa.array(begin[low] - base),
                            pa.array(end[high - 1] - base),
                        ],
                        [id_column, item_column, "similarity", "first_word", "n_words", "start", "stop"],
                    )

        found = found.union(texts.mapInArrow(run, schema))
    return found


def to_arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
