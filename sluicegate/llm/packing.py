"""Packing of token pieces into sequences by a configuration linear program.

Texts are tokenized, given an end id and cut at the sequence length.  Full pieces are
sequences of their own.  For the rest only the histogram of lengths matters, in classes rounded to a few
tokens: a configuration is a multiset of classes that fits in a sequence, and the program asks for the fewest
sequences, fractional for now, whose configurations together hold every piece.  It has too many configurations
to list, so multiplicative weights solve it: classes that are behind gain weight, and a knapsack
dynamic program prices the best configuration for the present weights.  The fractional solution
is rounded, classes become the lengths of their pieces, and the shortest pieces and those that rounding leaves
over fill the room between.

The histogram has at most one row per length below the sequence length, so the program costs the same at
any size and is the only thing solved on the driver.  Pieces are numbered within their
length by counts per task and length, so a length that holds a third of all pieces is
not gathered anywhere; the plan, a bounded table of runs of numbers, then gives each piece its place.

Null and empty texts are one piece that holds the end id alone.  Very long texts are cut like any other.  Repeated rows and null ids are packed like any other.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.frames import stored, word_hashes

# Parts whose ids a worker remembers between groups of texts, and characters of a group.
CACHED_PARTS = 800_000
GROUP_CHARS = 1 << 22
# Letters below U+0240 whose lower case lies beyond the letters spelt out below.
FAR_LETTER = re.compile(
    "[" + "".join(chr(c) for c in range(0x80, 0x240) if max(chr(c).lower()) > "\u024f") + "]"
)
# The tokenizer's own pattern, with letters, numbers and white space below U+0240 spelt out.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PART = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r \u0085\u00a0{_LETTERS}{_NUMBERS}]+"
)
SPACE, LETTER, NUMBER, MARK = range(4)
# What each character below U+0250 is; bytes beyond ASCII are set by pairs.
KINDS = np.array(
    [
        LETTER if re.match(f"[{_LETTERS}]", c)
        else NUMBER if re.match(f"[{_NUMBERS}]", c)
        else MARK if PART.match(c)
        else SPACE
        for c in map(chr, range(0x250))
    ],
    np.uint8,
)
BYTE_KINDS = KINDS[:0x80].tobytes() + bytes(0x80)
# Most rounds of the program, how steeply weights fall, classes of lengths, and the share of tokens left for filling.
ROUNDS = 1000
STEEPNESS = 20.0
CLASSES = 256
FILLING = 0.004
# The program is solved again for what rounding left, so many times; how full a rounded sequence is at least.
PHASES = 2
FULL = 0.98
# Classes to each side that may stand in for a class.
REACH = 4
ID_BYTES = 4


def cut_parts(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The parts of plain texts, as PART finds them in lower case, and the first part of each text (one more)."""
    lowered = [text.lower().encode() for text in texts]
    raw = b"".join([part for text in lowered for part in (text, b" ")]) + b"  "
    data = np.frombuffer(raw, np.uint8)
    kinds = np.frombuffer(bytearray(raw.translate(BYTE_KINDS)), np.uint8)
    lead = np.flatnonzero(data >= 0xC0)
    kinds[lead] = kinds[lead + 1] = KINDS[(data[lead] & 0x1F).astype(np.int64) << 6 | data[lead + 1] & 0x3F]
    solid = kinds != SPACE
    begins = np.empty(len(data), bool)
    begins[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    begins |= kinds == NUMBER
    begins &= solid
    begins[lead + 1] = False
    # A contraction takes one or two letters from the run behind its apostrophe.
    quote = np.flatnonzero(data == ord("'"))
    quote = quote[begins[quote]]
    one, two = data[quote + 1], data[quote + 2]
    taken = np.isin(one, list(b"stmd")).astype(np.int64)
    for letters in (b"re", b"ve", b"ll"):
        taken[(one == letters[0]) & (two == letters[1])] = 2
    quote, taken = quote[taken > 0], taken[taken > 0]
    begins[quote + 1] = False
    begins[quote + 1 + taken] = solid[quote + 1 + taken]
    starts = np.cumsum([0, *map(len, lowered)]) + np.arange(len(lowered) + 1)
    bounds = np.searchsorted(np.flatnonzero(begins), starts)
    offsets = np.append(np.flatnonzero(begins[solid]), np.count_nonzero(solid)).astype(np.int32)
    letters = pa.py_buffer(data[solid])
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), letters), bounds


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of runs, one after another, each from its first on."""
    places = np.repeat(first - np.cumsum(counts) + counts, counts)
    places += np.arange(len(places))
    return places


class PartEncoder:
    """Token ids of a text, remembered by part.

    The tokenizer lowers a text's case, drops its white space and cuts it into parts (runs of
    letters, runs of marks, single digits) that it encodes one by one.  Texts of Latin letters are cut
    here, many at once, and each distinct part is encoded once; other texts go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # The same model for parts that are already cut and in lower case.
        spec = json.loads(self._tokenizer.to_str())
        spec["normalizer"] = None
        to_bytes = spec["pre_tokenizer"]["pretokenizers"][-1]
        spec["pre_tokenizer"] = {
            "type": "Sequence",
            "pretokenizers": [{"type": "WhitespaceSplit"}, to_bytes],
        }
        self._plain = Tokenizer.from_str(json.dumps(spec))
        tokens = self._tokenizer.get_vocab()
        self._ends_part = np.zeros(max(tokens.values()) + 1, bool)
        self._ends_part[[i for token, i in tokens.items() if token.endswith("</w>")]] = True
        # Known parts by number, their ids one after another, where a part's begin (one more), and how often it was met.
        # The empty part, which no text has, saves the case of none.
        self._parts = pa.array([""])
        self._ids = np.empty(0, "<u4")
        self._bounds = np.zeros(2, np.int64)
        self._uses = np.zeros(1, np.int64)
        # Hashes of the parts in order, and whose they are.
        self._hashes = np.zeros(1, np.uint64)
        self._owners = np.zeros(1, np.int64)

    def _numbers(self, parts: pa.StringArray) -> np.ndarray:
        """The number of each of the parts, which are distinct; unknown ones are learnt.

        A part is found by its hash and compared, so one that shares its hash with another is just learnt again.
        """
        offsets = np.frombuffer(parts.buffers()[1], np.int32, len(parts) + 1, 4 * parts.offset)
        data = np.frombuffer(parts.buffers()[2], np.uint8)
        # Hashing takes many bytes for one, so the parts of a very long text are hashed some at a time.
        cuts = np.unique(np.append(np.searchsorted(offsets, np.arange(0, offsets[-1], GROUP_CHARS)), len(parts))).tolist()
        hashes = []
        for low, high in itertools.pairwise(cuts):
            within = offsets[low : high + 1] - offsets[low]
            hashes.append(word_hashes(data[offsets[low] : offsets[high]], within[:-1], within[1:]))
        hashes = np.concatenate(hashes)
        place = np.searchsorted(self._hashes, hashes)
        numbers = self._owners[np.minimum(place, len(self._owners) - 1)]
        fresh = ~pc.equal(self._parts.take(pa.array(numbers)), parts).to_numpy(zero_copy_only=False)
        numbers[fresh] = np.arange(len(self._parts), len(self._parts) + np.count_nonzero(fresh))
        self._learn(parts.filter(pa.array(fresh)))
        order = np.flatnonzero(fresh)[np.argsort(hashes[fresh])]
        self._owners = np.insert(self._owners, place[order], numbers[order])
        self._hashes = np.insert(self._hashes, place[order], hashes[order])
        return numbers

    def _learn(self, parts: pa.StringArray) -> None:
        """Exactly the last token of a part is marked as an end."""
        wanted = parts.to_numpy(zero_copy_only=False).tolist()
        ids = [self._ids]
        for low in range(0, len(wanted), 200):
            some = " ".join(wanted[low : low + 200])
            encoded = self._plain.encode_batch_fast([some], add_special_tokens=False)
            ids.append(np.array(encoded[0].ids, "<u4"))
        known, self._ids = len(self._ids), np.concatenate(ids)
        ends = np.flatnonzero(self._ends_part[self._ids[known:]]) + 1 + known
        if len(ends) != len(wanted):
            raise ValueError("a part's tokens do not end with it")
        self._bounds = np.append(self._bounds, ends)
        self._parts = pa.concat_arrays([self._parts, parts])
        self._uses = np.append(self._uses, np.zeros(len(wanted), np.int64))

    def _forget(self) -> None:
        """Keep the parts met most, as many as half the limit; what they were met for counts half from now on."""
        kept = np.argsort(self._uses, kind="stable")[-(CACHED_PARTS // 2) :]
        counts = np.diff(self._bounds)[kept]
        self._ids = self._ids[spread(self._bounds[kept], counts)]
        self._bounds = np.append(0, np.cumsum(counts))
        self._parts = self._parts.take(pa.array(kept))
        self._uses = self._uses[kept] // 2
        renumbered = np.full(len(self._owners), -1)
        renumbered[kept] = np.arange(len(kept))
        owners = renumbered[self._owners]
        self._owners, self._hashes = owners[owners >= 0], self._hashes[owners >= 0]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, four bytes each."""
        low = size = 0
        for high, text in enumerate(texts, 1):
            size += len(text)
            if size > GROUP_CHARS or high == len(texts):
                yield from self._encode_group(texts[low:high])
                low, size = high, 0

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        plain = [self._is_plain(text) for text in texts]
        cut = self._encode_plain([text for text, fits in zip(texts, plain, strict=True) if fits])
        for text, fits in zip(texts, plain, strict=True):
            if fits:
                yield next(cut)
            else:
                ids = self._tokenizer.encode(text, add_special_tokens=False).ids
                yield np.array(ids, "<u4").tobytes()

    def _encode_plain(self, texts: list[str]) -> Iterator[bytes]:
        """Equal parts are looked up once for all texts."""
        parts, bounds = cut_parts(texts)
        if not len(parts):
            yield from [b""] * len(texts)
            return
        named = parts.dictionary_encode()
        numbers = self._numbers(named.dictionary)
        met = named.indices.to_numpy()
        self._uses[numbers] += np.bincount(met)
        first, counts = self._bounds[numbers][met], np.diff(self._bounds)[numbers][met]
        ids = self._ids[spread(first, counts)]
        tokens = np.append(0, np.cumsum(counts))[bounds].tolist()
        if len(self._parts) > CACHED_PARTS:
            self._forget()
        for low, high in itertools.pairwise(tokens):
            yield ids[low:high].tobytes()

    @staticmethod
    def _is_plain(text: str) -> bool:
        """Only characters below U+0240, in lower case too, which are composed, and no special token."""
        if text.isascii():
            return "<|" not in text
        data = text.encode()
        high = np.frombuffer(data, np.uint8).max() >= 0xC9
        return not high and "<|" not in text and not FAR_LETTER.search(text)


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> PartEncoder:
    """One encoder per worker process, which keeps its parts from task to task."""
    return PartEncoder(path)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    length: int,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece with its place in its document, its task and its rank there by length."""
    size = length * ID_BYTES
    end = int(end_id).to_bytes(ID_BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        task = TaskContext.get().partitionId()
        ranks = np.zeros(length + 1, np.int64)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            row, piece, lengths, sums = [], [], [], []
            for at, ids in enumerate(known.encode(texts)):
                ids += end
                for low in range(0, len(ids), size):
                    part = ids[low : low + size]
                    row.append(at)
                    piece.append(low // size)
                    lengths.append(len(part) // ID_BYTES)
                    sums.append(zlib.crc32(part))
            counts = np.array(lengths, np.int64)
            order = np.argsort(counts, kind="stable")
            sizes, first, many = np.unique(counts[order], return_index=True, return_counts=True)
            rank = np.empty(len(counts), np.int64)
            rank[order] = np.arange(len(counts)) - np.repeat(first, many) + np.repeat(ranks[sizes], many)
            ranks[sizes] += many
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(np.array(piece, np.int64) * length),
                    pa.array(counts),
                    pa.array(sums, pa.int64()),
                    pa.array(np.full(len(counts), task), pa.int64()),
                    pa.array(rank),
                ],
                ["id", "piece", "start", "length", "ids_crc32", "task", "rank"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    ).mapInArrow(
        run,
        f"id {kind}, piece int, start long, length long, ids_crc32 long, task long, rank long",
    )


def price(weights: np.ndarray, length: int) -> np.ndarray:
    """How often the configuration of the greatest total weight takes each size.

    Unbounded knapsack over the sizes 1 to ``len(weights)``.
    """
    top = len(weights)
    best = np.zeros(length + 1)
    taken = np.zeros(length + 1, np.int64)
    backward = np.ascontiguousarray(weights[::-1])
    for room in range(1, length + 1):
        count = min(room, top)
        gains = best[room - count : room] + backward[top - count :]
        at = int(gains.argmax())
        if gains[at] > best[room - 1]:
            best[room], taken[room] = gains[at], count - at
        else:
            best[room] = best[room - 1]
    found = np.zeros(top + 1, np.int64)
    room = length
    while room > 0:
        if taken[room]:
            found[taken[room]] += 1
            room -= taken[room]
        else:
            room -= 1
    return found


def fractional(demand: np.ndarray, room: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, float]]:
    """Configurations of classes and their fractional uses, by multiplicative weights.

    ``demand[c]`` pieces take c + 1 units of a sequence's ``room``.  A class weighs less, exponentially, the larger
    the share of it that is served, and the configuration of the greatest weight is used some more, until every class is served.
    """
    present = np.flatnonzero(demand)
    if not len(present):
        return []
    wanted = demand[present].astype(float)
    least = float((wanted * (present + 1)).sum()) / room
    supplied = np.zeros(len(demand))
    uses: dict[bytes, float] = {}
    shapes: dict[bytes, np.ndarray] = {}
    while True:
        share = supplied[present] / wanted
        low = share.min()
        if low > 1 - 1e-9:
            return [(shapes[key], use) for key, use in uses.items()]
        worth = np.zeros(len(demand))
        worth[present] = np.exp(-(share - low) * STEEPNESS) / wanted * (share <= 1 - 1e-9)
        # The length itself is a small bonus, so that room is not left empty.
        worth /= worth.max()
        worth[present] += 1e-6 * (present + 1) / room * (share <= 1 - 1e-9)
        shape = price(worth, room)[1:]
        held = np.flatnonzero(shape)
        # A class gains a tenth of its pieces at once, or so much that the rounds stay bounded, but not more than it wants.
        add = max(float((demand[held] / shape[held]).min()) / 10, least / rounds)
        add = min(add, float(((demand - supplied)[held] / shape[held]).min()))
        key = shape.tobytes()
        shapes[key] = shape
        uses[key] = uses.get(key, 0.0) + add
        supplied += add * shape


def rounded(
    solution: list[tuple[np.ndarray, float]], demand: np.ndarray, room: int
) -> list[tuple[np.ndarray, int]]:
    """Whole uses of configurations, which hold no more pieces than there are.

    Uses are rounded so that their running total is, which loses less than one sequence altogether.  Where a class runs
    out, the configuration goes on without it as long as it fills FULL of the room.  ``demand`` loses the pieces held.
    """
    left = demand
    plan = []
    total, given = 0.0, 0
    for shape, use in sorted(solution, key=lambda item: -item[1]):
        total += use
        many, given = round(total) - given, round(total)
        while many > 0:
            shape = np.minimum(shape, left)
            held = np.flatnonzero(shape)
            if (shape[held] * (held + 1)).sum() < FULL * room:
                break
            now = int(min(many, (left[held] // shape[held]).min()))
            plan.append((shape, now))
            left[held] -= now * shape[held]
            many -= now
    return plan


def _spelt_out(
    plan: list[tuple[np.ndarray, int]], counts: np.ndarray, length: int, grain: int
) -> list[tuple[list[int], int]]:
    """The lengths that take the classes' places, and how many sequences have the same ones.

    Each place takes the length nearest to the room that the later places' classes leave it, the last one the longest that
    fits, from its class or those beside it; a place for which there is none stays empty.  Equal sequences are made
    together until a length runs out, so the steps are bounded by lengths and configurations.
    ``counts`` loses the pieces taken.
    """
    found = []
    for shape, many in plan:
        held = np.flatnonzero(shape)
        slots = np.repeat(held, shape[held])[::-1].tolist()
        while many:
            room, later = length, grain * sum(at + 1 for at in slots)
            taken: list[int] = []
            for at in slots:
                middle = grain * (at + 1)
                later -= middle
                top = min(room, middle + REACH * grain)
                low = max(1, middle - REACH * grain)
                near = counts[low : top + 1].copy()
                for size in taken:
                    if low <= size <= top:
                        near[size - low] -= 1
                sizes = np.flatnonzero(near > 0) + low
                if len(sizes):
                    size = int(sizes[np.abs(sizes - (room - later)).argmin()])
                    taken.append(size)
                    room -= size
            if not taken:
                break
            wanted = Counter(taken)
            now = min(many, *(int(counts[size]) // each for size, each in wanted.items()))
            for size, each in wanted.items():
                counts[size] -= now * each
            found.append((taken, now))
            many -= now
    return found


def _filled(
    plan: list[tuple[list[int], int]], counts: np.ndarray, length: int
) -> list[tuple[list[int], int]]:
    """Sequences with the room that is left filled by the longest pieces left that fit; ``counts`` loses them."""
    found = []
    open_ = sorted(((length - sum(sizes), sizes, many) for sizes, many in plan), key=lambda x: x[0])
    while open_:
        space, sizes, many = open_.pop()
        fitting = np.flatnonzero(counts[: space + 1])
        if not len(fitting):
            found.append((sizes, many))
            continue
        size = int(fitting[-1])
        now = min(many, int(counts[size]))
        counts[size] -= now
        if now < many:
            open_.append((space, sizes, many - now))
        open_.append((space - size, [*sizes, size], now))
    return found


def configurations(
    counts: np.ndarray, length: int, rounds: int = ROUNDS
) -> list[tuple[list[int], int]]:
    """The lengths of a sequence's pieces and how many sequences are alike; together they hold every piece.

    ``counts[l]`` is the number of pieces of length l.  The program is over classes of lengths rounded to a grain.
    The shortest pieces, which hold FILLING of all tokens, are not asked of it: with what rounding leaves over,
    they fill the room that is left, and after that best fit packs them.
    """
    left = counts.astype(np.int64).copy()
    plan = linear_part(left, length, rounds)
    return _filled(plan, left, length) + best_fit(left, length)


def linear_part(counts: np.ndarray, length: int, rounds: int = ROUNDS) -> list[tuple[list[int], int]]:
    """The sequences that the rounded program fills; ``counts`` loses their pieces."""
    grain = -(-length // CLASSES)
    room = length // grain
    sizes = np.arange(len(counts))
    tokens = np.cumsum(counts * sizes)
    asked = np.where(tokens > FILLING * tokens[-1], counts, 0)
    classes = np.clip((sizes + grain // 2) // grain, 1, room) - 1
    counts -= asked
    plan = []
    for phase in range(PHASES):
        demand = np.bincount(classes, weights=asked, minlength=room).astype(np.int64)
        more = _spelt_out(rounded(fractional(demand, room, rounds >> phase), demand, room), asked, length, grain)
        if not more:
            break
        plan += more
    counts += asked
    return plan


def best_fit(counts: np.ndarray, length: int) -> list[tuple[list[int], int]]:
    """Pack a histogram longest first, each sequence filled by the longest that still fit.

    Equal sequences are made together, so the cost depends on the number of lengths and not of pieces.
    """
    left = counts.astype(np.int64).copy()
    plan = []
    while True:
        present = np.flatnonzero(left)
        if not len(present):
            return plan
        shape: dict[int, int] = {}
        room = length
        while len(present := present[present <= room]):
            size = int(present[-1])
            shape[size] = min(int(left[size]), room // size)
            room -= shape[size] * size
            present = present[:-1]
        many = min(int(left[size]) // each for size, each in shape.items())
        plan.append(([size for size, each in shape.items() for _ in range(each)], many))
        for size, each in shape.items():
            left[size] -= many * each


def runs(plan: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length the runs of ranks: first rank, first sequence, pieces each, offset."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for sizes, many in plan:
        offset = 0
        for size, each in sorted(Counter(sizes).items()):
            found.setdefault(size, []).append((given.get(size, 0), sequence, each, offset))
            given[size] = given.get(size, 0) + each * many
            offset += each * size
        sequence += many
    return {size: np.array(rows, np.int64) for size, rows in found.items()}


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    length: int = 4096,
    end_id: int = 1,
    rounds: int = ROUNDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece of every document with its sequence and its offset in it."""
    pieces = stored(
        token_pieces(docs, tokenizer, length, end_id, id_column, text_column), "pieces"
    )
    by_task = stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "task-counts")
    histogram = np.zeros(length + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    full = int(histogram[length])
    histogram[length] = 0
    plan = configurations(histogram, length, rounds)
    table = runs(plan)
    if full:
        # Full pieces take the sequence numbers after the mixed ones.
        table[length] = np.array([[0, sum(many for _, many in plan), 1, 0]], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("number").to_numpy(zero_copy_only=False)
            sequence = np.zeros(len(size), np.int64)
            offset = np.zeros(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            sizes, first = np.unique(size[order], return_index=True)
            for at, value in enumerate(sizes.tolist()):
                who = order[first[at] : first[at + 1] if at + 1 < len(first) else None]
                rows = table[value]
                run = rows[np.searchsorted(rows[:, 0], rank[who], "right") - 1]
                inner = rank[who] - run[:, 0]
                sequence[who] = run[:, 1] + inner // run[:, 2]
                offset[who] = run[:, 3] + inner % run[:, 2] * value
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    before = by_task.selectExpr(
        "length",
        "task",
        "sum(n) over (partition by length order by task rows between unbounded preceding and 1 preceding) as before",
    )
    numbered = pieces.join(before, ["length", "task"]).select(
        F.col("id").alias(id_column),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("rank") + F.coalesce("before", F.lit(0))).alias("number"),
    )
    kind = docs.schema[id_column].dataType.simpleString()
    return numbered.mapInArrow(
        place,
        f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
