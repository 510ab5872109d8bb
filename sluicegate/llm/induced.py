"""Suffix arrays with common prefixes by induced sorting in external memory.

A suffix is of type S if it is less than its successor and of type L otherwise; an S suffix after an L
one is a seed.  Seeds are sorted first: their substrings are named in order, and where names repeat
the string of names is sorted by recursion.  A pass over the sorted seeds from the least character up
induces the order of all L suffixes, and a pass over those from the greatest down that of all S
suffixes: each suffix that passes puts its predecessor into a priority queue.

The queue carries tuples of first character, position, and the common prefix with the tuple before it of
the same character, which is one more than the least common prefix passed since.  Its tuples lie in ranges of
characters of known size; beyond a memory bound ranges are written to disk, and a range is read
back when the pass reaches it.  Large arrays are memory-mapped files.  So a string can be
far larger than memory; only a string of names that fits is sorted there, which ends the recursion.  Passes work on blocks of tuples at a time, as far as none of them induces
another one inside the block.

Common prefixes are capped: ``cap`` says from where on they do not matter.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np

NAMES_IN_MEMORY = 1 << 22
RANGE_TUPLES = 1 << 13
BLOCK = 1 << 19
#: Tuples in memory before ranges go to disk, and array sizes from which arrays are files.
MEMORY_TUPLES = 4_000_000
MAPPED_BYTES = 64 << 20


class Arena:
    """Arrays and queue files of one sort, in a folder that goes with it."""

    def __init__(self, memory_tuples: int = MEMORY_TUPLES, mapped_bytes: int = MAPPED_BYTES):
        self.memory_tuples = memory_tuples
        self.mapped_bytes = mapped_bytes
        self._folder: Path | None = None
        self._files = 0

    def path(self) -> Path:
        if self._folder is None:
            self._folder = Path(tempfile.mkdtemp(prefix="induced-"))
        self._files += 1
        return self._folder / f"{self._files}.bin"

    def array(self, size: int, dtype) -> np.ndarray:
        if size * np.dtype(dtype).itemsize < self.mapped_bytes:
            return np.zeros(size, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(size,))

    def __enter__(self) -> Arena:
        return self

    def __exit__(self, *_) -> None:
        if self._folder is not None:
            shutil.rmtree(self._folder, ignore_errors=True)


TUPLE = np.dtype([("key", np.uint32), ("pos", np.int64), ("lcp", np.uint8)])


class RangeQueue:
    """A priority queue of tuples, first in first out among equal keys.

    ``sizes`` are how many tuples each key will get in all, from which the ranges follow: neighbouring keys of at most
    ``RANGE_TUPLES`` tuples together, or one key of more.
    """

    def __init__(self, sizes: np.ndarray, arena: Arena):
        total = np.cumsum(sizes)
        low, tops = 0, []
        while low < len(sizes):
            base = total[low - 1] if low else 0
            high = int(np.searchsorted(total, base + RANGE_TUPLES, "right"))
            high = max(high, low + 1)
            tops.append(high - 1)
            low = high
        self.tops = np.array(tops, np.int64)  # last key of each range
        self._arena = arena
        self._memory: list[list[np.ndarray]] = [[] for _ in tops]
        self._files: dict[int, Path] = {}
        self._held = 0

    def push(self, tuples: np.ndarray) -> None:
        """Add tuples that are sorted by key, equal keys in order of arrival."""
        if not len(tuples):
            return
        ranges = np.searchsorted(self.tops, tuples["key"])
        cuts = np.flatnonzero(np.diff(ranges)) + 1
        for part, low, high in zip(
            ranges[np.append(0, cuts)].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(ranges)], strict=True
        ):
            self._memory[part].append(tuples[low:high])
        self._held += len(tuples)
        if self._held > self._arena.memory_tuples:
            self._spill()

    def _spill(self) -> None:
        for part, pieces in enumerate(self._memory):
            if pieces:
                if part not in self._files:
                    self._files[part] = self._arena.path()
                with self._files[part].open("ab") as out:
                    for piece in pieces:
                        out.write(np.ascontiguousarray(piece).tobytes())
                self._memory[part] = []
        self._held = 0

    def take(self, part: int) -> Iterator[np.ndarray]:
        """The tuples of a range in order of arrival, a block at a time."""
        path = self._files.pop(part, None)
        if path is not None:
            with path.open("rb") as source:
                while data := source.read(BLOCK * TUPLE.itemsize):
                    yield np.frombuffer(data, TUPLE)
            path.unlink()
        pieces, self._memory[part] = self._memory[part], []
        self._held -= sum(map(len, pieces))
        if pieces:
            yield np.concatenate(pieces)


class _Minima:
    """Least common prefix passed since each key was last pushed."""

    def __init__(self, keys: int, cap: int):
        self.cap = cap
        self.seen = np.full(keys, -1, np.int64)  # batch of the last push
        self.tail = np.zeros(keys, np.uint8)  # least prefix after it in that batch
        self.since = np.zeros(64, np.uint8)  # least prefix from each batch on
        self.batches = 0

    def pushed(self, keys: np.ndarray, at: np.ndarray, passed: np.ndarray) -> np.ndarray:
        """Common prefix of each new tuple with the one before it of its key.

        ``passed`` are the prefixes of a batch of passing suffixes, ``at`` which of them induced each tuple;
        tuples come sorted by key and then by ``at``.
        """
        levels = [passed]
        span = 1
        while 2 * span <= len(passed):
            last = levels[-1]
            levels.append(np.minimum(last[: len(last) - span], last[span:]))
            span *= 2
        result = np.zeros(len(keys), np.uint8)
        if len(keys):
            first = np.append(True, keys[1:] != keys[:-1])
            low = np.append(0, at[:-1] + 1)
            low[first] = 0
            length = at - low + 1
            level = np.zeros(len(length), np.int64)
            level = np.frexp(length.astype(float))[1] - 1
            least = np.empty(len(keys), np.uint8)
            for depth in np.unique(level).tolist():
                who = np.flatnonzero(level == depth)
                row = levels[depth]
                least[who] = np.minimum(row[low[who]], row[at[who] - (1 << depth) + 1])
            own = keys[first]
            batch = self.seen[own]
            before = np.minimum(self.tail[own], self._between(batch + 1))
            before[batch < 0] = 0
            fresh = batch < 0
            least_first = np.minimum(least[first], before)
            result = np.minimum(least, self.cap - 1) + 1
            value = np.minimum(least_first, self.cap - 1) + 1
            value[fresh] = 0
            result[first] = value
            ends = np.append(np.flatnonzero(first)[1:], len(keys)) - 1
            after = np.full(len(passed) + 1, self.cap, np.uint8)
            after[:-1] = np.minimum.accumulate(passed[::-1])[::-1]
            self.tail[own] = after[at[ends] + 1]
            self.seen[own] = self.batches
        if self.batches == len(self.since):
            self.since = np.concatenate([self.since, np.zeros(len(self.since), np.uint8)])
        self.since[self.batches] = self.cap
        most = passed.min() if len(passed) else self.cap
        live = self.since[: self.batches + 1]
        np.minimum(live, most, out=live)
        self.batches += 1
        return result

    def _between(self, batch: np.ndarray) -> np.ndarray:
        """Least prefix of the batches from one on, up to the present one (which is not counted)."""
        padded = np.append(self.since[: self.batches], np.uint8(self.cap))
        return padded[np.minimum(batch, self.batches)]


def induce(
    keys: np.ndarray,
    wanted: np.ndarray,
    seeds: np.ndarray,
    seed_lcp: np.ndarray,
    runs: np.ndarray,
    cap: int,
    arena: Arena,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pass in key order over seeds and all that they induce: blocks of position, prefix, is-seed.

    A passing suffix induces its predecessor if that is ``wanted``.  Among equal keys the induced ones pass before the
    seeds.  ``runs`` are how often the character at a position is repeated from there.
    """
    width = int(keys.max()) + 1
    queue = RangeQueue(np.bincount(keys[np.flatnonzero(wanted)], minlength=width), arena)
    minima = _Minima(width, cap)
    seed_keys = keys[seeds]
    last_key, last_pos, last_seed = -1, 0, False
    next_seed = 0

    def emit(pos: np.ndarray, key: np.ndarray, lcp: np.ndarray, is_seed: np.ndarray):
        """Let suffixes pass: their prefixes, and the tuples that they induce."""
        nonlocal last_key, last_pos, last_seed
        before_key = np.append(last_key, key[:-1].astype(np.int64))
        before_pos = np.append(last_pos, pos[:-1])
        before_seed = np.append(last_seed, is_seed[:-1])
        passed = np.where(before_key == key, lcp, 0).astype(np.uint8)
        turn = np.flatnonzero((before_key == key) & is_seed & ~before_seed)
        # An induced suffix and a seed of the same character part where the shorter run ends.
        passed[turn] = np.minimum(np.minimum(runs[pos[turn]], runs[before_pos[turn]]), cap)
        last_key, last_pos, last_seed = int(key[-1]), int(pos[-1]), bool(is_seed[-1])
        at = np.flatnonzero((pos > 0) & wanted[np.maximum(pos - 1, 0)])
        target = pos[at] - 1
        target_key = keys[target]
        order = np.argsort(target_key, kind="stable")
        tuples = np.empty(len(at), TUPLE)
        tuples["key"], tuples["pos"] = target_key[order], target[order]
        tuples["lcp"] = minima.pushed(target_key[order].astype(np.int64), at[order], passed)
        return passed, tuples

    for part, top in enumerate(queue.tops.tolist()):
        bottom = int(queue.tops[part - 1]) + 1 if part else 0
        seed_end = int(np.searchsorted(seed_keys, top, "right"))
        if bottom == top:
            # One key: what it induces of its own key joins its queue until nothing is left.
            pending = list(queue.take(part))
            while pending:
                for tuples in pending:
                    pos = tuples["pos"].astype(np.int64)
                    is_seed = np.zeros(len(pos), bool)
                    passed, found = emit(pos, tuples["key"].astype(np.int64), tuples["lcp"], is_seed)
                    queue.push(found)
                    yield pos, passed, is_seed
                pending = list(queue.take(part))
            for low in range(next_seed, seed_end, BLOCK):
                some = slice(low, min(low + BLOCK, seed_end))
                pos = np.asarray(seeds[some])
                is_seed = np.ones(len(pos), bool)
                passed, found = emit(pos, seed_keys[some].astype(np.int64), np.asarray(seed_lcp[some]), is_seed)
                queue.push(found)
                yield pos, passed, is_seed
            next_seed = seed_end
            continue
        active = np.concatenate([np.empty(0, TUPLE), *queue.take(part)])
        active = active[np.argsort(active["key"], kind="stable")]
        size = 1024
        while len(active) or next_seed < seed_end:
            mine = active[:size]
            more = slice(next_seed, min(next_seed + size, seed_end))
            some = np.asarray(seeds[more])
            pos = np.concatenate([mine["pos"].astype(np.int64), some])
            key = np.concatenate([mine["key"].astype(np.int64), seed_keys[more].astype(np.int64)])
            lcp = np.concatenate([mine["lcp"], np.asarray(seed_lcp[more])])
            is_seed = np.zeros(len(pos), bool)
            is_seed[len(mine) :] = True
            # Keys beyond either cut may not be complete here.
            bound = top + 1
            if len(mine) < len(active):
                bound = min(bound, int(mine["key"][-1]))
            if more.stop < seed_end:
                bound = min(bound, int(seed_keys[more.stop - 1]))
            order = np.argsort(2 * key + is_seed, kind="stable")
            pos, key, lcp, is_seed = pos[order], key[order], lcp[order], is_seed[order]
            previous = np.maximum(pos - 1, 0)
            induced = np.where((pos > 0) & wanted[previous], keys[previous].astype(np.int64), width)
            least = np.minimum.accumulate(np.append(width, induced[:-1]))
            stop = np.flatnonzero((key >= least) | (key >= bound))
            count = int(stop[0]) if len(stop) else len(key)
            if not count or (key[0] == induced[:count]).any():
                # The first key goes on its own: induced suffixes up to its own kind's next, then seeds.
                own = (key == key[0]) & (is_seed == is_seed[0])
                count = max(1, int(np.argmin(own)) if not own.all() else len(own))
            seeds_taken = int(is_seed[:count].sum())
            passed, found = emit(pos[:count], key[:count], lcp[:count], is_seed[:count])
            yield pos[:count], passed, is_seed[:count]
            active = active[count - seeds_taken :]
            next_seed += seeds_taken
            inside = int(np.searchsorted(found["key"], top, "right"))
            if inside:
                where = np.searchsorted(active["key"], found["key"][:inside], "right")
                active = np.insert(active, where, found[:inside])
            queue.push(found[inside:])
            size = max(1024, min(BLOCK, 2 * count))


def several(text: np.ndarray) -> np.ndarray:
    """From each place the next characters, as many as fit 64 bits, in one number; zeros after the end."""
    each = text.dtype.itemsize
    whole = np.zeros(len(text), np.uint64)
    for step in range(8 // each):
        whole <<= np.uint64(8 * each)
        whole[: len(text) - step] |= text[step:].astype(np.uint64)
    return whole


def extended(
    text: np.ndarray, together: np.ndarray, left: np.ndarray, right: np.ndarray, start: np.ndarray, cap: int
) -> np.ndarray:
    """Common prefixes of pairs of suffixes, known to be at least ``start``, up to ``cap``.

    ``together`` is ``several(text)``: characters are compared several at a time as far as all agree, then one by one.
    """
    length = np.minimum(start, cap).astype(np.int64)
    end = len(text) - 1
    step = 8 // text.dtype.itemsize
    active = np.flatnonzero(length + step <= cap)
    while len(active):
        a, b = left[active] + length[active], right[active] + length[active]
        same = (np.maximum(a, b) + step - 1 <= end) & (together[np.minimum(a, end)] == together[np.minimum(b, end)])
        active = active[same]
        length[active] += step
        active = active[length[active] + step <= cap]
    active = np.flatnonzero(length < cap)
    while len(active):
        a, b = left[active] + length[active], right[active] + length[active]
        same = (np.maximum(a, b) <= end) & (text[np.minimum(a, end)] == text[np.minimum(b, end)])
        active = active[same]
        length[active] += 1
        active = active[length[active] < cap]
    return length.astype(np.uint8)


def _doubling(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a string in memory, by doubling the ranks of those that are not told apart."""
    size = len(text)
    order = np.argsort(text, kind="stable")
    fresh = np.append(True, text[order][1:] != text[order][:-1])
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(size), 0))
    alike = ~(fresh & np.append(fresh[1:], True))
    places = np.flatnonzero(alike)  # where in the order suffixes are not told apart
    span = 1
    while len(places):
        who = order[places]
        ahead = who + span
        key = np.where(ahead < size, rank[np.minimum(ahead, size - 1)] + 1, 0)
        group = rank[who]
        new = np.argsort(group * (size + 1) + key, kind="stable")
        who, group, key = who[new], group[new], key[new]
        order[places] = who
        fresh = np.append(True, (group[1:] != group[:-1]) | (key[1:] != key[:-1]))
        rank[who] = np.maximum.accumulate(np.where(fresh, places, 0))
        places = places[~(fresh & np.append(fresh[1:], True))]
        span *= 2
    lcp = np.zeros(size, np.uint8)
    lcp[1:] = extended(text, several(text), order[1:], order[:-1], np.zeros(size - 1, np.int64), cap)
    return order, lcp


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are of type S, and how often each character is repeated from its place."""
    size = len(text)
    change = np.append(np.flatnonzero(text[1:] != text[:-1]), size - 1)
    lengths = np.diff(np.append(-1, change))
    rises = np.append(text[change[:-1] + 1] > text[change[:-1]], True)
    is_s = np.repeat(rises, lengths)
    runs = np.minimum(np.repeat(change, lengths) - np.arange(size) + 1, 255).astype(np.uint8)
    return is_s, runs


def _names(text: np.ndarray, is_s: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Order-keeping names of the substrings from each seed to the next.

    Substrings are read in chunks from their end; a chunk and the name of what follows it make a name.
    A character's code has its type, so no substring is a prefix of another.
    """
    bits = int(2 * int(text.max()) + 1).bit_length()
    chunk = max(1, 62 // bits)
    lengths = np.append(np.diff(seeds), 0) + 1
    chunks = -(-lengths // chunk)
    following = np.zeros(len(seeds), np.int64)
    names = following
    for at in range(int(chunks.max()) - 1, -1, -1):
        who = np.flatnonzero(chunks > at) if at else np.arange(len(seeds))
        packed = np.zeros(len(who), np.int64)
        for step in range(at * chunk, at * chunk + chunk):
            place = seeds[who] + step
            inside = step < lengths[who]
            place = np.minimum(place, len(text) - 1)
            code = np.where(inside, 2 * text[place].astype(np.int64) + is_s[place], 0)
            packed = (packed << bits) | code
        if at == int(chunks.max()) - 1:
            found = np.unique(packed, return_inverse=True)[1] + 1
        else:
            follow = following[who]
            order = np.lexsort((follow, packed))
            fresh = np.append(
                True,
                (packed[order][1:] != packed[order][:-1]) | (follow[order][1:] != follow[order][:-1]),
            )
            found = np.empty(len(who), np.int64)
            found[order] = np.cumsum(fresh)
        following = np.zeros(len(seeds), np.int64)
        following[who] = found
        names = following
    return names - 1


def suffix_order(
    text: np.ndarray, cap: int, arena: Arena, names_in_memory: int = NAMES_IN_MEMORY
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the one before it (at most ``cap``).

    The last character must be the least and occur once; ``cap`` is at most 255.  A string of at most
    ``names_in_memory`` names is sorted in memory, a longer one by recursion.
    """
    size = len(text)
    if size < 4:
        return _doubling(text, cap)
    is_s, runs = _types(text)
    seeds = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    names = _names(text, is_s, seeds)
    count = len(seeds)
    if int(names.max()) + 1 == count:
        order = np.empty(count, np.int64)
        order[names] = np.arange(count)
        shared = np.zeros(count, np.uint8)
    else:
        sort = _doubling if count <= names_in_memory else suffix_order
        more = () if count <= names_in_memory else (arena, names_in_memory)
        order, shared = sort(names.astype(np.uint32), cap, *more)
    del names
    # Prefixes in names become prefixes in characters: whole substrings, then what the next two share.
    sorted_seeds = seeds[order]
    lcp = np.zeros(count, np.uint8)
    together = several(text)
    for low in range(1, count, BLOCK):
        part = slice(low, low + BLOCK)
        reach = np.minimum(order[part] + shared[part], count - 1)
        start = seeds[reach] - seeds[order[part]]
        before = seeds[order[low - 1 : min(low + BLOCK, count) - 1]]
        lcp[part] = extended(text, together, sorted_seeds[part], before, start, cap)
    del order, shared, together
    # Up: seeds induce the L suffixes.
    total = int(size - is_s.sum())
    large = arena.array(total, np.int64)
    large_lcp = arena.array(total, np.uint8)
    at = 0
    for pos, passed, is_seed in induce(text, ~is_s, sorted_seeds, lcp, runs, cap, arena):
        own = ~is_seed
        many = int(own.sum())
        large[at : at + many] = pos[own]
        large_lcp[at : at + many] = passed[own]
        at += many
    del sorted_seeds, lcp
    # Down: the L suffixes, greatest first, induce the S suffixes.
    flipped = (int(text.max()) - text.astype(np.int64)).astype(text.dtype)
    downward = np.zeros(total, np.uint8)
    downward[1:] = large_lcp[:0:-1]
    result = arena.array(size, np.int64)
    result_lcp = arena.array(size, np.uint8)
    at = size
    for pos, passed, _ in induce(flipped, is_s, large[::-1], downward, runs, cap, arena):
        many = len(pos)
        result[at - many : at] = pos[::-1]
        # A suffix's prefix with the one that passed before it, which is the next greater one.
        stop = at - many + 1
        result_lcp[stop : at + 1 if at < size else at] = passed[::-1][: len(result_lcp[stop : at + 1])] if at < size else passed[::-1][:-1]
        at -= many
    result[0] = size - 1
    result_lcp[0] = 0
    result_lcp[1] = 0
    return result, result_lcp
