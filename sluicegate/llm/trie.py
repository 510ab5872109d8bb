"""A compact n-gram trie in flat arrays, made to be memory-mapped.

Values that only grow are held in Elias-Fano form: their low bits in a packed array and their high bits as gaps in
unary, with the place of every eighth mark.  A level of the trie has, for each n-gram in order of its
context, the number of its last word, and a probability and a back-off weight as one-byte codes into a
table of quantised logarithms.  Pointers say where each context's successors begin; they only
grow.  The numbers of words grow within a context, and summed with the base of their context they grow
over the whole level, so both are Elias-Fano.

A query starts from the range of successors of its context and searches it for its word.  Words are numbered by their
hashes, so a context's successors lie about evenly and the search goes where the word should stand.  Reads touch only the
pages that hold what they ask for.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8
# Rounds after which a search halves its range, should its numbers not lie evenly.
EVEN_ROUNDS = 6
_SELECT = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    _bits = [i for i in range(8) if _byte >> i & 1]
    _SELECT[_byte, : len(_bits)] = _bits
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_EACH = np.uint64(0x0101010101010101)
_TOPS = np.uint64(0x8080808080808080)


class EliasFano:
    """A sequence of numbers that never falls."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.size, self.low_bits = (int(x) for x in arrays[f"{name}.head"])
        self.low = arrays[f"{name}.low"]
        self.high = arrays[f"{name}.high"]
        self.marks = arrays[f"{name}.marks"]

    @staticmethod
    def encode(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        """The arrays of a sequence."""
        values = np.asarray(values, np.uint64)
        size = len(values)
        top = int(values[-1]) + 1 if size else 1
        low_bits = max(0, (top // max(size, 1)).bit_length() - 1)
        bits = np.zeros(((size * low_bits + 63) // 64 + 1) * 64, np.uint8)
        if low_bits and size:
            wide = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            bits[: size * low_bits] = wide.astype(np.uint8).ravel()
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(size)
        high = np.zeros((int(place[-1]) // 64 + 2) * 64 if size else 64, np.uint8)
        high[place] = 1
        return {
            f"{name}.head": np.array([size, low_bits], np.int64),
            f"{name}.low": np.packbits(bits, bitorder="little").view(np.uint64),
            f"{name}.high": np.packbits(high, bitorder="little").view(np.uint64),
            f"{name}.marks": place[::SAMPLE].astype(np.int64),
        }

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The values at some places."""
        at = np.asarray(at, np.int64)
        place = self._select(at)
        value = (place - at).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bit = at * self.low_bits
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            part = self.low[word] >> shift
            rest = self.low[word + 1] << (np.uint64(63) - shift) << np.uint64(1)
            value |= (part | rest) & np.uint64((1 << self.low_bits) - 1)
        return value.astype(np.int64)

    def _select(self, at: np.ndarray) -> np.ndarray:
        """Where the mark of each number stands: from its sample word by word, then within the word."""
        start = self.marks[at // SAMPLE]
        left = (at % SAMPLE).astype(np.uint64)
        word = start >> 6
        value = self.high[word] & (_ALL << (start & 63).astype(np.uint64))
        ones = np.bitwise_count(value)
        behind = np.flatnonzero(ones <= left)
        while len(behind):
            left[behind] -= ones[behind]
            word[behind] += 1
            value[behind] = self.high[word[behind]]
            ones[behind] = np.bitwise_count(value[behind])
            behind = behind[ones[behind] <= left[behind]]
        # Marks up to and with each byte, in the bytes of a number; those not above ``left`` are passed.
        sums = value - ((value >> np.uint64(1)) & np.uint64(0x5555555555555555))
        pairs = np.uint64(0x3333333333333333)
        sums = (sums & pairs) + ((sums >> np.uint64(2)) & pairs)
        sums = ((sums + (sums >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH
        passed = np.bitwise_count(((left * _EACH) | _TOPS) - sums & _TOPS).astype(np.uint64)
        shift = passed << np.uint64(3)
        before = ((sums << np.uint64(8)) >> shift) & np.uint64(0xFF)
        byte = (value >> shift) & np.uint64(0xFF)
        return word * 64 + (shift + _SELECT[byte, left - before]).astype(np.int64)


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays as one file: a text header, then each at a multiple of 64 bytes."""
    lines, body, at = [], [], 0
    for name, array in arrays.items():
        data = np.ascontiguousarray(array).tobytes()
        lines.append(f"{name} {array.dtype.str} {len(array)} {at}")
        gap = -len(data) % 64
        body += [data, b"\0" * gap]
        at += len(data) + gap
    head = "\n".join(lines).encode()
    head += b" " * (-(len(head) + 8) % 64)
    return len(head).to_bytes(8, "little") + head + b"".join(body)


def unpack(data: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a file, as views of it."""
    data = data.view(np.ndarray)  # a mapped array is slower to index than a plain view of it
    length = int.from_bytes(bytes(data[:8]), "little")
    found = {}
    for line in bytes(data[8 : 8 + length]).decode().split("\n"):
        name, kind, size, at = line.split()
        begin = 8 + length + int(at)
        found[name] = data[begin : begin + int(size) * np.dtype(kind).itemsize].view(kind)
    return found


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-byte codes and the table of logarithms they stand for: means of equally filled bins."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.float32)
    edges = np.unique(np.quantile(values, np.linspace(0, 1, 257)[1:-1], method="lower"))
    codes = np.searchsorted(edges, values)
    count = np.bincount(codes, minlength=len(edges) + 1)
    mean = np.bincount(codes, values, len(edges) + 1) / np.maximum(count, 1)
    return codes.astype(np.uint8), mean.astype(np.float32)


def level(context: np.ndarray, word: np.ndarray, contexts: int, vocabulary: int) -> dict[str, np.ndarray]:
    """Pointers and successors of the n-grams (context, word), sorted by both."""
    pointers = np.searchsorted(context, np.arange(contexts + 1))
    lengths = np.diff(pointers)
    # Within a context numbers grow; a new context begins from where the last one ended.
    last = np.zeros(contexts, np.int64)
    have = lengths > 0
    last[have] = word[pointers[1:][have] - 1] + 1
    base = np.concatenate(([0], np.cumsum(last)))
    return EliasFano.encode(pointers, "pointers") | EliasFano.encode(word + base[context], "words")


class Level:
    """One level of a trie, to search."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.pointers = EliasFano(arrays, "pointers")
        self.words = EliasFano(arrays, "words")

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each (context, word), or -1, and where the context's successors begin.

        Contexts below zero have no successors.
        """
        result, begin = np.full(len(context), -1, np.int64), np.zeros(len(context), np.int64)
        who = np.flatnonzero(context >= 0)
        if not len(who) or not self.words.size:
            return result, begin
        # A context's own figures are looked up once, as a frequent one lies behind a long gap.
        own, which = np.unique(context[who], return_inverse=True)
        lows, highs = self.pointers[own], self.pointers[own + 1]
        bases = np.where(lows > 0, self.words[np.maximum(lows - 1, 0)] + 1, 0)
        tops = self.words[np.maximum(highs - 1, 0)]
        low, high, base, top = lows[which], highs[which], bases[which], tops[which]
        begin[who] = low
        # A context's numbers are relative to the last value of the contexts before it.
        wanted = word[who] + base
        have = (high > low) & (wanted <= top)
        who, wanted, first, last = who[have], wanted[have], low[have], high[have] - 1
        # The numbers just before the first place and at the last one.
        less, more = base[have] - 1, top[have]
        rounds = 0
        while len(who):
            rounds += 1
            if rounds > EVEN_ROUNDS:
                middle = (first + last) >> 1
            else:
                share = (wanted - less - 1) / (more - less)
                middle = np.minimum(first + (share * (last - first + 1)).astype(np.int64), last)
            found = self.words[middle]
            hit = found == wanted
            result[who[hit]] = middle[hit]
            under = found < wanted
            first, less = np.where(under, middle + 1, first), np.where(under, found, less)
            last, more = np.where(under, last, middle - 1), np.where(under, more, found)
            left = np.flatnonzero(~hit & (first <= last))
            who, wanted, first, last, less, more = (x[left] for x in (who, wanted, first, last, less, more))
        return result, begin

    def words_at(self, places: np.ndarray) -> np.ndarray:
        """The word of the n-gram at each place."""
        every = self.pointers[np.arange(self.pointers.size)]
        low = every[np.searchsorted(every, places, "right") - 1]
        base = np.where(low > 0, self.words[np.maximum(low - 1, 0)] + 1, 0)
        return self.words[places] - base
