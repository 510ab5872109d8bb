"""Spelling variants: words one edit apart, found by pivotal grams, and the form each goes back to.

Every word is cut into bigrams, ordered by how many places of the vocabulary hold them, the rarest first.  A word's
prefix is its bigrams up to the third of that order, ties included.  Among them a dynamic program chooses two
disjoint ones of the least total frequency, the pivots.  One edit spoils at most one of two disjoint bigrams, so if
two words are one edit apart, a pivot of the one whose prefix ends earlier in the order stands in the prefix
of the other.  Pivots are therefore looked up among prefixes, by length and by place: an edit behind a bigram leaves
its place and all before it, one before it leaves its distance from the end and all behind it.  That is an equi-join
on the length and the hash of the untouched side with the bigram.  Each pair found is verified by its edit distance,
unless their sets of letters, as bits of a number, differ in more than two, which no single edit can bring about.

A bigram's share of the vocabulary does not matter, as words choose their rarest ones; the skewed rest is split by adaptive
execution.  The table of bigrams is held by every task: it has at most the square of the letters' number.

Words are counted over whole texts.  Null and empty texts have no words; repeated rows count each time; words in
rows without an id are never altered.  An empty table gives no rows.  Names of further columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.frames import stored

LETTERS = "A-Za-zÀ-ÿ"
RUN = re.compile(f"[{LETTERS}]+")
# Distinct letters after lower-casing, which bounds the number of bigrams.
ALPHABET = 26 + 64
GRAM = 2
EDITS = 1
# A word of four letters has three bigrams, enough for two disjoint ones.
LEAST_LETTERS = GRAM * EDITS + GRAM
HELD_WORDS = 400_000
# Differences in length of words one edit apart.
LONGER = (-1, 0, 1)


def altered(word: str, seed: int, divisor: int) -> str:
    """The word, or where ``divisor`` divides its checksum after ``seed`` the word without one letter."""
    check = zlib.crc32(word.encode(), seed)
    if check % divisor:
        return word
    at = check % len(word)
    return word[:at] + word[at + 1 :]


def count_words(
    docs: DataFrame,
    least_letters: int,
    least_count: int,
    typo_divisor: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Words of enough letters and their number ``n``, lower-cased from A to Z.

    With ``typo_divisor`` a letter is taken out of those runs that ``altered`` chooses by document.
    """

    def blocks(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                # Bytes change case from A to Z alone.
                found = Counter(RUN.findall(text.encode().lower().decode()))
                if typo_divisor and key is not None:
                    seed = zlib.crc32(f"{key}:".encode())
                    for word in list(found):
                        if (changed := altered(word, seed, typo_divisor)) is not word:
                            held[changed] += found.pop(word)
                for word, n in found.items():
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield blocks(held)
                    held = Counter()
        yield blocks(held)

    rows = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text_column}`").alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").where(F.length("word") >= least_letters)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank, rarest first, and frequency of every bigram; at most the alphabet's square."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                counts.update(map(str.__add__, word, word[1:]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"]
        )

    counted = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counted.limit(ALPHABET**GRAM + 1).collect()
    if len(rows) > ALPHABET**GRAM:
        raise ValueError("the words have letters beyond the alphabet")
    order = sorted((row["n"], row["gram"]) for row in rows)
    return {gram: (rank, n) for rank, (n, gram) in enumerate(order)}


def pivots(places: Sequence[int], costs: Sequence[int], wanted: int = EDITS + 1) -> list[int]:
    """Indices of ``wanted`` disjoint bigrams of the least total cost; places ascend."""
    # best[k] after each bigram: the least cost of k disjoint ones up to it, and which.
    before = [(0, ())] + [None] * wanted
    history = []
    for at, (place, cost) in enumerate(zip(places, costs, strict=True)):
        reach = at - 1
        while reach >= 0 and places[reach] > place - GRAM:
            reach -= 1
        free = history[reach] if reach >= 0 else [(0, ())] + [None] * wanted
        now = list(before)
        for k in range(1, wanted + 1):
            if free[k - 1] is not None:
                taken = (free[k - 1][0] + cost, (*free[k - 1][1], at))
                if now[k] is None or taken < now[k]:
                    now[k] = taken
        history.append(now)
        before = now
    if before[wanted] is None:
        raise ValueError("too few disjoint bigrams")
    return list(before[wanted][1])


def signature(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[int, list[tuple[int, int, bool]]]:
    """Rank at which the prefix ends, and its bigrams: rank, place and whether a pivot."""
    known = [ranks[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(rank for rank, _ in known)[GRAM * EDITS]
    places = [i for i, (rank, _) in enumerate(known) if rank <= last]
    chosen = set(pivots(places, [known[i][1] for i in places]))
    return last, [(known[i][0], i, at in chosen) for at, i in enumerate(places)]


def letter_bits(word: str) -> int:
    """The letters that occur, as bits of a signed 64-bit number."""
    bits = 0
    for letter in set(word):
        bits |= 1 << (ord(letter) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def signatures(words: DataFrame, ranks: dict[str, tuple[int, int]]) -> DataFrame:
    """Each word's prefix, one row a bigram."""
    kind = pa.list_(pa.struct([("gram", pa.int32()), ("place", pa.int32()), ("pivot", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("word").to_pylist()
            found = [signature(word, ranks) for word in listed]
            grams = [[dict(zip(("gram", "place", "pivot"), g, strict=True)) for g in prefix] for _, prefix in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([last for last, _ in found], pa.int32()),
                    pa.array(map(letter_bits, listed), pa.int64()),
                    pa.array(grams, kind),
                ],
                ["word", "n", "last", "letters", "grams"],
            )

    rows = words.select("word", "n").mapInArrow(
        run, "word string, n long, last int, letters long, grams array<struct<gram: int, place: int, pivot: boolean>>"
    )
    return rows.select("word", "n", "last", "letters", F.length("word").alias("size"), F.inline("grams"))


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair of words one edit apart, once: ``a`` below ``b``, with their numbers."""
    grams = stored(signatures(words, gram_ranks(words)), "spelling-grams")
    # The word up to the bigram's end, and from its begin on.
    sides = (F.substring("word", F.lit(1), F.col("place") + GRAM), F.substring("word", F.col("place") + 1, F.col("size")))
    keys = F.array(*(F.xxhash64(F.lit(at), side) for at, side in enumerate(sides)))
    entries = grams.select("word", "n", "last", "letters", "size", "pivot", F.explode(keys).alias("key"))
    probes = entries.where("pivot").select(
        "key",
        F.explode(F.array(*(F.col("size") + longer for longer in LONGER))).alias("size"),
        *(F.col(c).alias(f"left_{c}") for c in ("word", "n", "last", "letters")),
    )
    met = probes.join(entries.drop("pivot"), ["key", "size"])
    verified = met.where(
        (F.col("left_last") <= F.col("last"))
        & (F.bit_count(F.col("left_letters").bitwiseXOR(F.col("letters"))) <= 2 * EDITS)
        & (F.col("left_word") != F.col("word"))
        & (F.levenshtein("left_word", "word", EDITS) == EDITS)
    )
    ends = [F.struct(F.col(f"{s}word").alias("word"), F.col(f"{s}n").alias("n")) for s in ("left_", "")]
    return verified.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """The word at the end of each word's chain of forms, by doubling steps.

    A form is at least twice as frequent as its word, so chains have fewer than 63 links and six rounds end them.
    """
    roots = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        roots = moved.drop("next")
        if moved.where("next is not null").isEmpty():
            return roots


def variants(
    docs: DataFrame,
    *,
    least_letters: int = 5,
    least_count: int = 3,
    ratio: int = 2,
    typo_divisor: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every frequent enough word with its form, its root and the number of words near it.

    A word's form is the most frequent word one edit away, the smallest among equals, if that is at
    least ``ratio`` times as frequent; its root is what the forms lead to.
    """
    if least_letters < LEAST_LETTERS:
        raise ValueError(f"words need {LEAST_LETTERS} letters for two disjoint bigrams in a prefix")
    if ratio < 2:
        raise ValueError("a form has to be at least twice as frequent, or chains may not end")
    counted = count_words(docs, least_letters, least_count, typo_divisor, id_column, text_column)
    words = stored(counted, "spelling-words")
    pairs = near_pairs(words)
    ends = F.array(F.struct(F.col("a").alias("own"), F.col("b").alias("other")), F.struct(F.col("b").alias("own"), F.col("a").alias("other")))
    sides = pairs.select(F.inline(ends)).select("own.*", F.col("other.word").alias("other"), F.col("other.n").alias("other_n"))
    best: Column = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = sides.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = -F.col("best.less") >= ratio * F.col("n")
    near = near.select(
        "word",
        "n_near",
        F.when(formed, F.col("best.form")).alias("form"),
        F.when(formed, -F.col("best.less")).alias("form_n"),
    )
    near = stored(near, "spelling-near")
    links = near.where("form is not null")
    facts = near.join(_roots(links), "word", "left")
    return words.join(facts, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
