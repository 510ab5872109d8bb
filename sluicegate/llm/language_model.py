"""A trigram language model in a sharded Elias-Fano trie, and the scores of texts under it.

Training counts words, then pairs, then triples, each over all training texts.  A task adds up what it has
seen and sends sorted, packed blocks to the shards of the trie; a shard merges its blocks and writes one
file.  Words are numbered in the order of their hashes.  A triple's last word is numbered among the successors of
its middle word, so its numbers are small; pairs and triples seen once are kept.  Smoothing is absolute discounting, interpolated with the next shorter history down to
add-one words.  Logarithms are quantised to a byte.

The files lie in the shared scratch folder.  Scoring maps them into memory, where all tasks of a machine share their
pages; on a file system that cannot be mapped a worker first copies them, and the copy has no name.
Nothing passes through the driver but the shards' sizes.

Null and empty texts are one token, the end.  Very long texts are scored whole.  Null ids are scored and learnt
from as the caller's condition says.  Repeated rows count each time.  An empty table gives no rows, and
with nothing to learn from every probability is one.
"""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.frames import Chunk, chunks, lowered, word_hashes
from sluicegate.llm.trie import Level, level, pack, quantised, unpack
from sluicegate.session import shared_scratch

END = np.uint64(0x5DEECE66D1234567)
LEAST_COUNT = 1
# Places of pairs take the upper half of a signed key.
MOST_PAIRS = 1 << 31
DISCOUNT = 0.75
# Keys a task holds before it sends its blocks, and text scored at a time.
HELD_KEYS = 3_000_000
SCORED_BYTES = 6 << 20


def tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and where each text's begin; a text's last token is its end."""
    begin, end, first = chunk.words()
    codes = np.insert(word_hashes(lowered(chunk.data), begin, end), first[1:], END)
    return codes, first + np.arange(len(first))


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, so that equal high bytes stand together and pack well."""
    width = values.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def _unplanes(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _blocks(
    docs: DataFrame, keys_of: Callable[[Chunk], np.ndarray], shard_of: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """Counted keys of all texts as packed blocks by shard."""

    def sent(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        shard = shard_of(keys)
        first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        bounds = np.append(first, len(keys))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(shard[first].astype(np.int32)),
                pa.array([_planes(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in zip(bounds, bounds[1:])]),
                pa.array([_planes(counts[a:b].astype(np.uint32)) for a, b in zip(bounds, bounds[1:])]),
            ],
            ["shard", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for chunk in chunks(batch.column(0), SCORED_BYTES):
                keys = keys_of(chunk)
                held.append(added(keys, np.ones(len(keys), np.int64)))
                size += len(held[-1][0])
                if size > HELD_KEYS:
                    keys, counts = added(*(np.concatenate(x) for x in zip(*held)))
                    held, size = [], 0
                    if len(keys):
                        yield sent(keys, counts)
        if held:
            keys, counts = added(*(np.concatenate(x) for x in zip(*held)))
            if len(keys):
                yield sent(keys, counts)

    return docs.mapInArrow(run, "shard int, keys binary, counts binary")


def _merged(
    blocks: DataFrame, shards: int, build: Callable[[int, np.ndarray, np.ndarray], int]
) -> dict[int, tuple[int, int]]:
    """Merge each shard's blocks and build its file; the size that each build reports, and the total count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def finish() -> pa.RecordBatch:
            keys, counts = added(*(np.concatenate(x) for x in zip(*held)))
            size = build(shard, keys, counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([size]), pa.array([int(counts.sum())])],
                ["shard", "size", "total"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if held:
                        yield finish()
                    shard, held = row["shard"], []
                keys = np.cumsum(_unplanes(row["keys"], np.uint64), dtype=np.uint64)
                held.append((keys, _unplanes(row["counts"], np.uint32).astype(np.int64)))
        if held:
            yield finish()

    sizes = (
        blocks.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, "shard int, size long, total long")
    )
    return {row["shard"]: (row["size"], row["total"]) for row in sizes.collect()}


def _filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def _write(uri: str, data: bytes) -> None:
    """Write a file whole: a reader or a second attempt never meets a part of it."""
    system, path = _filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    partial = f"{path}.{np.random.default_rng().integers(1 << 62)}"
    with system.open_output_stream(partial) as out:
        out.write(data)
    system.move(partial, path)


@functools.lru_cache(maxsize=4096)
def _mapped(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a model file, mapped into memory."""
    system, path = _filesystem(uri)
    if isinstance(system, pyarrow.fs.LocalFileSystem):
        return unpack(np.memmap(path, np.uint8, "r"))
    with tempfile.TemporaryFile() as copy, system.open_input_stream(path) as source:
        while data := source.read(1 << 22):
            copy.write(data)
        copy.flush()
        return unpack(np.memmap(copy, np.uint8, "r"))


@dataclass
class Model:
    """Where the shards lie and how large they are."""

    folder: str
    shards: int
    word_starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    pair_starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    triples: frozenset[int] = frozenset()
    tokens: int = 0

    @property
    def vocabulary(self) -> int:
        return int(self.word_starts[-1])

    def file(self, kind: str, shard: int) -> str:
        return f"{self.folder}/{kind}-{shard}.bin"

    def hash_shard(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64)

    def pair_shard(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.word_starts, (keys >> np.uint64(32)).astype(np.int64), "right") - 1

    def triple_shard(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.pair_starts, (keys >> np.uint64(32)).astype(np.int64), "right") - 1

    @staticmethod
    def _each(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Runs of equal shards, which come in order."""
        first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
        for a, b in zip(first, np.append(first[1:], len(shard)) if len(shard) else []):
            yield int(shard[a]), slice(int(a), int(b))

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and training count of each word; unknown ones have -1 and 0."""
        known, inverse = np.unique(hashes, return_inverse=True)
        number, count = np.full(len(known), -1, np.int64), np.zeros(len(known), np.int64)
        for shard, part in self._each(self.hash_shard(known)):
            if self.word_starts[shard] == self.word_starts[shard + 1]:
                continue
            arrays = _mapped(self.file("words", shard))
            at = np.minimum(np.searchsorted(arrays["hash"], known[part]), len(arrays["hash"]) - 1)
            hit = arrays["hash"][at] == known[part]
            number[part] = np.where(hit, at + self.word_starts[shard], -1)
            count[part] = np.where(hit, arrays["count"][at], 0)
        return number[inverse], count[inverse]

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Training counts of words by number; numbers need not be sorted."""
        found = np.zeros(len(numbers), np.int64)
        order = np.argsort(numbers, kind="stable")
        own = numbers[order]
        for shard, part in self._each(np.searchsorted(self.word_starts, own, "right") - 1):
            arrays = _mapped(self.file("words", shard))
            found[order[part]] = arrays["count"][own[part] - self.word_starts[shard]]
        return found

    def log_word(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.vocabulary + 1))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place of each pair (or -1), its number among its word's successors, and logarithms.

        The logarithms are that of the pair (zero where it is not held) and the back-off of its first word.
        """
        keys = np.where((left >= 0) & (right >= 0), (left << 32) | np.maximum(right, 0), np.where(left >= 0, (left << 32) | 0xFFFFFFFF, -1))
        known, inverse = np.unique(keys, return_inverse=True)
        size = len(known)
        place, rank = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        chance, back = np.zeros(size, np.float32), np.zeros(size, np.float32)
        first = int(np.searchsorted(known, 0))
        own, word = known[first:] >> 32, known[first:] & 0xFFFFFFFF
        for shard, part in self._each(np.searchsorted(self.word_starts, own, "right") - 1):
            if self.pair_starts[shard] == self.pair_starts[shard + 1]:
                continue
            arrays = _mapped(self.file("pairs", shard))
            held = Level(arrays)
            context = own[part] - self.word_starts[shard]
            at, begin = held.find(context, word[part])
            hit = at >= 0
            goal = slice(first + part.start, first + part.stop)
            place[goal] = np.where(hit, at + self.pair_starts[shard], -1)
            rank[goal] = np.where(hit, at - begin, -1)
            chance[goal] = np.where(hit, arrays["chances"][arrays["chance"][np.maximum(at, 0)]], 0)
            back[goal] = arrays["backs"][arrays["back"][context]]
        return place[inverse], rank[inverse], chance[inverse], back[inverse]

    def triples_of(self, pair: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each triple is held, its logarithm, and the back-off of its pair."""
        keys = np.where(pair >= 0, (pair << 32) | np.where(rank >= 0, rank, 0xFFFFFFFF), -1)
        known, inverse = np.unique(keys, return_inverse=True)
        size = len(known)
        hits, chance, back = np.zeros(size, bool), np.zeros(size, np.float32), np.zeros(size, np.float32)
        first = int(np.searchsorted(known, 0))
        own, word = known[first:] >> 32, known[first:] & 0xFFFFFFFF
        for shard, part in self._each(np.searchsorted(self.pair_starts, own, "right") - 1):
            if shard not in self.triples:
                continue
            arrays = _mapped(self.file("triples", shard))
            context = own[part] - self.pair_starts[shard]
            at, _ = Level(arrays).find(context, word[part])
            goal = slice(first + part.start, first + part.stop)
            hits[goal] = at >= 0
            chance[goal] = np.where(at >= 0, arrays["chances"][arrays["chance"][np.maximum(at, 0)]], 0)
            back[goal] = arrays["backs"][arrays["back"][context]]
        return hits[inverse], chance[inverse], back[inverse]

    def successor_chance(self, words: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Logarithms of pairs, given the first word and the second's number among its successors."""
        found = np.zeros(len(words), np.float32)
        order = np.argsort(words, kind="stable")
        own = words[order]
        for shard, part in self._each(np.searchsorted(self.word_starts, own, "right") - 1):
            arrays = _mapped(self.file("pairs", shard))
            held, which = np.unique(own[part] - self.word_starts[shard], return_inverse=True)
            at = Level(arrays).pointers[held][which] + rank[order[part]]
            found[order[part]] = arrays["chances"][arrays["chance"][at]]
        return found


def _inside(first: np.ndarray, count: int, skip: int) -> np.ndarray:
    """Tokens with at least ``skip`` tokens of their text before them."""
    inside = np.ones(count, bool)
    for step in range(skip):
        at = first[:-1] + step
        inside[at[at < first[1:]]] = False
    return np.flatnonzero(inside)


def _starts(sizes: dict[int, int], shards: int) -> np.ndarray:
    return np.concatenate(([0], np.cumsum([sizes.get(i, 0) for i in range(shards)]))).astype(np.int64)


def _discounted(context: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Discounted shares of the successors held, and what each context leaves to its back-off."""
    share = (counts - DISCOUNT) / totals[context]
    left = 1 - np.bincount(context, share, len(totals))
    return share, np.clip(left, 1e-7, 1)


def train(docs: DataFrame, text_column: str = "text", shards: int | None = None) -> Model:
    """Count the texts and write the trie; its shards follow the session's shuffle width."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_scratch(spark, "language-model"))
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = "file://" + folder[len("file:") :]
    model = Model(folder, shards)
    texts = docs.select(F.col(text_column).cast("string").alias("text"))

    def build_words(shard: int, keys: np.ndarray, counts: np.ndarray) -> int:
        _write(model.file("words", shard), pack({"hash": keys, "count": counts.astype(np.uint64)}))
        return len(keys)

    words = _blocks(texts, lambda chunk: tokens(chunk)[0], model.hash_shard)
    sizes = _merged(words, shards, build_words)
    model.word_starts = _starts({shard: size for shard, (size, _) in sizes.items()}, shards)
    model.tokens = sum(total for _, total in sizes.values())
    if not model.vocabulary:
        return model
    counted = model

    def pair_keys(chunk: Chunk) -> np.ndarray:
        codes, first = tokens(chunk)
        number, _ = counted.words(codes)
        at = _inside(first, len(codes), 1)
        return ((number[at - 1] << 32) | number[at]).astype(np.uint64)

    def build_pairs(shard: int, keys: np.ndarray, counts: np.ndarray) -> int:
        keep = counts >= LEAST_COUNT
        keys, counts = keys[keep], counts[keep]
        if not len(keys):
            return 0
        base = counted.word_starts[shard]
        contexts = int(counted.word_starts[shard + 1] - base)
        context = (keys >> np.uint64(32)).astype(np.int64) - base
        word = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        totals = _mapped(counted.file("words", shard))["count"].astype(np.int64)
        share, left = _discounted(context, counts, totals)
        lower = 10.0 ** counted.log_word(counted.counts(word))
        chance, chances = quantised(np.log10(share + left[context] * lower))
        back, backs = quantised(np.log10(left))
        arrays = level(context, word, contexts, counted.vocabulary) | {
            "chance": chance, "chances": chances, "back": back, "backs": backs, "count": counts.astype(np.uint32 if counts.max() < 1 << 32 else np.uint64),
        }
        _write(counted.file("pairs", shard), pack(arrays))
        return len(keys)

    pairs = _blocks(texts, pair_keys, model.pair_shard)
    sizes = {shard: size for shard, (size, _) in _merged(pairs, shards, build_pairs).items()}
    paired = Model(folder, shards, model.word_starts, _starts(sizes, shards), frozenset(), model.tokens)
    if paired.pair_starts[-1] >= MOST_PAIRS:
        raise ValueError(f"{paired.pair_starts[-1]} distinct pairs of words; keys of triples hold {MOST_PAIRS}")

    def triple_keys(chunk: Chunk) -> np.ndarray:
        codes, first = tokens(chunk)
        number, _ = paired.words(codes)
        at = _inside(first, len(codes), 1)
        place = np.full(len(codes), -1, np.int64)
        rank = np.full(len(codes), -1, np.int64)
        place[at], rank[at], _, _ = paired.pairs(number[at - 1], number[at])
        at = _inside(first, len(codes), 2)
        at = at[(place[at - 1] >= 0) & (place[at] >= 0)]
        return ((place[at - 1] << 32) | rank[at]).astype(np.uint64)

    def build_triples(shard: int, keys: np.ndarray, counts: np.ndarray) -> int:
        keep = counts >= LEAST_COUNT
        keys, counts = keys[keep], counts[keep]
        if not len(keys):
            return 0
        arrays = _mapped(paired.file("pairs", shard))
        totals = arrays["count"].astype(np.int64)
        context = (keys >> np.uint64(32)).astype(np.int64) - paired.pair_starts[shard]
        rank = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        share, left = _discounted(context, counts, totals)
        # The shorter history of a triple is the pair of its last two words.
        held, inverse = np.unique(context, return_inverse=True)
        middle = Level(arrays).words_at(held)[inverse]
        lower = 10.0 ** paired.successor_chance(middle, rank)
        chance, chances = quantised(np.log10(share + left[context] * lower))
        back, backs = quantised(np.log10(left))
        _write(
            paired.file("triples", shard),
            pack(
                level(context, rank, len(totals), 0)
                | {"chance": chance, "chances": chances, "back": back, "backs": backs}
            ),
        )
        return len(keys)

    sizes = _merged(_blocks(texts, triple_keys, paired.triple_shard), shards, build_triples)
    paired.triples = frozenset(shard for shard, (size, _) in sizes.items() if size)
    return paired


def score(
    docs: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: the id, ``n_tokens``, ``n_known``, ``base_score`` (add-one words), and ``score`` (the model's)."""

    def of(chunk: Chunk) -> list[pa.Array]:
        codes, first = tokens(chunk)
        number, count = model.words(codes)
        word = model.log_word(count)
        begin = first[:-1]
        total = word.copy()
        at = _inside(first, len(codes), 1)
        place, rank = np.full(len(codes), -1, np.int64), np.full(len(codes), -1, np.int64)
        place[at], rank[at], chance, back = model.pairs(number[at - 1], number[at])
        total[at] = np.where(place[at] >= 0, chance, back + word[at])
        at = _inside(first, len(codes), 2)
        hit, chance, back = model.triples_of(place[at - 1], rank[at])
        total[at] = np.where(hit, chance, back + total[at])
        return [
            pa.array(np.diff(first)),
            pa.array(np.add.reduceat((count > 0).astype(np.int64), begin)),
            pa.array(np.add.reduceat(word, begin)),
            pa.array(np.add.reduceat(total, begin)),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), SCORED_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[chunk.rows], *of(chunk)],
                    [id_column, "n_tokens", "n_known", "base_score", "score"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, F.col(text_column).cast("string").alias("text")).mapInArrow(
        run, f"`{id_column}` {kind}, n_tokens long, n_known long, base_score double, score double"
    )


def fit_and_score(
    docs: DataFrame, learnt: Column, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Learn from the rows for which ``learnt`` holds and score all rows; adds ``train_tokens``."""
    model = train(docs.where(learnt), text_column)
    return score(docs, model, id_column=id_column, text_column=text_column).withColumn(
        "train_tokens", F.lit(model.tokens).cast("long")
    )
