"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word, between boundary marks and in lower case, has its character n-grams of three to five bytes and
itself as features, hashed into a fixed number of buckets.  A text is the average of the embeddings
of all its features.  Embeddings and the softmax on top are trained together, in numpy, so
a misspelling that was never seen shares the vectors of the n-grams that it kept.

The model is fitted on a bounded, hash-ordered sample of the labelled rows; its bounds are
``TRAIN_ROWS`` and, for very long texts, ``TRAIN_FEATURES`` distinct features of all its texts together.  A tenth of it chooses the number of passes.  The model's size is fixed by the number
of buckets, and once trained it folds into one weight per bucket, so scoring is one narrow pass.

Null, empty and blank texts have no features and get the score of the bias alone.  Labels that are null,
or whose document is missing, are not used; of repeated labels the highest counts, and of rows that share
an id one is trained on, by the hash of its text.
Repeated rows are scored each; a null id is scored and not held out.  An empty table, or one without
labels of both kinds, gives scores from a model with the observed rate of label 1 (or a half).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.frames import Chunk, chunks, lowered, mix, stored, word_hashes

TRAIN_ROWS = 4000
TRAIN_FEATURES = 24_000_000
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
GRAMS = (3, 4, 5)
WIDTH = 8
# Scales the average, which is small as most features of a text say nothing.
GAIN = 50.0
PASSES = 12
BATCH = 128
RATE = 0.02
DECAY = 1e-6


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature and the text it belongs to, in no particular order."""
    begin, end, first = Chunk(slice(0, len(starts) - 1), data, starts).words()
    if not len(begin):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(first))
    low = lowered(data)
    sizes = end - begin
    # Every word between marks, one after another.
    marked = np.concatenate(([0], np.cumsum(sizes + 2)))
    stream = np.full(marked[-1] + max(GRAMS), 60, np.uint8)
    stream[marked[1:] - 1] = 62
    shift = np.repeat(marked[:-1] + 1 - begin, sizes)
    inside = np.repeat(begin - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    stream[inside + shift] = low[inside]
    at = np.arange(marked[-1])
    word = np.repeat(np.arange(len(begin)), sizes + 2)
    room = marked[1:][word] - at
    packed = np.zeros(marked[-1], np.uint64)
    buckets, owners = [], []
    for size in range(1, max(GRAMS) + 1):
        packed |= stream[size - 1 : size - 1 + marked[-1]].astype(np.uint64) << np.uint64(8 * (size - 1))
        if size in GRAMS:
            whole = room >= size
            codes = mix(packed[whole] ^ np.uint64(size << 56)) >> np.uint64(64 - BUCKET_BITS)
            buckets.append(codes.astype(np.int64))
            owners.append(owner[word[whole]])
    own = word_hashes(low, begin, end) >> np.uint64(64 - BUCKET_BITS)
    return np.concatenate([*buckets, own.astype(np.int64)]), np.concatenate([*owners, owner])


@dataclass
class Model:
    """One weight per bucket, and the bias: the log odds of label 1."""

    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        buckets, owners = features(data, starts)
        texts = len(starts) - 1
        count = np.bincount(owners, minlength=texts)
        total = np.bincount(owners, self.weights[buckets], texts)
        odds = self.bias + total / np.maximum(count, 1)
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -40, 40)))


@dataclass
class Bags:
    """Averaging weights of the distinct features of each text."""

    buckets: np.ndarray
    shares: np.ndarray
    starts: np.ndarray
    labels: np.ndarray

    def take(self, rows: np.ndarray) -> Bags:
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Bags(self.buckets[at], self.shares[at], starts, self.labels[rows])

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.labels)), np.diff(self.starts))

    def averages(self, embeddings: np.ndarray) -> np.ndarray:
        owner = self.owners()
        return np.stack(
            [
                np.bincount(owner, embeddings[self.buckets, i] * self.shares, len(self.labels))
                for i in range(embeddings.shape[1])
            ],
            axis=1,
        )


class _Adam:
    def __init__(self, values: np.ndarray, rate: float):
        self.values, self.rate, self.steps = values, rate, 0
        self.mean, self.square = np.zeros_like(values), np.zeros_like(values)

    def update(self, slope: np.ndarray) -> None:
        self.steps += 1
        self.mean += 0.1 * (slope - self.mean)
        self.square += 0.001 * (slope * slope - self.square)
        mean = self.mean / (1 - 0.9**self.steps)
        square = self.square / (1 - 0.999**self.steps)
        self.values -= self.rate * mean / (np.sqrt(square) + 1e-8)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(bags: Bags, seed: int = 7) -> Model:
    """Train embeddings and softmax together; keep the pass with the least held-back loss."""
    total = len(bags.labels)
    ones = int(bags.labels.sum())
    if not total or ones in (0, total):
        rate = min(max(ones / total, 0.001), 0.999) if total else 0.5
        return Model(np.zeros(BUCKETS), float(np.log(rate / (1 - rate))))
    random = np.random.Generator(np.random.PCG64(seed))
    order = random.permutation(total)
    held = bags.take(order[: total // 10])
    rest = order[total // 10 :]
    embeddings = _Adam(random.normal(0, 0.01, (BUCKETS, WIDTH)), RATE)
    output = _Adam(random.normal(0, 0.1, (WIDTH, 2)), RATE)
    prior = ones / total
    bias = _Adam(np.log(np.array([[1 - prior, prior]])), RATE)
    best, kept = np.inf, None
    for _ in range(PASSES):
        random.shuffle(rest)
        for low in range(0, len(rest), BATCH):
            some = bags.take(rest[low : low + BATCH])
            average = GAIN * some.averages(embeddings.values)
            wrong = _softmax(average @ output.values + bias.values)
            wrong[np.arange(len(wrong)), some.labels] -= 1
            wrong /= len(wrong)
            back = GAIN * (wrong @ output.values.T)
            owner = some.owners()
            slope = np.stack(
                [
                    np.bincount(some.buckets, back[owner, i] * some.shares, BUCKETS)
                    for i in range(WIDTH)
                ],
                axis=1,
            )
            output.update(average.T @ wrong + DECAY * output.values)
            bias.update(wrong.sum(axis=0, keepdims=True))
            embeddings.update(slope + DECAY * embeddings.values)
        logits = GAIN * held.averages(embeddings.values) @ output.values + bias.values
        chosen = _softmax(logits)[np.arange(len(held.labels)), held.labels]
        loss = -np.log(np.maximum(chosen, 1e-12)).mean() if len(chosen) else -1.0
        if loss < best:
            best = loss
            both = GAIN * embeddings.values @ output.values
            kept = Model(both[:, 1] - both[:, 0], float(bias.values[0, 1] - bias.values[0, 0]))
    return kept


def bags_of(rows: pa.Table) -> Bags:
    """Bags from the columns ``label``, ``buckets`` and ``counts``."""
    rows = rows.combine_chunks()
    buckets, counts = rows["buckets"].combine_chunks(), rows["counts"].combine_chunks()
    starts = buckets.offsets.to_numpy().astype(np.int64)
    shares = counts.flatten().to_numpy().astype(np.float32)
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    total = np.bincount(owner, shares, len(sizes))
    shares /= np.maximum(total, 1)[owner].astype(np.float32)
    labels = rows["label"].to_numpy().astype(np.int64)
    return Bags(buckets.flatten().to_numpy(), shares, starts - starts[0], labels)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features and their counts for every text."""
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            buckets, owners = features(chunk.data, chunk.starts)
            texts = len(chunk.starts) - 1
            keys, counts = np.unique(owners * BUCKETS + buckets, return_counts=True)
            cut = np.searchsorted(keys, np.arange(texts + 1) * BUCKETS)
            offsets = pa.array(cut, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[chunk.rows],
                    pa.ListArray.from_arrays(offsets, pa.array(keys % BUCKETS, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                    batch.column(2)[chunk.rows],
                    pa.array(np.diff(cut), pa.int64()),
                ],
                ["label", "buckets", "counts", "place", "size"],
            )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    train_features: int = TRAIN_FEATURES,
) -> Model:
    """Fit on at most ``train_rows`` labelled rows for which ``usable`` (of the id) holds.

    The sample is small by its bound, so its ids and labels are what is sent to the documents.
    """
    sample = (
        labels.where(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1) & usable)
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.max(label_column).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(train_rows)
    )
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    labelled = texts.join(F.broadcast(sample), "id").withColumn("place", F.xxhash64("id", "text"))
    # However many rows share an id, one place of each comes back.
    places = [r[0] for r in labelled.groupBy("id").agg(F.min("place")).select("min(place)").collect()]
    chosen = docs.sparkSession.createDataFrame([(place,) for place in places], "place long")
    bags = stored(
        labelled.join(F.broadcast(chosen), "place", "left_semi")
        .select("label", "text", "place")
        .mapInArrow(
            _counted, "label int, buckets array<int>, counts array<int>, place long, size long"
        )
        .groupBy("place")
        .agg(F.first("label").alias("label"), F.first("buckets").alias("buckets"), F.first("counts").alias("counts"), F.first("size").alias("size")),
        "bags",
    )
    # In an order that does not depend on which task came first.
    total, last = 0, None
    for place, size in sorted(tuple(r) for r in bags.select("place", "size").collect()):
        total += size
        if total > train_features:
            break
        last = place
    rows = bags.where(F.col("place") <= F.lit(last)).select("label", "buckets", "counts", "place").toArrow()
    return train(bags_of(rows.take(pa.compute.sort_indices(rows["place"]))))


def score(
    docs: DataFrame,
    model: Model,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The id and the probability of label 1 for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[chunk.rows], pa.array(model.scores(chunk.data, chunk.starts))],
                    [id_column, "score"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, F.col(text_column).cast("string").alias("text")).mapInArrow(
        run, f"`{id_column}` {kind}, score double"
    )
