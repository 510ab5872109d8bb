"""SimHash near-duplicates, found by vantage-point trees.

A text's fingerprint has a bit set where more than half of its shingle hashes have it.
Fingerprints that differ in at most ``radius`` bits link; linked texts form components.

Equal fingerprints are one point.  A vantage-point tree, fitted on a bounded sample,
splits the Hamming space into shards: each node sends points within its radius to one side and the
rest to the other.  A point is stored in its own shard and asked in every shard that its ball
overlaps (by the triangle inequality no other can hold a link), so the pairs are exact
whatever the sample.  Inside a shard a tree of the same kind prunes the search.  A shard
reports a spanning forest of its links and never their pairs, so a dense group of n
points costs n rows.  Forests are joined by star contraction, with every round stored.

Null, empty and blank texts have fingerprint zero and link like any other.  Rows with a null id
keep it; they join components but never name one unless all of its ids are null.  Repeated
rows stay repeated.  An empty table gives no rows.  Columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.frames import stored

HASH_SEED = 42
# Points of the sample the shards are fitted on, and points wanted in a shard.
SAMPLE_POINTS = 4096
SHARD_POINTS = 8192
LEAF_POINTS = 128
_BLOCK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The SimHash of one text as an unsigned 64-bit number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - width + 1
    hashed, seed = xxhash.xxh64_intdigest, HASH_SEED
    bits = np.zeros(64, np.int64)
    begin, end = starts[:count].tolist(), ends[width - 1 :].tolist()
    for low in range(0, count, _BLOCK):
        values = np.array(
            [hashed(joined[a:b], seed) for a, b in zip(begin[low : low + _BLOCK], end[low : low + _BLOCK])],
            dtype="<u8",
        )
        rows = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += rows.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * bits > count).tolist())


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3
) -> DataFrame:
    """The id and the signed 64-bit fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            values = np.array(
                [fingerprint(x.as_py(), shingle) for x in texts], dtype=np.uint64
            ).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], ["id", "fp"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    ).mapInArrow(run, f"id {kind}, fp long")


class Router:
    """A vantage-point tree over a sample; its leaves are shards."""

    def __init__(self, sample: np.ndarray, depth: int, radius: int):
        self.radius = radius
        self.nodes: list[tuple[int, int, int, int]] = []  # vantage, bound, near, far
        self.shards = 0
        self._grow(sample, depth)

    def _grow(self, points: np.ndarray, depth: int) -> int:
        """Index of the node, or the one's complement of a shard."""
        if depth and len(points) > 1:
            vantage = points[0]
            away = np.bitwise_count(points ^ vantage).astype(int)
            bound = int(np.median(away))
            near = away <= bound
            if near.any() and not near.all():
                at = len(self.nodes)
                self.nodes.append((0, 0, 0, 0))
                sides = self._grow(points[near], depth - 1), self._grow(points[~near], depth - 1)
                self.nodes[at] = (int(vantage), bound, *sides)
                return at
        self.shards += 1
        return ~(self.shards - 1)

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shard, index of the point, and whether the shard is the point's own."""
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        everyone = np.arange(len(points))
        todo = [(0 if self.nodes else ~0, everyone, np.ones(len(points), bool))]
        while todo:
            at, who, own = todo.pop()
            if not len(who):
                continue
            if at < 0:
                found.append((~at, who, own))
                continue
            vantage, bound, near, far = self.nodes[at]
            away = np.bitwise_count(points[who] ^ np.uint64(vantage)).astype(int)
            inside = away <= bound
            for side, reached, mine in (
                (near, away <= bound + self.radius, inside),
                (far, away > bound - self.radius, ~inside),
            ):
                todo.append((side, who[reached], own[reached] & mine[reached]))
        if not found:
            return np.empty(0, int), np.empty(0, int), np.empty(0, bool)
        return (
            np.concatenate([np.full(len(w), s) for s, w, _ in found]),
            np.concatenate([w for _, w, _ in found]),
            np.concatenate([o for _, _, o in found]),
        )


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _unite(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    while len(left):
        parent = _roots(parent)
        a, b = parent[left], parent[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    return parent


def forest(points: np.ndarray, own: np.ndarray, radius: int) -> np.ndarray:
    """For each point of a shard the smallest index it is linked with inside the shard.

    Links run between a point stored here (``own``) and any point of the shard.
    """
    parent = np.arange(len(points))
    todo = [(np.flatnonzero(own), np.arange(len(points)))]
    while todo:
        data, asked = todo.pop()
        if not len(data) or not len(asked):
            continue
        away = np.bitwise_count(points[data] ^ points[data[0]]).astype(int)
        bound = int(np.median(away))
        near = away <= bound
        if len(data) > LEAF_POINTS and not near.all():
            far = np.bitwise_count(points[asked] ^ points[data[0]]).astype(int)
            todo.append((data[near], asked[far <= bound + radius]))
            todo.append((data[~near], asked[far > bound - radius]))
            continue
        step = max(1, _BLOCK * 16 // len(data))
        for low in range(0, len(asked), step):
            some = asked[low : low + step]
            close = np.bitwise_count(points[some][:, None] ^ points[data][None, :]) <= radius
            i, j = np.nonzero(close)
            apart = some[i] != data[j]
            parent = _unite(parent, some[i][apart], data[j][apart])
    return _roots(parent)


def _links(points: DataFrame, radius: int, sample_points: int, shard_points: int) -> DataFrame:
    """A forest (a, b) over the distinct fingerprints, holding every link."""
    sample = [
        r.fp for r in points.orderBy(F.xxhash64("fp"), "fp").limit(sample_points).collect()
    ]
    total = points.count()
    depth = max(0, int(np.ceil(np.log2(max(1, total / shard_points)))))
    router = Router(np.array(sample, dtype=np.int64).view(np.uint64), depth, radius)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            shard, who, own = router.route(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int32)), pa.array(values[who]), pa.array(own)],
                ["shard", "fp", "own"],
            )

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fp"].to_numpy().copy()
        parent = forest(values.view(np.uint64), rows["own"].to_numpy(), radius)
        joined = parent != np.arange(len(parent))
        return pd.DataFrame({"a": values[joined], "b": values[parent[joined]]})

    sent = points.select("fp").mapInArrow(send, "shard int, fp long, own boolean")
    return sent.groupBy("shard").applyInPandas(search, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """Smallest vertex ``root`` reachable from each other vertex ``v`` of the links (a, b).

    Alternates large and small stars until nothing changes; the number of rounds grows with
    the logarithm of the longest path.  Neighbourhoods are only ever aggregated to their
    minimum, never gathered.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(),
        "links",
    )
    seen = None
    while True:
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        lowest = both.groupBy("v").agg(F.min("u").alias("m"))
        large = (
            both.join(lowest, "v")
            .where("u > v")
            .select(F.col("u").alias("v"), F.least("m", "v").alias("u"))
            .distinct()
        )
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(lowest, "v")
        small = (
            joined.select("v", F.col("m").alias("u"))
            .union(joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")))
            .distinct()
        )
        edges = stored(small, "stars")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))
        ).first()
        if tuple(state) == seen:
            return edges.groupBy("v").agg(F.min("u").alias("root"))
        seen = tuple(state)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    shingle: int = 3,
    radius: int = 2,
    sample_points: int = SAMPLE_POINTS,
    shard_points: int = SHARD_POINTS,
) -> DataFrame:
    """One row per document: id, fingerprint (hex) and the smallest id of its component."""
    prints = stored(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    points = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "points")
    roots = components(_links(points, radius, sample_points, shard_points))
    placed = points.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = placed.join(named, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
