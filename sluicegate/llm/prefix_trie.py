"""The trie of all prefixes of sequences, built in range shards below a broadcast skeleton.

A sequence is a list of steps, each known by a 128-bit digest; its path is the digests one after another, so that sorting
paths puts the sequences that share a prefix next to each other.  Tasks first put equal paths of theirs together,
with members by blocks of ids.  Splitters, each cut to the shortest prefix that tells it from the path before it, divide
the order of paths into shards of about equal steps.  The trie of the splitters' own prefixes is the skeleton: a
node that lies in several shards has a splitter among its descendants, so every node outside the skeleton is whole in
one shard.  A shard is sorted and read once, with a stack of open nodes; it finishes its own nodes and gives partial
aggregates for those of the skeleton, which are summed by node and rolled up from the leaves of the skeleton.

The skeleton is broadcast and has at most ``MOST_NODES`` nodes, or splitters are thinned.  However many
copies a sequence has, they are a few rows a task; a member list is hashed as it is read, block by block.  A
path is one row, so one sequence's digests have to fit in a row (2 GB, some 130 million steps).

Sequences without an id belong to nobody and are left out.  A sequence without steps is a member of the root.  Repeated ids
are members twice.  Empty tables give no nodes, not even the root.  Names of further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.frames import stored

DIGEST = 16
# Members whose ids agree above so many bits are put together.
BLOCK_BITS = 16
SHARD_STEPS = 20_000
MOST_SHARDS = 65_536
MOST_NODES = 1_000_000
# Paths drawn for each splitter, and their bytes in all that are brought to the driver.
DRAWN = 20
DRAWN_BYTES = 64 << 20
HELD_BYTES = 16 << 20
OUT_ROWS = 20_000
NO_ENDS = hashlib.sha256().digest()

_PACKED = "path binary, sizes array<long>, block long, ids array<long>"
_NODES = T.StructType(
    [
        T.StructField("node", T.IntegerType()),
        T.StructField("above", T.IntegerType()),
        T.StructField("low", T.LongType()),
        T.StructField("depth", T.LongType()),
        T.StructField("parent_low", T.LongType()),
        T.StructField("members", T.LongType()),
        T.StructField("children", T.LongType()),
        T.StructField("leaves", T.LongType()),
        T.StructField("saved", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("ends", T.BinaryType()),
    ]
)
_KINDS = [pa.int32(), pa.int32(), *[pa.int64()] * 8, pa.binary()]


def steps_of(
    turns: DataFrame, near: Column, id_column: str = "conv_id", order_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """Turns as steps by conversation: ``steps`` holds a digest of role and text and the text's code points.

    Turns go by their order, null first; those that tie go by their digests.  A null role or text is empty.
    Conversations of equal ``near``, an expression of their id, meet in one task.
    """
    said, who = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (text_column, role_column))
    # The role's length keeps role and text apart.
    digest = F.unhex(F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said).cast("binary")))
    place = F.col(f"`{order_column}`")
    step = F.struct(place.isNotNull().alias("known"), place.alias("place"), digest.alias("key"), F.length(said).cast("long").alias("size"))
    rows = turns.select(near.alias("near"), F.col(f"`{id_column}`").alias("id"), step.alias("step")).where("id is not null")
    listed = rows.repartition("near").groupBy("near", "id").agg(F.sort_array(F.collect_list("step")).alias("listed"))
    steps = F.transform("listed", lambda s: F.struct(s["key"].alias("key"), s["size"].alias("size")))
    return listed.select("near", "id", steps.alias("steps"))


def grafted(steps: DataFrame, taken: Column, most: int) -> DataFrame:
    """Sequences whose first steps are replaced by the first ``taken``, at most ``most``, of the one with the id ``near``.

    Where that has fewer all of its steps are taken, and none where there is no such sequence.
    """
    first = F.max(F.when(F.col("id") == F.col("near"), F.slice("steps", 1, most))).over(Window.partitionBy("near"))
    rows = steps.select("id", "steps", first.alias("first"), taken.cast("int").alias("taken"))
    head = F.slice(F.coalesce("first", F.slice("steps", 1, 0)), F.lit(1), F.col("taken"))
    rest = F.slice("steps", F.col("taken") + 1, F.size("steps"))
    return rows.select("id", F.concat(head, rest).alias("steps"))


def _pack(sequences: DataFrame) -> DataFrame:
    """Equal paths of a task as one row for each block of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            keys, values = list(held), list(held.values())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([path for path, _ in keys], pa.binary()),
                    pa.array([sizes for sizes, _ in values], pa.list_(pa.int64())),
                    pa.array([block for _, block in keys], pa.int64()),
                    pa.array([sorted(ids) for _, ids in values], pa.list_(pa.int64())),
                ],
                ["path", "sizes", "block", "ids"],
            )

        held: dict[tuple[bytes, int], tuple[list[int], list[int]]] = {}
        size = 0
        for batch in batches:
            for key, path, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = (path, key >> BLOCK_BITS)
                if at not in held:
                    held[at] = (sizes, [])
                    size += len(path) + 8 * len(sizes)
                held[at][1].append(key)
                size += 8
                if size > HELD_BYTES:
                    yield rows()
                    held, size = {}, 0
        yield rows()

    hexes = F.transform("steps", lambda s: F.hex(s["key"]))
    paths = sequences.select(
        "id", F.unhex(F.array_join(hexes, "")).alias("path"), F.transform("steps", lambda s: s["size"]).alias("sizes")
    )
    return paths.mapInArrow(run, _PACKED)


def common_steps(a: bytes, b: bytes) -> int:
    """Steps that two paths share from their beginning."""
    most = min(len(a), len(b)) // DIGEST
    if a[: most * DIGEST] == b[: most * DIGEST]:
        return most
    low, high = 0, most
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * DIGEST : middle * DIGEST] == b[low * DIGEST : middle * DIGEST]:
            low = middle
        else:
            high = middle
    return low


def splitters(drawn: list[bytes], shards: int, most_nodes: int = MOST_NODES) -> list[bytes]:
    """Ascending shortest prefixes that divide the drawn paths into shards of about equal steps."""
    paths = sorted(drawn)
    total = sum(len(path) // DIGEST + 1 for path in paths)
    found: list[bytes] = []
    done, before = 0, b""
    for path in paths:
        if done * shards >= total * (len(found) + 1) and path != before:
            found.append(path[: (common_steps(before, path) + 1) * DIGEST])
        done += len(path) // DIGEST + 1
        before = path
    while sum(len(path) // DIGEST for path in found) > most_nodes:
        found = found[1::2]
    return found


class Skeleton:
    """The trie of the splitters' prefixes; node 0 is the root."""

    def __init__(self, cuts: list[bytes]):
        self.cuts = cuts
        self.children: list[dict[bytes, int]] = [{}]
        self.parents = [-1]
        for cut in cuts:
            node = 0
            for at in range(0, len(cut), DIGEST):
                key = cut[at : at + DIGEST]
                if key not in self.children[node]:
                    self.children[node][key] = len(self.children)
                    self.children.append({})
                    self.parents.append(node)
                node = self.children[node][key]

    def shard(self, path: bytes) -> int:
        return bisect_right(self.cuts, path)


class _Open:
    """A node whose descendants are still being read."""

    __slots__ = ("children", "depth", "ends", "leaves", "low", "members", "node", "pending", "saved", "size")

    def __init__(self, depth: int, size: int, node: int):
        self.depth, self.size, self.node = depth, size, node
        self.low, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: bytes | None = None
        self.pending: list[tuple] = []

    def meet(self, low: int, members: int) -> None:
        self.low = low if self.low is None else min(self.low, low)
        self.members += members


class _Shard:
    """Builds the nodes of one shard from its sorted paths; ``out`` receives rows of ``_NODES``."""

    def __init__(self, skeleton: Skeleton, out: list[tuple]):
        self._skeleton, self._out = skeleton, out
        self._stack = [_Open(0, 0, 0)]
        self._path: bytes | None = None
        self._hash = None
        self._block: int | None = None
        self._ids: list[int] = []

    def add(self, path: bytes, sizes: list[int], block: int, ids: list[int]) -> None:
        if path != self._path:
            self._end_path()
            same = 0 if self._path is None else common_steps(self._path, path)
            while len(self._stack) - 1 > same:
                self._close()
            for depth in range(same + 1, len(path) // DIGEST + 1):
                above = self._stack[-1]
                key = path[(depth - 1) * DIGEST : depth * DIGEST]
                node = -1 if above.node < 0 else self._skeleton.children[above.node].get(key, -1)
                self._stack.append(_Open(depth, sizes[depth - 1], node))
            self._path, self._block = path, block
        elif block != self._block:
            self._end_block()
            self._block = block
        # Rows of one block come from several tasks; a block holds a bounded range of ids.
        self._ids += ids

    def _end_block(self) -> None:
        self._ids.sort()
        text = ",".join(map(str, self._ids)).encode()
        if self._hash is None:
            self._hash = hashlib.sha256(text)
        else:
            self._hash.update(b"," + text)
        self._stack[-1].meet(self._ids[0], len(self._ids))
        self._ids = []

    def _end_path(self) -> None:
        if self._path is not None:
            self._end_block()
            self._stack[-1].ends = self._hash.digest()
            self._hash = None

    def _close(self) -> None:
        done = self._stack.pop()
        if done.node >= 0:
            self._partial(done)
            return
        above = self._stack[-1]
        leaves = done.leaves if done.children else 1
        saved = done.saved + (done.members - 1) * done.size
        for row in done.pending:
            self._out.append((None, None, row[0], row[1], done.low, *row[2:]))
        row = (done.low, done.depth, done.members, done.children, leaves, saved, done.size, done.ends)
        above.meet(done.low, done.members)
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        if above.node >= 0:
            # Its parent's least member is known only when all shards have been read.
            self._out.append((None, above.node, row[0], row[1], None, *row[2:]))
        else:
            above.pending.append(row)

    def _partial(self, done: _Open) -> None:
        """What this shard has seen of a skeleton node, without its descendants in the skeleton."""
        self._out.append(
            (done.node, None, done.low, done.depth, None, done.members, done.children, done.leaves, done.saved, done.size, done.ends)
        )

    def finish(self) -> None:
        self._end_path()
        while self._stack:
            self._close()


def _build(packed: DataFrame, skeleton: Skeleton) -> DataFrame:
    shared = packed.sparkSession.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = [shared.value.shard(path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), *batch.columns], ["shard", *batch.schema.names])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def rows() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[] for _ in _KINDS]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS, strict=True)], _NODES.names)

        now, shard = None, None
        for batch in batches:
            for at, path, sizes, block, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != now:
                    if shard:
                        shard.finish()
                    now, shard = at, _Shard(shared.value, out)
                shard.add(path, sizes, block, ids)
                if len(out) > OUT_ROWS:
                    yield rows()
                    out.clear()
        if shard:
            shard.finish()
        yield rows()

    dealt = packed.mapInArrow(deal, f"shard int, {_PACKED}").repartition(len(skeleton.cuts) + 1, "shard")
    return dealt.sortWithinPartitions("shard", "path", "block").mapInArrow(build, _NODES)


def _rolled_up(nodes: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """The skeleton's nodes whole: partial aggregates summed by node, then added up from the leaves."""
    sums = [F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")]
    lows = [F.min("low").alias("low"), F.max("depth").alias("depth"), F.max("size").alias("size"), F.max("ends").alias("ends")]
    rows = {r["node"]: r.asDict() for r in nodes.where("node is not null").groupBy("node").agg(*sums, *lows).collect()}
    # A node is numbered after its parent, so its descendants are whole before it is added.
    for node in sorted(rows, reverse=True):
        row, above = rows[node], skeleton.parents[node]
        row["leaves"] = row["leaves"] if row["children"] else 1
        row["saved"] += max(row["members"] - 1, 0) * row["size"]
        if above >= 0:
            top = rows[above]
            top["children"] += 1
            top["low"] = row["low"] if top["low"] is None else min(top["low"], row["low"])
            for c in ("members", "leaves", "saved"):
                top[c] += row[c]
    found = []
    for node, row in sorted(rows.items()):
        above = skeleton.parents[node]
        parent = rows[above]["low"] if above >= 0 else None
        found.append((node, above if above >= 0 else None, row["low"], row["depth"], parent, row["members"], row["children"], row["leaves"], row["saved"], row["size"], row["ends"]))
    return found


def prefix_nodes(
    sequences: DataFrame, *, shard_steps: int = SHARD_STEPS, most_shards: int = MOST_SHARDS, id_name: str = "conv_id"
) -> DataFrame:
    """One row a node of the trie.

    ``sequences`` has ``id`` (a whole number) and ``steps`` (an array of ``key``, 16 bytes, and ``size``).  A node
    is named by its smallest member; ``saved`` sums, over its subtree, each node's members but one times its last
    step's size; ``ends_sha256`` hashes the ids of the sequences that end at it, in ascending order.
    """
    packed = stored(_pack(sequences.where("id is not null")), "trie-paths")
    totals = packed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0))).first()
    rows, size = totals[0], totals[1]
    shards = min(most_shards, size // DIGEST // shard_steps + 1)
    drawn: list[bytes] = []
    if shards > 1:
        share = min(1.0, DRAWN * shards / rows, DRAWN_BYTES / size)
        drawn = [bytes(r[0]) for r in packed.select("path").sample(fraction=share, seed=1).collect()]
    skeleton = Skeleton(splitters(drawn, shards))
    nodes = stored(_build(packed, skeleton), "trie-nodes")
    whole = nodes.sparkSession.createDataFrame(_rolled_up(nodes, skeleton), _NODES)
    tops = F.broadcast(whole.select(F.col("node").alias("above"), F.col("low").alias("top_low")))
    local = nodes.where("node is null").join(tops, "above", "left").withColumn("parent_low", F.coalesce("parent_low", "top_low"))
    ends: Column = F.lower(F.hex(F.coalesce("ends", F.lit(NO_ENDS))))
    return local.drop("top_low").unionByName(whole).select(
        F.col("low").alias(id_name),
        "depth",
        F.col("parent_low").alias(f"parent_{id_name}"),
        F.col("members").alias("n_members"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        "saved",
        ends.alias("ends_sha256"),
    )
