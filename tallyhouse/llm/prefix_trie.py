"""Prefix trie of rebuilt conversations: one row per distinct sequence of first turns.

A conversation c starts with the first h turns of conversation c - c % 20 (the remainder has the sign of c), where
h is the checksum of c modulo 4, and goes on with its own turns after its first h. Texts become digests in the tasks that read them; only
digests, word counts and ids are shuffled. A task goes through the turns of its conversations in order and
chains the digests, so a node is the 128-bit digest of its whole sequence, and a grouped count finds the
distinct nodes and their members.

What a node needs from its subtree comes from node tables. A shard holds whole subtrees; a minimal perfect hash
over the digests gives every node a slot, which is verified by comparing the digest stored there, and counts are
scattered into flat arrays and added up through the array of parent slots, the deepest level first.

Two kinds of nodes stay out of the shards. A node with one member whose parent has one member too belongs to the
unshared tail of a conversation, a chain on which nothing adds up. A node with very many members would make a
shard as large as its subtree: nodes with more than `members` of them, which a prefix of a popular conversation
or the root has, go into one table above the shards, which receives the sums of the subtrees below. As each
such node has more than so many of the turns below it, there are at most rows / members of them, and `members`
grows with the rows so that this stays below MOST_TOP.

Turns are in the order of `turn`, null first, equal ones in the order of their digests. Null roles and texts are
empty. Rows without a conv_id take no part. A table without conversations has no nodes. A repeated row is one
more turn. A conversation of very many turns is a long run of narrow rows in one task, which holds one digest
at a time; likewise the ids that end at one node, which its SHA-256 takes one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.text_arrays import U, mix, release_memory
from tallyhouse.llm.work_tables import WorkTables

#: A conversation shares turns with the first of so many, at most so many less one of them.
FAMILY, SHARED = 20, 4
#: Members above which a node goes into the table above the shards, at least; and nodes of that table, at most.
LEAST_MEMBERS, MOST_TOP = 1 << 13, 1 << 18
#: Nodes that a shard aims at.
SHARD_NODES = 1 << 18
_ROOT = bytes(16)
_NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = "hi long, lo long, parent_hi long, parent_lo long, conv_id long, depth long, n_convs long, words long"
_ADDED = "add_children long, add_leaves long, add_saved long"
_TABLE = (
    "hi long, lo long, parent_hi long, parent_lo long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long"
)


def _halves(digests: list[bytes]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(both[:, i])) for i in (0, 1)]


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns with the digest of role and text and the words of the text instead of both."""
    for batch in batches:
        digests, words = [], []
        for role, text in zip(batch.column("role"), batch.column("text")):
            said = (text.as_py() or "").encode()
            who = (role.as_py() or "").encode()
            digests.append(hashlib.blake2b(b"%d:%b%b" % (len(who), who, said), digest_size=16).digest())
            words.append(len(said.split()))  # bytes split at the six ASCII blanks
        ids = [batch.column("conv_id"), batch.column("turn")]
        yield pa.RecordBatch.from_arrays(
            [*ids, *_halves(digests), pa.array(words, pa.int64())], ["conv_id", "turn", "hi", "lo", "words"]
        )
        release_memory()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns, sorted by conversation and place, to nodes: the digest of all turns up to each."""
    conversation, depth, node = None, 0, _ROOT
    for batch in batches:
        own = np.stack([np.asarray(batch.column(name)) for name in ("hi", "lo")], axis=1).astype(">i8").tobytes()
        depths, nodes, parents = [], [], []
        for i, conv_id in enumerate(batch.column("conv_id").to_pylist()):
            if conv_id != conversation:
                conversation, depth, node = conv_id, 0, _ROOT
            parents.append(node)
            node = hashlib.blake2b(node + own[16 * i : 16 * i + 16], digest_size=16).digest()
            depth += 1
            nodes.append(node)
            depths.append(depth)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(depths, pa.int64()), *_halves(nodes), *_halves(parents), batch.column("words")],
            ["conv_id", "depth", "hi", "lo", "parent_hi", "parent_lo", "words"],
        )


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations, sorted by their last node and id, to the SHA-256 of each node's ids."""
    node, digest = None, None

    def finished() -> pa.RecordBatch:
        columns = [[node[0]], [node[1]], [digest.hexdigest()]]
        kinds = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["hi", "lo", "ends_sha256"]
        )

    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("hi", "lo", "conv_id"))):
            if row[:2] == node:
                digest.update(b",%d" % row[2])
            else:
                if node is not None:
                    yield finished()
                node, digest = row[:2], hashlib.sha256(b"%d" % row[2])
    if node is not None:
        yield finished()


class SlotTable:
    """A minimal perfect hash of distinct 128-bit keys, with the keys stored at their slots.

    On every level the keys hash into twice as many bits as there are keys; those alone at a bit are placed, the
    others go on to the next level. The slot of a key is the number of bits set before its own.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray) -> None:
        self.hi, self.lo = hi.view(U), lo.view(U)
        self.sizes: list[int] = []
        levels: list[np.ndarray] = []
        left = np.arange(len(hi))
        while len(left):
            if len(self.sizes) == 64:
                raise ValueError("a digest occurs twice")
            size = max(8, 2 * len(left))
            at = self._places(len(self.sizes), size, self.hi[left], self.lo[left])
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, dtype=bool)
            bits[at[alone]] = True
            self.sizes.append(size)
            levels.append(bits)
            left = left[~alone]
        self.first = np.concatenate(([0], np.cumsum(self.sizes))).astype(np.int64)
        self.bits = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
        self.rank = np.cumsum(self.bits) - 1
        slots = self._slots(self.hi, self.lo)
        keys = np.zeros((len(hi), 2), dtype=U)
        keys[slots, 0], keys[slots, 1] = self.hi, self.lo
        self.keys, self.own = keys, slots
        if (self.find(hi, lo) != slots).any():
            raise ValueError("two digests share a slot")

    @staticmethod
    def _places(level: int, size: int, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        seed = U((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mix(hi ^ mix(lo + seed)) % U(size)).astype(np.int64)

    def _slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        slots = np.full(len(hi), -1, dtype=np.int64)
        left = np.arange(len(hi))
        for level, size in enumerate(self.sizes):
            at = self.first[level] + self._places(level, size, hi[left], lo[left])
            there = self.bits[at]
            slots[left[there]] = self.rank[at[there]]
            left = left[~there]
        return slots

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 for those that are not in the table."""
        hi, lo = hi.view(U), lo.view(U)
        slots = self._slots(hi, lo)
        known = slots >= 0
        known[known] = (self.keys[slots[known], 0] == hi[known]) & (self.keys[slots[known], 1] == lo[known])
        return np.where(known, slots, -1)


def accumulate(nodes: pa.Table) -> pa.Table:
    """Sums over the subtrees of a shard's nodes. What lies below the shard comes in as add_ columns."""
    column = {name: np.asarray(nodes.column(name).combine_chunks()) for name in nodes.column_names if name != "shard"}
    table = SlotTable(column["hi"], column["lo"])

    def scattered(values: np.ndarray) -> np.ndarray:
        flat = np.empty(len(values), dtype=values.dtype)
        flat[table.own] = values
        return flat

    flat = {name: scattered(values) for name, values in column.items()}
    depth = flat["depth"]
    parent = np.where(depth > 0, table.find(flat["parent_hi"], flat["parent_lo"]), -1)
    inside = np.flatnonzero(parent >= 0)
    children, leaves = flat["add_children"].copy(), flat["add_leaves"].copy()
    saved = flat["add_saved"] + (flat["n_convs"] - 1) * flat["words"]
    np.add.at(children, parent[inside], 1)
    leaves[children == 0] = 1
    deepest_first = inside[np.argsort(-depth[inside], kind="stable")]
    levels = np.flatnonzero(np.diff(depth[deepest_first], prepend=-1, append=-1))
    for low, high in pairwise(levels):
        at = deepest_first[low:high]
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    above = pa.array(flat["conv_id"][parent] if len(parent) else parent, mask=parent < 0)
    names = ["hi", "lo", "parent_hi", "parent_lo", "conv_id", "depth"]
    arrays = [pa.array(flat[name]) for name in names]
    arrays += [above, pa.array(flat["n_convs"]), pa.array(children), pa.array(leaves), pa.array(saved)]
    return pa.Table.from_arrays(
        arrays, [*names, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    )


def _shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % SHARED


def _rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, place, hi, lo, words) of all turns of the rebuilt conversations, in the order of place."""
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "hi", "lo")
    numbered = turns.withColumn("place", (F.row_number().over(in_order) - 1).cast("long"))
    own = numbered.where(F.col("place") >= _shared_turns(F.col("conv_id")))
    heads = numbered.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED - 1)).select(
        F.col("conv_id").alias("family"), F.col("place").alias("at"), "hi", "lo", "words"
    )
    members = turns.select("conv_id").distinct().withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    taken = members.join(heads, "family").where(F.col("at") < _shared_turns(F.col("conv_id")))
    columns = ["conv_id", "place", "hi", "lo", "words"]
    return taken.withColumn("place", F.col("at") - SHARED).select(*columns).unionByName(own.select(*columns))


def _added(children=0, leaves=0, saved=0) -> list[Column]:
    values = zip((children, leaves, saved), ("add_children", "add_leaves", "add_saved"))
    return [(v if isinstance(v, Column) else F.lit(v)).cast("long").alias(name) for v, name in values]


def prefix_trie(
    conversations: DataFrame, least_members: int = LEAST_MEMBERS, most_top: int = MOST_TOP, shard_nodes: int = SHARD_NODES
) -> DataFrame:
    """One row per node; see the module. Sizes change the work and not the result."""
    work = WorkTables(conversations.sparkSession, "trie")
    named = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    turns = work.keep(
        named.mapInArrow(_digested, "conv_id long, turn long, hi long, lo long, words long"), "turns"
    )
    placed = _rebuilt(turns).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    paths = work.keep(
        placed.select("conv_id", "hi", "lo", "words").mapInArrow(
            _chained, "conv_id long, depth long, hi long, lo long, parent_hi long, parent_lo long, words long"
        ),
        "paths",
    )
    counted = paths.groupBy("hi", "lo").agg(
        F.min("parent_hi").alias("parent_hi"),
        F.min("parent_lo").alias("parent_lo"),
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.min("words").alias("words"),
    )
    everyone = turns.agg(F.min("conv_id").alias("conv_id"), F.count_distinct("conv_id").alias("n_convs"))
    zero = F.lit(0).cast("long")
    root = everyone.where(F.col("n_convs") > 0).select(
        zero.alias("hi"),
        zero.alias("lo"),
        F.lit(None).cast("long").alias("parent_hi"),
        F.lit(None).cast("long").alias("parent_lo"),
        "conv_id",
        zero.alias("depth"),
        "n_convs",
        zero.alias("words"),
    )
    nodes = work.keep(counted, "nodes")
    sizes = nodes.agg(F.sum("n_convs").alias("rows"), F.count_if(F.col("n_convs") > 1).alias("shared")).first()
    members = max(least_members, -(-(sizes["rows"] or 0) // most_top))
    top = work.keep(nodes.where(F.col("n_convs") > members).unionByName(root), "top")
    top_nodes = F.broadcast(top.select("hi", "lo", F.lit(True).alias("is_top")))

    last, place = F.max(F.struct("depth", "hi", "lo")), F.struct("depth", "hi", "lo")
    ways = work.keep(
        paths.join(top_nodes, ["hi", "lo"], "left")
        .groupBy("conv_id")
        .agg(last.alias("last"), F.min(F.when(F.col("is_top").isNull(), place)).alias("entry")),
        "ways",
    )
    alone = nodes.where("n_convs = 1").groupBy("conv_id").agg(F.min("depth").alias("alone_from"))
    below = work.keep(
        nodes.where(F.col("n_convs") <= members)
        .join(ways, "conv_id")
        .join(alone, "conv_id", "left")
        .withColumn("goes_on", F.when(F.col("n_convs") == 1, F.col("depth") < F.col("last.depth")).otherwise(False)),
        "below",
    )
    in_tail = (F.col("n_convs") == 1) & (F.col("depth") > F.col("alone_from"))
    tails = below.where(in_tail).select(
        "hi",
        "lo",
        "conv_id",
        "depth",
        F.col("conv_id").alias("parent_conv_id"),
        "n_convs",
        F.col("goes_on").cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"),
    )
    node_columns = ["hi", "lo", "parent_hi", "parent_lo", "conv_id", "depth", "n_convs", "words"]
    n_shards = -(-(sizes["shared"] + 1) // shard_nodes)
    shards = below.where(~in_tail).select(
        F.pmod(F.xxhash64("entry.hi", "entry.lo"), F.lit(n_shards)).alias("shard"),
        *node_columns,
        *_added(F.col("goes_on"), F.col("goes_on")),
    )
    inner = work.keep(shards.groupBy("shard").applyInArrow(accumulate, _TABLE), "inner")
    entries = inner.where(F.col("parent_conv_id").isNull())
    sums = entries.groupBy(F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")).agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    known = [F.coalesce(name, F.lit(0)) for name in ("children", "leaves", "saved")]
    above = top.join(sums, ["hi", "lo"], "left").select(
        F.lit(0).alias("shard"),
        "hi",
        "lo",
        *[F.coalesce(name, zero).alias(name) for name in ("parent_hi", "parent_lo")],
        *node_columns[4:],
        *_added(*known),
    )
    above = work.keep(above.groupBy("shard").applyInArrow(accumulate, _TABLE), "above")
    over = F.broadcast(
        top.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("over"))
    )
    inner = inner.join(over, ["parent_hi", "parent_lo"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "over")
    )
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    found = tails.select("hi", "lo", *result)
    for part in (inner, above):
        found = found.unionByName(part.select("hi", "lo", *result))
    with_turns = ways.select("conv_id", "last.hi", "last.lo")
    turnless = turns.select("conv_id").distinct().join(ways, "conv_id", "left_anti")
    ending = with_turns.unionByName(turnless.select("conv_id", zero.alias("hi"), zero.alias("lo")))
    ends = (
        ending.repartition("hi", "lo")
        .sortWithinPartitions("hi", "lo", "conv_id")
        .select("hi", "lo", "conv_id")
        .mapInArrow(_ends, "hi long, lo long, ends_sha256 string")
    )
    return found.join(ends, ["hi", "lo"], "left").select(
        *result, F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")
    )
