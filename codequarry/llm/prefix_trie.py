"""Prefix trie of conversations: node tables addressed by minimal perfect hashes.

A turn's digest and its place give two 64-bit numbers; the XOR of those of the first d turns is the digest
of a depth-d prefix, so prefixes need no chain and a conversation can be cut anywhere.  Conversations are
cut into units of some thousand turns, units are dealt to shards.  A shard enumerates its distinct prefix
digests, gives each a slot by a minimal perfect hash that is verified against the stored digests, and
scatters counts into flat arrays; after the shards' tables are merged by digest, sums over subtrees
run up the parent slots, deepest first.

What is summed over a subtree belongs to a node's smallest member: each node is counted in the one shard
where that conversation lies, which also holds all its ancestors, so partial sums of the shards add up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .meeting import group_bounds

_KEY = ["depth", "a", "b"]
_EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_LOCAL = ["kind", "slot", "parent", "depth", "a", "b", "ghost", "n", "least", "ends", "end_least", "size"]
_NODE, _GOES_ON, _END = 0, 1, 2


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys (rows of 64-bit numbers), and -1 for any other key.

    Each level hashes the keys that are left into a bit array; those alone in their place stay there, the
    others go on.  A slot is the number of set bits before a key's place; the key stored there must be equal.
    """

    def __init__(self, keys: np.ndarray):
        self._marks: list[np.ndarray] = []
        self._before: list[np.ndarray] = []
        left, taken = keys, 0
        while len(left):
            size = 2 * len(left) + 1
            place = self._place(left, len(self._marks), size)
            alone = np.bincount(place, minlength=size) == 1
            self._marks.append(alone)
            self._before.append(taken + np.cumsum(alone) - alone)
            taken += int(alone.sum())
            left = left[~alone[place]]
            if len(self._marks) > 64:
                raise ValueError("keys are not distinct")
        self.stored = np.zeros_like(keys)
        self.stored[self._find(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = np.full(len(keys), (level + 1) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
        for column in keys.T:
            mixed = (mixed ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(29)
        return (mixed % np.uint64(size)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (marks, before) in enumerate(zip(self._marks, self._before)):
            place = self._place(keys[left], level, len(marks))
            here = marks[place]
            slots[left[here]] = before[place[here]]
            left = left[~here]
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        found = self._find(keys)
        if not len(self.stored):
            return found
        return np.where((found >= 0) & (self.stored[found] == keys).all(axis=1), found, -1)


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, size``: digest of role and text (null: empty), and bytes of the text, of each row.

    Rows without a conversation number take no part; other columns are left behind.
    """
    role, text = (F.coalesce(conversations[name].cast("string"), F.lit("")) for name in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    return rows.filter("conv_id is not null")


def in_order(rows: DataFrame) -> DataFrame:
    """``conv_id, at, digest, size``: turns numbered from 0 by ``turn`` (null first), then digest.

    Rows are dealt by ranges of the whole order, so a conversation of very many turns lies in many tasks; each
    numbers its own, and the numbers of the tasks before are added.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, passed = None, 0
        for batch in batches:
            if not len(batch):
                continue
            conv = batch.column("conv_id").to_numpy()
            new = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
            index = np.arange(len(conv))
            start = np.maximum.accumulate(np.where(new, index, -1))
            place = np.where(start < 0, passed + index, index - start)
            last, passed = conv[-1], int(place[-1]) + 1
            names = ["part", "conv_id", "digest", "size"]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in names], pa.array(place)], names=[*names, "place"])

    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    # The number of tasks is that of the session: rows are few bytes, and ranges are sampled.
    dealt = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    dealt = dealt.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    numbered = dealt.mapInArrow(run, "part int, conv_id long, digest binary, size long, place long")
    numbered = materialize(numbered, "numbered-turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    passed = numbered.groupBy("conv_id", "part").count().withColumn("passed", F.sum("count").over(before))
    # Only what goes on from another task: one conversation a task at most.
    passed = passed.filter("passed > 0").select("conv_id", "part", "passed")
    at = (F.col("place") + F.coalesce("passed", F.lit(0))).alias("at")
    return numbered.join(F.broadcast(passed), ["conv_id", "part"], "left").select("conv_id", at, "digest", "size")


def forked(ordered: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as forks of others: ``conv_id, at, digest, size``, and ``conv_id`` of all, turnless ones included.

    Conversation c has the first h turns of conversation c - c % family, then its own after its first h; h is
    the unsigned crc32 of c in decimals % most.  Negative numbers belong to the family below them.
    """
    first = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    convs = ordered.select("conv_id").distinct()
    heads = (
        ordered.filter(F.col("at") < most)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "size"))).alias("head"))
    )
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    shared = convs.withColumn("h", first).join(heads, base == F.col("base"), "left")
    taken = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int"))
    shared = materialize(shared.select("conv_id", "h", taken.alias("head")), "fork-heads")
    heads = shared.select("conv_id", F.inline("head"))
    kept = ordered.join(shared.select("conv_id", "h", F.size("head").alias("moved")), "conv_id").filter("at >= h")
    own = kept.select("conv_id", (F.col("at") - F.col("h") + F.col("moved")).alias("at"), "digest", "size")
    return heads.unionByName(own), shared.select("conv_id")


def _unit(depth: Column, unit: int) -> Column:
    return F.floor(depth / unit).cast("long")


def _units(ordered: DataFrame, convs: DataFrame, unit: int, shards: int) -> DataFrame:
    """``shard, conv_id, unit, depth, a, b, size, last, ghost``: turns as steps of a path, the root as depth 0.

    ``a, b`` are a turn's own numbers.  A unit that goes on from another one begins with a ghost: the
    prefix before it, with its digest.  ``last`` marks where a conversation ends.
    """
    depth = F.col("at") + 1
    own = ordered.select(
        "conv_id", depth.alias("depth"), F.xxhash64("digest", depth).alias("a"), F.xxhash64(depth, "digest", F.lit(1)).alias("b"), "size"
    )
    lengths = own.groupBy("conv_id").agg(F.max("depth").alias("length"))
    every = convs.join(lengths, "conv_id", "left").select("conv_id", F.coalesce("length", F.lit(0)).alias("length"))
    zero = F.lit(0).cast("long")
    roots = every.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("size"))
    steps = own.unionByName(roots).join(every, "conv_id").withColumn("last", F.col("depth") == F.col("length"))
    steps = steps.withColumn("unit", _unit(F.col("depth"), unit)).withColumn("ghost", F.lit(False))
    # Conversations of more than one unit: what the units before have, XORed.
    long = steps.filter(F.col("length") >= unit).groupBy("conv_id", "unit").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    before = Window.partitionBy("conv_id").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    ghosts = long.select("conv_id", "unit", F.bit_xor("a").over(before).alias("a"), F.bit_xor("b").over(before).alias("b"))
    ghosts = ghosts.filter("unit > 0").select(
        "conv_id", "unit", (F.col("unit") * unit - 1).alias("depth"), "a", "b",
        zero.alias("size"), F.lit(False).alias("last"), F.lit(True).alias("ghost"),
    )
    both = steps.drop("length").unionByName(ghosts)
    return both.withColumn("shard", F.pmod(F.xxhash64("conv_id", "unit"), F.lit(shards)).cast("int"))


def _local_nodes(table: pa.Table, unit: int) -> pa.Table:
    """Rows of a shard by ``kind``: its nodes, where units that go on end (conversation and unit), and where conversations end."""
    conv, number, depth, a, b, size = (table.column(name).to_numpy().astype(np.int64) for name in ("conv_id", "unit", "depth", "a", "b", "size"))
    last, ghost = (table.column(name).to_numpy().astype(bool) for name in ("last", "ghost"))
    order = np.lexsort((depth, number, conv))
    conv, number, depth, a, b, size, last, ghost = (x[order] for x in (conv, number, depth, a, b, size, last, ghost))
    new = np.concatenate([[True], (conv[1:] != conv[:-1]) | (number[1:] != number[:-1])])
    start = np.maximum.accumulate(np.where(new, np.arange(len(conv)), 0))

    def prefixes(own: np.ndarray) -> np.ndarray:
        whole = np.bitwise_xor.accumulate(own)
        return whole ^ np.where(start > 0, whole[start - 1], 0)

    keys = np.column_stack([2 * depth + ghost, prefixes(a), prefixes(b)])
    by_key, firsts, _ = group_bounds(*keys.T)
    table_of = PerfectHash(keys[by_key[firsts]])
    slot = table_of.slots(keys)
    if (slot < 0).any():
        raise ValueError("a prefix digest was not found in its own table")
    count = len(firsts)
    parent, n, ends, sizes = np.full(count, -1), np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int64)
    most = np.iinfo(np.int64).max
    least, end_least = np.full(count, most), np.full(count, most)
    # Equal prefixes have equal parents, but for ghosts, which have none.
    parent[slot[~new]] = slot[np.flatnonzero(~new) - 1]
    real = slot[~ghost]
    np.add.at(n, real, 1)
    np.minimum.at(least, real, conv[~ghost])
    np.maximum.at(sizes, real, size[~ghost])
    np.add.at(ends, slot[last], 1)
    np.minimum.at(end_least, slot[last], conv[last])
    kept, on, end = table_of.stored, np.flatnonzero(np.append(new[1:], True) & ~last), np.flatnonzero(last)
    nodes = {
        "kind": np.zeros(count, np.int64), "slot": np.arange(count), "parent": parent,
        "depth": kept[:, 0] >> 1, "a": kept[:, 1], "b": kept[:, 2], "ghost": kept[:, 0] & 1,
        "n": n, "least": least, "ends": ends, "end_least": end_least, "size": sizes,
    }

    def places(kind: int, at: np.ndarray) -> dict[str, np.ndarray]:
        own = {"kind": np.full(len(at), kind), "slot": slot[at], "parent": number[at], "least": conv[at]}
        own |= {"depth": depth[at], "a": keys[at, 1], "b": keys[at, 2]}
        return {name: own.get(name, np.zeros(len(at), np.int64)) for name in nodes}

    parts = [nodes, places(_GOES_ON, on), places(_END, end)]
    columns = {name: np.concatenate([part[name] for part in parts]).astype(np.int64) for name in nodes}
    shard = np.full(len(columns["slot"]), table.column("shard")[0].as_py(), np.int32)
    return pa.table({"shard": pa.array(shard)} | {name: pa.array(values) for name, values in columns.items()})


def _subtree_sums(table: pa.Table) -> pa.Table:
    """Partial sums of a shard's nodes over their subtrees; ghosts only hand on the number of children."""
    seeds, rows = table.filter(table.column("seed")), table.filter(pc.invert(table.column("seed")))
    rows = {name: rows.column(name).to_numpy() for name in rows.column_names if name != "seed"}
    count = len(rows["slot"])

    def by_slot(name: str) -> np.ndarray:
        out = np.zeros(count, np.int64)
        out[rows["slot"]] = rows[name]
        return out

    parent, depth, owner, ghost = by_slot("parent"), by_slot("depth"), by_slot("conv_id"), by_slot("ghost") == 1
    own = (by_slot("least") == owner) & ~ghost
    saved, leaves = np.where(own, by_slot("weight"), 0), np.where(own, by_slot("leaf"), 0)
    np.add.at(saved, seeds.column("slot").to_numpy(), seeds.column("weight").to_numpy())
    np.add.at(leaves, seeds.column("slot").to_numpy(), seeds.column("leaf").to_numpy())
    children = np.zeros(count, np.int64)
    child = np.flatnonzero(own & (parent >= 0))
    np.add.at(children, parent[child], 1)
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for level in reversed(np.split(by_depth, cuts)):
        level = level[parent[level] >= 0]
        np.add.at(saved, parent[level], saved[level])
        np.add.at(leaves, parent[level], leaves[level])
    above = np.where(parent >= 0, owner[parent], -1)
    return pa.table({
        "conv_id": owner, "depth": depth,
        "parent_conv_id": pa.array(above, pa.int64(), mask=parent < 0),
        "n_convs": by_slot("n_convs"), "n_children": children,
        "n_leaves": np.where(ghost, 0, leaves), "saved_tokens": np.where(ghost, 0, saved),
        "ends": by_slot("n_ends"), "end_least": by_slot("end_first"),
    })


def _end_digests(ends: DataFrame, at_once: int = 65_536) -> DataFrame:
    """``conv_id, depth, digest``: SHA-256 of the members of each node, ascending and joined by commas.

    Members are sorted over all tasks by ranges, each of which writes its part of the text, so that the one
    task that a hash of a whole text needs reads few rows and holds no list.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, depth, member = (batch.column(name).to_numpy() for name in ("conv_id", "depth", "member"))
            turns = np.flatnonzero((conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])) + 1
            cuts = np.unique(np.concatenate([[0], turns, np.arange(0, len(conv), at_once), [len(conv)]])).astype(np.int64)
            begins = cuts[:-1]
            texts = [",".join(map(str, member[begin:end].tolist())) for begin, end in zip(cuts, cuts[1:])]
            columns = [conv[begins], depth[begins], member[begins]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(texts, pa.string())], names=["conv_id", "depth", "first", "text"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(node: tuple, state) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv_id": node[0], "depth": node[1], "digest": state.hexdigest()}])

        node, state = None, None
        for batch in batches:
            for conv, depth, text in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "depth", "text"))):
                if (conv, depth) != node:
                    if state is not None:
                        yield row(node, state)
                    node, state = (conv, depth), hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
        if state is not None:
            yield row(node, state)

    order = ["conv_id", "depth", "member"]
    ranges = ends.repartitionByRange(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    texts = ranges.sortWithinPartitions(*order).mapInArrow(parts, "conv_id long, depth long, first long, text string")
    together = texts.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return together.mapInArrow(digests, "conv_id long, depth long, digest string")


def trie(ordered: DataFrame, convs: DataFrame, unit: int = 4_096, shard_rows: int = 200_000) -> DataFrame:
    """All nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends,
    ends_sha256``.

    ``ordered`` has ``conv_id, at, digest, size`` with places from 0 without gaps, ``convs`` the numbers of all
    conversations.  A node is its smallest member and its depth; ``ends`` counts the members that end there.
    ``saved_tokens`` sums, over the subtree, bytes of the last text times all members but one.  No
    conversations, no nodes.
    """
    ordered, convs = materialize(ordered, "ordered-turns"), materialize(convs.distinct(), "conversations")
    shards = max(1, (ordered.count() + convs.count()) // shard_rows)
    units = _units(ordered, convs, unit, shards)
    fields = ", ".join(f"{name} long" for name in _LOCAL)
    local = units.groupBy("shard").applyInArrow(lambda table: _local_nodes(table, unit), f"shard int, {fields}")
    local = materialize(local, "local-nodes")
    listed = local.filter(F.col("kind") == _NODE)
    nodes = listed.filter("ghost = 0").groupBy(*_KEY).agg(
        F.min("least").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        F.sum("ends").alias("n_ends"),
        F.min("end_least").alias("end_first"),
        ((F.sum("n") - 1) * F.max("size")).alias("weight"),
    )
    # A node without children is one where all its members end.
    nodes = materialize(nodes.withColumn("leaf", (F.col("n_ends") == F.col("n_convs")).cast("long")), "nodes")
    known = listed.join(nodes, _KEY)
    # What a conversation owns beyond a unit counts at the end of that unit.
    owned = nodes.groupBy("conv_id", _unit(F.col("depth"), unit).alias("unit"))
    owned = owned.agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf"))
    goes_on = local.filter(F.col("kind") == _GOES_ON)
    goes_on = goes_on.select("shard", "slot", F.col("least").alias("conv_id"), F.col("parent").alias("unit"))
    following = owned.withColumn("unit", F.col("unit") - 1).filter("unit >= 0")
    later = Window.partitionBy("conv_id").orderBy(F.desc("unit")).rowsBetween(Window.unboundedPreceding, 0)
    seeds = goes_on.join(following, ["conv_id", "unit"], "left").select(
        "shard", "slot",
        F.coalesce(F.sum("weight").over(later), F.lit(0)).alias("weight"),
        F.coalesce(F.sum("leaf").over(later), F.lit(0)).alias("leaf"),
    )
    names = ["shard", "slot", "parent", "depth", "ghost", "least", "conv_id", "n_convs", "n_ends", "end_first", "weight", "leaf"]
    rows = known.select(*names, F.lit(False).alias("seed")).unionByName(seeds.withColumn("seed", F.lit(True)), allowMissingColumns=True)
    summed = rows.groupBy("shard").applyInArrow(
        _subtree_sums,
        "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends long, end_least long",
    )
    found = summed.groupBy("conv_id", "depth").agg(
        F.max("parent_conv_id").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        *[F.sum(name).alias(name) for name in ("n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"),
        F.min("end_least").alias("end_least"),
    )
    ends = local.filter(F.col("kind") == _END).select(*_KEY, F.col("least").alias("member"))
    several = _end_digests(ends.join(nodes.filter("n_ends > 1"), _KEY).select("conv_id", "depth", "member"))
    joined = found.join(several, ["conv_id", "depth"], "left")
    sha = F.when(F.col("ends") == 0, F.lit(_EMPTY_SHA256)).when(F.col("ends") == 1, F.sha2(F.col("end_least").cast("string"), 256))
    return joined.withColumn("ends_sha256", sha.otherwise(F.col("digest"))).drop("digest", "end_least")


def digests(nodes: DataFrame) -> DataFrame:
    return nodes.drop("ends")
