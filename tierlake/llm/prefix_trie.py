"""Conversation prefix trie as burst tries.

A turn is a unit of 20 bytes: the first 16 bytes of the SHA-256 of its role and text, and
its number of words.  A conversation is the bytes of its units, so texts leave the job in
the first step, and byte order keeps prefixes together.  Equal conversations are one class
with a count, the smallest id and a digest of the ids, so copies cost nothing later.

Classes start as suffixes in one container under the root.  A container of more than
``BURST_TURNS`` turns bursts by next turn id: what all its suffixes share is taken off
first (a burst therefore always branches), and each next turn becomes the head of a new
container.  A burst leaves a chain of trie heads, from the container's own node to the
branch; all of them have the same members.  Containers that are small enough (or hold one
suffix) are sorted and swept: neighbours in byte order share the longest prefixes, so a
stack of open nodes suffices, and a node is complete once the sweep leaves it.  Totals of
a container go up to the bursts above it, whose number is small.

Hot groups: a first turn or a long prefix that very many conversations share is burst over
rounds, never held by one task; ids of one class are joined and digested in slices of
``SLICE_IDS`` ids.  A round costs one pass over the suffixes that are still in oversized
containers.  The number of rounds is the number of branching places above containers, not
the depth of the tree.

Bounds: a container in memory holds at most ``BURST_TURNS`` turns or one suffix; one
conversation's units (20 bytes a turn) are one value.

Defined cases: rows without a conversation id take no part; turns that have the same
number are ordered by their units; repeated rows are turns of their own; a null role or
text is empty; a conversation without turns is a member of the root and ends there; no
conversations give no nodes.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.components import written

UNIT = 20                      # bytes of a turn: 16 of identity, 4 of word count
BURST_TURNS = 1 << 16          # turns of suffixes that a container may hold
SLICE_IDS = 1 << 14            # conversation ids joined by one row
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")


# ---------------------------------------------------------------- conversations

def turn_unit(role: Column, text: Column) -> Column:
    """The unit of a turn as 40 hexadecimal digits."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.lower(F.hex(F.regexp_count(text, F.lit(WORD)))), 8, "0"))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, units): every conversation's units in order of turn, nulls first."""
    held = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_unit(F.col("role"), F.col("text")).alias("unit"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "unit")))
    return held.groupBy("conv_id").agg(ordered.alias("t")).select("conv_id", F.col("t.unit").alias("units"))


def joined(units: Column) -> Column:
    """An array of units as bytes."""
    return F.unhex(F.array_join(units, ""))


def as_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path) of (conv_id, units)."""
    return conversations.select("conv_id", joined(F.col("units")).alias("path"))


def rebuilt(conversations: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """Conversations whose first h turns are those of their group's first conversation,
    h being their id's checksum modulo ``most`` + 1."""
    heads = conversations.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("__base"), F.slice("units", 1, most).alias("__head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    own = conversations.withColumns({"__of": F.col("conv_id") - F.col("conv_id") % group, "__h": h})
    head = F.when(F.col("__head").isNull(), F.array().cast("array<string>")) \
        .otherwise(F.slice("__head", F.lit(1), F.col("__h")))
    rest = F.slice("units", F.col("__h") + 1, F.size("units"))
    return own.join(heads, F.col("__of") == F.col("__base"), "left").select(
        "conv_id", F.concat(head, rest).alias("units"))


# ---------------------------------------------------------------- classes

def _digests(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per class of its chunks in order, fed chunk by chunk."""
    key, state = None, None
    for b in chunks:
        keys, digests = [], []
        for k, ids in zip(b.column("class").to_pylist(), b.column("ids").to_pylist()):
            if k != key:
                if state is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())],
                                         names=["class", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                                         names=["class", "ends"])


def classes(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """(path, n, least, ends): distinct paths, how many conversations have them, the smallest
    of their ids and the SHA-256 of all, ascending and comma-joined."""
    keyed = written(spark, paths.withColumn("class", F.unhex(F.sha2(F.col("path"), 256))), "trie_paths")
    slices = keyed.groupBy("class", F.floor(F.col("conv_id") / SLICE_IDS).alias("slice")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    chunks = slices.select("class", "slice", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    ends = (chunks.repartition("class").sortWithinPartitions("class", "slice").select("class", "ids")
            .mapInArrow(_digests, "class binary, ends string"))
    sums = keyed.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
                                      F.first("path").alias("path"))
    return sums.join(ends, "class").select("path", "n", "least", "ends")


# ---------------------------------------------------------------- bursting

def _turns(rest: Column) -> Column:
    return (F.length(rest) / UNIT).cast("int")


def _unit_words(unit: Column) -> Column:
    return F.conv(F.hex(F.substring(unit, 17, 4)), 16, 10).cast("long")


def _shared(a: Column, b: Column) -> Column:
    """Number of leading units that two byte strings share."""
    def unit(x, i):
        return F.substring(x, i * UNIT + 1, F.lit(UNIT))
    most = F.least(_turns(a), _turns(b))
    places = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.lit(0), lambda n, i: F.when((n == i) & (unit(a, i) == unit(b, i)), n + 1).otherwise(n))


def _oversized(spark: SparkSession, held: DataFrame, most: int) -> DataFrame:
    """(head, shared, n, least, path): containers to burst, and what their suffixes share."""
    sizes = held.groupBy("head").agg(F.sum(_turns(F.col("rest"))).alias("turns"), F.count(F.lit(1)).alias("rows"))
    big = written(spark, sizes.where((F.col("turns") > most) & (F.col("rows") > 1)).select("head"), "trie_big")
    stats = held.join(big, "head", "left_semi").groupBy("head").agg(
        F.min("rest").alias("a"), F.max("rest").alias("b"), F.sum("n").alias("e_n"), F.min("least").alias("e_least"))
    shared = stats.withColumn("shared", _shared(F.col("a"), F.col("b")))
    return written(spark, shared.select("head", "shared", "e_n", "e_least",
                                        F.substring(F.col("a"), F.lit(1), F.col("shared") * UNIT).alias("path")), "trie_bursts")


HELD = ("head", "depth", "head_words", "chain", "parent", "rest", "n", "least", "ends")


def burst(spark: SparkSession, found: DataFrame, most: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """(containers, bursts, ends at branches), each as the tables that the rounds wrote.

    A suffix carries its container's head (a digest that stands for the path to it), the head's
    depth and words, the chain of bursts above it and the smallest conversation id of the head's
    parent node."""
    held = found.select("head", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("head_words"),
                        F.array().cast("array<binary>").alias("chain"), F.lit(None).cast("long").alias("parent"),
                        F.col("path").alias("rest"), "n", "least", "ends")
    kept, bursts, ended = [], [], []
    while True:
        big = _oversized(spark, held, most)
        kept.append(held.join(big, "head", "left_anti").select(*HELD))
        if big.isEmpty():
            return kept, bursts, ended
        hit = held.join(big, "head")
        at = F.col("shared") * UNIT
        chain = F.concat("chain", F.array("head"))
        ended.append(hit.where(F.length("rest") == at).select("head", "ends"))
        # one row of each burst container tells what the container's rows have in common
        first = held.join(big.select("head"), "head", "left_semi").groupBy("head").agg(
            F.min(F.struct("depth", "head_words", "chain", "parent")).alias("c"))
        bursts.append(big.join(first, "head").select("head", "c.*", "shared", "path", F.col("e_n").alias("n"),
                                                     F.col("e_least").alias("least")))
        unit = F.substring(F.col("rest"), at + 1, F.lit(UNIT))
        held = written(spark, hit.where(F.length("rest") > at).select(
            F.unhex(F.substring(F.sha2(F.concat(F.col("head"), F.lit("/").cast("binary"), unit), 256), 1, 32)).alias("head"),
            (F.col("depth") + F.col("shared") + 1).alias("depth"), _unit_words(unit).alias("head_words"),
            chain.alias("chain"), F.col("e_least").alias("parent"),
            F.expr(f"substring(rest, shared * {UNIT} + {UNIT} + 1)").alias("rest"), "n", "least", "ends"), "trie_held")


# ---------------------------------------------------------------- sweeping

class _Sweep:
    """Nodes of one container from its suffixes in byte order."""

    def __init__(self, row: dict):
        self.depth, self.chain, self.parent = row["depth"], row["chain"], row["parent"]
        # per node: depth, words of the last turn, parent's number, members, least, children, leaves, saved, ends
        self.nodes = [[self.depth, row["head_words"], -1, 0, None, 0, 0, 0, EMPTY]]
        self.stack, self.last = [0], b""

    def add(self, rest: bytes, n: int, least: int, ends: str) -> None:
        shared, most = 0, min(len(rest), len(self.last))
        while shared < most and rest[shared:shared + UNIT] == self.last[shared:shared + UNIT]:
            shared += UNIT
        self.leave(shared // UNIT)
        for at in range(shared, len(rest), UNIT):
            words = int.from_bytes(rest[at + 16:at + UNIT], "big")
            self.nodes.append([self.depth + at // UNIT + 1, words, self.stack[-1], 0, None, 0, 0, 0, EMPTY])
            self.stack.append(len(self.nodes) - 1)
        node = self.nodes[self.stack[-1]]
        node[3] += n
        node[4] = least if node[4] is None else min(least, node[4])
        node[8] = ends
        self.last = rest

    def leave(self, level: int) -> None:
        """Close the open nodes below ``level``: they are complete."""
        while len(self.stack) > level + 1:
            self._close(self.nodes[self.stack.pop()])

    def _close(self, node: list) -> None:
        node[6] = node[6] or 1
        node[7] += (node[3] - 1) * node[1]
        if node[2] >= 0:
            up = self.nodes[node[2]]
            up[3] += node[3]
            up[4] = node[4] if up[4] is None else min(up[4], node[4])
            up[5] += 1
            up[6] += node[6]
            up[7] += node[7]

    def rows(self) -> Iterator[tuple]:
        self.leave(-1)
        for i, (depth, _, up, n, least, children, leaves, saved, ends) in enumerate(self.nodes):
            parent = self.nodes[up][4] if up >= 0 else self.parent
            yield least, depth, parent, n, children, leaves, saved, ends, self.chain if i == 0 else None


_SWEPT = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                              "saved_tokens")]
                   + [("ends_sha256", pa.string()), ("chain", pa.list_(pa.binary()))])


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose rows come together, sorted by suffix.  The head of a container
    has its chain of bursts; other nodes have none."""
    head, made, out = None, None, []

    def full() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SWEPT)], schema=_SWEPT)
        out.clear()
        return b

    for b in batches:
        for row in b.to_pylist():
            if made is None or row["head"] != head:
                if made is not None:
                    out.extend(made.rows())
                    if len(out) >= 4096:
                        yield full()
                head, made = row["head"], _Sweep(row)
            made.add(row["rest"], row["n"], row["least"], row["ends"])
    if made is not None:
        out.extend(made.rows())
    if out:
        yield full()


# ---------------------------------------------------------------- trie

def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _burst_nodes(spark: SparkSession, swept: DataFrame, bursts: DataFrame, ended: DataFrame) -> DataFrame:
    """The nodes that bursts left, with what lies in the containers and bursts below them."""
    # words of the node itself (the container's head), then of what its suffixes shared
    path = F.transform(F.sequence(F.lit(0), F.col("shared")),
                       lambda i: F.when(i == 0, F.col("head_words")).otherwise(
                           _unit_words(F.substring(F.col("path"), (i - 1) * UNIT + 1, F.lit(UNIT)))))
    bursts = written(spark, bursts.withColumn("words", path).withColumn(
        "own", (F.col("n") - 1) * F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)), "trie_burst_nodes")
    tops = swept.where(F.col("chain").isNotNull())
    below = tops.select(F.explode("chain").alias("head"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")) \
        .unionByName(bursts.select(F.explode("chain").alias("head"), F.lit(0).cast("long").alias("leaves"),
                                   F.col("own").alias("saved")))
    below = below.groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    child = tops.select(F.element_at("chain", -1).alias("head")).unionByName(
        bursts.where(F.size("chain") > 0).select(F.element_at("chain", -1).alias("head")))
    child = child.groupBy("head").agg(F.count(F.lit(1)).alias("children"))
    full = bursts.join(below, "head").join(child, "head").join(ended, "head", "left")
    step = F.posexplode("words").alias("i", "w")
    nodes = full.select("*", step)
    at_branch = F.col("i") == F.col("shared")
    deeper = F.aggregate(F.slice("words", F.col("i") + 1, F.size("words")), F.lit(0).cast("long"), lambda a, w: a + w)
    return nodes.select(
        F.col("least").alias("conv_id"), (F.col("depth") + F.col("i")).cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("parent")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(at_branch, F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), ((F.col("n") - 1) * deeper + F.col("saved")).alias("saved_tokens"),
        F.when(at_branch, F.coalesce("ends", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(spark: SparkSession, paths: DataFrame, burst_turns: int = BURST_TURNS) -> DataFrame:
    """One row per node (``NODE``) of the trie of (conv_id, path); conv_ids are distinct."""
    # the root's head is a column of the written table: as a constant it would turn joins into nested loops
    found = written(spark, classes(spark, paths).withColumn("head", F.unhex(F.lit(""))), "trie_classes")
    kept, bursts, ended = burst(spark, found, burst_turns)
    swept = (_union(kept).repartition("head").sortWithinPartitions("head", "rest")
             .mapInArrow(sweep, NODE + ", chain array<binary>"))
    columns = [c.strip().split(" ")[0] for c in NODE.split(",")]
    if not bursts:
        return swept.select(*columns)
    swept = written(spark, swept, "trie_swept")
    return swept.select(*columns).unionByName(_burst_nodes(spark, swept, _union(bursts), _union(ended)))
