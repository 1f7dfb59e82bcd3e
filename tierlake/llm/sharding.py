"""Balanced label propagation: documents into shards of equal row counts.

Links are a table (row, hub): rows with a hub are each other's neighbours, without
listing pairs.  Linked rows start spread evenly.  In each round a hub's favourite shard
is the one where most of its rows are; a row wants to move where the hubs it has,
weighted by their rows there, want it.  Wishes are summed per (from, to) and admitted
up to a quota: swaps in both directions, and the room that a shard has left.  Which of
them move is decided by a hash of the hub, so that groups move together; a group above
the quota is admitted row by row.

A last step makes sizes exact.  Each shard keeps its linked rows, groups in order, up
to its quota; linked rows above it, and those that still wanted to move after the last
round, then fill the shards' room, groups in order, from the emptiest shard on.  So a
group larger than a shard fills whole shards.  Rows without links are the filler.

Only DataFrame functions are used.  State is a table written every round.  What the
driver sees are counts per shard and per pair of shards.

Defined cases: a null text has no bytes and text_crc32 of the empty text, and null texts
are one group, the empty text another; repeated rows are rows of their own; no rows give
no rows.  Extra columns are dropped from the working tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.components import written

SHARDS = 24
ROUNDS = 4


def text_hub(text: str = "text") -> Column:
    """Equal texts have one hub: two hashes and the length, as one string."""
    c = F.col(text)
    return F.when(c.isNull(), F.lit("null")).otherwise(
        F.concat_ws(":", F.xxhash64(c).cast("string"), F.crc32(c).cast("string"), F.octet_length(c).cast("string")))


def _table(values: dict[int, float], size: int) -> Column:
    return F.array(*[F.lit(float(values.get(k, 0))) for k in range(size)])


def _quota(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def propagate(spark: SparkSession, links: DataFrame, total: int, shards: int = SHARDS,
              rounds: int = ROUNDS) -> DataFrame:
    """(row, shard) of linked rows; ``links`` is (row, hub, n), n the hub's rows, ``total``
    the number of all rows.  Shard is null for a row that found no room where it belongs."""
    state = written(spark, links.select("row").distinct().withColumn(
        "shard", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(shards)).cast("int")), "labels")
    quota = _quota(total, shards)
    for turn in range(rounds):
        here = links.join(state, "row")
        votes = here.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("votes"))
        sizes = {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}
        full = [s for s in range(shards) if sizes.get(s, 0) >= quota[s]]
        # a hub's favourite: most of its rows, not full unless its rows are there already
        open_first = ~F.col("shard").isin(full) if full else F.lit(True)
        favourite = votes.groupBy("hub").agg(
            F.max(F.struct(F.when(open_first, F.col("votes")).otherwise(F.col("votes") - 0.5).alias("v"),
                           (-F.col("shard")).alias("s"))).alias("best"))
        pull = (here.join(favourite, "hub")
                .select("row", "shard", "hub", "n", (-F.col("best.s")).alias("to"), F.col("best.v").alias("v")))
        wish = (pull.groupBy("row", "shard", "to").agg(F.sum("v").alias("v"), F.min(F.struct("hub", "n")).alias("h"))
                .groupBy("row", "shard").agg(F.max(F.struct("v", (-F.col("to")).alias("to"), "h")).alias("b"))
                .select("row", "shard", (-F.col("b.to")).alias("to"), F.col("b.h.hub").alias("hub"),
                        F.col("b.h.n").alias("n")))
        wish = written(spark, wish, "wishes")
        flow = {(r["shard"], r["to"]): r["count"] for r in wish.where("shard <> to").groupBy("shard", "to").count().collect()}
        if not flow:
            break
        admitted: dict[int, float] = {}
        for to in range(shards):
            coming = sum(n for (_, t), n in flow.items() if t == to)
            room = max(0, quota[to] - sizes.get(to, 0))
            swaps = {a: min(n, flow.get((to, a), 0)) for (a, t), n in flow.items() if t == to}
            rest = coming - sum(swaps.values())
            for a, both in swaps.items():
                n = flow[(a, to)]
                more = (n - both) * min(1.0, room / rest) if rest else 0
                admitted[a * shards + to] = (both + more) / n
        share = F.element_at(_table(admitted, shards * shards), F.col("shard") * shards + F.col("to") + 1)
        by_row = F.col("n") > min(quota) // 4
        luck = F.pmod(F.when(by_row, F.xxhash64("row", F.lit(turn))).otherwise(F.xxhash64("hub", F.lit(turn))),
                      F.lit(1 << 30)) / float(1 << 30)
        moves = (F.col("shard") != F.col("to")) & (luck < share)
        # after the last round, rows that still want to move are released
        stay = F.when((F.lit(turn) < rounds - 1) | (F.col("shard") == F.col("to")), F.col("shard"))
        state = written(spark, wish.select("row", F.when(moves, F.col("to")).otherwise(stay).alias("shard")), "labels")
    return state


def _numbered(spark: SparkSession, df: DataFrame, group: str, *order: str) -> DataFrame:
    """``df`` with ``at``: the row's place (from 0) within its group in the given order.
    Sorted by range, so one group may span any number of tasks, and written; places
    within a task are shifted by the rows that earlier tasks hold of the group."""
    sorted_rows = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    table = written(spark, sorted_rows.withColumn("__id", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__id", 33)
    runs = table.groupBy(F.col(group).alias("g"), part.alias("p")).agg(
        F.min("__id").alias("first"), F.count(F.lit(1)).alias("k"))
    # one row per task and group: tasks plus groups rows
    before = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("shift", F.coalesce(F.sum("k").over(before), F.lit(0)))
    return (table.withColumn("__p", part)
            .join(runs, (F.col(group) == F.col("g")) & (F.col("__p") == F.col("p")))
            .withColumn("at", F.col("__id") - F.col("first") + F.col("shift"))
            .drop("__id", "__p", "g", "p", "first", "k", "shift"))


def settle(spark: SparkSession, rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Exact sizes: ``rows`` is (row, hub, shard, ...), hub null without links, shard null
    if the row has none yet."""
    linked, free = rows.where(F.col("shard").isNotNull()), rows.where(F.col("shard").isNull())
    numbered = written(spark, _numbered(spark, linked, "shard", "hub", "row"), "numbered")
    held = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}
    quota = _quota(sum(held.values()), shards)
    keeps = {s: min(quota[s], held.get(s, 0)) for s in range(shards)}
    stays = F.col("at") < F.element_at(_table(keeps, shards), F.col("shard") + 1)
    rest = numbered.where(~stays).drop("at", "shard").unionByName(free.drop("shard"))
    queue = _numbered(spark, rest.withColumn("__all", F.lit(0)).withColumn("__free", F.col("hub").isNull().cast("int")),
                      "__all", "__free", "hub", "row")
    holes = sorted(((quota[s] - keeps[s], s) for s in range(shards) if quota[s] > keeps[s]), key=lambda h: (-h[0], h[1]))
    shard, slot, at = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    bounds = []
    for size, s in holes:
        bounds.append((at, at + size, s, keeps[s] - at))
        at += size
    for a, b, s, shift in reversed(bounds):
        inside = F.col("at") < b
        shard = F.when(inside, F.lit(s)).otherwise(shard)
        slot = F.when(inside, F.col("at") + shift).otherwise(slot)
    placed = queue.select(*[c for c in rows.columns if c != "shard"], shard.alias("shard"), slot.alias("slot"))
    kept = numbered.where(stays).select(*[c for c in rows.columns if c != "shard"], "shard",
                                        F.col("at").alias("slot"))
    return kept.unionByName(placed)


def shard_documents(spark: SparkSession, documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row, by the law
    ``rows``: counts at most one apart, slots gapless."""
    rows = written(spark, documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), text_hub(text).alias("hub")), "rows")
    groups = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    links = written(spark, rows.select("row", "hub").join(groups, "hub"), "links")
    labels = propagate(spark, links, rows.count(), shards)
    linked = links.select("row", F.col("hub").alias("__hub")).join(labels, "row")
    every = (rows.drop("hub").join(linked, "row", "left").withColumnRenamed("__hub", "hub")
             .select("row", "doc_id", "size", "text_crc32", "hub", "shard"))
    return settle(spark, every, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
