"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors of whole numbers are dealt into index blocks.  A posting (vector, dimension) has an
impact level, the number of binary digits of |value|.  A block is one row of the written
index: per level a segment of its postings, dimension by dimension; for each vector the norm
of what lies below each level; and for each dimension the largest |value| in the block.

A first pass scores every query against one block, which gives a lower bound of its k-th best
score.  A second pass over the largest values alone proves of (query block, index block)
pairs that no vector can reach the bound of any of their queries; these are not read.  The
others go through the segments from the highest level down and add them to the scores.  After
each level a vector's score is known up to |query| x (norm of its rest); a vector whose upper
bound is below the query's k-th best lower bound is out.  Processing stops when few vectors
are possible, which proves that all others are out; these few are scored again exactly.  A
round reads the segments of the upper levels only; pairs that could not stop there go on to a
round that reads more levels, at last all.

Queries are a stated set of rows and meet the blocks in query blocks; a unit returns at most k
rows per query, and a window with a group limit keeps the k best.

Defined cases: a vector that is null, empty, or holds null or non-finite components takes no
part, nor does a null id; shorter vectors count as padded by zeros; rows with equal ids are
rows of their own (each query row has its own ranks, and is no candidate of itself only); ties
go to the smaller id; components and scores beyond 64 bits count as the nearest long; a query
with fewer candidates gets all; an empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.components import shuffled_join, written
from tierlake.llm.vectors import exact, floored, largest, matrix, packed, takes_part, unpacked

INDEX_BLOCK = 4096             # vectors in an index block, about
QUERY_BLOCK = 256              # queries scored together
PEAK_GROUP = 1024              # index blocks whose largest values are sent together
SLICE_BLOCKS = 64              # query blocks that meet such a group in one task, about
FEW = 64                       # possible members per query that are simply rescored
DEPTHS = (0.8, 1.0)            # shares of the levels that the rounds read
MOST_TASKS = 20_000            # tasks that build the index


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): v the floored scaled components as longs, of vectors that take part."""
    return (vectors.where(F.col(vec_id).isNotNull() & takes_part(vector))
            .select(F.col(vec_id).cast("long").alias("id"), floored(vector).alias("v")))


# ---------------------------------------------------------------- index

def _levels(m: np.ndarray) -> np.ndarray:
    """The number of binary digits of |value|; 0 for 0."""
    level = np.zeros(m.shape, dtype=np.int64)
    size = np.where(m < 0, -(m + 1), m).astype(np.uint64) + (m < 0)      # the least long has no negation
    while (size > 0).any():
        level += size > 0
        size >>= np.uint64(1)
    return level


def _index(top: int):
    """The index row of one block: levels ``top`` down to 1."""
    def run(block: pa.Table) -> pa.Table:
        rows, ids = (block.column(c).to_numpy().astype("<i8") for c in ("row", "id"))
        m = matrix(block.column("v").to_pylist())
        level, square = _levels(m), m.astype(np.float64) ** 2
        small = largest(m) < 1 << 15
        rest = np.stack([np.sqrt(np.where(level < k, square, 0).sum(axis=1)) for k in range(top, 0, -1)])
        out = {"block": block.column("block").slice(0, 1), "wide": pa.array([m.shape[1]], pa.int32()), "small": pa.array([small])}
        for name, x in (("rows", rows), ("ids", ids), ("m", m.astype("<i2" if small else "<i8")), ("rest", rest.astype("<f8")),
                        ("peak", np.abs(m.astype(np.float64)).max(axis=0).astype("<f8"))):
            out[name] = pa.array([x.tobytes()], pa.binary())
        for k in range(1, top + 1):
            dim, row = np.nonzero((level == k).T)
            starts = np.searchsorted(dim, np.arange(m.shape[1] + 1)).astype("<i4")
            out[f"segment_{k}"] = pa.array([starts.tobytes() + row.astype("<i4").tobytes()], pa.binary())
        return pa.table(out)
    return run


def build_index(spark: SparkSession, rows: DataFrame, n_blocks: int, top: int) -> DataFrame:
    """One row per block of ``rows`` (row, id, v), written."""
    schema = ("block int, wide int, small boolean, rows binary, ids binary, m binary, rest binary, peak binary, "
              + ", ".join(f"segment_{k} binary" for k in range(1, top + 1)))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int"))
    dealt = dealt.repartition(min(n_blocks, MOST_TASKS), "block")      # tiny files would be read by one task
    return written(spark, dealt.groupBy("block").applyInArrow(_index(top), schema), "impact_index")


class Block:
    """An index row, read from level ``top`` down to ``last``."""

    def __init__(self, r: dict, top: int, last: int):
        self.rows, self.ids = (np.frombuffer(r[c], dtype="<i8") for c in ("rows", "ids"))
        n, wide = len(self.ids), r["wide"]
        self.m = np.frombuffer(r["m"], dtype="<i2" if r["small"] else "<i8").reshape(n, wide).astype(np.int64)
        self.rest = np.frombuffer(r["rest"], dtype="<f8").reshape(top, n)
        self.top, self.last, self.segments, self.read = top, last, {}, 0
        for k in range(top, last - 1, -1):
            at = 4 * (wide + 1)
            held = r[f"segment_{k}"]
            self.segments[k] = np.frombuffer(held[:at], dtype="<i4"), np.frombuffer(held[at:], dtype="<i4")

    def search(self, q_rows: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, list | None]:
        """(which queries are settled, their best k as (query row, row, id, score)).  ``floor`` is a
        lower bound of each query's k-th best score over all blocks."""
        wide = self.m.shape[1]
        q = np.pad(q, ((0, 0), (0, max(0, wide - q.shape[1]))))[:, :wide]      # dimensions of no vector here add nothing
        weights, m = q.astype(np.float64).T.copy(), self.m.astype(np.float64)
        norm = np.sqrt((weights ** 2).sum(axis=0))[None, :] * (1 + 1e-9)
        own = self.rows[:, None] == q_rows[None, :]
        score = np.zeros((len(self.rows), len(q)))
        possible = ~own
        for level in range(self.top, self.last - 1, -1):
            starts, rows = self.segments[level]
            if not len(rows):
                continue
            for d in np.flatnonzero(np.diff(starts)).tolist():
                at = rows[starts[d]:starts[d + 1]]
                score[at] += m[at, d][:, None] * weights[d][None, :]
                self.read += len(at)
            slack = self.rest[self.top - level][:, None] * norm + 1e-9 * np.abs(score) + 0.5
            lower = np.where(own, -np.inf, score - slack)
            # with fewer vectors than k there is no k-th best here
            kth = -np.partition(-lower, k - 1, axis=0)[k - 1] if len(lower) >= k else np.full(len(q), -np.inf)
            possible = ~own & (score + slack >= np.maximum(kth, floor)[None, :])
            if (np.count_nonzero(possible, axis=0) <= FEW).all():
                break
        settled = np.count_nonzero(possible, axis=0) <= FEW if self.last > 1 else np.ones(len(q), dtype=bool)
        r, a = np.nonzero(possible & settled[None, :])
        scores = exact(q, self.m, a, r)
        found = []
        order = np.array(sorted(range(len(r)), key=lambda i: (a[i], -int(scores[i]), self.ids[r[i]], self.rows[r[i]])), dtype=np.int64)
        taken = -1, 0
        for i in order.tolist():
            taken = (a[i], taken[1] + 1) if taken[0] == a[i] else (a[i], 1)
            if taken[1] <= k:
                found.append((int(q_rows[a[i]]), int(self.rows[r[i]]), int(self.ids[r[i]]), int(scores[i])))
        return settled, found


# ---------------------------------------------------------------- search

_QUERIES = "q_rows binary, q_m binary, q_wide int, q_small boolean, q_floor binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries (row, v, floor) in blocks of packed numbers; a null floor is none."""
    def block(held: list[dict]) -> pa.RecordBatch:
        m = matrix([r["v"] for r in held])
        held_m, small = packed(m)
        floor = np.array([-np.inf if r["floor"] is None else r["floor"] for r in held], dtype="<f8")
        return pa.RecordBatch.from_arrays(
            [pa.array([np.array([r["row"] for r in held], dtype="<i8").tobytes()], pa.binary()),
             pa.array([held_m], pa.binary()), pa.array([m.shape[1]], pa.int32()), pa.array([small]),
             pa.array([floor.tobytes()], pa.binary())], names=["q_rows", "q_m", "q_wide", "q_small", "q_floor"])
    held: list[dict] = []
    for b in batches:
        for r in b.to_pylist():
            held.append(r)
            if len(held) == QUERY_BLOCK:
                yield block(held)
                held = []
    if held:
        yield block(held)


def _query(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.frombuffer(r["q_rows"], dtype="<i8")
    return rows, unpacked(r["q_m"], len(rows), r["q_wide"], r["q_small"]), np.frombuffer(r["q_floor"], dtype="<f8")


def reachable(q: np.ndarray, floor: np.ndarray, peak: np.ndarray) -> np.ndarray:
    """Of each query: can a vector whose values are nowhere above ``peak`` reach its floor?"""
    wide = min(q.shape[1], len(peak))
    most = np.abs(q[:, :wide].astype(np.float64)) @ peak[:wide]
    return most * (1 + 1e-9) + 0.5 >= floor


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of blocks that have to be read; a row holds a query block and a group's peaks."""
    for b in batches:
        for i in range(b.num_rows):
            r = b.slice(i, 1).to_pylist()[0]
            _, q, floor = _query(r)
            met = [p["block"] for p in r["peaks"] if reachable(q, floor, np.frombuffer(p["peak"], dtype="<f8")).any()]
            yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array([r["q_block"]] * len(met), pa.int64())],
                                             names=["block", "q_block"])


def _search(k: int, top: int, last: int):
    """Best rows of settled queries; a row without a score is a query that needs more levels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                rows, q, floor = _query(r)
                settled, found = Block(r, top, last).search(rows, q, floor, k)
                # a pair of blocks is settled as a whole, or read again
                out = found if settled.all() else [(None, None, None, None)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]] * len(out), pa.int32()), pa.array([r["q_block"]] * len(out), pa.int64()),
                     *[pa.array([f[c] for f in out], pa.int64()) for c in range(4)]],
                    names=["block", "q_block", "q_row", "x_row", "vec_id", "score"])
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc("vec_id"), F.asc("x_row"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(spark: SparkSession, vectors: DataFrame, asked: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (id, v) that the condition ``asked``
    names, against all of them."""
    rows = written(spark, vectors.withColumn("row", F.monotonically_increasing_id()), "impact_rows")
    digits = F.aggregate("v", F.lit(0), lambda a, x: F.greatest(a, F.length(F.bin(F.abs(F.greatest(x, F.lit(-(2 ** 63 - 1)))))) ))
    n, n_asked, top = rows.agg(F.count(F.lit(1)), F.count(F.when(asked, 1)), F.max(digits)).first()
    n_blocks, top = max(1, -(-n // INDEX_BLOCK)), max(1, min(64, (top or 1) + 1))
    index = build_index(spark, rows, n_blocks, top)
    queries = rows.where(asked)
    kinds = "block int, q_block long, q_row long, x_row long, vec_id long, score long"

    def blocks(of: DataFrame) -> DataFrame:
        packed = of.select("row", "v", "floor").mapInArrow(_pack, _QUERIES)
        return written(spark, packed.withColumn("q_block", F.monotonically_increasing_id()), "impact_queries")

    def units(pairs: DataFrame, of: DataFrame, last: int) -> DataFrame:
        held = index.select("block", "wide", "small", "rows", "ids", "m", "rest", *[f"segment_{j}" for j in range(top, last - 1, -1)])
        sent = shuffled_join(of, pairs, ["q_block"])
        return shuffled_join(sent, held, ["block"]).mapInArrow(_search(k, top, last), kinds)

    # a floor for every query: its k-th best score in one block
    first = blocks(queries.withColumn("floor", F.lit(None).cast("double")))
    seed = units(written(spark, first.select("q_block", F.lit(0).alias("block")), "impact_seeds"), first, 1)
    floor = _best(seed.where(F.col("q_row").isNotNull()), k).where(F.col("rank") == k).select(
        F.col("q_row").alias("row"), F.col("score").cast("double").alias("floor"))
    floor = written(spark, floor, "impact_floors")
    # a double may round a large score up, a bound must not
    asked_blocks = blocks(queries.join(floor, "row", "left").withColumn(
        "floor", F.col("floor") - F.abs("floor") * F.lit(1e-9)))
    # peaks are small: groups of them go to slices of the query blocks, not every query to every index block
    n_groups, n_slices = -(-n_blocks // PEAK_GROUP), max(1, -(-n_asked // (QUERY_BLOCK * SLICE_BLOCKS)))
    peaks = index.groupBy(F.floor(F.col("block") / PEAK_GROUP).cast("int").alias("group")).agg(
        F.collect_list(F.struct("block", "peak")).alias("peaks"))
    peaks = peaks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
    every = asked_blocks.withColumn("slice", F.pmod(F.xxhash64("q_block"), F.lit(n_slices)).cast("int")) \
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    pairs = written(spark, shuffled_join(every, peaks, ["group", "slice"]).mapInArrow(_meet, "block int, q_block long"), "impact_pairs")

    results = []
    for share in DEPTHS:
        last = max(1, top - int(np.ceil(share * top)) + 1) if share < 1 else 1
        found = written(spark, units(pairs, asked_blocks, last), "impact_found")
        results.append(found.where(F.col("q_row").isNotNull()))
        if last == 1:
            break
        pairs = written(spark, found.where(F.col("q_row").isNull()).select("block", "q_block"), "impact_pairs")
        if pairs.isEmpty():
            break
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return (_best(out, k).join(queries.select(F.col("row").alias("q_row"), F.col("id").alias("query_id")), "q_row")
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
