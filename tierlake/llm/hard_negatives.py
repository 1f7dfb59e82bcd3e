"""Hard-negative mining by L2AP-style threshold joins.

Rows are dealt into shards.  A shard orders its dimensions by their energy and knows, for
each row and place in that order, the norm of what is left from there on (the suffix
norm).  A row and an anchor whose score reaches t share a dimension before the place
where suffix norm times anchor norm falls below t, so for the threshold t a posting
(dimension, row) behind that place is not needed.  The index files every posting under
the first of a descending list of levels (threshold over anchor norm) that needs it, and a
join at a level reads the postings of that level and those above it only.

A join at one level takes every pending anchor against every shard: the postings of one
dimension after another add partial scores; a pair is dropped once its partial score plus
the product of both remaining norms is below the anchor's threshold, and when few pairs
are left they are scored exactly, in whole numbers, at once.  Only scores that reach the
threshold come out, so what a join finds at the top of an anchor's list is the top.
Anchors whose windows are not full go on to the next lower level; the last level has no
threshold.  The first run of joins fills the positives, the second, with windows set by
the positives' scores, the negatives; a window is also full when the threshold has passed
its lower end.

Anchors are a stated query set (rows dealt by id) and meet the shards in blocks: a shard's
index row is read once per join, blocks of anchors are sent to the shards.  A unit returns
at most k rows per window and anchor; windows with a group limit keep the best.

Defined cases: a row takes no part if its id, label or vector is null, if the vector is
empty or holds a null or non-finite component; shorter vectors count as padded by zeros;
rows with equal ids are rows of their own (each anchor row has its own results, and is
no candidate of itself only); ties go to the smaller id; components and scores beyond 64
bits count as the nearest long; an anchor without another row of its label, and a pair
without a negative, give no row; an empty table gives none.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.components import shuffled_join, written
from tierlake.llm.vectors import exact, floored, largest, matrix, packed, takes_part, unpacked

SHARD_ROWS = 4096              # rows of a shard, about
ANCHOR_BLOCK = 128             # anchors scored together
LEVELS = (0.8, 0.5, 0.35, 0.25, 0.12, 0.0)   # thresholds over anchor norm, in median row norms
CHECK_EVERY = 8                # dimensions between two prunings
FEW = 16                       # pairs per anchor that are simply scored exactly
MOST_TASKS = 20_000            # tasks that build the index
POSITIVES, NEGATIVES = 5, 3
LEAST_SHARE, MOST_SHARE = 50, 95   # a negative's score over its positive's, in hundredths


# ---------------------------------------------------------------- rows

def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
              relabel: bool = True) -> DataFrame:
    """(id, label, v) of the rows that take part: v the floored scaled components as longs.
    With ``relabel`` labels of ids divisible by 7 move on by one, modulo 10."""
    ids, labels = F.col(vec_id).cast("long"), F.col(label).cast("long")
    if relabel:
        labels = F.when(ids % 7 == 0, (labels + 1) % 10).otherwise(labels)
    return (vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & takes_part(vector))
            .select(ids.alias("id"), labels.alias("label"), floored(vector).alias("v")))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


# ---------------------------------------------------------------- index

def _index(levels: list[float]):
    """The index row of one shard: its rows, and per level the postings it adds."""
    def run(shard: pa.Table) -> pa.Table:
        rows, ids, labels = (shard.column(c).to_numpy().astype(np.int64) for c in ("row", "id", "label"))
        m = matrix(shard.column("v").to_pylist())
        energy = m.astype(np.float64) ** 2
        order = np.argsort(-energy.sum(axis=0), kind="stable")
        m, energy = m[:, order], energy[:, order]
        suffix = np.sqrt(np.cumsum(energy[:, ::-1], axis=1)[:, ::-1])
        # the first level whose threshold the suffix norm reaches, with room for rounding
        need = np.searchsorted(-np.array(levels), -(suffix * (1 + 1e-9) + 1e-9), side="left")
        need[m == 0] = len(levels)
        small = largest(m) < 1 << 15
        out = {"shard": shard.column("shard").slice(0, 1), "wide": pa.array([m.shape[1]], pa.int32()), "small": pa.array([bool(small)]),
               "dims": pa.array([order.astype("<i4").tobytes()], pa.binary()),
               "m": pa.array([m.astype("<i2" if small else "<i8").tobytes()], pa.binary())}
        for name, x in (("rows", rows), ("ids", ids), ("labels", labels)):
            out[name] = pa.array([x.astype("<i8").tobytes()], pa.binary())
        for k in range(len(levels)):
            dim, row = np.nonzero((need == k).T)      # postings dimension by dimension
            starts = np.searchsorted(dim, np.arange(m.shape[1] + 1)).astype("<i4")
            out[f"post_{k}"] = pa.array([starts.tobytes() + row.astype("<i4").tobytes()], pa.binary())
        return pa.table(out)
    return run


def build_index(spark: SparkSession, rows: DataFrame, levels: list[float], n_shards: int) -> DataFrame:
    """One row per shard of ``rows`` (row, id, label, v), written."""
    schema = ("shard int, wide int, small boolean, dims binary, m binary, rows binary, ids binary, labels binary, "
              + ", ".join(f"post_{k} binary" for k in range(len(levels))))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int"))
    dealt = dealt.repartition(min(n_shards, MOST_TASKS), "shard")      # tiny files would be read by one task
    return written(spark, dealt.groupBy("shard").applyInArrow(_index(levels), schema), "negatives_index")


class Shard:
    """An index row, read up to one level."""

    def __init__(self, r: dict, level: int):
        self.rows, self.ids, self.labels = (np.frombuffer(r[c], dtype="<i8") for c in ("rows", "ids", "labels"))
        self.m = np.frombuffer(r["m"], dtype="<i2" if r["small"] else "<i8").reshape(len(self.ids), r["wide"]).astype(np.int64)
        self.dims = np.frombuffer(r["dims"], dtype="<i4")
        self.values = self.m.astype(np.float64)
        self.parts = []
        for k in range(level + 1):
            at = 4 * (r["wide"] + 1)
            self.parts.append((np.frombuffer(r[f"post_{k}"][:at], dtype="<i4"), np.frombuffer(r[f"post_{k}"][at:], dtype="<i4")))
        self.suffix = np.sqrt(np.cumsum((self.values ** 2)[:, ::-1], axis=1)[:, ::-1])
        self.postings_read = sum(len(p) for _, p in self.parts)

    def postings(self, place: int) -> np.ndarray:
        return np.concatenate([rows[starts[place]:starts[place + 1]] for starts, rows in self.parts])

    def reaching(self, q: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """(anchor number, row number, exact score) of the allowed pairs that may reach ``least``
        (-inf: no threshold), among them all that do."""
        wide = len(self.dims)
        if q.shape[1] < wide:
            q = np.pad(q, ((0, 0), (0, wide - q.shape[1])))
        q = q[:, self.dims]           # dimensions that no row of the shard has add nothing
        weights = q.astype(np.float64).T.copy()
        rest = np.sqrt(np.cumsum((weights ** 2)[::-1], axis=0)[::-1])
        score = np.zeros((len(self.ids), q.shape[0]))
        done = np.zeros(len(self.ids), dtype=np.int64)     # the place after a row's last posting so far
        alive = allowed.T.copy()
        free = np.isinf(least).any()
        for place in range(wide):
            at = self.postings(place)
            score[at] += self.values[at, place][:, None] * weights[place][None, :]
            done[at] = place + 1
            if not free and (place + 1) % CHECK_EVERY == 0 and place + 1 < wide:
                alive &= score + self._bound(done, rest) >= least[None, :]
                if np.count_nonzero(alive) <= FEW * q.shape[0]:
                    break
        else:
            if not free:
                alive &= score + self._bound(done, rest) >= least[None, :]
        r, a = np.nonzero(alive)
        return a, r, exact(q, self.m, a, r)

    def _bound(self, done: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """What a pair's score may still gain, with room for rounding: the product of the norms of
        the row's part that was not added and of the anchor's from there on."""
        wide = len(self.dims)
        held = np.where(done < wide, self.suffix[np.arange(len(done)), np.minimum(done, wide - 1)], 0.0)
        left = np.vstack([rest, np.zeros((1, rest.shape[1]))])[done]
        return held[:, None] * left * (1 + 1e-9) + 1e-6 * (1 + rest[0][None, :] * self.suffix[:, :1])


# ---------------------------------------------------------------- joins

_BLOCK = "a_rows binary, a_labels binary, a_wide int, a_small boolean, a_m binary, a_least binary, a_windows binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors (row, label, v, least, windows) in blocks, as packed integers.  ``windows`` holds
    (number, positive score) pairs, padded by number -1."""
    def block(held: list[dict]) -> pa.RecordBatch:
        m = matrix([r["v"] for r in held])
        most = max([1, *(len(r["windows"]) for r in held)])
        windows = np.full((len(held), most, 2), -1, dtype="<i8")
        for i, r in enumerate(held):
            for j, w in enumerate(r["windows"]):
                windows[i, j] = w["number"], w["score"]
        held_m, small = packed(m)
        least = np.array([np.nan if r["least"] is None else r["least"] for r in held], dtype="<f8")
        rows, labels = (np.array([r[c] for r in held], dtype="<i8") for c in ("row", "label"))
        return pa.RecordBatch.from_arrays(
            [pa.array([rows.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary()), pa.array([m.shape[1]], pa.int32()),
             pa.array([small]), *[pa.array([x], pa.binary()) for x in (held_m, least.tobytes(), windows.tobytes())]],
            names=[c.split(" ")[0] for c in _BLOCK.split(", ")])
    held: list[dict] = []
    for b in batches:
        for r in b.to_pylist():
            held.append(r)
            if len(held) == ANCHOR_BLOCK:
                yield block(held)
                held = []
    if held:
        yield block(held)


def _join(level: int, same_label: bool, keep: int):
    """Rows of a unit that reach the thresholds: the best ``keep`` per anchor and window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                found = list(_unit(Shard(r, level), r, same_label, keep))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[c] for f in found], pa.int64()) for c in range(5)],
                    names=["row", "number", "x_row", "x_id", "score"])
    return run


def _unit(shard: Shard, r: dict, same_label: bool, keep: int) -> Iterator[tuple]:
    rows, labels = (np.frombuffer(r[c], dtype="<i8") for c in ("a_rows", "a_labels"))
    q = unpacked(r["a_m"], len(rows), r["a_wide"], r["a_small"])
    least = np.frombuffer(r["a_least"], dtype="<f8")
    least = np.where(np.isnan(least), -np.inf, least)
    windows = np.frombuffer(r["a_windows"], dtype="<i8").reshape(len(rows), -1, 2)
    alike = labels[:, None] == shard.labels[None, :]
    allowed = (alike if same_label else ~alike) & (rows[:, None] != shard.rows[None, :])
    a, x, score = shard.reaching(q, least, allowed)
    real = score >= least[a]
    a, x, score = a[real], x[real], score[real]
    if not len(score) or np.abs(score.astype(np.float64)).max() < 1 << 52:
        order = np.lexsort((shard.rows[x], shard.ids[x], -score, a))
    else:      # the negation of the least long is no long
        order = np.array(sorted(range(len(score)), key=lambda i: (a[i], -int(score[i]), shard.ids[x[i]], shard.rows[x[i]])),
                         dtype=np.int64)
    a, x, score = a[order], x[order], score[order]
    ends = np.searchsorted(a, np.arange(len(rows) + 1))
    for i in range(len(rows)):
        s = slice(ends[i], ends[i + 1])
        if same_label:
            for j in range(s.start, min(s.stop, s.start + keep)):
                yield int(rows[i]), 0, int(shard.rows[x[j]]), int(shard.ids[x[j]]), int(score[j])
            continue
        for number, positive in windows[i].tolist():
            if number < 0:
                continue
            # lowest and highest whole scores of the window
            low, high = -((-LEAST_SHARE * positive) // 100), (MOST_SHARE * positive) // 100
            for j in (s.start + np.flatnonzero((score[s] >= low) & (score[s] <= high))[:keep]).tolist():
                yield int(rows[i]), number, int(shard.rows[x[j]]), int(shard.ids[x[j]]), int(score[j])


def threshold_join(index: DataFrame, anchors: DataFrame, level: int, n_shards: int, same_label: bool, keep: int) -> DataFrame:
    """(row, number, x_row, x_id, score, rank): for each anchor (row, label, v, least, windows) and window
    the best ``keep`` rows that reach ``least``; read from the index up to ``level``."""
    blocks = anchors.select("row", "label", "v", "least", "windows").mapInArrow(_pack, _BLOCK)
    sent = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    needed = ["shard", "wide", "small", "dims", "m", "rows", "ids", "labels", *[f"post_{k}" for k in range(level + 1)]]
    found = shuffled_join(sent, index.select(*needed), ["shard"]).mapInArrow(
        _join(level, same_label, keep), "row long, number long, x_row long, x_id long, score long")
    best = Window.partitionBy("row", "number").orderBy(F.desc("score"), F.asc("x_id"), F.asc("x_row"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _least(level: float) -> Column:
    """An anchor's threshold at a level: one above the product, so that rounding can't lose a posting."""
    if level <= 0:
        return F.lit(None).cast("double")
    return F.ceil(F.lit(float(level)) * F.col("q_norm") * F.lit(1 + 1e-9)).cast("double") + 1


_NO_WINDOWS = "array<struct<number:int,score:long>>"


def mine(spark: SparkSession, vectors: DataFrame, anchors: Column | None = None, positives: int = POSITIVES,
         negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of
    ``vectors`` (id, label, v) that the condition ``anchors`` names (ids divisible by 50)."""
    rows = written(spark, vectors.withColumn("row", F.monotonically_increasing_id())
                   .withColumn("q_norm", norm(F.col("v"))), "negatives_rows")
    n, middle = rows.agg(F.count(F.lit(1)), F.percentile_approx("q_norm", 0.5)).first()
    levels = [x * (middle or 1.0) for x in LEVELS]
    n_shards = max(1, -(-n // SHARD_ROWS))
    index = build_index(spark, rows, levels, n_shards)
    asked = rows.where(F.col("id") % 50 == 0 if anchors is None else anchors)

    # positives: lower the threshold until each anchor has all it needs
    pending = asked.withColumn("windows", F.array().cast(_NO_WINDOWS))
    full = []
    for k, level in enumerate(levels):
        last = k == len(levels) - 1
        found = written(spark, threshold_join(index, pending.withColumn("least", _least(level)), k, n_shards, True, positives),
                        "negatives_positive")
        if last:
            full.append(found)
            break
        done = found.where(F.col("rank") == positives).select("row")
        full.append(found.join(done, "row", "left_semi"))
        pending = written(spark, pending.join(done, "row", "left_anti"), "negatives_pending")
        if pending.isEmpty():
            break
    pairs = written(spark, _union(full).select("row", F.col("rank").alias("number"), F.col("x_id").alias("positive_id"),
                                               F.col("score").alias("positive_score")), "negatives_pairs")

    # negatives: windows under the positives' scores; those of scores below zero are empty
    held = pairs.where(F.col("positive_score") >= 0).groupBy("row").agg(
        F.collect_list(F.struct("number", F.col("positive_score").alias("score"))).alias("windows"))
    pending = written(spark, asked.join(held, "row"), "negatives_windows")
    full = []
    for k, level in enumerate(levels):
        last = k == len(levels) - 1
        at = pending.withColumn("least", _least(level))
        # a threshold above all windows finds nothing: such anchors wait for a lower level
        open_ = at.where(F.col("least").isNull() | F.exists(
            "windows", lambda w: w["score"].cast("double") * MOST_SHARE >= F.col("least") * 100))
        found = written(spark, threshold_join(index, open_, k, n_shards, False, negatives), "negatives_found")
        if last:
            full.append(found)
            break
        counts = found.groupBy("row").agg(F.collect_list(F.when(F.col("rank") == negatives, F.col("number"))).alias("filled"))
        left = at.join(counts, "row", "left").withColumn("filled", F.coalesce("filled", F.array().cast("array<long>")))
        # a window is settled if it is full, or if the threshold has passed its lower end
        settled = written(spark, left.withColumn("settled", F.filter("windows", lambda w: F.array_contains(
            F.col("filled"), w["number"].cast("long")) | (F.col("least") * 100 <= w["score"].cast("double") * LEAST_SHARE))),
            "negatives_settled")
        ready = settled.select("row", F.explode("settled.number").alias("number"))
        full.append(found.join(ready, ["row", "number"], "left_semi"))
        pending = written(spark, settled.withColumn("windows", F.array_except("windows", "settled"))
                          .where(F.size("windows") > 0).select("row", "id", "label", "v", "q_norm", "windows"), "negatives_pending")
        if pending.isEmpty():
            break
    return (_union(full).select("row", "number", F.col("rank").cast("int").alias("rank"), F.col("x_id").alias("negative_id"),
                                F.col("score").alias("negative_score"))
            .join(pairs, ["row", "number"]).join(asked.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
