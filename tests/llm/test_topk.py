import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierlake.llm import topk

LONG = 2 ** 63 - 1


def clip(x):
    return max(min(x, LONG), -LONG - 1)


def whole(x):
    return clip(math.floor(256 * x)) if math.isfinite(256 * x) else (LONG if x > 0 else -LONG - 1)


def brute(rows, step, k=5):
    held = [(i, [whole(x) for x in e]) for i, e in rows
            if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (q, v) in enumerate(held):
        if q % step == 0:
            s = sorted((-clip(sum(x * y for x, y in zip(v, w))), c) for b, (c, w) in enumerate(held) if b != a)
            out += [(q, r + 1, c, -n) for r, (n, c) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, step, k=5):
    t = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], "vec_id long, embedding array<double>, score string, row int")
    return sorted(tuple(r) for r in topk.top_k(spark, topk.quantised(t), F.col("id") % step == 0, k).collect())


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(topk, "INDEX_BLOCK", 37)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 11)
    monkeypatch.setattr(topk, "FEW", 3)


def odd(n=300):
    r = random.Random(1)
    return [(i, [r.choice([-1.5, 0.0, 0.01, 0.3, 2.0]) for _ in range(8)]) for i in range(n)]


def test_ties_nulls_and_blocks(spark, small_blocks):
    rows = odd() + [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (None, [1.0] * 8),
                    (305, [1e9] * 8), (306, [-1e9, 1e9]), (310, [0.0] * 8)]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_repeated_rows_and_ids(spark, small_blocks):
    rows = odd(100) + [(0, [0.3] * 8), (0, [0.3] * 8), (7, [2.0] * 8), (7, [-1.5] * 8)] + [(1000, [0.01] * 8)] * 60
    got = run(spark, rows, 5)
    assert got == brute(rows, 5)
    assert len([r for r in got if r[0] == 0]) == 15       # three rows of one id, five ranks each


def test_random_vectors(spark, small_blocks):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(400, 16)))]
    assert run(spark, rows, 20, 3) == brute(rows, 20, 3)


def test_huge_components(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e300, 0.0]), (3, [1e9, 1e9]), (4, [2e9, -1.0]), (5, [1e-3, 0.0]), (50, [1e3, 1.0])]
    assert run(spark, rows, 50, 3) == brute(rows, 50, 3)


def test_few_rows(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [2.0])]
    assert run(spark, rows, 50) == [(0, 1, 1, 131072), (0, 2, 2, 131072)]
    assert run(spark, rows[:1], 50) == []
    assert run(spark, [(1, [1.0])], 50) == []
    assert run(spark, [(None, [1.0])], 50) == []


def block_of(m, top):
    t = pa.table({"block": [0] * len(m), "row": range(len(m)), "id": range(len(m)), "v": m.tolist()})
    return topk._index(top)(t).to_pylist()[0]


def test_upper_levels_settle_and_fewer_postings_are_read():
    r = np.random.default_rng(5)
    m = np.round(3 * r.standard_cauchy(size=(2000, 32))).clip(-5000, 5000).astype(np.int64)
    m[:40] *= 20                                          # a few strong vectors
    top = int(topk._levels(m).max())
    index, q = block_of(m, top), m[1000:1020]
    true = q @ m.T
    read = 0
    for i in range(20):
        block = topk.Block(index, top, 1)
        settled, found = block.search(np.arange(1000 + i, 1001 + i), q[i:i + 1], np.full(1, -np.inf), 5)
        read += block.read
        want = sorted((-int(true[i, j]), j) for j in range(len(m)) if j != 1000 + i)[:5]
        assert settled.all() and [(-f[3], f[2]) for f in found] == want
    assert read < 0.75 * 20 * np.count_nonzero(m)
    # levels that are not there are not read; a query that needs them is not settled
    shallow = topk.Block({c: x for c, x in index.items() if c not in ("segment_1", "segment_2")}, top, 3)
    settled, found = shallow.search(np.arange(1000, 1020), q, np.full(20, -np.inf), 5)
    for i in np.flatnonzero(settled).tolist():
        want = sorted((-int(true[i, j]), j) for j in range(len(m)) if j != 1000 + i)[:5]
        assert [(-f[3], f[2]) for f in found if f[0] == 1000 + i] == want


def test_blocks_out_of_reach_are_proved_so():
    q = np.array([[10, -3, 0], [1, 1, 1]])
    peak = np.array([2.0, 5.0, 1.0])
    assert topk.reachable(q, np.array([36.0, 8.0]), peak).tolist() == [False, True]
    assert topk.reachable(q, np.array([35.0, -np.inf]), peak).tolist() == [True, True]


def test_pairs_that_cannot_reach_are_not_read(spark, small_blocks, monkeypatch):
    # vectors of a second half are tiny: only blocks that hold a large one are met
    rows = [(i, [float(i % 7 + 1)] * 4 if i < 30 else [1e-2] * 4) for i in range(600)]
    read = []
    plain = topk.written
    monkeypatch.setattr(topk, "written", lambda s, df, name: read.append((name, plain(s, df, name))) or read[-1][1])
    assert run(spark, rows, 100) == brute(rows, 100)
    blocks = next(df for name, df in read if name == "impact_index").count()
    queries = [df for name, df in read if name == "impact_queries"][-1].count()
    assert next(df for name, df in read if name == "impact_pairs").count() <= blocks * queries
    assert any(name == "impact_floors" and df.count() for name, df in read)


def test_queries_sent_to_many_blocks_are_not_broadcast(spark, small_blocks, monkeypatch):
    # the estimate of exploded rows is that of the file they come from, so the driver would get them all
    monkeypatch.setattr(topk, "PEAK_GROUP", 3)
    monkeypatch.setattr(topk, "SLICE_BLOCKS", 2)
    plans, held = [], []
    plain = topk.written

    def kept(s, df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        held.append((name, plain(s, df, name)))
        return held[-1][1]
    monkeypatch.setattr(topk, "written", kept)
    rows = odd()
    assert run(spark, rows, 5) == brute(rows, 5)
    assert {"impact_pairs", "impact_found"} <= {name for name, _ in plans}
    assert not [name for name, plan in plans if name in ("impact_pairs", "impact_found") and "Broadcast" in plan]
    # each pair of blocks once at most
    pairs = next(df for name, df in held if name == "impact_pairs")
    assert pairs.count() == pairs.distinct().count() > 0
