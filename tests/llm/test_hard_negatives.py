"""Threshold joins against scores of all pairs."""

import math
import random

import numpy as np
import pytest

from tierlake.llm import hard_negatives as hn

LONG = 2 ** 63 - 1


def clip(x):
    return max(min(x, LONG), -LONG - 1)


def brute(rows, step=50, relabel=True):
    held = []
    for i, e, label in rows:
        if i is None or label is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        if relabel and i % 7 == 0:
            label = (label + 1) % 10
        held.append((i, label, [clip(math.floor(256 * x)) if math.isfinite(256 * x) else (LONG if x > 0 else -LONG - 1) for x in e]))
    out = []
    for a, (i, label, v) in enumerate(held):
        if i % step:
            continue
        scored = sorted((-clip(sum(x * y for x, y in zip(v, w))), j, lab == label)
                        for b, (j, lab, w) in enumerate(held) if b != a)
        for s, j, _ in [x for x in scored if x[2]][:5]:
            hard = [x for x in scored if not x[2] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(hard)]
    return sorted(out)


def run(spark, rows, step=50):
    t = spark.createDataFrame([(i, e, label, "x", 1) for i, e, label in rows],
                              "vec_id long, embedding array<double>, label int, score string, row int")
    got = hn.mine(spark, hn.quantised(t), anchors=None if step == 50 else hn.F.col("id") % step == 0)
    return sorted(tuple(r) for r in got.collect())


def vectors(n, wide, seed, spread=1.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, wide))
    out = []
    for i in range(n):
        label = int(r.integers(0, 10))
        v = centres[label % 6] + spread * r.normal(size=wide)
        out.append((i, [float(x) for x in v / np.linalg.norm(v)], label))
    return out


@pytest.mark.parametrize("spread", [0.3, 3.0])
def test_against_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(hn, "SHARD_ROWS", 70)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 5)
    monkeypatch.setattr(hn, "FEW", 1)
    rows = vectors(400, 24, 1, spread)
    assert run(spark, rows, 20) == brute(rows, 20)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "SHARD_ROWS", 40)
    r = random.Random(2)
    rows = [(i, [r.choice([-1.5, 0.0, 0.01, 0.3, 2.0]) for _ in range(r.choice([3, 8]))], r.choice([0, 1, None])) for i in range(200)]
    rows += [(300, None, 1), (300, [], 1), (350, [1.0, None], 1), (350, [float("nan")], 1), (None, [1.0], 1), (400, [0.0] * 8, 1)]
    rows += [(10, [0.3] * 8, 0), (10, [0.3] * 8, 0), (50, [1.0] * 8, 1), (50, [1.0] * 8, 1)]      # repeated ids and rows
    assert run(spark, rows, 10) == brute(rows, 10)


def test_huge_components(spark):
    rows = [(0, [1e300, 1.0], 3), (1, [1e300, 2.0], 4), (2, [-1e300, 0.0], 4), (3, [1e9, 1e9], 4), (4, [2e9, -1.0], 4),
            (50, [1e3, 1.0], 4), (51, [-1e300, -1e300], 4)]
    assert run(spark, rows) == brute(rows)


def test_few_rows(spark):
    assert run(spark, [(1, [1.0], 1)]) == []
    assert run(spark, [(50, [1.0], 1)]) == []
    assert run(spark, [(None, [1.0], 1)]) == []
    rows = [(50, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.7, 0.7], 2), (3, [0.9, 0.1], 3), (4, [0.96, 0.1], 3)]
    assert run(spark, rows) == brute(rows) != []


def shard_of(rows, levels):
    import pyarrow as pa
    t = pa.table({"shard": [0] * len(rows), "row": [r[0] for r in rows], "id": [r[0] for r in rows], "label": [r[2] for r in rows],
                  "v": [[math.floor(256 * x) for x in r[1]] for r in rows]})
    return hn._index(levels)(t).to_pylist()[0]


def test_high_levels_read_fewer_postings_and_lose_nothing():
    rows = vectors(300, 32, 5)
    norm = 256.0
    levels = [x * norm for x in hn.LEVELS]
    index = shard_of(rows, levels)
    q = np.array([[math.floor(256 * x) for x in r[1]] for r in rows[:40]], dtype=np.int64)
    m = np.array([[math.floor(256 * x) for x in r[1]] for r in rows], dtype=np.int64)
    true = q @ m.T
    read = []
    for k, level in enumerate(levels):
        shard = hn.Shard(index, k)
        read.append(shard.postings_read)
        least = np.ceil(level * np.linalg.norm(q, axis=1)) + 1 if level else np.full(len(q), -np.inf)
        a, x, score = shard.reaching(q, least, np.ones((len(q), len(m)), dtype=bool))
        assert (score == true[a, x]).all()
        assert {*zip(a.tolist(), x.tolist())} >= {*zip(*(y.tolist() for y in np.nonzero(true >= least[:, None])))}
    assert read == sorted(read) and read[0] < read[-1] / 1.5 and read[-1] == np.count_nonzero(m)
    a, _, _ = hn.Shard(index, 0).reaching(q, np.ceil(levels[0] * np.linalg.norm(q, axis=1)) + 1, np.ones((len(q), len(m)), dtype=bool))
    assert len(a) < true.size / 4      # pruned, not scored


def test_anchors_sent_to_many_shards_are_not_broadcast(spark, monkeypatch):
    # the estimate of exploded rows is that of the file they come from, so the driver would get them all
    monkeypatch.setattr(hn, "SHARD_ROWS", 20)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 5)
    plans = []
    plain = hn.written
    monkeypatch.setattr(hn, "written", lambda s, df, name: plans.append(
        (name, df._jdf.queryExecution().executedPlan().toString())) or plain(s, df, name))
    rows = vectors(300, 24, 1, 3.0)
    assert run(spark, rows, 10) == brute(rows, 10)
    joins = [(name, plan) for name, plan in plans if name in ("negatives_positive", "negatives_found")]
    assert len({name for name, _ in joins}) == 2 and not [name for name, plan in joins if "Broadcast" in plan]
