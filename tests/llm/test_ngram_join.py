import random
import re
from collections import defaultdict

import numpy as np
from conftest import documents

from tierlake.llm import ngram_join as nj
from tierlake.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(t):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    inv = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            inv[g].append(i)
    both = defaultdict(int)
    for ids in inv.values():
        for a in ids:
            for b in ids:
                if a < b:
                    both[a, b] += 1
    links = defaultdict(set)
    for (a, b), n in both.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a].add(b)
            links[b].add(a)
    group = {}
    for i in sorted(texts):
        if i not in group:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in group:
                    group[x] = i
                    todo += links[x]
    return {i: (group[i], len(links[i])) for i in texts}


def result(df):
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in df.collect()}


def test_whole_table(spark, medium):
    texts = {r["doc_id"]: r["text"] for r in medium.collect()}
    assert result(nj.near_duplicates(spark, medium)) == brute(texts)


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BUCKET_CLASSES", 100)
    r = random.Random(1)
    base = [f"w{r.randrange(10**6)}" for _ in range(60)]
    texts = []
    for _ in range(600):
        t = list(base)
        for _ in range(r.randint(0, 2)):
            t[r.randrange(60)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(t))
    texts += texts[:50]
    docs = documents(spark, texts)
    assert result(nj.near_duplicates(spark, docs)) == brute(dict(enumerate(texts)))


def test_large_group_of_many_sizes_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BUCKET_CLASSES", 20)
    monkeypatch.setattr(nj, "BLOCK_CLASSES", 10)
    r = random.Random(8)
    base = [f"w{k}" for k in range(400)]
    # heads of one text: a chain of near-duplicates over many sizes, some changed
    texts = [" ".join(base[:n] + [f"x{r.randrange(10**6)}"]) for n in [r.randint(40, 400) for _ in range(250)]]
    docs = documents(spark, texts)
    assert result(nj.near_duplicates(spark, docs)) == brute(dict(enumerate(texts)))


def test_only_blocks_of_like_sizes_meet(spark):
    r = random.Random(6)
    sizes = [r.choice([1, 2, 3, 4, 5, 16, 20, 25, 99, 100, 124, 125, 126, 800, 1000, r.randint(1, 2000)]) for _ in range(500)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "class long, n long")
    loads = df.groupBy(nj._stratum().alias("stratum")).count().selectExpr("1 AS g", "stratum", "CAST(ceil(count / 10) AS INT) AS blocks")
    strata = nj._dealt(loads, "g").drop("g")
    rows = nj._in_units(df.join(strata)).collect()
    units, block = defaultdict(set), {}
    for x in rows:
        units[x["x"], x["y"]].add(x["class"])
        block[x["class"]] = x["block"]
    assert all(sum(b == v for b in block.values()) < 40 for v in set(block.values()))
    for a in range(500):
        for b in range(a + 1, 500):
            if min(sizes[a], sizes[b]) >= 0.8 * max(sizes[a], sizes[b]) - 1e-9:
                x, y = sorted((block[a], block[b]))
                assert {a, b} <= units[x, y]
    # each class meets a few of the blocks only
    assert len(rows) < 500 * len(set(block.values())) / 3
    one = nj._in_units(df.selectExpr("*", "CAST(NULL AS MAP<INT, INT>) AS strata")).collect()
    assert len(one) == 500 and {(x["block"], x["x"], x["y"]) for x in one} == {(0, 0, 0)}


def test_edges(spark):
    texts = [None, "", "!!", "one two", "One  TWO.", "a b c d e", "a b c d e f", None, "z" * 2_000_000]
    got = result(nj.near_duplicates(spark, documents(spark, texts)))
    assert got == brute(dict(enumerate(texts)))
    assert nj.near_duplicates(spark, documents(spark, texts).limit(0)).count() == 0
    same = documents(spark, ["a b c"] * 3, [4, 4, None])
    assert sorted((r["class_id"], r["n_links"]) for r in nj.near_duplicates(spark, same).collect()) == [(4, 2)] * 3
    assert nj.near_duplicates(spark, documents(spark, ["p q", "r s"], [None, None])).count() == 2


def test_pruning_keeps_all_similar_pairs():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(60):
        a = np.unique(rng.integers(1, 1 << 60, 200, dtype=np.uint64))
        keep = rng.random(len(a)) > rng.choice([0.02, 0.1, 0.2, 0.5])
        sets += [a, np.unique(np.concatenate([a[keep], rng.integers(1, 1 << 60, 5, dtype=np.uint64)]))]
    flat = np.concatenate(sets)
    sig = nj.signatures(flat, np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    i, j = nj.similar_pairs(sig, sets, sig, sets, True)
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
            if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))}
    assert set(zip(i.tolist(), j.tolist())) == want
    assert (nj._common_counts(sets[:9], sets[9:30])
            == [[len(np.intersect1d(a, b)) for b in sets[9:30]] for a in sets[:9]]).all()


def connected(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = [new if x == old else x for x in label]
    return label


def test_forest_connects_what_all_pairs_connect():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, (4, nj.HASHES), dtype=np.uint8)
    brief = base[rng.integers(0, 4, 150)]
    noise = rng.random(brief.shape) < rng.choice([0.0, 0.1, 0.35, 0.5], (150, 1))
    brief[noise] = rng.integers(0, 256, noise.sum(), dtype=np.uint8)
    sizes = rng.choice([90, 100, 130], 150)

    def possible(a, b):
        if min(sizes[a], sizes[b]) < 0.8 * max(sizes[a], sizes[b]):
            return False
        return all((brief[a, :n] == brief[b, :n]).sum() >= least for n, least in nj.least_matches())

    for left in (None, 60):
        pairs = [(a, b) for a in range(150) for b in range(a + 1, 150)
                 if (left is None or a < left <= b) and possible(a, b)]
        forest = nj.possible_forest(brief, sizes, left)
        assert len(forest) < 150 < len(pairs) and set(forest) <= set(pairs)
        assert connected(150, forest) == connected(150, pairs)


def test_texts_that_share_a_band_are_no_group(spark):
    r = random.Random(4)
    common = [f"w{k}" for k in range(60)]
    texts = [" ".join(common + [f"x{r.randrange(10**9)}" for _ in range(60)]) for _ in range(300)]
    seen, real = [], nj.components
    try:
        nj.components = lambda spark, edges: seen.append(edges.count()) or real(spark, edges)
        assert result(nj.near_duplicates(spark, documents(spark, texts))) == {i: (i, 0) for i in range(300)}
    finally:
        nj.components = real
    assert seen == [0, 0]


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
