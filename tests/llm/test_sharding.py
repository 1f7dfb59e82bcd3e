import zlib
from collections import Counter, defaultdict

from conftest import documents

from tierlake.llm import sharding


def check(rows, texts, shards=24):
    assert len(rows) == len(texts)
    sizes = Counter(r["shard"] for r in rows)
    assert all(0 <= s < shards for s in sizes)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        t = texts[r["doc_id"]]
        assert r["size"] == (len(t.encode()) if t is not None else 0) + 8
        assert r["text_crc32"] == zlib.crc32((t or "").encode())
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_whole_table_and_groups(spark, medium):
    texts = {r["doc_id"]: r["text"] for r in medium.collect()}
    rows = sharding.shard_documents(spark, medium).collect()
    check(rows, texts)
    of = defaultdict(set)
    for r in rows:
        of[texts[r["doc_id"]]].add(r["shard"])
    together = [len(of[t]) == 1 for t, n in Counter(texts.values()).items() if n > 1]
    # at most one group is cut at each shard's border
    assert sum(together) >= len(together) - 24


def test_group_larger_than_a_shard(spark):
    texts = ["same"] * 100 + [f"other {i}" for i in range(200)]
    rows = sharding.shard_documents(spark, documents(spark, texts)).collect()
    check(rows, dict(enumerate(texts)))
    # 300 rows, 12 or 13 a shard: 100 copies need 8 shards; one more may be cut
    assert len({r["shard"] for r in rows if r["doc_id"] < 100}) <= 10


def test_edges(spark):
    texts = [None, "", None, "ä", "ä", "x" * 100_000]
    rows = sharding.shard_documents(spark, documents(spark, texts)).collect()
    check(rows, dict(enumerate(texts)))
    assert sharding.shard_documents(spark, documents(spark, texts).limit(0)).count() == 0
    twice = documents(spark, ["a", "a", "b"], [1, 1, None])
    assert sharding.shard_documents(spark, twice).count() == 3


def test_general_links(spark):
    # two cliques through shared hubs; a row may have several hubs
    links = spark.createDataFrame([(r, h) for r in range(10) for h in ([f"a{r % 2}"] + (["b"] if r < 2 else []))],
                                  "row long, hub string")
    n = links.groupBy("hub").count().withColumnRenamed("count", "n")
    out = sharding.propagate(spark, links.join(n, "hub").select("row", "hub", "n"), 40, shards=2).collect()
    assert len(out) == 10 and {r["shard"] for r in out} <= {0, 1, None}
