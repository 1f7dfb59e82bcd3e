import hashlib
import random

from conftest import documents

from tierlake.llm import decontam
from test_ngram_join import WORD
import re


def words(t):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))


def brute(text, items):
    w = words(text)
    hit, names = set(), set()
    for name, t in items:
        iw = words(t)
        n = min(10, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for p in range(len(w) - n + 1 if n else 0):
            if tuple(w[p:p + n]) in wins:
                hit |= set(range(p, p + n))
                names.add(str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_random_texts(spark):
    r = random.Random(4)
    items = [(i, " ".join(r.choice("abc") for _ in range(r.choice([1, 3, 9, 10, 14, 30])))) for i in range(6, 14)]
    items += [(6, "A! a, C"), (20, None), (21, "..."), (22, "Ünï ßpecial"), (23, "q r s t u v w x y z aa bb")]
    texts = [" ".join(r.choice("abcd") for _ in range(r.randint(0, 60))) for _ in range(80)]
    texts += [None, "", "ünï", "Ünï-ßPECIAL", "Q r s T u v w x y z", "q r s t u v w x y", "x " * 300_000 + "q r s t u v w x y z aa bb cc"]
    docs = documents(spark, texts).selectExpr("*", "doc_id + 1 AS __row")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    want = {i: brute(t, items) for i, t in enumerate(texts)}

    def got():
        found = decontam.find_matches(docs, bench)
        assert set(found.columns) == {*docs.columns, *decontam.MADE} - {"text"}
        assert found.where("__row = doc_id + 1").count() == len(texts)
        rows = decontam.digest(found).collect()
        return {x["doc_id"]: tuple(x[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for x in rows}
    assert got() == want
    whole, decontam.BLOCK_WORDS = decontam.BLOCK_WORDS, 40     # several blocks of the test set
    try:
        assert got() == want
    finally:
        decontam.BLOCK_WORDS = whole
    clean = decontam.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {x["doc_id"] for x in clean.collect()} == {i for i, v in want.items() if not v[4]}


def test_empty_tables(spark):
    docs = documents(spark, ["a b", None])
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontam.digest(decontam.find_matches(docs.limit(0), bench)).count() == 0
    out = decontam.digest(decontam.find_matches(docs, bench.limit(0))).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in sorted(out)] == [(2, 0, False), (0, 0, False)]


def longest(text, items):
    """Of each item with an occurring window, the longest common run of words and its first places."""
    w, out = words(text), {}
    for name, t in items:
        iw = words(t)
        need = min(10, len(iw))
        best = (0,)
        row = [0] * (len(iw) + 1)
        for a in range(len(w)):
            row = [0] + [row[p] + 1 if w[a] == iw[p] else 0 for p in range(len(iw))]
            for p in range(len(iw)):
                n = row[p + 1]
                best = max(best, (n, -(a - n + 1), -(p - n + 1))) if n else best
        if need and best[0] >= need:
            out[name] = (-best[1], -best[2], best[0])
    return out


def test_longest_matches_and_their_places(spark):
    r = random.Random(9)
    items = [(i, " ".join(r.choice("ab") for _ in range(r.choice([2, 10, 12, 25, 40])))) for i in range(8)]
    items += [(20, " ".join("abcdefghijklmnopqrstuvwxyz")), (21, "a " * 60), (22, "q r"), (23, None)]
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 80))) for _ in range(60)]
    texts += ["zz " + " ".join("abcdefghijklmnopqrstuvwxyz") + " yy c d e f g h i j k l m n", "a " * 500, " ".join("cdefghijklmnop") + " 1", None, "q r q r"]
    docs = documents(spark, texts).selectExpr("*", "1 AS __matches")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontam.BLOCK_WORDS, 60):
        whole, decontam.BLOCK_WORDS = decontam.BLOCK_WORDS, block
        try:
            rows = decontam.find_matches(docs, bench).collect()
        finally:
            decontam.BLOCK_WORDS = whole
        for x in rows:
            got = {m["item"]: (m["start"], m["item_start"], m["n"]) for m in x["__matches"]}
            assert got == longest(texts[x["doc_id"]], items), texts[x["doc_id"]]
            assert sorted(got) == sorted(x["__items"])


def test_repeating_texts_do_not_pair_all_their_places():
    tests = decontam.TestSuffixes([b"a " * 400], [1])
    pairs = []
    plain = decontam.TestSuffixes._longest
    tests._longest = lambda *a: pairs.extend(a[4]) or plain(tests, *a)
    hashes, offsets = decontam.word_hashes([b"a " * 3000])
    _, found, best = tests.search(hashes, offsets)
    assert best.tolist() == [[0, 0, 400]] and sum(map(len, pairs)) < 2 * 3400


def test_blocks_of_the_test_set_are_bounded_and_whole(spark, monkeypatch):
    r = random.Random(2)
    rows = [(i % 40, " ".join("w" * r.randint(1, 9) for _ in range(r.randint(0, 50)))) for i in range(200)]
    rows += [(7, None), (None, "a b c"), (8, "long " * 900)]
    items = spark.createDataFrame(rows, "item int, text string").repartition(5)
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 600)
    blocks = [b.collect() for b in decontam._blocks(items)]
    assert sorted(map(repr, (tuple(x) for b in blocks for x in b))) == sorted(map(repr, rows)) and len(blocks) > 10
    for b in blocks:
        sizes = sorted(len(words(x["text"])) for x in b)
        assert sum(sizes[:-1]) <= 600
    assert len(decontam._blocks(items.limit(0))) == 1


def test_repeated_rows_keep_their_hits_in_several_blocks(spark, monkeypatch):
    ten = "q r s t u v w x y z"
    docs = spark.createDataFrame([(1, ten), (1, ten), (1, "k l"), (None, ten + " k l"), (None, None)], "doc_id int, text string")
    bench = spark.createDataFrame([(1, ten), (2, "k l"), (2, "k l"), (None, ten)], "item_id int, text string")
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 8)
    got = decontam.digest(decontam.find_matches(docs, bench)).collect()
    assert sorted((str(x["doc_id"]), x["n_words"], x["n_hit"], x["n_items"]) for x in got) == [
        ("1", 2, 2, 1), ("1", 10, 10, 2), ("1", 10, 10, 2), ("None", 0, 0, 0), ("None", 12, 12, 3)]
    assert [tuple(x) for x in decontam.remove_contaminated(docs, bench).collect()] == [(None, None)]
