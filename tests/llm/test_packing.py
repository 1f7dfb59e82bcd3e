import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from conftest import documents
from tokenizers import Tokenizer

from tierlake.llm import packing

FILES = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
ODD = ["a  b\n\n c   ", "x<|endoftext|>y ", "", None, " \t a's we'll  9  ", "日本語 ñ\r\n　 b", "\x1c\x85 ß", "w" * 30_000]


def check(rows, texts):
    t = Tokenizer.from_file(FILES[0])
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in texts.items()}
    seen, fill = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        seen[r["doc_id"]].append((r["start"], r["length"]))
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, x in ids.items():
        at = 0
        for start, n in sorted(seen[i]):
            assert start == at
            at += n
        assert at == len(x)
    for pieces in fill.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 1024
    return sum(map(len, ids.values())), len(fill)


def test_whole_table(spark, medium):
    texts = {r["doc_id"]: r["text"] for r in medium.collect()}
    rows = packing.pack(medium.select("doc_id", "text").coalesce(1), *FILES).collect()
    tokens, n = check(rows, texts)
    assert n * 1024 - tokens < 0.01 * tokens
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r["doc_tokens"])
    # beside its full windows a document is cut once in three at most, on the average
    assert sum(len(p) - -(-p[0] // 1024) for p in pieces.values()) < 0.4 * len(pieces)


def test_edges(spark):
    docs = documents(spark, ODD)
    check(packing.pack(docs, *FILES).collect(), dict(enumerate(ODD)))
    assert packing.pack(docs.limit(0), *FILES).count() == 0
    assert "spans" in packing.pack(docs, *FILES).columns


def test_differencing_is_near_equal():
    r = random.Random(3)
    for k in (1, 2, 7, 30):
        sizes = [r.randint(1, 128) for _ in range(12 * k)]
        got = packing.differencing(sizes, k)
        assert sorted(i for w in got for i in w) == list(range(len(sizes))) and len(got) == k
        loads = [sum(sizes[i] for i in w) for w in got]
        assert max(loads) - min(loads) <= 4
    assert all(sum(w) <= 1024 for w in ([[700, 700, 700][i] for i in w] for w in packing.windows([700, 700, 700])))


def test_items_are_cut_only_where_a_window_is_full(monkeypatch):
    r = random.Random(5)
    tries, plain = [], packing.differencing
    monkeypatch.setattr(packing, "differencing", lambda *a: tries.append(a) or plain(*a))
    cases = [[], [5], [0, 3], [1023] * 300 + [2], [512] * 400]
    cases += [[c] * 300 for c in (100, 341, 400, 513, 683, 700, 768, 900, 1000)]
    cases += [[r.randint(1, 1023) for _ in range(512)], [r.randint(900, 1023) for _ in range(512)]]
    for sizes in cases:
        tries.clear()
        seen = defaultdict(list)
        out = packing.filled(sizes)
        for window in out:
            assert 0 < sum(n for _, _, n in window) <= 1024
            for i, start, n in window:
                seen[i].append((start, n))
        for i, size in enumerate(sizes):
            at = 0
            for start, n in sorted(seen[i]):
                assert start == at and n > 0
                at += n
            assert at == size
        assert len(out) <= sum(sizes) * 1.01 / 1024 + 1 and len(tries) < 20
    assert all(len(w) == 2 for w in packing.filled([512] * 400))          # nothing to cut
    assert sorted(packing.filled([700, 700])) == [[(0, 0, 700)], [(1, 0, 700)]]
