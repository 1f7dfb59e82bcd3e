"""The burst trie against a dictionary of prefixes."""

import hashlib
import math
import random
import re
import zlib

import pytest

from tierlake.llm import prefix_trie as pt

TURNS = "conv_id long, turn long, role string, text string, rest int, head int"


def conversations(rows):
    held = {}
    for c, turn, role, text in rows:
        if c is not None:
            held.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in held.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]      # the sign of SQL's remainder
    return out


def brute(held):
    members = {}
    for c, turns in held.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for k, cs in members.items():
        below = [x for x in members if x[:len(k)] == k]
        kids = [x for x in below if len(x) == len(k) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in members)]
        saved = sum((len(members[x]) - 1) * len(re.findall("[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in cs if len(held[c]) == len(k))))
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS)


def run(spark, rows, most, group=True):
    found = pt.sequences(table(spark, rows))
    if group:
        found = pt.rebuilt(found)
    return sorted((tuple(r) for r in pt.prefix_trie(spark, pt.as_paths(found), most).collect()), key=str)


def odd_rows(seed, n=120):
    r = random.Random(seed)
    said = [None, "", "a b", "a  b\tc", "é x y", "long " * 50, "a", "b"]
    rows = []
    for c in r.sample(range(0, 4 * n), n):
        for turn in range(r.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, turn, r.choice([None, "", "user"]), r.choice(said[:4] if turn < 2 else said)))
    return rows


@pytest.mark.parametrize("most", [1, 7, 40, 1 << 16])
def test_against_prefixes(spark, most):
    rows = odd_rows(most)
    assert run(spark, rows, most) == brute(rebuilt(conversations(rows)))


def test_long_shared_prefix_bursts_once(spark, monkeypatch):
    shared = [(f"t{i}",) for i in range(60)]
    rows = [(c, i, "u", t[0]) for c in range(12) for i, t in enumerate([*shared, (f"own {c % 5}",), (f"x {c}",)])]
    rows += [(100, i, "u", t[0]) for i, t in enumerate(shared)]      # ends at the branch
    rows += [(101, i, "u", t[0]) for i, t in enumerate(shared[:30])]      # ends on the way
    rounds = []
    plain = pt._oversized
    monkeypatch.setattr(pt, "_oversized", lambda *a: rounds.append(1) or plain(*a))
    assert run(spark, rows, 10, group=False) == brute(conversations(rows))
    assert len(rounds) <= 5


def test_copies_are_one_class(spark):
    rows = [(c * 7919, i, "u", f"t{i}") for c in range(300) for i in range(4)]
    assert run(spark, rows, 8, group=False) == brute(conversations(rows))


def test_nulls_order_and_repeated_turns(spark):
    rows = [(None, 0, "u", "x"), (1, 3, "u", "last"), (1, None, None, None), (1, 0, "u", "first"), (2, None, "", ""),
            (-5, 1, "u", "n"), (-20, 0, "u", "q"), (45, 0, "u", "alone")]
    assert run(spark, rows, 2) == brute(rebuilt(conversations(rows)))
    twice = [(3, 0, "u", "same"), (3, 0, "u", "same"), (4, 0, "u", "same")]
    assert run(spark, twice, 2, group=False) == brute(conversations(twice))


def test_turnless_conversation(spark):
    # 3's checksum drops all its turns, and its group has no first conversation
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 1)
    rows = [(c, 0, "u", "gone")]
    assert run(spark, rows, 100) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_empty(spark):
    assert run(spark, [(None, 0, "u", "x")], 100) == []


def test_very_long_text_and_conversation(spark):
    rows = [(0, i, "u", "w") for i in range(3000)] + [(1, i, "u", "w") for i in range(2990)] + [(2, 0, "u", "x " * 200_000)]
    got = run(spark, rows, 500, group=False)
    want = conversations(rows)
    assert len(got) == 3002
    root = next(r for r in got if r[1] == 0)
    assert root[3:7] == (3, 2, 2, 2990)
    assert sum(r[7] == hashlib.sha256(str(c).encode()).hexdigest() for r in got for c in want) == 3
