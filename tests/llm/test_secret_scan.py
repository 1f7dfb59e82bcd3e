import hashlib
import random
import re
import string

from conftest import documents

from tierlake.llm import secret_scan as ss


def base(text):
    text = text or ""
    pat = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(pat, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def check(rows, texts):
    for r in rows:
        want = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(listed(want).encode()).hexdigest()
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(s[2] == kind for s in want)
        own = [s for s in r["spans"].split(",") if s]
        assert [s for s in own if not s.startswith("random")] == [s for s in listed(want).split(",") if s]
        keys = [(int(s.split(":")[1]), ss.KINDS.index(s.split(":")[0])) for s in own]
        assert keys == sorted(keys)


def test_whole_table(spark, medium):
    texts = {r["doc_id"]: r["text"] for r in medium.collect()}
    rows = ss.digest(ss.find_secrets(spark, medium)).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    # clean texts are left alone
    assert not [r for r in rows if "random" in r["spans"]]


ODD = [None, "", "token=short token=longer-than-8", 'Api_Key" = "abcdefgh.', "ſecret=abcdefgh12", "toKen: 12345678", "é AKIA" + "A" * 12,
       "AKIA123", "f" * 31, "f" * 32 + "g", "password=secret=token=abcdefghijk", "F" * 40, "secret:\n12345678", "0" * 100_000]


def test_edges_and_redaction(spark):
    docs = documents(spark, ODD)
    found = ss.find_secrets(spark, docs, keep_text=True)
    check(ss.digest(found).collect(), dict(enumerate(ODD)))
    clean = {r["doc_id"]: r["text"] for r in ss.redact(found).collect()}
    assert clean[0] is None and clean[2] == "token=short [SECRET]" and clean[6] == "é [SECRET]" and clean[8] == "f" * 31
    assert ss.digest(ss.find_secrets(spark, docs.limit(0))).count() == 0
    assert ss.redact(found.limit(0)).count() == 0


def test_many_spans_of_one_text():
    text = "secret=abcdefgh12 " * 20_000 + "x" * 30
    known = ss.known_spans(text)
    assert len(known) == 20_000
    assert [c[:2] for c in ss.candidates(text, known)] == [(len(text) - 30, len(text))]
    spans = [{"start": a, "end": b} for _, a, b in known]
    assert ss.masked(text, spans, "*") == "* " * 20_000 + "x" * 30
    assert ss.masked("abcdef", [{"start": 1, "end": 4}, {"start": 2, "end": 3}, {"start": 4, "end": 5}], "*") == "a**f"


def test_battery_adds_random_tokens_only(spark):
    r = random.Random(9)
    b64 = ["".join(r.choice(string.ascii_letters + string.digits + "+/") for _ in range(44)) for _ in range(40)]
    plain = ["internationalisation_of_long_names", "z" * 50, "2024-01-02-2024-01-03", "aB1" * 20, "0123456789" * 3,
             "CamelCaseIdentifiersAreOrdinary", "====================", "/usr/share/local/lib/python/site"]
    texts = [f"see {t} here" for t in b64 + plain]
    rows = {x["doc_id"]: x["spans"] for x in ss.digest(ss.find_secrets(spark, documents(spark, texts))).collect()}
    assert sum(rows[i] == f"random:4:{4 + 44}" for i in range(40)) >= 38
    assert not [texts[i] for i in range(40, len(texts)) if rows[i]]


def test_p_values():
    r = random.Random(2)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(60)) for _ in range(2000)]
    low = sum(ss.uniform_p(*ss.encoding_of(h)[1:]) < 0.01 for h in hexes)
    assert low < 60                      # three tests, each near its level
    assert abs(ss._upper_gamma(0.5, 1.92072941) - 0.05) < 1e-6 and abs(ss._upper_gamma(2.0, 4.743865) - 0.05) < 1e-6
    assert abs(ss._tail(10, 3, 0.15) - 0.17980) < 1e-4


def ordinary_tokens(r, n):
    words = ("under standing of the measure ment and inter nation al organ isation with out further consider ation "
             "develop ers should return every account number before they change public service names which are "
             "longer than usual between several different places").split()
    joins = (lambda w: "".join(w), lambda w: "_".join(w), lambda w: "".join(w).upper(),
             lambda w: "".join(x.title() for x in w), lambda w: "/".join(w))
    return words, [joins[i % 5]([r.choice(words) for _ in range(r.randint(5, 9))]) for i in range(n)]


def test_keys_of_small_alphabets_among_ordinary_tokens(spark):
    r = random.Random(31)
    words, plain = ordinary_tokens(r, 6000)
    plain = [t for t in plain if len(t) >= ss.MIN_LENGTH]
    made = {"base32": (string.ascii_uppercase + "234567", 32), "base36": (string.digits + string.ascii_lowercase, 32),
            "HEX": ("0123456789ABCDEF", 32), "lower": (string.ascii_lowercase, 40), "BASE36": (string.digits + string.ascii_uppercase, 40)}
    keys = [(name, "".join(r.choice(a) for _ in range(n))) for name, (a, n) in made.items() for _ in range(20)]
    tokens = [(None, t) for t in plain] + keys
    texts = [" ".join(r.choice(words) for _ in range(20)) + f" {t} here" for _, t in tokens]
    rows = {x["doc_id"]: x["spans"] for x in ss.digest(ss.find_secrets(spark, documents(spark, texts))).collect()}
    for name in made:
        at = [i for i, (k, _) in enumerate(tokens) if k == name]
        assert sum(rows[i].startswith("random") for i in at) >= 19, name
    assert not [texts[i] for i, (k, _) in enumerate(tokens) if k is None and rows[i]]


def test_values_after_names(spark):
    r = random.Random(12)
    b64, url = string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_"
    def key(a, n=40): return "".join(r.choice(a[:62]) for _ in range(n - 4)) + a[62] + a[63] + "7q"
    forms = [("AWS_SECRET_ACCESS_KEY=", key(b64), ""), ("DB_KEY=", key(b64), "=="), ("https://x.org/a?sig=", key(url), "&v=1"),
             ("auth=", key(b64), "="), ("my_service_account_name/", key(b64), ""), ("path/of-the/config+file_", key(url), "")]
    _, plain = ordinary_tokens(r, 500)
    texts = [f"see {a}{k}{z} here" for a, k, z in forms * 5] + [f"see {t} here" for t in plain] + ["see name_of=" + plain[0]]
    rows = {x["doc_id"]: x["spans"] for x in ss.digest(ss.find_secrets(spark, documents(spark, texts))).collect()}
    for i, (a, k, z) in enumerate(forms * 5):
        found = [tuple(map(int, s.split(":")[1:])) for s in rows[i].split(",") if s]
        held = {x for s, e in found for x in range(s, e)}
        at = texts[i].index(k)
        assert len(held & set(range(at, at + 40))) >= 36, texts[i]
        if "=" in a:
            assert found == [(at, at + 40 + len(z) * z.startswith("="))], texts[i]
    assert not [texts[i] for i in range(30, len(texts)) if rows[i]]
    # name=value of a short name: the length counts the value alone
    assert [c[:2] for c in ss.candidates("a=" + "x" * 19 + " b=" + "y" * 20, [])] == [(24, 44)]


def test_key_beside_known_form_in_one_run():
    text = "AKIA" + "Z" * 16 + "/" + "k3Jx9" * 5
    assert [c[:2] for c in ss.candidates(text, ss.known_spans(text))] == [(21, 46)]
