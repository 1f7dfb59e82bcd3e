import numpy as np
from conftest import documents

from tierlake.llm import langid
from tierlake.llm.queries import QUERIES
from conftest import SF_MEDIUM


def plain_phrases(learned: str, text: str) -> int:
    n = at = 0
    while at < len(text):
        k = 1
        while at + k < len(text) + 0 and text[at:at + k + 1] in learned:
            k += 1
        n += 1
        at += k
    return n


def test_automaton_gives_longest_matches():
    rng = np.random.default_rng(5)
    learned = rng.integers(0, 4, 400).astype(np.uint8)
    table = langid.suffix_automaton(learned, 6)
    for n in (1, 2, 50, 300):
        text = rng.integers(0, 6, n).astype(np.uint8)
        got = langid.phrases(table, text[:, None], np.array([n]))[0]
        assert got == plain_phrases("".join(map(str, learned)), "".join(map(str, text)))


def test_rare_symbols_parse_alike():
    rng = np.random.default_rng(6)
    learned = rng.zipf(1.3, 3000).clip(1, 900).astype(np.uint16)      # far more symbols than have a table
    automaton = langid.suffix_automaton(learned, 1000)
    assert automaton.any_rare and len(automaton.keys) > 100
    text = np.concatenate([learned[500:900], rng.integers(0, 1000, 200).astype(np.uint16), learned[:50]])
    assert langid.phrases(automaton, learned[100:108][:, None], np.array([8]))[0] == 1
    at = n = 0
    joined = " ".join(map(str, learned.tolist()))
    while at < len(text):
        k = 1
        while at + k < len(text) and f" {' '.join(map(str, text[at:at + k + 1].tolist()))} " in f" {joined} ":
            k += 1
        n, at = n + 1, at + k
    got = langid.phrases(automaton, text[:, None], np.array([len(text)]))[0]
    assert got == n


def test_memory_of_a_script_of_many_letters():
    rng = np.random.default_rng(1)
    han = "".join(chr(0x4E00 + int(k)) for k in rng.zipf(1.2, langid.SAMPLE_CHARS // 2).clip(1, 3000))
    latin = " ".join("".join(chr(97 + int(k)) for k in rng.integers(0, 26, 5)) for _ in range(langid.SAMPLE_CHARS // 12))
    model = langid.Model((("zh", (han, han[:1000] + "x")), ("en", (latin, latin[:1000]))))
    sizes = [t.nbytes() for t in model.tables]
    assert model.alphabet.size > 1500 and max(sizes) < 40 << 20, sizes
    assert model.predict([han[500:700], latin[500:700]])[0] == ["zh", "en"]


def test_predictions_equal_a_plain_parse(medium):
    rows = [r for r in medium.limit(400).collect() if r["text"] and r["lang"]]
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r["text"][:300])
    sample = tuple((name, tuple(texts[:6])) for name, texts in sorted(by.items()))
    model = langid.Model(sample)

    def numbered(text):
        return "".join(chr(200 + int(s)) for s in model.alphabet.symbols(text))
    learned = ["".join(numbered(t + " ") for t in list(dict.fromkeys(texts))[::2]) for _, texts in sample]
    texts = [r["text"][:200] for r in rows[:40]]
    got, _ = model.predict(texts)
    for text, lang in zip(texts, got):
        costs = [plain_phrases(x, numbered(text)) / rate for x, rate in zip(learned, model.rates)]
        assert model.langs[int(np.argmin(costs))] == lang


def test_many_languages_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "TOTAL_CHARS", 6000)
    texts = [words_of("abcdefgh"[k:] + "xyz", 100, 10 * k + j) for k in range(3) for j in range(8)]
    docs = spark.createDataFrame([(i, t, f"l{i // 8}") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    sample = langid.sample_texts(docs, "doc_id", "text", "lang")
    assert len(sample) == 3
    assert all(len(t) >= 2 and sum(map(len, t[2:])) <= langid.LEAST_CHARS for _, t in sample)


def test_held_out_accuracy(spark, medium):
    lang = {r["doc_id"]: r["lang"] for r in medium.collect()}
    rows = QUERIES["op4_language_id"](spark, SF_MEDIUM).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark):
    texts = [None, "", "12 34 !", "²³", "the cat sat", "日本", "the " * 40_000]
    docs = documents(spark, texts)
    sample = (("en", ("the cat sat on the mat and then the dog",) * 2), ("fr", ("le chat est sur le tapis",)), ("xx", ("1",)))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, sample).collect()}
    assert [got[i][0] for i in range(4)] == ["und"] * 4
    assert got[4][0] == "en" and got[6][0] == "en" and got[5][0] in ("en", "fr")
    assert {r["lang_pred"] for r in langid.identify(docs, ()).collect()} == {"und"}
    assert langid.identify(docs.limit(0), sample).count() == 0
    assert langid.sample_texts(docs.limit(0), "doc_id", "text", "lang") == ()
    assert langid.sample_texts(docs, "doc_id", "text", "lang")[0][0] == "en"


def words_of(letters, n, seed):
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(rng.choice(list(letters), int(k))) for k in np.random.default_rng(len(letters)).integers(2, 8, 60)]
    own = np.random.default_rng(7)
    vocabulary = ["".join(own.choice(list(letters), len(v))) for v in vocabulary]
    return " ".join(rng.choice(vocabulary, n))


def test_single_long_and_copied_texts(spark):
    en, fr, de = "aeionrstl", "uiosqrcmd", "hgnekwzbt"
    rows = [(i, words_of(en, 80, i), "en") for i in range(60)]
    rows += [(1000 + i, words_of(fr, 1500, i), "fr") for i in range(6)]          # long texts only
    copied = words_of(de, 80, 0)
    rows += [(2000 + i, copied, "de") for i in range(600)] + [(3000 + i, words_of(de, 80, 50 + i), "de") for i in range(4)]
    rows += [(4000, words_of("pqvxyfj", 80, 1), "one"), (4001, "12 34", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = dict(langid.sample_texts(docs, "doc_id", "text", "lang"))
    assert list(sample) == ["de", "en", "fr", "one"]
    assert len(sample["en"]) == langid.SAMPLE_ROWS and len(sample["fr"]) == 6 and len(sample["de"]) == 5
    assert all(len(set(v)) == len(v) for v in sample.values())
    model = langid.Model(tuple(sample.items()))
    assert max(model.rates) < 3 * min(model.rates)
    asked = [(words_of(a, 60, 900 + i), name) for name, a in (("en", en), ("fr", fr), ("de", de), ("one", "pqvxyfj")) for i in range(10)]
    got, _ = model.predict([t for t, _ in asked])
    assert got == [name for _, name in asked]


def test_two_texts_where_all_are_longer_than_the_budget(spark):
    rows = [(i, words_of("aeionrstl", 100, i), "en") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (_, texts), = langid.sample_texts(docs, "doc_id", "text", "lang", chars=200)
    assert len(set(texts)) == 2 and all(len(t) == 100 for t in texts)
    (_, texts), = langid.sample_texts(docs, "doc_id", "text", "lang", chars=1500)
    assert 2 <= len(texts) <= 3 and set(texts) <= {t for _, t, _ in rows}
