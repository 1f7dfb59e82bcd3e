"""Each stage against a plain version of its decision."""

import re

import corpus_pipeline as cp
from conftest import SF_SMALL, documents
from test_ngram_join import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    columns = docs.columns
    known = cp.language_id(spark, docs, SF_SMALL)
    assert known.columns == columns
    assert {r["doc_id"] for r in known.collect()} == {i for i, r in rows.items() if r["text"] and re.search(r"[^\W\d_]", r["text"])}
    one = cp.near_duplicates(spark, known, SF_SMALL)
    texts = {r["doc_id"]: r["text"] for r in known.collect()}
    assert {r["doc_id"] for r in one.collect()} == {g for g, _ in brute(texts).values()}
    clean = cp.benchmark_decontamination(spark, one, SF_SMALL)
    assert clean.columns == columns and clean.count() < one.count()
    safe = cp.secret_scans(spark, clean, SF_SMALL)
    assert safe.columns == columns and safe.count() == clean.count()
    for r in safe.collect():
        assert r["n_chars"] == len(r["text"])
        assert not re.search(r"AKIA[A-Z0-9]{12}", r["text"])
    packed = cp.token_packing(spark, safe, SF_SMALL)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in safe.collect()}


def test_repeated_rows_and_null_ids(spark):
    a, b = "one two three four five six seven", "some other words that go on and on"
    docs = documents(spark, [a, a, b, a, b, None, None, b], ids=[5, 5, 5, 7, 9, 11, 11, None])
    got = cp.near_duplicates(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    # copies of b: the null id comes first; null texts are no copies of each other
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got.collect()) == sorted(
        [("5", a), ("None", b), ("11", "None"), ("11", "None")])


def test_run_and_empty(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "packing"]
    assert cp.run(spark, SF_SMALL).count() > 0
    docs = documents(spark, ["a"]).limit(0)
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_columns_of_the_caller_come_through_every_stage(spark):
    texts = ["The cat sat on the mat with a password: hunter2hunter2 and slept", "und der Hund lief durch den Wald", None, "", "12 34",
             "long " * 100_000, "The cat sat on the mat with a password: hunter2hunter2 and slept"]
    docs = documents(spark, texts).selectExpr(
        "*", "0.123 AS score", "'mine' AS lang_pred", "array(1) AS __known", "7 AS __candidates", "'h' AS hex", "1 AS __n_words",
        "array('s') AS __spans", "2 AS __items", "doc_id AS id", "3 AS class_id", "4 AS n_links", "named_struct('a b', 1) AS `odd name`")
    want = {r["doc_id"]: r.asDict() for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == list(next(iter(want.values()))), name
        for r in docs.collect():
            assert {k: v for k, v in r.asDict().items() if k not in ("text", "n_chars")} == \
                {k: v for k, v in want[r["doc_id"]].items() if k not in ("text", "n_chars")}, name
    assert {r["doc_id"] for r in docs.collect()} == {0, 1, 5}
    packed = cp.token_packing(spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in packed.collect()} == {0, 1, 5}
