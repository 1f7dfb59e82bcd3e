import public_tokenizers as P
import sentencepiece
from conftest import documents

from tierlake.llm import token_counts as tc

MODEL = P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a  b \n c  ", "</s><s> a", "日本 語 ▁ ▁▁x ▁", "a" * 20_000, "x  y " * 9_000, "▁ a" * 9000, " " * 40_000,
       ("word " * 3000 + " " * 70) * 4, "<unk> \t\r\n　 "]


def test_whole_table_and_edges(spark, medium):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    odd = documents(spark, ODD, [-i - 1 for i in range(len(ODD))]).select("doc_id", "text")
    docs = medium.select("doc_id", "text").unionByName(odd)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r for r in tc.count_tokens(docs, MODEL).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        n = len(sp.encode(t))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len(t.encode()), n, n > 4096), t[:50]


def test_parts_are_balanced_and_cover():
    c = tc.Counter.of(MODEL)
    assert c.safe
    text = "some words here " * 5000
    parts = c.parts(text, 1000)
    assert " ".join(parts) == text and max(map(len, parts)) <= 1000


def test_empty_table(spark):
    out = tc.count_tokens(documents(spark, ["a"]).limit(0), MODEL)
    assert out.count() == 0 and "n_tokens" in out.columns


def test_last_space_after_a_stretch_without_spaces():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["中文" * 9000 + " ", "中文" * 9000 + "  ", "a b " + "x" * 20_000 + " ", "中文" * 9000 + " a"]
    assert tc.Counter.of(MODEL).counts(texts) == [len(sp.encode(t)) for t in texts]
