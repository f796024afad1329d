import random

import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import token_count as C
from tallyrisk.llm.common import table
from tallyrisk.llm.queries import QUERIES, vocabulary

sentencepiece = pytest.importorskip("sentencepiece")
MODEL = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return lambda text: len(sp.encode(text or ""))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_the_library_on_whole_texts(spark, library, sf):
    d = f"/root/testdata/sf{sf}"
    texts = {r.doc_id: r.text for r in table(spark, d, "documents").select("doc_id", "text").collect()}
    rows = {r.doc_id: r for r in QUERIES["op11_token_count"](spark, d).collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        n = library(t)
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len((t or "").encode()), n, n > 4096)


def test_random_texts(library):
    rng, count = random.Random(3), C.counter(MODEL).text
    parts = ["a", "e", "th", "in", "er", " ", "  ", "\n", "▁", "é", "的", "😀", "\x00", "23", ".", ",", "’", "ﬁ", "　", "The", "<s>", "<0x41>", "é", "İ"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert count(text) == library(text), text


@pytest.mark.parametrize("text", [" " * 200_000, "a" * 200_000, "\n" * 100_000, "的" * 50_000, "ab " * 100_000, " a" + " " * 50_001, "erther" * 30_000])
def test_very_long_stretches(library, text):
    assert C.counter(MODEL).text(text) == library(text)


def test_defined_cases(spark, library, monkeypatch):
    monkeypatch.setattr(C, "CACHE", 3)
    rows = [(1, None, "x", 9), (1, "", "y", 9), (None, "some words here and more", "z", 9), (2, "<s> </s>", None, 9), (2, "<s> </s>", None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string, n_tokens int")
    out = C.count_tokens(df, MODEL, limit=5).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit, r.extra or "") for r in out) == sorted(
        (len((t or "").encode()), library(t), library(t) > 5, e or "") for _, t, e, _ in rows)
    assert C.count_tokens(df.filter(F.lit(False)), MODEL).count() == 0
