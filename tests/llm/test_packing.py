import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import packing as P
from tallyrisk.llm.common import table
from tallyrisk.llm.queries import QUERIES, vocabulary

tokenizers = pytest.importorskip("tokenizers")


def _ids(text):
    t = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def _check(rows, texts, length):
    for doc_id, text in texts.items():
        ids, at = _ids(text), 0
        for r in sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def test_query_over_whole_documents(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, d, "documents").select("doc_id", "text").collect()}
    rows = QUERIES["op9_packing"](spark, d).collect()
    assert {r.doc_id for r in rows} == set(texts) and _check(rows, texts, P.LENGTH) == 0


@pytest.mark.parametrize("power_of_two", [True, False])
def test_defined_cases(spark, power_of_two):
    texts = {1: None, 2: "", 3: "<|endoftext|> a<|endoftext|>b", 4: "word " * 30_000, 5: "é😀\x00", 6: "z" * 5000}
    df = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id long, text string, length int")
    rows = P.pack(df, vocabulary("byte_bpe_50k.tiktoken"), 64, power_of_two).collect()
    padding = _check(rows, texts, 64)
    assert padding == 0 if power_of_two else padding < 64 * 16
    assert P.pack(df.filter(F.lit(False)), vocabulary("byte_bpe_50k.tiktoken")).count() == 0


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "one text"), (1, "one text"), (None, "x")], "doc_id long, text string")
    rows = P.pack(df, vocabulary("byte_bpe_50k.tiktoken")).collect()
    assert sum(r.length for r in rows) == 2 * len(_ids("one text")) + len(_ids("x"))


def test_hilbert_curve_visits_every_cell_by_single_steps(monkeypatch):
    monkeypatch.setattr(P, "BITS", 3)
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    key = P.hilbert_key((cells + 0.5) / 8)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json"])
def test_texts_that_the_encoder_alone_cannot_take(spark, name):
    texts = {1: " " * 1_000_000, 2: "a" + " " * 600_000 + "b", 3: "x" * 1_000_000, 4: "\n" * 700_000, 5: "!" * 700_000, 6: " \t" * 400_000 + "<|endoftext|>"}
    rows = P.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), vocabulary(name)).collect()
    assert _check(rows, texts, P.LENGTH) == 0
