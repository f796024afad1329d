import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyrisk.llm import order_minhash as O
from tallyrisk.llm.common import table
from tallyrisk.llm.queries import vocabulary
from tests.llm.brute import components
from tests.llm.test_packing import _ids
from tests.llm.test_substring_dedup import brute as without_repeats

pytest.importorskip("tokenizers")
D = "/root/testdata/sf0.001"


def _stages(spark, docs):
    out = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, D).collect()
        docs = spark.createDataFrame(rows, docs.schema)
        out.append(docs)
    return out, corpus_pipeline.STAGES[-1][1](spark, docs, D)


def test_each_stage_equals_brute_force_on_what_the_one_before_kept(spark):
    docs = table(spark, D, "documents")
    (known, single, cut), packed = _stages(spark, docs)
    assert all(x.columns == docs.columns for x in (known, single, cut))
    kept = {r.doc_id: r for r in known.collect()}
    all_ = {r.doc_id: r for r in docs.collect()}
    assert all(kept[i] == all_[i] for i in kept) and len(kept) > 0.9 * len(all_)
    ws = {i: O.words(r.text) for i, r in kept.items()}
    links = [(a, b) for a in ws for b in ws if a < b and len(ws[a]) and len(ws[b]) and O.aligned_similarity(ws[a], ws[b]) > 0]
    groups = components(ws, links)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i in groups if groups[i] == i)
    before = single.orderBy("doc_id").collect()
    after = {r.doc_id: r for r in cut.collect()}
    for r, (_, _, text) in zip(before, without_repeats([r.text for r in before])):
        assert after[r.doc_id].text == text and after[r.doc_id].n_chars == (None if text is None else len(text))
    pieces = packed.collect()
    for i, r in after.items():
        ids, at = _ids(r.text), 0
        for x in sorted((x for x in pieces if x.doc_id == i), key=lambda x: x.start):
            assert x.start == at and x.ids_crc32 == zlib.crc32(np.array(ids[at:at + x.length], "<u4").tobytes())
            at += x.length
        assert at == len(ids)


def test_defined_cases(spark):
    docs = table(spark, D, "documents").filter("doc_id < 40")
    some = docs.filter("length(text) > 300").orderBy("doc_id").first()
    odd = [(900, None, "en", "s", None), (901, "", "en", "s", 0), (902, some.text, some.lang, None, 1), (903, some.text * 200, some.lang, "s", 1),
           (904, " " * 1_000_000 + some.text, some.lang, "s", 1), (None, some.text[:200], some.lang, "s", 1), (905, "\n" * 300_000, None, None, None)]
    rows = docs.unionByName(spark.createDataFrame(odd + odd[2:3], docs.schema))
    rows = rows.withColumns({"removed": F.lit("mine"), "class_id": F.lit(1), "accepted": F.lit("?"), "size": F.lit(2)})
    stages, packed = _stages(spark, rows)
    assert all(x.columns == rows.columns for x in stages)
    last = stages[-1].collect()
    assert {r.removed for r in last} == {"mine"} and {r["size"] for r in last} == {2}
    assert sum(r.length for r in packed.collect()) == sum(len(_ids(r.text)) for r in last)
    empty, none = _stages(spark, rows.filter(F.lit(False)))
    assert all(x.count() == 0 for x in empty) and none.count() == 0
