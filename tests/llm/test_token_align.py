import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import token_align as A
from tallyrisk.llm.byte_bpe import byte_alphabet, byte_bpe
from tallyrisk.llm.common import table
from tallyrisk.llm.queries import QUERIES, vocabulary

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATHS = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def brute(texts):
    """Every row's result by plain loops over the libraries' tokens."""
    ta, sp = tokenizers.Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    ta.encode_special_tokens = True
    byte = byte_alphabet()
    docs = []
    for text in texts:
        a, b, want = [], [], b" " + (text or "").encode()
        if text:
            a, b = ta.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            wa = [bytes(byte[c] for c in ta.id_to_token(i)) for i in a]
            wb = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(wa) != want or b"".join(wb) != want:
                a, b = [], []
        ea, eb = (np.cumsum([len(w) for w in ws]).tolist() if ids else [] for ids, ws in ((a, wa if a else []), (b, wb if b else [])))
        owner_a = [i for i in range(len(a)) for _ in range((ea[i] - (ea[i - 1] if i else 0)))]
        owner_b = [i for i in range(len(b)) for _ in range((eb[i] - (eb[i - 1] if i else 0)))]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, i, j = [], 0, 0
        for end in sorted(set(ea) & set(eb)):
            i2, j2 = ea.index(end, i) + 1, eb.index(end, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        docs.append((a, b, groups, [(a[x], b[y]) for x, y in links]))
    count = Counter(p for d in docs for p in set(d[3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(len(a), len(b), len(g), len(l), sum(count[p] == most[p[0]] for p in l), sum(count[p] for p in l),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for a, b, g, l in docs]


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    rows = QUERIES["op12_token_align"](spark, d).orderBy("doc_id").collect()
    assert [tuple(r[f] for f in FIELDS) for r in rows] == brute([r.text for r in docs])


@pytest.mark.parametrize("size", [A.SLICE, 20])
def test_defined_cases_and_slices(spark, monkeypatch, size):
    texts = [None, "", "a▁b", "<|endoftext|> </s> é😀\x00", "  two  blanks ", " ", "unbelievable " * 3000, "same text", "same text",
             "的" * 700 + "abc", " " * 9000, "\n\t" * 40 + "ﬁ", "x" * 5000]
    df = spark.createDataFrame([(None if i == 4 else i, t, 1, "q") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, pairs string")
    rows = A.align(df.repartition(3), *PATHS, slice_pairs=size).collect()
    assert Counter((r.doc_id, *(r[f] for f in FIELDS)) for r in rows) == Counter(
        (None if i == 4 else i, *x) for i, x in enumerate(brute(texts)))
    assert A.align(df.filter(F.lit(False)), *PATHS).count() == 0
    assert A.align(df.filter("doc_id < 2"), *PATHS).agg(F.sum("count_sum")).first()[0] == 0


def test_lanes_do_not_change_the_result(monkeypatch):
    s = A.sides(*PATHS)
    tokens = [s(t) for t in ("some more words in a line, and others " * 60, "x", "", "的" * 300)]
    whole = A.aligned_texts(s, tokens)
    monkeypatch.setattr(A, "LANE", 8)
    cut = A.aligned_texts(s, tokens)
    assert whole["groups"] == cut["groups"] and all((whole[k] == cut[k]).all() for k in ("n_links", "n_groups", "pairs", "times", "ends"))


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + " " * 300_000 + "b", "\n" * 300_000 + " a", "a" * 300_000, "!?" * 100_000, " \n\t" * 50_000 + "<|endoftext|> z" + " " * 5000])
@pytest.mark.parametrize("specials", [True, False])
def test_byte_level_ids_of_very_long_runs(text, specials):
    t = tokenizers.Tokenizer.from_file(PATHS[0])
    t.encode_special_tokens = not specials
    assert byte_bpe(PATHS[0], specials)(text) == t.encode(text, add_special_tokens=False).ids
