import hashlib
import random

import pytest

from tallyrisk.llm import bpe_stream as B
from tallyrisk.llm.common import table
from tallyrisk.llm.queries import QUERIES, vocabulary

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def _texts():
    random.seed(0)
    alpha = "abcdefgh ABC  éèñßü'\"!?.,012 \n\t'sİΣσςжД漢字가각ᅡé́ ǅ<|endoftext|>😀­‍ ﬁ½²Ⅷ'"
    out = ["".join(random.choice(alpha) for _ in range(random.randint(0, 60))) for _ in range(500)]
    out += ["".join(random.choice("aeiounrst") for _ in range(random.randint(2000, 9000))) for _ in range(8)]
    return [*out, "a" * 5000, "ab" * 4000, "!" * 3000, "<|endoftext|>", "x<|startoftext|>y<|endoftext|", "it's 'll ''s don'tve",
            "the" * 3000, "", " \n "]


@pytest.mark.parametrize("piece", [7, 64, 500, 1 << 16])
def test_equals_the_library_whatever_the_pieces(library, monkeypatch, piece):
    monkeypatch.setattr(B, "PIECE", piece)
    for text in _texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert B.encode_text(text, PATH).tolist() == ids
        d = B.Decoder(B.vocabulary(PATH))
        assert "".join(d.feed(ids[i:i + piece]) for i in range(0, len(ids), piece)) + d.finish() == library.decode(
            ids, skip_special_tokens=False)


def test_lookahead_covers_every_change_of_a_growing_word():
    v = B.vocabulary(PATH)
    random.seed(3)
    for _ in range(60):
        word = "".join(random.choice("etaoinsrh") for _ in range(300))
        whole, part = (B.merge(list(w), v.ranks) for w in (word, word[:200]))
        n = 0
        for a, b in zip(whole, part):
            if a != b:
                break
            n += len(a)
        assert 200 - n <= v.lookahead


def test_state_machine_gives_the_text_back(library):
    v = B.vocabulary(PATH)
    ids = library.encode("naïve café, 漢字 😀 ok", add_special_tokens=False).ids
    d = B.Decoder(v, text=True)
    assert "".join(d.feed([i]) for i in ids) + d.finish() == "naïve café , 漢字 😀 ok"


def test_query_and_defined_cases(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_bpe_stream"](spark, d).collect()}
    for r in table(spark, d, "documents").select("doc_id", "text").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    rows = [(1, None, 1), (2, "", 2), (2, "", 2), (None, "Word", 3)]
    out = B.decode(B.encode(spark.createDataFrame(rows, "doc_id long, text string, ids int"), PATH), PATH).collect()
    assert [(r.doc_id, len(r.ids), r.decoded) for r in out] == [(1, 0, ""), (2, 0, ""), (2, 0, ""), (None, 1, "word</w>")]
    assert B.encode(spark.createDataFrame([], "text string"), PATH).count() == 0
