import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import lexical_search as S
from tallyrisk.llm.queries import ORACLE, QUERIES
from tests.oracle_check import duck

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=S.TOP):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        q, found = Counter(terms(text)), []
        for i, c in counts:
            if not c or i is None:
                continue
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(x * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, x in q.items() if c[t])
            if s > 0:
                found.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    want = duck(d).execute(f"SELECT item_id, rank, doc_id, score FROM ({ORACLE['op13_lexical_search']})").fetchall()
    assert result(QUERIES["op13_lexical_search"](spark, d)) == sorted(want, key=str)


@pytest.mark.parametrize("bucket,block", [(4, 7), (64, 100_000)])
def test_many_buckets_blocks_and_ties(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(S, "BUCKET", bucket)
    blocks = S.blocks
    monkeypatch.setattr(S, "blocks", lambda items: blocks(items, block))
    rng = random.Random(5)
    words = ["w%d" % (i * i // 40) for i in range(400)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 30, 200])))) for i in range(600)]
    docs += [(1000 + i, docs[7][1]) for i in range(300)]     # a third of all rows are one text
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 12])))) for i in range(12)] + [(50, docs[7][1])]
    spread = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(S.search(spread, spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_defined_cases(spark):
    docs = [(1, None), (2, ""), (3, " .,! "), (None, "rare words"), (4, "Rare WORDS ÉÀ"), (4, "Rare WORDS ÉÀ"), (5, "words " * 100_000), (6, "éà rare 1 2")]
    items = [(1, "rare"), (2, None), (3, "ÉÀ éà"), (None, "words"), (4, "nowhere"), (1, "rare")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, q string")
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    assert sorted(map(str, result(S.search(d, i)))) == sorted(map(str, brute(docs, [(1, "rare"), (2, None), (3, "ÉÀ éà"), (4, "nowhere")]) + [
        (None, r, x, s) for _, r, x, s in brute(docs, [(0, "words")])]))
    assert S.search(d.filter(F.lit(False)), i).count() == 0 and S.search(d, i.filter(F.lit(False))).count() == 0
