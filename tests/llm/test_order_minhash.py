import tracemalloc

import numpy as np
import pyarrow as pa

from tallyrisk.llm import order_minhash as O
from tests.llm.brute import components


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_banded_alignment_finds_the_least_edits():
    rng = np.random.default_rng(0)
    for _ in range(600):
        a, b = (rng.integers(0, 4, rng.integers(1, 15)) for _ in range(2))
        if rng.integers(2):    # with long common runs
            run = rng.integers(0, 1000, rng.integers(1, 300))
            a, b = np.concatenate([a, run, a[::-1]]), np.concatenate([b, run, b])
        d = _levenshtein(a.tolist(), b.tolist())
        assert O.edits(a, b, d) == d and O.edits(a, b, d + 3) == d and (d == 0 or O.edits(a, b, d - 1) is None)


def test_pairs_aligned_together_equal_pairs_aligned_alone():
    rng = np.random.default_rng(8)
    for _ in range(60):
        pairs = []
        for _ in range(rng.integers(1, 20)):
            run = rng.integers(0, 1000, rng.integers(0, 300))
            a, b = (np.concatenate([rng.integers(0, 4, rng.integers(1, 15)), run, rng.integers(0, 4, rng.integers(0, 9))]) for _ in range(2))
            pairs.append((a, b))
        most = rng.integers(0, 25, len(pairs)).tolist()
        alone = [O.edits(a, b, m) for (a, b), m in zip(pairs, most)]
        assert O.edits_many(pairs, most).tolist() == [-1 if d is None else d for d in alone]


def test_the_bound_leaves_no_pair_out():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = rng.integers(0, 30, rng.integers(3, 60)).astype(np.int32)
        b = a.tolist()
        for _ in range(rng.integers(0, len(a) // 4 + 2)):
            at = int(rng.integers(len(b) + 1))
            b[at:at + int(rng.integers(2))] = [int(x) for x in rng.integers(100, 200, rng.integers(2))]
        b = np.array(b, np.int32)
        d, n = _levenshtein(a.tolist(), b.tolist()), max(len(a), len(b))
        assert O.aligned_similarity(a, b) == (1 - d / n if len(b) and d <= 0.2 * n + 1e-9 else 0)


def test_similarity_follows_order():
    rng = np.random.default_rng(1)
    a = rng.integers(-2**31, 2**31, 400).astype(np.int32)
    one = a.copy()
    one[200] = 5
    assert O.aligned_similarity(a, a) == 1 and O.aligned_similarity(a, one) == 399 / 400
    moved = np.concatenate([a[200:], a[:200]])
    assert O.aligned_similarity(a, moved) == 0   # its set of shingles is almost the same
    assert O.aligned_similarity(a[:4], a[:3]) == 0


def test_twenty_thousand_words_with_swapped_halves_stay_small():
    rng = np.random.default_rng(4)
    a = rng.integers(-2**31, 2**31, 20_000).astype(np.int32)
    b = np.concatenate([a[10_000:], a[:10_000]])
    tracemalloc.start()
    assert O.aligned_similarity(a, b) == 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6


def _texts():
    rng = np.random.default_rng(2)
    vocab = [f"w{i}" for i in range(5000)]
    docs = [" ".join(rng.choice(vocab, rng.integers(40, 200))) for _ in range(120)]
    for i in range(60):    # one large group of near copies of document 0
        w = docs[0].split()
        w[rng.integers(len(w))] = "new"
        docs.append(" ".join(w))
    for i in range(1, 20):
        w = docs[i].split()
        for j in rng.integers(0, len(w), 1 + i // 3):
            w[j] = "edit"
        docs.append(" ".join(w) if i % 2 else docs[i].upper() + " !")
    return docs


def test_groups_against_all_pairs(spark):
    docs = _texts()
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(docs)], "doc_id long, text string, class_id int")
    ws = {i: O.words(t) for i, t in enumerate(docs)}
    links = [(a, b) for a in ws for b in ws if a < b and O.aligned_similarity(ws[a], ws[b]) > 0]
    got = O.near_duplicates(df).collect()
    assert {r.doc_id: r.class_id for r in got} == components(ws, links)
    assert len(got) == len(docs) and all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_small_blocks_find_the_same_groups(spark, monkeypatch):
    docs = _texts()
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    whole = {r.doc_id: r.class_id for r in O.near_duplicates(df).collect()}
    monkeypatch.setattr(O, "BLOCK", 16)
    assert {r.doc_id: r.class_id for r in O.near_duplicates(df).collect()} == whole


def test_defined_cases(spark):
    long = " ".join(f"v{i % 977}x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "too short"), (5, "Too SHORT!"), (None, "too short"), (6, "!!! ???"), (7, "!!! ???"),
            (8, long), (9, long + " end"), (10, "a b"), (10, "a b"), (11, "A.B")]
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in
                  O.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (None, None, True), (6, 6, True),
                          (7, 6, False), (8, 8, True), (9, 8, False), (10, 10, True), (10, 10, True), (11, 10, False)], key=str)
    assert O.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_block_returns_a_forest_that_joins_all_linked_members():
    rng = np.random.default_rng(3)
    n = 90
    base = rng.integers(-2**31, 2**31, 100).astype(np.int32)
    texts = []
    for i in range(n):      # copies of one text with 4 to 24 edits each: some pairs link, some do not
        w = base.copy()
        w[rng.choice(100, 4 + i % 21, replace=False)] = rng.integers(-2**31, 2**31, 4 + i % 21)
        texts.append(w)
    ids, bands = np.arange(n), np.zeros((n, 2), np.int64)
    links = O.block_links(ids, ids.copy(), np.zeros(n, np.int64), 0, bands, texts, O.THRESHOLD)
    want = [(a, b) for a in range(n) for b in range(a) if O.aligned_similarity(texts[a], texts[b]) > 0]
    assert components(range(n), links) == components(range(n), want) and len(links) < n
    assert all(O.aligned_similarity(texts[a], texts[b]) > 0 for a, b in links)
    assert not O.block_links(ids, ids.copy(), np.zeros(n, np.int64), 1, bands, texts, O.THRESHOLD)    # all met in band 0
    home = ids % 2
    cross = O.block_links(ids, ids.copy(), home, 0, bands, texts, O.THRESHOLD)
    assert components(range(n), cross) == components(range(n), [(a, b) for a, b in want if home[a] != home[b]])
    upper = np.triu(np.ones((n, n), bool), 1)
    for size in O.BOUNDS:
        marks = [set(O.labelled(O.shingles(t, size)).tolist()) for t in texts]
        assert O.shared_shingles(texts, size, upper)[5, 6:].tolist() == [len(marks[5] & m) for m in marks[6:]]


def test_the_prefix_filter_keeps_every_linked_pair():
    rng = np.random.default_rng(6)
    for _ in range(40):
        base, common = rng.integers(0, 40, rng.integers(1, 50)), rng.integers(0, 9, 20)
        texts = []
        for _ in range(25):
            w = rng.integers(0, 60, rng.integers(1, 50)) if rng.integers(3) == 0 else base.copy()
            at = rng.integers(0, len(w), rng.integers(0, len(w) // 5 + 2))
            w[at] = rng.integers(0, 60, len(at))
            texts.append(np.concatenate([w, common[:rng.integers(0, 20)]]).astype(np.int32))
        mask = O.sharing(texts, O.THRESHOLD)
        assert all(mask[i, j] for i in range(25) for j in range(i) if O.aligned_similarity(texts[i], texts[j]) > 0)


def test_long_texts_reach_python_in_small_batches(spark, monkeypatch):
    """Memory of a task: batches of bounded bytes, words made once, a small cache; the session's setting stays."""
    from tallyrisk.llm.common import BATCH_BYTES, Scratch
    long = spark.range(60, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 50000) AS text")
    before = spark.conf.get(BATCH_BYTES)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    seen = Scratch(spark, "test").write(long.mapInArrow(sizes, "n long, bytes long"), "sizes", O.BATCH).collect()
    assert sum(r.n for r in seen) == 60 and max(r.bytes for r in seen) < 2 * O.BATCH
    assert spark.conf.get(BATCH_BYTES) == before
    given = []
    write = Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name, *a: given.append((name, "MapInArrow" in df._jdf.queryExecution().optimizedPlan().toString(), a))
                        or write(self, df, name, *a))
    assert O.near_duplicates(long.limit(5)).count() == 5
    assert {name for name, python, _ in given if python} == {"sketches", "star"} and all(a == (O.BATCH,) for _, python, a in given if python)
