import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import nn_descent as N
from tallyrisk.llm.common import table
from tallyrisk.llm.queries import QUERIES


def _brute(ids, x, query, top=10):
    out = {}
    for q in np.flatnonzero(query):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[ids == ids[q]] = np.inf
        o = np.lexsort((ids, d))[:top]
        out[int(ids[q])] = [(int(ids[i]), d[i]) for i in o if np.isfinite(d[i])]
    return out


def _found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_exact_scores_of_the_query(spark):
    d = "/root/testdata/sf0.01"
    data = table(spark, d, "embeddings").select("vec_id", "embedding").toPandas()
    ids, x = data.vec_id.to_numpy(), np.stack(data.embedding).astype(float)
    want, got = _brute(ids, x, ids % 100 == 0), _found(QUERIES["op2_nn_descent"](spark, d).collect())
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    place = {i: n for n, i in enumerate(ids)}
    for q, hits in got.items():
        for v, s in hits:
            assert np.isclose(s, np.sqrt(((x[place[q]] - x[place[v]]) ** 2).sum()), rtol=1e-13, atol=0)
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)] + [(i, [1.0] * 8) for i in range(100, 140)]
    rows += [(100, [1.0] * 8), (200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [1.0, None] * 4), (204, [1.0] * 9), (None, [2.0] * 8)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<double>, rank int")
    ids = np.array([r[0] for r in rows[:100]])
    x = np.array([r[1] for r in rows[:100]])
    got = _found(N.nearest(df, F.col("vec_id") % 20 == 0).collect())
    want = _brute(ids, x, ids % 20 == 0)
    assert got.keys() == want.keys()
    for q, hits in want.items():
        assert [v for v, _ in got[q]] == [v for v, _ in hits]
        assert np.allclose([s for _, s in got[q]], [s for _, s in hits])


def test_tiny_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [4.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.score) for r in N.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 0.5), (2, 3.0)]
    assert N.nearest(df.limit(1), F.lit(True)).count() == 0
    assert N.nearest(df.filter(F.lit(False)), F.lit(True)).count() == 0


def test_one_vector_far_larger_than_the_others(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 16))
    x[1234] *= 1e9
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got, want = _found(N.nearest(df, F.col("vec_id") % 50 == 0).collect()), _brute(ids, x, ids % 50 == 0)
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_rounds_and_beams_grow_with_the_table():
    assert (N.rounds(2), N.beam_width(2)) == (N.ROUNDS, N.BEAM)
    assert N.rounds(1 << 30) > N.rounds(1 << 20) > N.ROUNDS and N.beam_width(1 << 30) > N.beam_width(1 << 20) > N.BEAM


@pytest.mark.parametrize("offset", [2_000, 20_000])
def test_a_common_offset_costs_no_recall(spark, offset):
    x = np.random.default_rng(7).standard_normal((3000, 16)) + offset
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got, want = _found(N.nearest(df, F.col("vec_id") % 100 == 0).collect()), _brute(ids, x, ids % 100 == 0)
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want]) >= 0.9


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning("), plan.count("InArrow")


def test_a_round_deals_its_rows_once_by_each_key(spark):
    """Every stage of a round costs a task for each partition: lists are merged in one, found nodes meet their vectors where they were made distinct."""
    node, pair = F.col("id").alias("node"), (F.col("id") % 7).alias("q")
    beam = spark.range(50).select(pair, node, F.lit(1.0).alias("d"), F.lit(False).alias("done"), F.lit(True).alias("next"))
    neigh = spark.range(50).select(node, F.array(F.col("id") + 1, F.col("id") + 2).alias("neigh"))
    halves = spark.range(60).select(node, F.lit(b"x").alias("half"))
    todo = beam.filter("node < 20")
    reached = N._reached(F.broadcast(todo), neigh, beam)
    assert _shuffles(reached.join(halves.hint("merge"), "node")) == (2, 0)
    got = {(r.q, r.node) for r in reached.collect()}
    held = {(r.q, r.node) for r in beam.collect()}
    assert got == {(i % 7, i + k) for i in range(20) for k in (1, 2)} - held and reached.count() == len(got)
    rows = spark.createDataFrame([(1, n, float(abs(n - 40)), n % 2 == 0) for n in range(2, 80)] + [(1, 40, 0.0, False), (2, 1, 3.0, True)],
                                 "node long, neigh long, d double, old boolean")
    lists = N._merged(rows)
    assert _shuffles(lists) == (1, 0)
    got = {(r.node, r.neigh): (r.d, r.new, r.nth) for r in lists.collect()}
    near = sorted(range(2, 80), key=lambda n: (abs(n - 40), n))[:N.K]
    assert got == {(1, n): (float(abs(n - 40)), n % 2 == 1, i) for i, n in enumerate(near)} | {(2, 1): (3.0, False, 0)}


def test_distances_to_the_nearest_of_a_querys_vectors():
    x, of, to = np.array([[0.0, 1.0], [3.0, 3.0], [5.0, 0.0]]), np.array([0, 2, 2]), np.array([0, 0, 2, 2, 2])
    y = np.array([[0.0, 0.0], [2.0, 1.0], [3.0, 3.0], [5.0, 1.0], [4.0, 4.0]])
    assert N._apart(x, of, y, to).tolist() == [1.0, 4.0, 0.0, 1.0, 2.0]
    assert N._apart(x, of, y[:0], to[:0]).tolist() == []


def test_a_query_id_with_two_vectors(spark):
    x = np.random.default_rng(3).standard_normal((40, 4))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, (x[7] + 0.001).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = N.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert len(got) == 10 and got[0].vec_id == 7 and np.isclose(got[0].score, 0.002)
