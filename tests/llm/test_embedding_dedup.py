import numpy as np

from tallyrisk.llm import embedding_dedup as E
from tests.llm.brute import components


def _data(seed=3, n=400):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 16))
    x[100:180] = x[5] + 0.12 * rng.standard_normal((80, 16))
    x[200:210] = x[7]
    return x


def test_links_and_components_against_brute_force(spark):
    x = _data()
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in E.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int"),
                                                  block=32).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    comp = components(range(len(x)), np.argwhere(near).tolist())
    found = sum(got[i].n_links for i in got)
    assert found >= 0.99 * near.sum() and all(got[i].n_links <= near[i].sum() for i in got)
    assert {i: r.component_id for i, r in got.items()} == comp
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_unusable_vectors_ties_and_unlike_lengths(spark):
    one = [1.0, 2.0]
    rows = [(1, one), (2, one), (2, one), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]),
            (8, [float("inf"), 1.0]), (9, [1.0, 2.0, 0.0]), (None, one), (10, [-0.0, 3.0]), (11, [0.0, 3.0]), (12, [1e-200, 2e-200])]
    got = sorted(E.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), key=lambda r: str(r))
    by = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert len(got) == len(rows)
    assert by[1] == by[2] == (3, 1) and by[12] == (3, 1) and by[10] == by[11] == (1, 10)
    assert all(by[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9)) and by[None] == (0, None)


def test_empty_table(spark):
    assert E.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_tables_follow_rows_and_threshold():
    small, large = E.plan_tables(10_000, 0.9, 0.999), E.plan_tables(10_000_000, 0.9, 0.999)
    assert small[0] < large[0] and small[1] < large[1]
