"""Vector near-duplicates and hard negatives against brute force and SQL."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

from starloom.llm import negatives, queries, vectors
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
KINDS = {"float": "vec_id long, embedding array<float>, label int, n string, node long, id string", "double": "vec_id long, embedding array<double>, label int, n string, node long, id string"}
RNG = np.random.default_rng(11)


def clustered(n: int, size: int, spread: float, clusters: int, rng=RNG) -> np.ndarray:
    centre = rng.standard_normal((clusters, size))
    x = centre[rng.integers(0, clusters, n)] + spread * rng.standard_normal((n, size))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, x, k, "n", 1, "i") for i, x, k in rows], KINDS[kind])


ODD = [
    (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 0.0], 1), (5, [float("nan"), 1.0, 0.0], 1), (6, [float("inf"), 1.0, 0.0], 1),
    (7, [1.0, 0.0, 0.0], 2), (8, [2.0, 0.0, 0.0], 2), (8, [2.0, 0.0, 0.0], 2), (None, [2.0, 0.01, 0.0], 2), (None, [0.0, 1.0, 0.0], 3),
    (9, [1.0, 0.0], 2), (10, [1.0, 0.001], 2), (11, [1e-30, 0.0, 0.0], None), (12, [-1.0, 0.0, 0.0], 1), (200, [5.0], 1), (300, [7.0], 1), (14, [5.0], 3),
    (400, [0.0, 0.0, 0.0], 1), (100, [1.0, 0.0, 0.5], 2), (100, [1.0, 0.0, 0.5], 2), (21, [0.5, 0.0, 0.25], 2), (22, [0.5, 0.0, 0.3], 4), (23, [0.5, 0.0, 0.3], 4),
]


def check(spark, df, name, found):
    con = duckdb.connect()
    con.register("embeddings", df.select("vec_id", "embedding", "label").toArrow())
    assert compare(found, con, queries.REGISTRY[name].sql) is None


TABLES = {
    "odd": ODD,
    "empty": [],
    "clusters": [(int(i) * 3, x.tolist(), int(i) % 4) for i, x in enumerate(clustered(700, 24, 0.12, 60))],
    "one group": [(int(i), x.tolist(), int(i) % 3) for i, x in enumerate(clustered(400, 16, 0.05, 1))],
    "a third equal": [(int(i), [1.0] * 8 if i % 3 == 0 else x.tolist(), int(i) % 10) for i, x in enumerate(clustered(500, 8, 0.3, 40))],
    "wide": [(int(i), x.tolist(), 0 if i % 2 else 5) for i, x in enumerate(clustered(300, 131, 0.02, 20))],
}


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("name", list(TABLES))
def test_links_against_sql(spark, name, kind):
    if kind == "double" and name not in ("odd", "clusters"):
        pytest.skip("the odd and the clustered table are enough")
    df = frame(spark, TABLES[name], kind)
    check(spark, df, "op11_subspace_pigeonhole", vectors.near_vectors(df, 0.95, tile=64))


@pytest.mark.parametrize("name", list(TABLES))
def test_negatives_against_sql(spark, name):
    df = frame(spark, TABLES[name])
    label = queries.F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    check(spark, df, "op12_threshold_negatives", negatives.mine(df, "id % 100 = 0", label, block_rows=90))


@pytest.mark.parametrize("name", ["op11_subspace_pigeonhole", "op12_threshold_negatives"])
def test_queries_against_sql(spark, name):
    q = queries.REGISTRY[name]
    assert compare(q.run(spark, SMALL), connect(SMALL), q.sql) is None


@pytest.mark.parametrize("least", [0.5, 0.8, 0.95, 0.999])
def test_every_close_pair_is_found_in_exactly_one_block(least):
    rng = np.random.default_rng(5)
    x = clustered(300, 20, 0.25, 12, rng)
    x[::7] = x[3] + 0.002 * rng.standard_normal((43, 20))
    u = vectors.units(x)
    q = vectors.whole(u @ vectors.rotation(20))
    edges, limit = vectors.block_edges(20), vectors.budgets(20, least)
    weight = rng.integers(1, 4, 300)
    total = np.zeros(300, int)
    for at in range(4):
        home = np.arange(300) < 130
        total += vectors.join_tiles(q, u, weight, home, True, at, limit, edges, least)[0]
        rest = slice(130, None)
        total[rest] += vectors.join_tiles(q[rest], u[rest], weight[rest], np.ones(170, bool), True, at, limit, edges, least)[0]
    close = u @ u.T >= least
    np.fill_diagonal(close, False)
    assert (total == close @ weight).all() and total.any()


def test_threshold_stops_early_and_loses_nothing():
    rng = np.random.default_rng(7)
    rows = np.floor(256 * rng.standard_normal((5000, 4)))
    lists = negatives.Lists(rows)
    fewer = 0
    for _ in range(40):
        anchor = np.floor(256 * rng.standard_normal(4)) * (rng.random(4) < 0.8)
        score = (rows @ anchor).astype(int)
        windows = [(int(w * 3e4), int(w * 9e4)) for w in (1, 2, -1)] + [(5, 4), (-(1 << 63) + 1, (1 << 63) - 1)]
        taken = rng.random(5000) < 0.1
        found, _, seen = lists.best(anchor, windows, 10, taken)
        for (least, most), f in zip(windows, found, strict=True):
            at = [i for i in np.lexsort((np.arange(5000), -score)) if not taken[i] and least <= score[i] <= most]
            assert f.tolist() == at[:10]
        fewer += seen < 5000
    assert fewer > 0


def test_scores_beyond_doubles_are_whole():
    big = np.array([[2.0**40, 1.0], [2.0**40, 3.0]])
    assert negatives.inner(big, np.array([2.0**20, 1.0]), 2.0**40).tolist() == [2**60 + 1, 2**60 + 3]
