"""Neighbours and outlier factors against every pair; isolation trees against their definition."""

import numpy as np
import pytest

from tidemark.operators import challengers, neighbours


def brute(x: np.ndarray, k: int) -> list[float]:
    """The factor of each row from all pairs, equally near rows by their number."""
    k = max(1, min(k, len(x) - 1))
    d = neighbours.distances(x, x)
    near = [[j for _, j in sorted((d[i, j], j) for j in range(len(x)) if j != i)[:k]] for i in range(len(x))]
    reach = [max(d[i, j] for j in near[i]) for i in range(len(x))]
    density = [1 / (np.mean([max(d[i, j], reach[j]) for j in near[i]]) + 1e-10) for i in range(len(x))]
    return [np.mean([density[j] for j in near[i]]) / density[i] for i in range(len(x))]


def table(spark, x):
    return spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "row long, x array<double>").repartition(3)


def normal(n, d):
    return np.random.default_rng(n).normal(0, 1, (n, d))


CASES = {
    "spread": (np.concatenate([normal(300, 4), normal(3, 4) + 6]), 7),
    "clusters": (np.concatenate([normal(150, 3) / 5 + 8 * k for k in range(4)]), 12),
    "grid of ties": (np.array([[a, b] for a in range(12) for b in range(12)]), 5),
    "repeated rows": (np.concatenate([np.zeros((60, 2)), np.round(normal(200, 2)), np.ones((3, 2)) * 9]), 6),
    "all the same": (np.zeros((40, 3)), 5),
    "two rows": (np.array([[0.0], [1.0]]), 5),
    "more neighbours than rows": (normal(6, 2), 35),
}


@pytest.mark.parametrize("name", CASES)
def test_factors_are_those_of_all_pairs(spark, monkeypatch, name):
    monkeypatch.setattr(neighbours, "LEAST_POINTS", 8)
    monkeypatch.setattr(neighbours, "BLOCK_POINTS", 16)
    x, k = CASES[name]
    got = {r["row"]: r["lof"] for r in neighbours.outlier_factors(table(spark, x), k).collect()}
    assert np.allclose([got[r] for r in range(len(x))], brute(x, k), rtol=1e-9)


def test_one_row_and_none(spark):
    assert [tuple(r) for r in neighbours.outlier_factors(table(spark, [[1.0]]), 5).collect()] == [(0, None)]
    assert neighbours.outlier_factors(spark.createDataFrame([], "row long, x array<double>"), 5).count() == 0


def test_far_blocks_never_meet(spark):
    x, k = np.concatenate([normal(400, 2) / 10 + 20 * c for c in range(10)]), 5
    points = neighbours.distinct_points(table(spark, x), k).select("point", "x", "n")
    pivots = x[::200]
    made = neighbours.blocks(neighbours.with_pivot(points, pivots), 64, 2, k).persist()
    blocks, met = made.count(), neighbours.meetings(made, pivots).count()
    assert sum(len(r["points"]) for r in made.collect()) == len(x) and max(len(r["points"]) for r in made.collect()) <= 64
    assert blocks >= 60 and met < blocks * (blocks - 1) / 5


def test_a_point_takes_its_least_numbers_from_equal_points(spark):
    rows = [(k, [0.0]) for k in range(50, 0, -1)] + [(0, [1.0])]
    points = neighbours.distinct_points(spark.createDataFrame(rows, "row long, x array<double>"), 3).orderBy("point").collect()
    assert [(r["point"], r["n"], r["ids"]) for r in points] == [(0, 1, [0]), (1, 50, [1, 2, 3, 4])]


def test_tree_samples_are_the_least_hashes(spark):
    rng = np.random.default_rng(5)
    h, x = rng.integers(-(1 << 63), (1 << 63) - 1, 700), rng.normal(size=(700, 2))
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(h, x, strict=True)], "h long, x array<double>")
    seeds = challengers.tree_seeds(7).tolist()
    whole = challengers.tree_samples(df.repartition(5), 7, 16)
    assert len(whole) == len(seeds) == challengers.TREES

    def mixed(value, seed):
        z, m = (value ^ seed) % (1 << 64), (1 << 64) - 1
        z = (z ^ (z >> 30)) * 0xBF58476D1CE4E5B9 & m
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB & m
        return z ^ (z >> 31)

    for t in (0, 41, 99):
        order = sorted(range(700), key=lambda r: mixed(int(h[r]), seeds[t]))[:16]
        assert np.array_equal(whole[t], x[order])
    assert len({tuple(map(tuple, s)) for s in whole}) == len(whole)
    few = challengers.tree_samples(df.limit(3), 7, 16)
    assert len(few) == challengers.TREES and all(len(s) == 3 for s in few)


def length(tree, row):
    """Path length of one row, node by node."""
    depth = 0
    while tree[0] != "leaf":
        tree, depth = tree[2] if row[tree[0]] < tree[1] else tree[3], depth + 1
    return depth + challengers.expected_depth(tree[1])


def test_isolation_scores_by_walking_every_tree(spark):
    x = np.concatenate([normal(500, 3), np.full((2, 3), 7.0)])
    df = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "h long, x array<double>")
    samples = challengers.tree_samples(df, 11, 64)
    got = challengers.isolation_score(samples, 11)(x)
    forest = challengers.isolation_forest(samples, 11)
    assert np.allclose(got, [2 ** (-np.mean([length(t, row) for t in forest]) / challengers.expected_depth(64)) for row in x], rtol=1e-12)
    assert set(np.argsort(-got)[:2]) == {500, 501}

    def sizes(tree):
        return tree[1] if tree[0] == "leaf" else sizes(tree[2]) + sizes(tree[3])

    assert all(sizes(t) == 64 for t in forest)


def test_scores_do_not_depend_on_how_rows_are_dealt(spark):
    from tests.test_engine import AGGREGATION

    x = normal(300, 2)
    scores = spark.createDataFrame([(str(k), *row.tolist()) for k, row in enumerate(x)], "customer_id string, a double, b double")
    rules = AGGREGATION | {"challenger_models": AGGREGATION["challenger_models"] | {"min_rows": 50, "feature_columns": ["a", "b"]}}
    one, other = ({r["customer_id"]: r for r in challengers.add_challengers(scores.repartition(n), rules, large=n > 1).collect()} for n in (1, 7))
    for name in ("pca_challenger_score", "if_challenger_score", "lof_challenger_score", "model_challenger_score"):
        assert len(one) == 300 and np.allclose([one[k][name] for k in one], [other[k][name] for k in one])
