"""Paths through an isolation tree without branches against a walk node by node."""

import numpy as np

from lacuna.operators import outliers


def test_paths_match_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    x[:40] = x[0]
    nodes = []
    outliers._grow(x[:200], rng, 0, 8, nodes)
    arr = np.array(nodes, dtype=float)
    x[7, 1] = np.nan

    def walk(row):
        node = depth = 0
        while arr[node, 0] >= 0:
            node = int(arr[node, 2 if row[int(arr[node, 0])] < arr[node, 1] else 3])
            depth += 1
        return depth + outliers._c_factor(arr[node, 4])

    got = outliers._path_length(outliers._steps(arr), x)
    assert np.allclose(got, [walk(r) for r in x], rtol=1e-12, atol=0)


def test_a_single_leaf():
    steps = outliers._steps(np.array([[-1.0, 0.0, -1.0, -1.0, 5.0]]))
    assert np.allclose(outliers._path_length(steps, np.zeros((3, 2))), outliers._c_factor(5))
