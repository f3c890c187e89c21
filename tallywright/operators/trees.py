"""What runs inside the isolation forest's tasks: growing one tree, walking all trees.

Pickled by value, so that executors need numpy and pandas but not this package.
"""

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = "tree int, node int, feature int, cut double, low int, high int, depth double"


def mean_path(n: float) -> float:
    """Mean length of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + float(np.euler_gamma)) - 2.0 * (n - 1.0) / n


def grow_tree(tree: int, x: np.ndarray, seed: int) -> pd.DataFrame:
    """Nodes of one tree; a leaf points to itself and holds its depth plus the path still open."""
    rng = np.random.default_rng([seed, tree])
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[tuple] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(())
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(open_features) == 0:
            nodes[at] = (tree, at, 0, np.inf, at, at, depth + mean_path(len(rows)))
            return at
        feature = int(rng.choice(open_features))
        cut = float(rng.uniform(low[feature], high[feature]))
        if cut >= high[feature]:
            cut = float(low[feature])
        below = rows[:, feature] <= cut
        left = grow(rows[below], depth + 1)
        right = grow(rows[~below], depth + 1)
        nodes[at] = (tree, at, feature, cut, left, right, 0.0)
        return at

    grow(x, 0)
    columns = [c.split()[0] for c in NODES.split(", ")]
    return pd.DataFrame(nodes, columns=columns)


def decide(trees: list[tuple[np.ndarray, ...]], levels: int, sample: int, x: np.ndarray):
    """Decision per row of ``x``: 0.5 minus the anomaly score; below 0 is an anomaly.

    A tree is the arrays feature, cut, children (low and high child of node i at 2i and 2i + 1) and
    depth. All rows of a batch walk a tree level by level.
    """
    width = x.shape[1]
    flat = np.ascontiguousarray(x, dtype=float).ravel()
    first = np.arange(len(x), dtype=np.int64) * width
    total = np.zeros(len(x))
    for feature, cut, children, depth in trees:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(levels):
            beyond = flat.take(first + feature.take(node)) > cut.take(node)
            node = children.take(2 * node + beyond)
        total += depth.take(node)
    path = mean_path(sample)
    if path == 0.0:
        return np.full(len(x), 0.0)
    return 0.5 - 2.0 ** (-total / (max(len(trees), 1) * path))
