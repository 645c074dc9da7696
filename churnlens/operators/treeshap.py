"""Path-dependent TreeSHAP for Spark GBT models.

Algorithm: Lundberg, Erion & Lee, "Consistent Individualized Feature
Attribution for Tree Ensembles" (arXiv:1802.03888), Algorithm 2.  The
recursion over a tree visits the same nodes for every row; only which child
is "hot" (the one the row follows) differs.  So each batch of rows walks the
tree once and carries per-row vectors for the hot indicators and path
weights, which turns the per-row Python recursion into numpy operations on
whole Arrow batches.

Spark GBT trees (binary classification) are regression trees on a margin
``F = sum_t weight_t * tree_t(x)`` with ``P(y=1) = 1 / (1 + exp(-2F))``, so
contributions in log-odds are ``2 * weight_t * phi_t`` summed over trees.  A
row goes left when ``x[feature] <= threshold``.  Node covers are the training
instance weights stored with each node.

A leaf's contributions depend only on which of the features on its path a row
agrees with.  For trees whose paths test few features (``TABLE_FEATURES``) they
are tabulated once per leaf and pattern of agreement; a row then costs one
lookup per leaf (``LeafTables``).  Deeper trees take the recursion.

Execution: the node arrays (trees x nodes, bounded by the model) are
broadcast; ``mapInPandas`` explains each Arrow batch; no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    left: np.ndarray       # child index or -1 for a leaf
    right: np.ndarray
    feature: np.ndarray    # split feature or -1
    threshold: np.ndarray
    value: np.ndarray      # leaf prediction
    cover: np.ndarray      # training weight reaching the node
    weight: float = 1.0    # tree weight in the ensemble
    made: LeafTables | None = field(default=None, repr=False, compare=False)

    def expected_value(self) -> float:
        leaves = self.left < 0
        return float(np.sum(self.cover[leaves] * self.value[leaves]) / self.cover[0])

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(x.shape[0], dtype=np.int64)
        while (internal := self.left[node] >= 0).any():
            f = np.where(internal, self.feature[node], 0)
            go_left = x[np.arange(x.shape[0]), f] <= self.threshold[node]
            nxt = np.where(go_left, self.left[node], self.right[node])
            node = np.where(internal, nxt, node)
        return self.value[node]


class _Path:
    """Unique path of features with per-row hot fractions and weights."""

    __slots__ = ("d", "z", "o", "w")

    def __init__(self, d, z, o, w):
        self.d, self.z, self.o, self.w = d, z, o, w

    def copy(self):
        return _Path(list(self.d), list(self.z), list(self.o), list(self.w))


def _extend(m: _Path, p_z: float, p_o: np.ndarray, p_i: int) -> _Path:
    m = m.copy()
    depth = len(m.d)
    m.d.append(p_i)
    m.z.append(p_z)
    m.o.append(p_o)
    m.w.append(np.ones_like(p_o) if depth == 0 else np.zeros_like(p_o))
    for k in range(depth - 1, -1, -1):
        m.w[k + 1] = m.w[k + 1] + p_o * m.w[k] * ((k + 1) / (depth + 1))
        m.w[k] = p_z * m.w[k] * ((depth - k) / (depth + 1))
    return m


def _unwind(m: _Path, i: int) -> _Path:
    """Remove path element ``i`` (0-based), undoing its extension."""
    size = len(m.d)
    o_i, z_i = m.o[i], m.z[i]
    hot = o_i != 0
    n = m.w[size - 1]
    w = list(m.w[:size - 1])
    with np.errstate(divide="ignore", invalid="ignore"):
        for j in range(size - 2, -1, -1):
            t = w[j]
            w_hot = n * size / ((j + 1) * np.where(hot, o_i, 1.0))
            w_cold = t * size / (z_i * (size - (j + 1))) if z_i != 0 else np.zeros_like(t)
            w[j] = np.where(hot, w_hot, w_cold)
            n = np.where(hot, t - w[j] * z_i * (size - (j + 1)) / size, n)
    d = m.d[:i] + m.d[i + 1:]
    z = m.z[:i] + m.z[i + 1:]
    o = m.o[:i] + m.o[i + 1:]
    return _Path(d, z, o, w)


def _unwound_sum(m: _Path, i: int) -> np.ndarray:
    size = len(m.d)
    o_i, z_i = m.o[i], m.z[i]
    hot = o_i != 0
    n = m.w[size - 1]
    total = np.zeros_like(n)
    with np.errstate(divide="ignore", invalid="ignore"):
        for j in range(size - 2, -1, -1):
            t = m.w[j]
            w_hot = n * size / ((j + 1) * np.where(hot, o_i, 1.0))
            w_cold = t * size / (z_i * (size - (j + 1))) if z_i != 0 else np.zeros_like(t)
            total = total + np.where(hot, w_hot, w_cold)
            n = np.where(hot, t - w_hot * z_i * (size - (j + 1)) / size, n)
    return total


def tree_shap(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Contributions of every feature for every row of ``x`` to one tree's output."""
    rows, n_features = x.shape
    phi = np.zeros((rows, n_features))

    def recurse(j: int, m: _Path, p_z: float, p_o: np.ndarray, p_i: int) -> None:
        m = _extend(m, p_z, p_o, p_i)
        if tree.left[j] < 0:
            for i in range(1, len(m.d)):
                w = _unwound_sum(m, i)
                phi[:, m.d[i]] += w * (m.o[i] - m.z[i]) * tree.value[j]
            return
        f = int(tree.feature[j])
        go_left = (x[:, f] <= tree.threshold[j]).astype(np.float64)
        i_z, i_o = 1.0, np.ones(rows)
        if f in m.d[1:]:
            k = m.d.index(f, 1)
            i_z, i_o = m.z[k], m.o[k]
            m = _unwind(m, k)
        a, b = int(tree.left[j]), int(tree.right[j])
        recurse(a, m, i_z * tree.cover[a] / tree.cover[j], i_o * go_left, f)
        recurse(b, m, i_z * tree.cover[b] / tree.cover[j], i_o * (1.0 - go_left), f)

    recurse(0, _Path([], [], [], []), 1.0, np.ones(rows), -1)
    return phi


# A table has 2**features rows; paths that test more features take the recursion.
TABLE_FEATURES = 8


class LeafTables:
    """Contributions of every leaf of a tree for every pattern of features that a row agrees with."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self.nodes: list[int] = []      # inner nodes
        self.leaves: list[tuple[np.ndarray, list[list[tuple[int, bool]]], np.ndarray]] = []
        self._walk(0, {}, {})

    @staticmethod
    def fits(tree: Tree) -> bool:
        """Whether no path tests more than ``TABLE_FEATURES`` different features."""
        def deepest(j: int, seen: frozenset) -> int:
            if tree.left[j] < 0:
                return len(seen)
            now = seen | {int(tree.feature[j])}
            return max(deepest(int(tree.left[j]), now), deepest(int(tree.right[j]), now))

        return deepest(0, frozenset()) <= TABLE_FEATURES

    def _walk(self, j: int, share: dict[int, float], tests: dict[int, list[tuple[int, bool]]]) -> None:
        t = self.tree
        if t.left[j] < 0:
            if share:
                names = sorted(share)
                cold = np.array([share[f] for f in names])
                self.leaves.append((np.array(names), [tests[f] for f in names], t.value[j] * pattern_weights(cold)))
            return
        f, at = int(t.feature[j]), len(self.nodes)
        self.nodes.append(j)
        for child, left in ((int(t.left[j]), True), (int(t.right[j]), False)):
            part = t.cover[child] / t.cover[j] if t.cover[j] else 0.0
            self._walk(child, share | {f: share.get(f, 1.0) * part}, tests | {f: [*tests.get(f, []), (at, left)]})

    def add(self, x: np.ndarray, phi: np.ndarray, weight: float) -> None:
        """Add ``weight`` times the contributions of every row of ``x`` to ``phi``."""
        if not self.nodes:
            return
        left = x[:, self.tree.feature[self.nodes]] <= self.tree.threshold[self.nodes]
        for names, tests, table in self.leaves:
            pattern = np.zeros(len(x), dtype=np.int64)
            for i, test in enumerate(tests):
                agrees = left[:, test[0][0]] == test[0][1]
                for at, side in test[1:]:
                    agrees = agrees & (left[:, at] == side)
                pattern |= agrees.astype(np.int64) << i
            phi[:, names] += weight * table[pattern]


def pattern_weights(cold: np.ndarray) -> np.ndarray:
    """(2**n x n): Shapley values of the game prod_i (agrees_i if known else cold_i) for every pattern of agreement.

    Joining the known features, i changes the product by (agrees_i - cold_i);
    orders are counted by a polynomial in the number of other known features:
    sum over subsets S of |S|! (n - 1 - |S|)! / n! times the product.
    """
    n = len(cold)
    agrees = (np.arange(1 << n)[:, None] >> np.arange(n) & 1).astype(float)
    out = np.zeros((1 << n, n))
    order = np.array([math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) for k in range(n)])
    for i in range(n):
        by_size = np.zeros((1 << n, n))  # coefficient k: products over the other features with k of them known
        by_size[:, 0] = 1.0
        for j in range(n):
            if j != i:
                known = np.zeros_like(by_size)
                known[:, 1:] = by_size[:, :-1] * agrees[:, j:j + 1]
                by_size = by_size * cold[j] + known
        out[:, i] = (by_size @ order) * (agrees[:, i] - cold[i])
    return out


def ensemble_shap(trees: list[Tree], x: np.ndarray, scale: float = 2.0) -> tuple[np.ndarray, float]:
    """Log-odds contributions of a GBT ensemble and its base value."""
    phi = np.zeros(x.shape)
    base = 0.0
    for t in trees:
        if LeafTables.fits(t):
            tables(t).add(x, phi, t.weight)
        else:
            phi += t.weight * tree_shap(t, x)
        base += t.weight * t.expected_value()
    return scale * phi, scale * base


def tables(tree: Tree) -> LeafTables:
    """The tree's tables, made once and kept with it."""
    if tree.made is None:
        tree.made = LeafTables(tree)
    return tree.made
