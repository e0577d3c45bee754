"""Gradient-boosted trees for a yes/no label, grown from histograms: sums a node, feature and bin over rows that may be anywhere."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)  # go left if the value is at most this
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, x in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(x)
        return len(self.value) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf(x)]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The node without children that each row comes to."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), dtype=np.int64)
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = np.where(x[rows, feature[node]] <= cut[node], left[node], right[node])
        return at


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Boosted:
    base: float
    rate: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


#: Gradients and weights are summed as whole multiples of 1 / SCALE, so that sums do not depend on the order of the rows.
SCALE = float(1 << 24)
#: Cuts tried a feature; a value's bin is the number of cuts below it.
CUTS = 32


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of each value: value <= cuts[k] is bin <= k."""
    return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def histograms(b: np.ndarray, n: np.ndarray, right: np.ndarray, margin: np.ndarray, tree: Tree, nodes: list[int]) -> np.ndarray:
    """[what, node, feature, bin] as integers: gradients, weights and examples of rows of bins, each of n examples of which so many
    are right, in the given nodes of a tree that grows."""
    p = sigmoid(margin)
    gradient, weight = np.rint((right - n * p) * SCALE), np.rint(n * p * (1 - p) * SCALE)
    place = np.full(len(tree.value), -1)
    place[nodes] = np.arange(len(nodes))
    place = place[tree.leaf(b)]
    on = place >= 0
    features, size = b.shape[1], len(nodes) * b.shape[1] * (CUTS + 1)
    cell = ((place[on, None] * features + np.arange(features)) * (CUTS + 1) + b[on]).ravel()
    out = [np.bincount(cell, np.repeat(values[on], features), size) for values in (gradient, weight, n.astype(np.float64))]
    return np.rint(out).astype(np.int64).reshape(3, len(nodes), features, CUTS + 1)


def grown(start: dict[str, tuple[int, int]], measure, trees: int = 30, depth: int = 3, rate: float = 0.3, least: int = 5, ridge: float = 1.0) -> dict[str, Boosted]:
    """Boost trees of second-order gain on the logistic loss, for some kinds side by side, each with `start` examples of which so
    many are right. measure(models, trees, nodes) gives the histograms of each kind that has nodes. Cuts are numbers of bins."""
    models = {}
    for kind, (n, right) in start.items():
        share = np.clip(right / n if n else 0.5, 1e-3, 1 - 1e-3)
        models[kind] = Boosted(float(np.log(share / (1 - share))), rate, [])
    for _ in range(trees):
        new = {kind: Tree() for kind, (n, _) in start.items() if n}
        nodes = {kind: [tree.add(0.0)] for kind, tree in new.items()}
        for level in range(depth):
            if not nodes:
                break
            found, inner = measure(models, new, nodes), {}
            for kind, tree in new.items():
                for node, sums in zip(nodes.get(kind, []), found[kind].swapaxes(0, 1) if kind in nodes else []):
                    g, h, n = sums[:, 0].sum(axis=-1)
                    g, h = g / SCALE, h / SCALE
                    tree.value[node] = float(g / (h + ridge))
                    gs, hs, ns = sums.cumsum(axis=-1)[..., :-1]
                    gs, hs = gs / SCALE, hs / SCALE
                    gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
                    gain[(ns < least) | (n - ns < least)] = 0
                    f, k = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[f, k] > 1e-6:
                        tree.feature[node], tree.cut[node] = int(f), int(k)
                        tree.left[node] = tree.add(float(gs[f, k] / (hs[f, k] + ridge)))
                        tree.right[node] = tree.add(float((g - gs[f, k]) / (h - hs[f, k] + ridge)))
                        inner.setdefault(kind, []).extend([tree.left[node], tree.right[node]])
            nodes = inner
        for kind, tree in new.items():
            models[kind].trees.append(tree)
    return models


def measured(rows: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """The measure for rows that are here: bins, examples and right ones of each kind."""
    margins, done = {}, {}

    def measure(models, trees, nodes):
        out = {}
        for kind in nodes:
            b, n, right = rows[kind]
            margin = margins.setdefault(kind, np.full(len(b), models[kind].base))
            for tree in models[kind].trees[done.get(kind, 0) :]:
                margin += models[kind].rate * tree.predict(b)
            done[kind] = len(models[kind].trees)
            out[kind] = histograms(b, n, right, margin, trees[kind], nodes[kind])
        return out

    return measure


def valued(model: Boosted, cuts: list[np.ndarray]) -> Boosted:
    """The model of values instead of bins."""
    at = lambda t: [float(cuts[f][k]) if f >= 0 else 0.0 for f, k in zip(t.feature, t.cut)]
    return Boosted(model.base, model.rate, [Tree(t.feature, at(t), t.left, t.right, t.value) for t in model.trees])


def fit(x: np.ndarray, y: np.ndarray, **settings) -> Boosted:
    """Boosted trees of examples that are here. Cuts are tried at every distinct value, at most 32 a feature."""
    if not len(y):
        return grown({"": (0, 0)}, None, **settings)[""]
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[:-1], method="lower")) for f in range(x.shape[1])]
    rows = {"": (binned(x, cuts), np.ones(len(y), np.int64), np.asarray(y))}
    return valued(grown({"": (len(y), int(np.sum(y)))}, measured(rows), **settings)[""], cuts)
