"""Gradient-boosted trees on histograms, fitted in numpy on a bounded table or level by level on a table of any size, and
kept as flat arrays."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sums of a distributed histogram are whole numbers of this part of one, so they don't depend on the order of rows.
UNIT = 1 << 30


@dataclass
class Trees:
    """Complete binary trees of one depth. Inner nodes of a tree lie level by level: below node i are 2i+1 and 2i+2, and
    a row goes right if its feature is above the threshold. Leaves follow in order; `start` is added to their sum."""

    depth: int
    start: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row; all rows step down a tree together."""
        total = np.full(len(rows), self.start)
        at, inner = np.arange(len(rows)), 2**self.depth - 1
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (rows[at, feature[node]] > threshold[node])
            total += value[node - inner]
        return total

    def sql(self, features: str) -> str:
        """Log odds as an SQL expression over an array of features, added up in the order that `raw` takes."""

        def node(tree: int, at: int) -> str:
            inner = 2**self.depth - 1
            if at >= inner:
                return repr(float(self.value[tree, at - inner])) + "D"
            limit = self.threshold[tree, at]
            if not np.isfinite(limit):
                return node(tree, 2 * at + 1)
            right, left = node(tree, 2 * at + 2), node(tree, 2 * at + 1)
            return left if left == right else f"if({features}[{self.feature[tree, at]}] > {float(limit)!r}D, {right}, {left})"

        return " + ".join([f"{self.start!r}D", *(node(t, 0) for t in range(len(self.feature)))])

    def predict(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(rows)))


def blank(share: float, trees: int, depth: int) -> Trees:
    """Trees that predict a share."""
    inner = 2**depth - 1
    return Trees(depth, float(np.log(share / (1 - share))), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))


def chosen(pull: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], l2: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The feature and the place among its cuts by which each node is split, the place -1 if no split helps, from the
    histograms of a level: features x nodes x bins."""
    nodes = np.arange(pull.shape[1])
    best, feature, place = np.zeros(len(nodes)), np.zeros(len(nodes), np.int64), np.full(len(nodes), -1)
    for f, limits in enumerate(cuts):
        if not len(limits):
            continue
        gl, hl = pull[f].cumsum(axis=1), weight[f].cumsum(axis=1)
        g, h = gl[:, -1:], hl[:, -1:]
        gain = gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2)
        gain[(hl < least) | (h - hl < least)] = 0
        cut = gain[:, : len(limits)].argmax(axis=1)
        found = gain[nodes, cut]
        better = found > best + 1e-9
        best[better], feature[better], place[better] = found[better], f, cut[better]
    return feature, place


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Trees:
    """Trees for labels 0 and 1. Without rows they predict one half, and with one label, or no split that helps, the
    smoothed share of ones."""
    count, width = rows.shape
    model = blank((labels.sum() + 0.5) / (count + 1), trees, depth)
    if not 0 < labels.sum() < count:
        return model
    inner = 2**depth - 1
    cuts = [np.unique(np.quantile(rows[:, f], np.arange(1, bins) / bins, method="lower")) for f in range(width)]
    codes = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(width)], axis=1)
    raw, at = np.full(count, model.start), np.arange(count)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-raw))
        sides = labels - chance, chance * (1 - chance)
        node, split = np.zeros(count, np.int64), np.full(inner, bins)
        for level in range(depth):
            first, size = 2**level - 1, 2**level
            places = [(node - first) * bins + codes[:, f] for f in range(width)]
            pull, weight = (np.stack([np.bincount(place, w, size * bins).reshape(size, bins) for place in places]) for w in sides)
            feature, place = chosen(pull, weight, cuts, l2, least)
            for n in np.flatnonzero(place >= 0):
                model.feature[tree, first + n], model.threshold[tree, first + n], split[first + n] = feature[n], cuts[feature[n]][place[n]], place[n]
            node = 2 * node + 1 + (codes[at, model.feature[tree, node]] > split[node])
        leaf = node - inner
        g, h = (np.bincount(leaf, w, inner + 1) for w in sides)
        model.value[tree] = rate * g / (h + l2)
        raw += model.value[tree][leaf]
    return model


def fit_table(
    rows: DataFrame, kept: Callable[[DataFrame, str], DataFrame], trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 1.0
) -> Trees:
    """What `fit` does, on all rows of a table: features (an array of doubles), label, and times, how often a row counts.

    The driver gets histograms only: of values to find the cuts (as many rows as the features have values), then of each
    level of a tree, features x nodes x bins. `kept` writes a table under a name and reads it back; the log odds of all rows
    are written after each tree, in two places in turn.
    """
    total = rows.agg(F.sum("times").alias("all"), F.sum(F.col("times") * F.col("label")).alias("ones")).first()
    count, ones = total["all"] or 0, total["ones"] or 0
    model = blank((ones + 0.5) / (count + 1), trees, depth)
    if not 0 < ones < count:
        return model
    inner = 2**depth - 1
    counted = rows.select("times", F.posexplode("features").alias("f", "value")).groupBy("f", "value").agg(F.sum("times").alias("n")).collect()
    width = 1 + max(r.f for r in counted)
    wanted = np.floor((count - 1) * (np.arange(1, bins) / bins)).astype(np.int64)
    cuts = []
    for f in range(width):
        values, times = np.array(sorted((r.value, r.n) for r in counted if r.f == f)).T
        cuts.append(np.unique(values[np.searchsorted(times.cumsum(), wanted, side="right")]))
    code = lambda f: F.size(F.filter(F.lit(cuts[f].tolist()), lambda cut: cut < F.col("features")[f]))
    codes = F.array(*[code(f).cast("tinyint") for f in range(width)])
    table = kept(rows.select(codes.alias("codes"), "label", "times", F.lit(model.start).alias("raw")), "odds-0")
    whole = lambda x: F.round(x * F.col("times") * UNIT).cast("long")
    chance = 1 / (1 + F.exp(-F.col("raw")))
    for tree in range(trees):
        split = np.full(inner, -1)

        def walk(at: int, end: int, leaf: Callable[[int], str], tree=tree, split=split) -> str:
            if at >= end:
                return leaf(at)
            left = walk(2 * at + 1, end, leaf)
            return left if split[at] < 0 else f"if(codes[{model.feature[tree, at]}] > {split[at]}, {walk(2 * at + 2, end, leaf)}, {left})"

        for level in range(depth):
            first, size = 2**level - 1, 2**level
            sides = [whole(F.col("label") - chance).alias("pull"), whole(chance * (1 - chance)).alias("weight")]
            placed = table.select(F.expr(walk(0, first, lambda at: str(at))).alias("node"), *sides, F.posexplode("codes").alias("f", "code"))
            pull, weight = np.zeros((2, width, size, bins))
            for r in placed.groupBy("node", "f", "code").agg(F.sum("pull").alias("pull"), F.sum("weight").alias("weight")).collect():
                place = r.f, r.node - first, r.code
                pull[place], weight[place] = r.pull / UNIT, r.weight / UNIT
            feature, place = chosen(pull, weight, cuts, l2, least)
            for n in np.flatnonzero(place >= 0):
                model.feature[tree, first + n], model.threshold[tree, first + n], split[first + n] = feature[n], cuts[feature[n]][place[n]], place[n]
        # the leaves' sums are those beside the cuts of the last level; without a cut all rows go left
        for n in range(size):
            ends = place[n] + 1 if place[n] >= 0 else bins
            for side, part in enumerate((slice(0, ends), slice(ends, bins))):
                g, h = (x[feature[n], n, part].sum() for x in (pull, weight))
                model.value[tree, 2 * n + side] = rate * g / (h + l2)
        step = walk(0, inner, lambda at, tree=tree: repr(float(model.value[tree, at - inner])) + "D")
        table = kept(table.withColumn("raw", F.col("raw") + F.expr(step)), f"odds-{(tree + 1) % 2}")
    return model
