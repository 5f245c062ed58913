"""Uplift trees and forests grown level by level with grouped aggregates.

Rows are never collected: one aggregate per level gives the counts and outcome sums on
both sides of every candidate split, and only the best split per node (at most 2**depth
rows) reaches the driver. The next level's node number is a CASE expression. A forest counts
quantised features instead, for all its trees at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import poisson1, uniform
from tessera.plans.prefix import cut_lineage, quantiles_of_counts
from tessera.operators.uplift import effect

# Percentiles tried as split thresholds for many and for few distinct values.
MANY = [3, 5, 10, 20, 30, 50, 70, 80, 90, 95, 97]
FEW = [10, 50, 90]


@dataclass(frozen=True)
class Limits:
    """When a node may split: depth, and rows, treated and controls on both sides."""

    max_depth: int = 3
    min_leaf: int = 1000
    min_treated: int = 300
    min_control: int = 300


@dataclass
class Tree:
    """Splits by node number (children 2i+1 and 2i+2) and the effect at every node."""

    splits: dict[int, tuple[str, float]] = field(default_factory=dict)
    nodes: dict[int, dict] = field(default_factory=dict)

    def node_column(self, node: int = 0) -> Column:
        if node not in self.splits:
            return F.lit(node)
        feature, threshold = self.splits[node]
        left, right = self.node_column(2 * node + 1), self.node_column(2 * node + 2)
        return F.when(F.col(feature) <= F.lit(threshold), left).otherwise(right)

    def predict_column(self, node: int = 0) -> Column:
        if node not in self.splits:
            return F.lit(self.nodes[node]["ate"])
        feature, threshold = self.splits[node]
        left, right = self.predict_column(2 * node + 1), self.predict_column(2 * node + 2)
        return F.when(F.col(feature) <= F.lit(threshold), left).otherwise(right)

    def table(self, spark) -> DataFrame:
        rows = [
            (n, *self.splits.get(n, (None, None)), v["n"], v["n_t"], v["n_c"], v["ate"]) for n, v in sorted(self.nodes.items())
        ]
        return spark.createDataFrame(
            rows, "node int, feature string, threshold double, n bigint, n_t bigint, n_c bigint, ate double"
        )

    @staticmethod
    def from_table(table: DataFrame) -> "Tree":
        """Rebuild a saved tree (a table has one row per node)."""
        tree = Tree()
        for r in table.collect():
            tree.nodes[r["node"]] = {k: r[k] for k in ("n", "n_t", "n_c", "ate")}
            if r["feature"] is not None:
                tree.splits[r["node"]] = (r["feature"], r["threshold"])
        return tree


def _long(df: DataFrame, keep: Sequence[str], features: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        list(keep), list(features), "feature", "x"
    )


def threshold_lists(long: DataFrame, keys: Sequence[str], few_up_to: int = 10) -> DataFrame:
    """(keys, edges): ascending candidate thresholds without repeats per key."""
    counts = long.where(F.col("x").isNotNull()).groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n"))
    kinds = counts.groupBy(*keys).agg((F.count(F.lit(1)) <= few_up_to).alias("few"))
    # percentiles of the distinct values are percentiles with every count set to 1
    weighted = counts.join(kinds, list(keys)).withColumn("n", F.when(F.col("few"), 1).otherwise(F.col("n")))
    qs = quantiles_of_counts(weighted, keys, "x", "n", {f"p{p}": p / 100 for p in MANY}).join(kinds, list(keys))
    pick = lambda ps: F.array_sort(F.array_distinct(F.array(*[F.col(f"p{p}") for p in ps])))
    return qs.select(*keys, F.when(F.col("few"), pick(FEW)).otherwise(pick(MANY)).alias("edges"))


def thresholds(df: DataFrame, features: Sequence[str], few_up_to: int = 10) -> DataFrame:
    """Candidate split points per feature: (feature, threshold).

    Features with at most ``few_up_to`` distinct values use percentiles of the distinct
    values, others percentiles of all values.
    """
    lists = threshold_lists(_long(df, [], features), ["feature"], few_up_to)
    return lists.select("feature", F.explode("edges").alias("threshold"))


def split_gains(
    df: DataFrame, node: str, features: Sequence[str], w: str, y: str, limits: Limits, weight: str | None = None, edges: DataFrame | None = None
) -> DataFrame:
    """Every admissible split: (node, feature, threshold, n_left, n_right, tau_left, tau_right, gain).

    Rows are counted per interval between thresholds, so a row is touched once per feature
    whatever the number of thresholds.
    """
    keep = [node, w, y] + ([weight] if weight else [])
    long = _long(df, keep, features)
    keys = [node, "feature"]
    lists = threshold_lists(long, keys) if edges is None else edges
    on = [c for c in keys if c in lists.columns]
    c = F.col(weight) if weight else F.lit(1)
    treated = F.col(w) == 1
    # (nodes x features) short lists: Spark broadcasts them if they are small
    cells = (
        long.join(lists, on)
        .groupBy(*keys, F.size(F.filter("edges", lambda e: e < F.col("x"))).alias("cell"))
        .agg(
            F.sum(c).alias("n"),
            F.sum(F.when(treated, c).otherwise(0)).alias("nt"),
            F.sum(F.when(treated, c * F.col(y)).otherwise(0)).alias("yt"),
            F.sum(F.when(~treated, c * F.col(y)).otherwise(0)).alias("yc"),
        )
    )
    tried = cells.select(*keys).distinct().join(lists, on).select(*keys, F.posexplode("edges").alias("i", "threshold"))
    left = F.col("cell") <= F.col("i")
    sides = (
        tried.join(cells, keys)
        .groupBy(*keys, "i", "threshold")
        .agg(
            *[F.sum(F.when(left, F.col(s)).otherwise(0)).alias(f"l_{s}") for s in ("n", "nt", "yt", "yc")],
            *[F.sum(F.when(left, 0).otherwise(F.col(s))).alias(f"r_{s}") for s in ("n", "nt", "yt", "yc")],
        )
    )
    enough, tau = F.lit(True), {}
    for side in "lr":
        n, nt, nc = F.col(f"{side}_n"), F.col(f"{side}_nt"), F.col(f"{side}_n") - F.col(f"{side}_nt")
        enough = enough & (n >= limits.min_leaf) & (nt >= max(limits.min_treated, 1)) & (nc >= max(limits.min_control, 1))
        tau[side] = F.col(f"{side}_yt") / nt - F.col(f"{side}_yc") / nc
    return sides.where(enough).select(
        *keys,
        "threshold",
        F.col("l_n").alias("n_left"),
        F.col("r_n").alias("n_right"),
        tau["l"].alias("tau_left"),
        tau["r"].alias("tau_right"),
        F.abs(tau["l"] - tau["r"]).alias("gain"),
    )


def best_splits(gains: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Largest gain per key; on ties the earlier feature, then the lower threshold."""
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    order = F.struct(F.col("gain"), -place, -F.col("threshold"))
    best = F.max_by(F.struct("feature", "threshold", "gain"), order).alias("best")
    return gains.groupBy(*keys).agg(best).select(*keys, "best.*")


def node_effects(df: DataFrame, node: str, w: str, y: str) -> DataFrame:
    """Size and effect per node."""
    return df.groupBy(node).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(w) == 1).alias("n_t"),
        F.count_if(F.col(w) == 0).alias("n_c"),
        effect(F.col(y), F.col(w)).alias("ate"),
    )


def fit_tree(df: DataFrame, features: Sequence[str], w: str, y: str, limits: Limits = Limits()) -> Tree:
    """Grow one tree; every level reads the rows once from the written copy."""
    rows = cut_lineage(df.select(*[F.col(f).cast("double").alias(f) for f in features], w, y))
    tree, active = Tree(), [0]
    for depth in range(limits.max_depth + 1):
        level = rows.withColumn("_node", tree.node_column()).where(F.col("_node").isin(active))
        for r in node_effects(level, "_node", w, y).collect():
            tree.nodes[r["_node"]] = {k: r[k] for k in ("n", "n_t", "n_c", "ate")}
        if depth == limits.max_depth:
            break
        gains = split_gains(level, "_node", features, w, y, limits)
        found = best_splits(gains, ["_node"], features).collect()
        for r in found:
            tree.splits[r["_node"]] = (r["feature"], r["threshold"])
        active = [c for r in found for c in (2 * r["_node"] + 1, 2 * r["_node"] + 2)]
        if not active:
            break
    return tree


def predict(df: DataFrame, tree: Tree, name: str = "uplift") -> DataFrame:
    return df.withColumn(name, tree.predict_column())


@dataclass
class Forest:
    trees: list[Tree]

    def predict(self, df: DataFrame, name: str = "uplift") -> DataFrame:
        total = F.lit(0.0)
        for t in self.trees:
            total = total + t.predict_column()
        return df.withColumn(name, total / len(self.trees))


#: How good a split is: "delta" is the difference of the sides' effects, the others are divergences
#: of treated and control outcomes ("kl" and "chi" for outcomes from 0 to 1), summed over the sides.
CRITERIA = ("delta", "ed", "kl", "chi")


def _divergence(criterion: str, treated: np.ndarray, control: np.ndarray) -> np.ndarray:
    if criterion == "ed":
        return (treated - control) ** 2
    t, c = (np.clip(p, 1e-6, 1 - 1e-6) for p in (treated, control))
    if criterion == "kl":
        return t * np.log(t / c) + (1 - t) * np.log((1 - t) / (1 - c))
    return (t - c) ** 2 / c + (t - c) ** 2 / (1 - c)


def split_scores(bins: np.ndarray, limits: Limits, criterion: str, n_reg: float = 0.0) -> np.ndarray:
    """Score of a split after each bin but the last; -inf where a side is too small.

    ``bins`` holds rows, treated rows, and outcome sums of treated and controls for each bin of a
    feature. Outcomes of the sides are drawn to the node's by ``n_reg`` rows.
    """
    left = np.cumsum(bins, axis=0)[:-1]
    total = bins.sum(axis=0)
    sides, enough = [], np.ones(len(left), dtype=bool)
    node = (total[2] / max(total[1], 1), total[3] / max(total[0] - total[1], 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        for n, nt, yt, yc in (left.T, (total - left).T):
            enough &= (n >= limits.min_leaf) & (nt >= max(limits.min_treated, 1)) & (n - nt >= max(limits.min_control, 1))
            sides.append((n / total[0], (yt + node[0] * n_reg) / (nt + n_reg), (yc + node[1] * n_reg) / (n - nt + n_reg)))
        if criterion == "delta":
            (_, lt, lc), (_, rt, rc) = sides
            score = np.abs((lt - lc) - (rt - rc))
        else:
            score = sum(share * _divergence(criterion, t, c) for share, t, c in sides) - _divergence(criterion, *map(np.array, node))
    return np.where(enough, score, -np.inf)


@dataclass
class _Level:
    """What a task needs for one level: each tree's splits by bin, and the nodes whose bins it counts."""

    feature: np.ndarray  # tree x node, -1 without a split
    upto: np.ndarray
    slot: np.ndarray  # tree x node, -1 where nothing is counted

    def nodes(self, bins: np.ndarray, tree: int, depth: int) -> np.ndarray:
        node = np.zeros(len(bins), dtype=np.int64)
        for _ in range(depth):
            feature = self.feature[tree][node]
            right = bins[np.arange(len(bins)), np.maximum(feature, 0)] > self.upto[tree][node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node


@dataclass
class Quantised:
    """Features as bin numbers: ``rows`` (bins, draws, w, y, ...), and the thresholds between the bins."""

    rows: DataFrame
    features: list[str]
    edges: dict[str, list[float]]
    n_trees: int


def quantise(df: DataFrame, id_col: str, features: Sequence[str], w: str, y: str, n_trees: int, seed: int = 0, keep: Sequence[str] = ()) -> Quantised:
    """Cut features at the whole table's thresholds and write them, with each tree's draws of a row, once.

    A bin is the number of thresholds below the value; null lies above all. Rows without
    treatment or outcome are left out.
    """
    features = list(features)
    wide = df.select(*{id_col, w, y, *keep}, *[F.col(f).cast("double").alias(f) for f in features])
    lists = threshold_lists(_long(wide, [], features), ["feature"]).collect()  # a row for each feature
    edges = {f: [] for f in features} | {r["feature"]: [float(e) for e in r["edges"]] for r in lists}
    below = lambda f: sum(((F.lit(e) < F.col(f)).cast("int") for e in edges[f]), F.lit(0))
    bins = [F.when(F.col(f).isNull(), len(edges[f])).otherwise(below(f)).cast("smallint") for f in features]
    draws = [poisson1(uniform(F.col(id_col), seed, F.lit(i))).cast("smallint") for i in range(n_trees)]
    known = wide.where(F.col(w).isNotNull() & F.col(y).isNotNull()).select(
        F.array(*bins).alias("bins"), F.array(*draws).alias("draws"), F.col(w).cast("double").alias("w"), F.col(y).cast("double").alias("y"), *keep
    )
    return Quantised(cut_lineage(known), features, edges, n_trees)


def _histograms(rows: DataFrame, level: _Level, depth: int, slots: int, n_features: int, n_bins: int) -> np.ndarray:
    """(slot, feature, bin, 4): rows, treated rows and both arms' outcome sums of the counted nodes.

    Each task adds up its rows in an array of that size; only the sums are shuffled and
    collected, (trees x nodes x features x bins) rows whatever the table's size.
    """
    shared = rows.sparkSession.sparkContext.broadcast(level)
    size = slots * n_features * n_bins

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, size))
        for batch in batches:
            if not len(batch):
                continue
            bins, draws = np.stack(batch["bins"]).astype(np.int64), np.stack(batch["draws"]).astype(float)
            w, y = batch["w"].to_numpy() == 1, batch["y"].to_numpy()
            for tree in range(draws.shape[1]):
                slot = shared.value.slot[tree][shared.value.nodes(bins, tree, depth)]
                own = np.flatnonzero((slot >= 0) & (draws[:, tree] > 0))
                weight = draws[own, tree]
                parts = (weight, weight * w[own], weight * y[own] * w[own], weight * y[own] * ~w[own])
                for f in range(n_features):
                    cell = (slot[own] * n_features + f) * n_bins + bins[own, f]
                    for i, part in enumerate(parts):
                        total[i] += np.bincount(cell, weights=part, minlength=size)
        used = np.flatnonzero(total[0])
        yield pd.DataFrame({"cell": used, **{name: total[i][used] for i, name in enumerate(names)}})

    names = ["n", "nt", "yt", "yc"]
    counted = rows.mapInPandas(run, "cell bigint, n double, nt double, yt double, yc double")
    out = np.zeros((size, 4))
    for r in counted.groupBy("cell").agg(*[F.sum(n).alias(n) for n in names]).collect():
        out[r["cell"]] = [r[n] for n in names]
    return out.reshape(slots, n_features, n_bins, 4)


def fit_forest(
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    w: str,
    y: str,
    n_trees: int = 10,
    max_features: int | None = None,
    limits: Limits = Limits(),
    seed: int = 0,
    criterion: str = "delta",
    n_reg: float = 0.0,
) -> Forest:
    """Bagged trees: Poisson row weights, and a subset of ``max_features`` features for each node.

    Features are cut at the whole table's thresholds once and written as bin numbers. Each
    level is one pass over these for all trees, which adds up the bins of every node's smaller
    child; the other child is its parent less the smaller one. The driver holds the
    histograms of one level: trees x nodes x features x bins.
    """
    table = quantise(df, id_col, features, w, y, n_trees, seed)
    return grow_forest(table, table.rows, max_features, limits, seed, criterion, n_reg)


def grow_forest(
    table: Quantised, rows: DataFrame, max_features: int | None = None, limits: Limits = Limits(), seed: int = 0, criterion: str = "delta", n_reg: float = 0.0
) -> Forest:
    """:func:`fit_forest` on ``rows`` of a table that is cut already."""
    if criterion not in CRITERIA:
        raise ValueError(f"criterion must be one of {CRITERIA}")
    features, edges, n_trees = table.features, table.edges, table.n_trees
    k = max_features or len(features)
    rows = rows.select("bins", "draws", "w", "y")
    n_bins = max(map(len, edges.values())) + 1
    trees = [Tree() for _ in range(n_trees)]
    nodes = 2 ** (limits.max_depth + 1) - 1
    level = _Level(np.full((n_trees, nodes), -1), np.zeros((n_trees, nodes), dtype=np.int64), np.full((n_trees, nodes), -1))
    held: dict[tuple[int, int], np.ndarray] = {}
    counted = [(i, 0) for i in range(n_trees)]
    for depth in range(limits.max_depth + 1):
        level.slot[:] = -1
        for slot, (i, node) in enumerate(counted):
            level.slot[i, node] = slot
        bins = _histograms(rows, level, depth, len(counted), len(features), n_bins)
        parents, held = held, {}
        for slot, (i, node) in enumerate(counted):
            held[i, node] = bins[slot]
            if node:
                other = node + 1 if node % 2 else node - 1
                held[i, other] = parents[i, (node - 1) // 2] - bins[slot]
        counted = []
        for (i, node), own in sorted(held.items()):
            n, nt, yt, yc = own[0].sum(axis=0)
            trees[i].nodes[node] = {"n": round(n), "n_t": round(nt), "n_c": round(n - nt), "ate": yt / nt - yc / (n - nt) if nt and n > nt else None}
            if depth == limits.max_depth:
                continue
            best: tuple[float, int, int] | None = None
            for f in _subset(features, k, seed, i, node):
                at = features.index(f)
                scores = split_scores(own[at][: len(edges[f]) + 1], limits, criterion, n_reg)
                for upto, score in enumerate(scores):
                    if score > (best[0] + 1e-12 if best else -np.inf):
                        best = (score, at, upto)
            if best:
                _, at, upto = best
                level.feature[i, node], level.upto[i, node] = at, upto
                trees[i].splits[node] = (features[at], edges[features[at]][upto])
                left = own[at][: upto + 1, 0].sum()
                counted.append((i, 2 * node + (1 if left <= n - left else 2)))
        if not counted:
            break
    return Forest(trees)


def _subset(features: Sequence[str], k: int, seed: int, tree: int, node: int) -> list[str]:
    """k features of one node, chosen by hash order of their names; in the features' order."""
    if k >= len(features):
        return list(features)
    chosen = sorted(features, key=lambda f: hashlib.md5(f"{seed}_{tree}_{node}_{f}".encode()).hexdigest())[:k]
    return [f for f in features if f in chosen]
