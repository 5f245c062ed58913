"""Ranking quality, listwise losses, lambda gradients and rankers.

A query may hold a large part of all rows: ranks and running sums come from the
distributed prefix, @k metrics from a row-number limit that Spark applies before the
shuffle, and pair sums from running counts or from blocks evaluated inside tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import hash_order, uniform
from tessera.plans.prefix import blocks, cut_lineage, join_on_keys, prefix


def gain(y: Column, scheme: str = "const") -> Column:
    if scheme == "exp2":
        return F.pow(F.lit(2.0), y) - 1
    if scheme == "const":
        return y.cast("double")
    raise ValueError(f"unknown gain scheme {scheme!r}")


def _positions(df: DataFrame, query: str, id_col: str, by: str, k: int | None, name: str = "rank") -> DataFrame:
    """Ranks by ``by`` descending; with k only the first k rows of each query are kept.

    Up to 1000 rows Spark drops the others before the shuffle; more of a query may be too
    many for one task and are ranked in range partitions.
    """
    order = [F.col(by).desc(), F.col(id_col)]
    if k is None or k > 1000:
        ranked = prefix(df, [query], order, pos=name)
        return ranked if k is None else ranked.where(F.col(name) <= k)
    w = Window.partitionBy(query).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def dcg(df: DataFrame, query: str, id_col: str, y: str, score: str, k: int | None = None, scheme="const", name="dcg") -> DataFrame:
    ranked = _positions(df.select(query, id_col, *{y, score}), query, id_col, score, k)
    value = F.sum(gain(F.col(y), scheme) / F.log2(F.col("rank") + F.lit(1.0)))
    return ranked.groupBy(query).agg(value.alias(name))


def ndcg(df: DataFrame, query: str, id_col: str, y: str, score: str, k: int | None = None, scheme="const") -> DataFrame:
    """nDCG per query, 0 where the ideal is 0."""
    got = dcg(df, query, id_col, y, score, k, scheme, "dcg")
    best = dcg(df, query, id_col, y, y, k, scheme, "ideal")
    return join_on_keys(got, best, [query]).withColumn(
        "ndcg", F.coalesce(F.col("dcg") / F.nullif(F.col("ideal"), F.lit(0.0)), F.lit(0.0))
    )


def swapped_pairs(df: DataFrame, query: str, y: str, score: str) -> DataFrame:
    """Pairs with a higher label but a lower score, per query, without forming pairs.

    Labels get dense codes; two codes differ first at exactly one bit, so the pairs are
    counted bit by bit: within rows that share the higher bits, in score order, each row
    with bit 0 meets the earlier rows with bit 1.
    """
    codes = prefix(df.select(query, y).distinct(), [query], [y], pos="_code")
    top = codes.agg(F.max("_code")).first()[0] or 1
    levels = max(1, int(top - 1).bit_length())
    cells = join_on_keys(
        df.groupBy(query, y, score).agg(F.count(F.lit(1)).alias("_n")), codes, [query, y]
    ).withColumn("_code", F.col("_code") - 1)
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_level")
    spread = cells.select(query, score, "_n", "_code", level)
    bit = F.expr("shiftright(_code, _level) & 1")
    per = (
        spread.withColumn("_high", F.expr("shiftright(_code, _level + 1)"))
        .groupBy(query, "_level", "_high", score)
        .agg(F.sum(F.when(bit == 1, F.col("_n")).otherwise(0)).alias("_ones"), F.sum(F.when(bit == 0, F.col("_n")).otherwise(0)).alias("_zeros"))
    )
    run = prefix(per, [query, "_level", "_high"], [score], sums={"_upto": F.col("_ones")}, pos=None)
    return run.groupBy(query).agg(F.sum(F.col("_zeros") * (F.col("_upto") - F.col("_ones"))).alias("swapped"))


def precision_at_k(df: DataFrame, query: str, id_col: str, y: str, score: str, k: int) -> DataFrame:
    """``precision`` over the k retrieved, and ``capped``: divided by min(k retrieved, all relevant).

    Relevant means a label of 1; a query without relevant rows gets -1 in ``capped``.
    """
    ranked = _positions(df.select(query, id_col, y, score), query, id_col, score, k)
    hits = ranked.groupBy(query).agg(F.count_if(F.col(y) == 1).alias("hits"), F.count(F.lit(1)).alias("got"))
    total = df.groupBy(query).agg(F.sum(y).alias("relevant"))
    capped = F.col("hits") / F.least(F.col("got"), F.col("relevant"))
    return join_on_keys(hits, total, [query]).select(
        query,
        (F.col("hits") / F.col("got")).alias("precision"),
        F.when(F.col("relevant") == 0, F.lit(-1.0)).otherwise(capped).alias("capped"),
    )


def full_list_metrics(
    df: DataFrame, query: str, id_col: str, y: str, score: str, p_break: float = 0.15
) -> DataFrame:
    """reciprocal_rank, p_found and average_precision per query from one ranking.

    ``p_found`` reads the label as a probability in [0, 1]; the running product of its
    complements is a running sum of logarithms with certain hits counted apart.
    """
    label = F.col(y).cast("double")
    sure = (label >= 1).cast("int")
    run = prefix(
        df.select(query, id_col, y, score),
        [query],
        [F.col(score).desc(), id_col],
        sums={
            "_rel": (label == 1).cast("int"),
            "_sure": sure,
            "_log": F.when(label < 1, F.log1p(-label)).otherwise(F.lit(0.0)),
        },
        pos="rank",
    )
    before_sure = F.col("_sure") - sure
    before_log = F.col("_log") - F.when(label < 1, F.log1p(-label)).otherwise(F.lit(0.0))
    look = F.when(before_sure > 0, F.lit(0.0)).otherwise(
        F.exp(before_log) * F.pow(F.lit(1 - p_break), F.col("rank") - 1)
    )
    top = F.max(F.struct(F.col(y), (-F.col("rank")).alias("r")))
    out = run.groupBy(query).agg(
        (1 / -top["r"].cast("double")).alias("reciprocal_rank"),
        F.sum(look * label).alias("p_found"),
        F.sum(F.when(label == 1, F.col("_rel") / F.col("rank"))).alias("_hits"),
        F.sum(label).alias("_n"),
    )
    ap = F.when(F.col("_n") == 0, F.lit(-1.0)).otherwise(F.coalesce(F.col("_hits"), F.lit(0.0)) / F.col("_n"))
    return out.withColumn("average_precision", ap).drop("_hits", "_n")


def listwise_losses(df: DataFrame, query: str, y: str, score: str) -> DataFrame:
    """Softmax cross-entropy and KL divergence of scores against labels per query."""
    tops = df.groupBy(query).agg(F.max(y).alias("_my"), F.max(score).alias("_ms"))
    yy, ss = F.col(y) - F.col("_my"), F.col(score) - F.col("_ms")
    sums = join_on_keys(df.select(query, y, score), tops, [query]).groupBy(query).agg(
        F.sum(F.exp(yy)).alias("zy"),
        F.sum(F.exp(ss)).alias("zs"),
        F.sum(F.exp(yy) * ss).alias("cross"),
        F.sum(F.exp(yy) * yy).alias("own"),
    )
    ce = F.ln("zs") - F.col("cross") / F.col("zy")
    entropy = F.ln("zy") - F.col("own") / F.col("zy")
    return sums.select(query, ce.alias("cross_entropy"), (ce - entropy).alias("kl"))


def pair_label_sums(df: DataFrame, query: str, id_col: str, y: str) -> DataFrame:
    """Per row: how many rows of its query have a lower, equal and higher label, and the summed
    gain and rank-discount differences. Comes from label counts, so no pairs are formed."""
    grades = df.groupBy(query, y).agg(F.count(F.lit(1)).alias("_c"))
    run = prefix(
        grades, [query], [y], sums={"_n": F.col("_c"), "_g": F.col("_c") * F.pow(F.lit(2.0), F.col(y))}, pos=None, totals=True
    )
    ranked = prefix(
        df.select(query, id_col, y), [query], [F.col(y).desc(), id_col], pos="_r"
    ).withColumn("_d", 1 / F.log2(F.col("_r") + F.lit(1.0)))
    decay = ranked.groupBy(query).agg(F.sum("_d").alias("_dsum"))
    joined = join_on_keys(join_on_keys(ranked, run, [query, y]), decay, [query])
    total = F.col("_n_total")
    return joined.select(
        query,
        id_col,
        (F.col("_n") - F.col("_c")).alias("n_lower"),
        F.col("_c").alias("n_equal"),
        (total - F.col("_n")).alias("n_higher"),
        (total * F.pow(F.lit(2.0), F.col(y)) - F.col("_g_total")).alias("gain_diff"),
        (total * F.col("_d") - F.col("_dsum")).alias("decay_diff"),
    )


#: blocks on a side of the square of block pairs that one task takes at a time
TILE = 8


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _lambda_block(
    y: pd.Series, s: pd.Series, r: pd.Series, y2: pd.Series, s2: pd.Series, r2: pd.Series
) -> pd.Series:
    """Lambda sums of the left rows against one block of right rows of the same query."""
    out = []
    for a, b, c, d, e, f in zip(y, s, r, y2, s2, r2):
        rel = np.sign(np.subtract.outer(a, d))
        gains = np.subtract.outer(np.exp2(a), np.exp2(d))
        decay = np.subtract.outer(1 / np.log2(c + 1.0), 1 / np.log2(f + 1.0))
        step = 0.5 * (1 - rel) - 1 / (1 + np.exp(np.subtract.outer(b, e)))
        out.append((step * np.abs(gains * decay)).sum(axis=1))
    return pd.Series(out)


def lambdas(
    df: DataFrame, query: str, id_col: str, y: str, score: str, k: int | None = None, block: int = 1024, name="lambda"
) -> DataFrame:
    """Lambda gradient of every row.

    The sum over the other rows of the query needs every score difference. Rows are packed
    into blocks of bounded size, blocks of the same query meet, and a task returns one sum
    per row: pairs of rows exist only as numpy matrices of block size. Blocks meet under the
    query and the tile of the pair, at most ``TILE`` by ``TILE`` blocks, so that a query of
    any size is spread over all tasks.
    """
    ranked = prefix(df.select(query, id_col, y, score), [query], [F.col(y).desc(), id_col], pos="_r")
    discount = gain(F.col(y), "exp2") / F.log2(F.col("_r") + F.lit(1.0))
    counted = discount if k is None else F.when(F.col("_r") <= k, discount).otherwise(0.0)
    ideal = ranked.groupBy(query).agg(F.sum(counted).alias("_ideal"))
    packed = (
        ranked.withColumn("_b", F.floor((F.col("_r") - 1) / block))
        .groupBy(query, "_b")
        # at most ``block`` rows per list
        .agg(F.collect_list(F.struct(id_col, F.col(y).cast("double").alias("y"), F.col(score).cast("double").alias("s"), F.col("_r").cast("double").alias("r"))).alias("rows"))
    )
    column = lambda rows, c: F.transform(F.col(rows), lambda x: x[c])
    tiles = ranked.groupBy(query).agg(F.floor((F.max("_r") - 1) / (block * TILE)).alias("_tiles"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), "_tiles"))
    own = F.floor(F.col("_b") / TILE)
    tiled = join_on_keys(packed, tiles, [query])
    left = tiled.select(query, "rows", own.alias("_t1"), every.alias("_t2"))
    right = tiled.select(F.col(query).alias("_q"), F.col("rows").alias("rows2"), every.alias("_u1"), own.alias("_u2"))
    same = F.col(query).eqNullSafe(F.col("_q")) & (F.col("_t1") == F.col("_u1")) & (F.col("_t2") == F.col("_u2"))
    sums = (
        left.join(right, same)
        .withColumn("_sum", _lambda_block(*[column(rows, c) for rows in ("rows", "rows2") for c in ("y", "s", "r")]))
        .select(query, F.explode(F.arrays_zip(column("rows", id_col).alias("id"), F.col("_sum").alias("v"))).alias("z"))
        .groupBy(query, F.col("z.id").alias(id_col))
        .agg(F.sum("z.v").alias("_v"))
    )
    scale = F.when(F.col("_ideal") > 0, 1 / F.col("_ideal")).otherwise(F.lit(0.0))
    return join_on_keys(sums, ideal, [query]).select(query, id_col, (F.col("_v") * scale).alias(name))


class LambdaMart:
    """Boosted regression trees on lambda gradients, cut at the best validation round."""

    def __init__(self, features, query, id_col, y, n_trees=10, lr=0.5, depth=3, rows=0.8, columns=0.8, k=10, seed=0):
        self.features, self.query, self.id_col, self.y = list(features), query, id_col, y
        self.n_trees, self.lr, self.depth, self.rows, self.columns, self.k, self.seed = n_trees, lr, depth, rows, columns, k, seed

    def _columns(self, i: int) -> list[str]:
        import hashlib

        n = max(1, round(self.columns * len(self.features)))
        return sorted(self.features, key=lambda f: hashlib.md5(f"{self.seed}_{i}_{f}".encode()).hexdigest())[:n]

    def _step(self, df: DataFrame, used: Sequence[str], tree) -> DataFrame:
        x = VectorAssembler(inputCols=list(used), outputCol="_x").transform(df)
        return tree.transform(x).withColumn("score", F.col("score") + self.lr * F.col("_p")).drop("_x", "_p")

    def fit(self, train: DataFrame, valid: DataFrame) -> "LambdaMart":
        keep = [self.query, self.id_col, self.y, *self.features]
        train = cut_lineage(train.select(*keep).withColumn("score", F.lit(0.0)))
        valid = cut_lineage(valid.select(*keep).withColumn("score", F.lit(0.0)))
        self.trees, self.rounds = [], []
        for i in range(self.n_trees):
            grad = lambdas(train, self.query, self.id_col, self.y, "score", self.k)
            rows = train.join(grad, [self.query, self.id_col]).where(
                uniform(F.col(self.id_col), self.seed, i) < self.rows
            )
            used = self._columns(i)
            x = VectorAssembler(inputCols=used, outputCol="_x").transform(rows.withColumn("_t", -F.col("lambda")))
            tree = DecisionTreeRegressor(
                featuresCol="_x", labelCol="_t", predictionCol="_p", maxDepth=self.depth, seed=self.seed
            ).fit(x)
            self.trees.append((used, tree))
            # scores are written down each round, so plans do not grow with the trees
            train = cut_lineage(self._step(train, used, tree))
            valid = cut_lineage(self._step(valid, used, tree))
            quality = ndcg(valid, self.query, self.id_col, self.y, "score", self.k, "exp2")
            self.rounds.append(quality.agg(F.avg("ndcg")).first()[0])
        best = int(np.argmax(self.rounds)) + 1
        self.trees = self.trees[:best]
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        df = df.withColumn("score", F.lit(0.0))
        for used, tree in self.trees:
            df = self._step(df, used, tree)
        return df


def neighbour_pairs(
    df: DataFrame, query: str, id_col: str, y: str, columns: Sequence[str], partners: int = 4, seed: int = 0
) -> DataFrame:
    """Training pairs of a query: each row with the next rows in hash order that differ in label.

    Returns column differences (higher label first or second) and ``target``.
    """
    shuffled = df.select(query, id_col, y, *columns).withColumn("_h", hash_order(F.col(id_col), seed))
    cut = blocks(shuffled, [query], ["_h", id_col], halo=partners)
    w = Window.partitionBy(query, "block").orderBy("pos")
    row = F.struct(y, *columns)
    ahead = F.filter(F.array(*[F.lag(row, i).over(w) for i in range(1, partners + 1)]), lambda x: x.isNotNull())
    pairs = cut.withColumn("_other", ahead).where("own").select("*", F.explode("_other").alias("o")).where(F.col(y) != F.col(f"o.{y}"))
    return pairs.select(
        query,
        *[(F.col(c) - F.col(f"o.{c}")).alias(c) for c in columns],
        (F.col(y) > F.col(f"o.{y}")).cast("double").alias("target"),
    )


def fit_linear_ranker(
    df: DataFrame, query: str, id_col: str, y: str, features: Sequence[str], partners: int = 4, seed: int = 0
) -> list[float]:
    """Weights of a linear pairwise ranker: logistic regression on feature differences."""
    pairs = neighbour_pairs(df, query, id_col, y, features, partners, seed)
    x = VectorAssembler(inputCols=list(features), outputCol="_x").transform(pairs)
    model = LogisticRegression(featuresCol="_x", labelCol="target", fitIntercept=False, maxIter=20).fit(x)
    return [float(v) for v in model.coefficients]


def linear_score(features: Sequence[str], weights: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for f, w in zip(features, weights):
        total = total + F.col(f) * F.lit(w)
    return total
