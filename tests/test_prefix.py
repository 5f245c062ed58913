"""Distributed ranks, running values and quantiles equal the plain window, hot keys included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators.series import forward_fill_rows, previous, rolling
from tessera.plans.prefix import blocks, exact_quantiles, prefix


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    n = 4000
    keys = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 40, n)).astype(float)
    keys[rng.random(n) < 0.05] = np.nan
    value = np.round(rng.normal(size=n), 3)
    gaps = np.where(rng.random(n) < 0.7, np.nan, value)
    return pd.DataFrame({"k": keys, "t": rng.integers(0, 50, n), "id": np.arange(n), "v": value, "g": gaps})


@pytest.fixture(scope="module")
def df(spark, rows):
    clean = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in rows.itertuples(index=False)]
    return spark.createDataFrame([(None if k is None else int(k), int(t), int(i), v, g) for k, t, i, v, g in clean], "k int, t int, id int, v double, g double")


def expected(rows):
    s = rows.assign(kk=rows.k.fillna(-1)).sort_values(["kk", "t", "id"])
    g = s.groupby("kk")
    return s.assign(
        pos=g.cumcount() + 1, total=g["id"].transform("size"), run=g.v.cumsum(), best=g.v.cummax(), filled=g.g.ffill()
    ).set_index("id").sort_index()


def test_positions_sums_lasts_maxs(df, rows):
    out = prefix(
        df, ["k"], ["t", "id"], sums={"run": F.col("v")}, lasts={"filled": F.col("g")}, maxs={"best": F.col("v")}, totals=True
    ).toPandas().set_index("id").sort_index()
    want = expected(rows)
    assert len(out) == len(rows)
    assert (out.pos == want.pos).all() and (out.pos_total == want.total).all()
    np.testing.assert_allclose(out.run, want.run, atol=1e-9)
    np.testing.assert_allclose(out.best, want.best)
    np.testing.assert_allclose(out.filled.astype(float), want.filled, equal_nan=True)


def test_no_keys_and_descending(df, rows):
    out = prefix(df, [], [F.col("v").desc(), "id"], pos="r").toPandas().set_index("id").sort_index()
    order = rows.sort_values(["v", "id"], ascending=[False, True]).id.to_numpy()
    want = pd.Series(np.arange(1, len(rows) + 1), index=order).sort_index()
    assert (out.r == want).all()


def test_quantiles(df, rows):
    out = exact_quantiles(df, ["t"], "v", {"a": 0.1, "b": 0.5, "c": 0.97}).toPandas().set_index("t").sort_index()
    want = rows.groupby("t").v.quantile([0.1, 0.5, 0.97]).unstack()
    np.testing.assert_allclose(out.to_numpy(dtype=float), want.to_numpy(), atol=1e-9)


def test_small_blocks_give_the_whole_window(df, rows):
    known = df.where("k IS NOT NULL")
    out = rolling(known, "k", ["t", "id"], "v", 6, block_rows=7).toPandas().set_index("id").sort_index()
    s = rows.dropna(subset=["k"]).sort_values(["k", "t", "id"])
    g = s.groupby("k").v
    for name, fn in (("max", "max"), ("min", "min"), ("mean", "mean")):
        want = g.transform(lambda x, fn=fn: getattr(x.rolling(6, min_periods=1), fn)())
        want.index = s.id
        np.testing.assert_allclose(out[f"v_{name}6"], want.sort_index(), atol=1e-9)
    before = previous(known, "k", ["t", "id"], "v", "p", block_rows=5).toPandas().set_index("id").sort_index()
    want = g.shift(1).fillna(0)
    want.index = s.id
    np.testing.assert_allclose(before.p, want.sort_index())


def test_blocks_are_bounded(df):
    cut = blocks(df, ["k"], ["t", "id"], halo=3, size=50)
    assert cut.groupBy("k", "block").count().agg(F.max("count")).first()[0] <= 53
    assert cut.where("own").count() == df.count()


def test_forward_fill_rows(df, rows):
    out = forward_fill_rows(df, "k", ["t", "id"], ["g"]).toPandas().set_index("id").sort_index()
    np.testing.assert_allclose(out.g.astype(float), expected(rows).filled, equal_nan=True)
