from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import stats
from tessera.functions.hashing import md5_mod, uniform
from tessera.operators import abtest, multiple, sequential
from tessera.plans.resample import permuted_moments, weighted_sums


def test_normal_cdf(spark):
    z = [-9.0, -7.2, -3.0, -1.0, 0.0, 0.5, 1.959963984540054, 6.9, 7.5, 40.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in z], "z double").select(stats.norm_cdf(F.col("z"))).collect()]
    np.testing.assert_allclose(got, [NormalDist().cdf(v) for v in z], rtol=1e-9, atol=1e-15)


@pytest.mark.parametrize(
    "t, dof, p",
    [(2.0, 10, 0.07338803), (12.7062047, 1, 0.05), (2.2281389, 10, 0.05), (1.9600, 1e7, 0.0499958), (0.0, 5, 1.0), (4.032143, 5, 0.01)],
)
def test_student_p_values(t, dof, p):
    assert stats.student_two_sided([t], [dof])[0] == pytest.approx(p, rel=2e-5)


def test_t_quantile(spark):
    row = spark.createDataFrame([(0.975, 10.0), (0.025, 10.0)], "p double, d double").select(stats.t_quantile("p", "d").alias("q")).collect()
    assert [round(r.q, 5) for r in row] == [2.22814, -2.22814]


def test_md5_modulo_matches_whole_number_arithmetic(spark):
    import hashlib

    names = [f"user {i}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    for n in (2, 6, 100, 2**31 - 1):
        got = [r[0] for r in df.select(md5_mod(F.col("s"), n)).collect()]
        assert got == [int(hashlib.md5(s.encode()).hexdigest(), 16) % n for s in names]


def test_poisson_weights_resample_the_rows(spark):
    df = spark.range(2000).select("id", F.lit(1.0).alias("v"))
    sums = weighted_sums(df, ["id"], [], {"s": F.col("v")}, 41).toPandas()
    assert len(sums) == 41 and (sums.s == sums.n).all()
    assert abs(sums.n.mean() - 2000) < 40 and 30 < sums.n.std() < 62


def test_permutations_are_exact_splits(spark):
    df = spark.range(999).select("id", uniform(F.col("id"), "x").alias("v"))
    out = permuted_moments(df, "id", ["v"], 400, 7, hex_digits=2).toPandas()
    pdf = df.toPandas()
    assert (out.n1 == 400).all() and (out.n2 == 599).all()
    both = out.mean1 * 400 + out.mean2 * 599
    np.testing.assert_allclose(both, pdf.v.sum())
    import hashlib

    for r in out.itertuples():
        keys = sorted(pdf.id, key=lambda i: hashlib.md5(f"{i}_0_{r.perm}".encode()).hexdigest())
        first = pdf.set_index("id").v.loc[keys[:400]]
        assert r.mean1 == pytest.approx(first.mean()) and r.var1 == pytest.approx(first.var())


def test_aa_p_values_look_uniform(spark):
    rows = spark.range(4000).withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(99))))
    rows = rows.select("split", uniform(F.col("id"), "v").alias("v"), F.when(uniform(F.col("id"), F.col("split")) < 0.5, "a").otherwise("b").alias("g"))
    p = [r.p_value for r in abtest.t_test(rows, "g", "v", "a", "b", ["split"]).collect()]
    assert len(p) == 100 and 0.35 < np.mean(p) < 0.65 and np.mean(np.array(p) < 0.05) < 0.15


def test_zero_padding_equals_real_zeros(spark):
    values = [3.0, 4.0, 10.0]
    sums = spark.createDataFrame([("a", sum(values), sum(v * v for v in values))], "g string, sum double, sumsq double")
    sizes = spark.createDataFrame([("a", 8)], "g string, n bigint")
    row = abtest.pad_with_zeros(sums, sizes, ["g"]).first()
    padded = np.array(values + [0] * 5)
    assert row["mean"] == pytest.approx(padded.mean()) and row["var"] == pytest.approx(padded.var(ddof=1))


def test_multiple_testing_methods(spark):
    p = [0.001, 0.008, 0.039, 0.041, 0.042, 0.06, 0.074, 0.205]
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(p)], "family string, test int, p double")
    out = multiple.decisions(df, "family", "test", "p").orderBy("test").toPandas()
    assert out.bonferroni.tolist() == [1, 0, 0, 0, 0, 0, 0, 0]
    assert out.holm.tolist() == [1, 0, 0, 0, 0, 0, 0, 0]
    assert out.bh.tolist() == [1, 1, 0, 0, 0, 0, 0, 0]
    adj = multiple.adjusted(df, "family", "test", "p").orderBy("test").toPandas()
    np.testing.assert_allclose(adj.holm[:3], [0.008, 0.056, 0.234])
    np.testing.assert_allclose(adj.bh[:3], [0.008, 0.032, 0.0672])


def test_sequential_test_against_a_loop(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0.4, 1, 300), rng.normal(0, 1, 280)
    rows = [("p", i, float(v)) for i, v in enumerate(a)] + [("c", i, float(v)) for i, v in enumerate(b)]
    df = spark.createDataFrame(rows, "g string, i int, v double").withColumn("e", F.lit("x"))
    row = sequential.wald(
        df, ["e"], "g", ["i"], "v", "p", "c", sequential.normal(0, 1.41), sequential.normal(0.4, 1.41), 0.05, 0.2
    ).first()
    z, low, high = 0.0, np.log(0.2 / 0.95), np.log(0.8 / 0.05)
    want = (0.5, 280)
    for i in range(280):
        d = a[i] - b[i]
        z += (d**2 - (d - 0.4) ** 2) / (2 * 1.41**2)
        if z < low or z > high:
            want = (0.0 if z < low else 1.0, i + 1)
            break
    assert (row["result"], row["length"]) == want
