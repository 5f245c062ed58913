"""Constant, single-row and empty groups, null keys, and texts without a word."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.columns import bins_equal_width
from tessera.functions.hashing import POISSON1_CDF
from tessera.functions.stats import student_two_sided
from tessera.operators import abtest, bootstrap, cuped, matching, ranking, sales


@pytest.fixture(scope="module")
def constant(spark):
    return spark.createDataFrame([(i, "pc"[i % 2], 5.0, 1.0) for i in range(20)], "id int, g string, y double, x double")


@pytest.mark.parametrize("equal_var", [False, True])
def test_t_columns_of_constant_and_single_rows(spark, equal_var):
    df = spark.createDataFrame([(10, 5.0, 0.0, 10, 5.0, 0.0), (1, 5.0, None, 1, 4.0, None), (1, 5.0, 0.0, 1, 4.0, 0.0)], "n_p bigint, mean_p double, var_p double, n_c bigint, mean_c double, var_c double")
    assert [r.t for r in df.select(abtest.t_columns(equal_var)["t"].alias("t")).collect()] == [None, None, None]


def test_constant_values(spark, constant):
    assert abtest.histogram_overlap(constant, "g", "y", "p", "c", 5).first().overlap == pytest.approx(1.0)
    assert [r.n for r in sales.histogram(constant, "y", 4).orderBy("bin").collect()] == [20, 0, 0, 0]
    assert {r[0] for r in constant.select(bins_equal_width(F.col("y"), F.lit(5.0), F.lit(5.0), 3)).collect()} == {1}
    assert constant.select(bins_equal_width(F.lit(None).cast("double"), F.lit(1.0), F.lit(5.0), 3)).first()[0] is None
    adjusted = cuped.adjust(constant, "y", "x", "adj")
    assert {r.adj for r in adjusted.collect()} == {5.0}
    sums, stat = bootstrap.skew_of_sums()
    moments = constant.agg(F.count("*").cast("double").alias("n"), *[F.sum(v).alias(k) for k, v in sums("y").items()])
    assert moments.select(stat.alias("s")).first().s is None


def test_null_features_keep_their_rows(spark):
    rows = [(i, float(i % 7) if i % 5 else None, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, f double, y double")
    got = cuped.model_covariate(df, df, ["f"], "y")
    assert got.columns == ["id", "f", "y", "prediction"]
    assert got.count() == 40 and got.where("prediction is null").count() == 0


def test_null_query_is_a_group(spark):
    df = spark.createDataFrame([(q, i, i % 3, float(i)) for q in (1, None) for i in range(6)], "q int, id int, y int, s double")
    assert ranking.ndcg(df, "q", "id", "y", "s").count() == 2
    assert ranking.precision_at_k(df, "q", "id", "y", "s", 3).count() == 2
    assert ranking.lambdas(df, "q", "id", "y", "s").count() == 12


def test_many_kept_ranks_equal_few(spark):
    df = spark.createDataFrame([(1, i, i % 3, float(i % 50)) for i in range(3000)], "q int, id int, y int, s double")
    whole = ranking.dcg(df, "q", "id", "y", "s", 3000).first().dcg
    assert whole == pytest.approx(ranking.dcg(df, "q", "id", "y", "s").first().dcg)


def test_text_without_a_word_is_padding(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "doc_id int, text string")
    ids = spark.createDataFrame([("a", 2)], "token string, id bigint")
    got = {r.doc_id: list(r.ids) for r in matching.id_sequences(docs, "doc_id", ids, pad_to=3).collect()}
    assert got[2] == got[3] == [matching.PAD] * 3 and got[1][0] == 2


@pytest.mark.parametrize("dof", [1e6, 1e8, 1e10, 1e12])
@pytest.mark.parametrize("t", [0.1, 1.7, 3.0])
def test_p_values_do_not_drift(t, dof):
    # the normal law, and its first term in 1 / dof
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    want = math.erfc(t / math.sqrt(2)) + density * t * (t * t + 1) / (2 * dof)
    assert float(student_two_sided(t, dof)) == pytest.approx(want, rel=1e-9)


def test_poisson_counts_reach_the_end_of_the_draw():
    steps = np.diff([0.0, *POISSON1_CDF])
    want = [math.exp(-1) / math.factorial(k) for k in range(len(steps))]
    assert len(POISSON1_CDF) > 15 and steps == pytest.approx(want, abs=1e-15)
