"""Experiment design, tests, bootstrap, ratio metrics and CUPED."""

from statistics import NormalDist

from pyspark.sql import functions as F

from tessera.catalog.d_aggregates import GROUPED_EVENTS, grouped_events
from tessera.catalog.e_series import phi_sql
from tessera.catalog.registry import query
from tessera.functions.columns import half_open, scalar
from tessera.functions.hashing import POISSON1_CDF, md5_mod
from tessera.operators import abtest, bootstrap, clean, cuped, design, ratio
from tessera.operators.multiple import p_value_ecdf
from tessera.plans.prefix import exact_quantiles

Z95 = NormalDist().inv_cdf(0.975)
Z_SUM = Z95 + NormalDist().inv_cdf(0.8)


def t_p_sql(t: str, dof: str) -> str:
    """Two-sided Student-t p-value by Simpson's rule, independent of the Spark form."""
    step = f"(abs({t}) / 2000)"
    c = f"(exp(lgamma((({dof}) + 1) / 2) - lgamma(({dof}) / 2)) / sqrt(({dof}) * pi()))"
    terms = (
        f"list_sum(list_transform(range(0, 2001), lambda k: (CASE WHEN k = 0 OR k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) "
        f"* power(1 + power(k * {step}, 2) / ({dof}), -((({dof}) + 1) / 2))))"
    )
    return f"greatest(0, 1 - 2 * {c} * {step} / 3 * {terms})"


def moments_sql(rows: str, keys: str = "") -> str:
    """n, mean and variance of both groups of (keys, grp, v) rows, side by side."""
    head = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    cols = ", ".join(
        f"{fn}(v) FILTER (grp = '{g}')::DOUBLE AS {name}_{g[0]}"
        for name, fn in (("n", "count"), ("mean", "avg"), ("var", "var_samp"))
        for g in ("pilot", "control")
    )
    return f"SELECT {head}{cols} FROM ({rows}){group}"


def pooled_sql(moments: str, keys: str = "") -> str:
    head = f"{keys}, " if keys else ""
    return f"""SELECT {head}mean_p - mean_c AS delta, n_p + n_c - 2 AS dof, var_p, var_c,
      (mean_p - mean_c) / sqrt(((n_p - 1) * var_p + (n_c - 1) * var_c) / (n_p + n_c - 2) * (1 / n_p + 1 / n_c)) AS t FROM ({moments})"""


def welch_sql(moments: str, keys: str = "") -> str:
    head = f"{keys}, " if keys else ""
    return f"""SELECT {head}mean_p - mean_c AS delta, power(var_p / n_p + var_c / n_c, 2) / (power(var_p / n_p, 2) / (n_p - 1) + power(var_c / n_c, 2) / (n_c - 1)) AS dof,
      (mean_p - mean_c) / sqrt(var_p / n_p + var_c / n_c) AS t FROM ({moments})"""


def weight_sql(unit: str, seed, iterations: int) -> str:
    """(unit, iter, weight) rows of the hash bootstrap."""
    cases = " + ".join(f"CAST(u >= {edge!r} AS INT)" for edge in POISSON1_CDF)
    return f"""(SELECT {unit}, iter, {cases} AS weight FROM (SELECT DISTINCT {unit}, iter,
        CAST(concat('0x', substr(md5({unit} || '_{seed}_' || (iter // 4)), 1 + 8 * (iter % 4), 8)) AS UBIGINT) / 4294967296.0::DOUBLE AS u
        FROM SRC, range(0, {iterations}) r(iter)))"""


CUSTOMER_GROUP = "CASE WHEN concat('0x', md5(CAST(c_custkey AS VARCHAR)))::UHUGEINT % 2 = 1 THEN 'pilot' ELSE 'control' END"
SPEND_SQL = f"""(SELECT c_custkey, c_mktsegment, {CUSTOMER_GROUP} AS grp, coalesce(v, 0) AS v, coalesce(x, 0) AS x, coalesce(n, 0) AS n
  FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) FILTER (o_orderdate >= DATE '2000-01-01') / 1000 AS v,
  sum(o_totalprice) FILTER (o_orderdate < DATE '2000-01-01') / 1000 AS x, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey)"""


def spend(t):
    """Per customer: hash group, spend since 2000 (v), spend before (x) and order count (n)."""
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        (F.sum(F.when(late, F.col("o_totalprice"))) / 1000).alias("v"),
        (F.sum(F.when(~late, F.col("o_totalprice"))) / 1000).alias("x"),
        F.count("*").alias("n"),
    )
    pilot = md5_mod(F.col("c_custkey").cast("string"), 2) == 1
    return (
        t.customer.select("c_custkey", "c_mktsegment", F.when(pilot, "pilot").otherwise("control").alias("grp"))
        .join(sums, "c_custkey", "left")
        .fillna(0, ["v", "x", "n"])
    )


@query(
    "ab_01_proportion_ci",
    "event_type string, p double, lower double, upper double",
    """SELECT event_type, p, greatest(0, p - 1.96 * sqrt(p * (1 - p) / n)) AS lower, least(1, p + 1.96 * sqrt(p * (1 - p) / n)) AS upper
       FROM (SELECT event_type, avg(CAST(value > 100 AS INT)) AS p, count(*) AS n FROM events GROUP BY 1)""",
)
def proportion_ci(t):
    df = t.events.withColumn("hit", (F.col("value") > 100).cast("int"))
    return abtest.proportion_ci(df, "hit", ["event_type"])


ROWS_BY_TYPE = f"SELECT event_type, grp, value AS v FROM {GROUPED_EVENTS}"


@query(
    "ab_02_t_test",
    "event_type string, delta double, t double, dof double, p_value double, pooled_t double",
    f"""SELECT w.event_type, w.delta, w.t, w.dof, {t_p_sql("w.t", "w.dof")} AS p_value, p.t AS pooled_t
        FROM ({welch_sql(moments_sql(ROWS_BY_TYPE, "event_type"), "event_type")}) w JOIN ({pooled_sql(moments_sql(ROWS_BY_TYPE, "event_type"), "event_type")}) p USING (event_type)""",
)
def t_test(t):
    ev = grouped_events(t)
    welch = abtest.t_test(ev, "grp", "value", "pilot", "control", ["event_type"])
    pooled = abtest.t_test(ev, "grp", "value", "pilot", "control", ["event_type"], equal_var=True)
    return welch.select("event_type", "delta", "t", "dof", "p_value").join(
        pooled.select("event_type", F.col("t").alias("pooled_t")), "event_type"
    )


@query(
    "ab_03_mann_whitney",
    "u double, z double, p_value double",
    f"""WITH r AS (SELECT grp, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS rk, count(*) OVER (PARTITION BY value) AS ties FROM {GROUPED_EVENTS}),
       s AS (SELECT sum(rk) FILTER (grp = 'pilot')::DOUBLE AS rs, count(*) FILTER (grp = 'pilot')::DOUBLE AS n1, count(*)::DOUBLE AS n, sum(ties * ties - 1)::DOUBLE AS tt FROM r),
       q AS (SELECT rs - n1 * (n1 + 1) / 2 AS u, n1, n - n1 AS n2, n, tt FROM s),
       z AS (SELECT u, greatest(abs(u - n1 * n2 / 2) - 0.5, 0) / sqrt(n1 * n2 / 12 * ((n + 1) - tt / (n * (n - 1)))) AS z FROM q)
       SELECT u, z, 2 * (1 - {phi_sql("z")}) AS p_value FROM z""",
)
def mann_whitney(t):
    return abtest.mann_whitney(grouped_events(t), "grp", "value", "pilot", "control")


def boot_sql(rows: str, unit: str, keys: str, sums: str, seed, iterations: int) -> str:
    """Resampled sums per (keys, iter) of the rows."""
    head = f"{keys}, " if keys else ""
    return f"""WITH SRC AS ({rows}), W AS {weight_sql(unit, seed, iterations)},
      B AS (SELECT {head}iter, sum(weight)::DOUBLE AS n, {sums} FROM SRC JOIN W USING ({unit}) WHERE weight > 0 GROUP BY {head}iter)"""


CI = "quantile_cont(d, 0.025) AS lower, quantile_cont(d, 0.975) AS upper, avg(d) AS mean, stddev_pop(d) AS std"


@query(
    "ab_04_bootstrap_mean_difference",
    "lower double, upper double, mean double, std double, significant bigint",
    boot_sql(f"SELECT c_custkey, grp, v FROM {SPEND_SQL}", "c_custkey", "grp", "sum(weight * v) AS s", 4, 100)
    + f""", D AS (SELECT iter, max(s / n) FILTER (grp = 'pilot') - max(s / n) FILTER (grp = 'control') AS d FROM B GROUP BY iter)
       SELECT *, CAST(lower > 0 OR upper < 0 AS INT) AS significant FROM (SELECT {CI} FROM D)""",
)
def bootstrap_mean_difference(t):
    return bootstrap.bootstrap_mean_difference(spend(t), "c_custkey", "grp", "v", "pilot", "control", 100, seed=4)


@query(
    "ab_05_bootstrap_skewness",
    "point double, lower double, upper double, pivot_lower double, pivot_upper double",
    boot_sql(
        f"SELECT c_custkey, v FROM {SPEND_SQL}", "c_custkey", "",
        "sum(weight * v) AS s1, sum(weight * v * v) AS s2, sum(weight * v * v * v) AS s3", 5, 100,
    )
    + f""", D AS (SELECT (s3 / n - 3 * (s1 / n) * s2 / n + 2 * power(s1 / n, 3)) / power(s2 / n - power(s1 / n, 2), 1.5) AS d FROM B),
       P AS (SELECT (avg(v ** 3) - 3 * avg(v) * avg(v ** 2) + 2 * avg(v) ** 3) / stddev_pop(v) ** 3 AS point FROM SRC),
       C AS (SELECT {CI} FROM D)
       SELECT point, lower, upper, 2 * point - upper AS pivot_lower, 2 * point - lower AS pivot_upper FROM C, P""",
)
def bootstrap_skewness(t):
    return bootstrap.bootstrap_skewness(spend(t), "c_custkey", "v", 100, seed=5)


MOMENT_SUMS = "sum(weight * v) AS s1, sum(weight * v * v) AS s2"
ITER_MOMENTS = """M AS (SELECT iter, max(n) FILTER (grp = 'pilot') AS n_p, max(n) FILTER (grp = 'control') AS n_c, max(s1 / n) FILTER (grp = 'pilot') AS mean_p,
   max(s1 / n) FILTER (grp = 'control') AS mean_c, max((s2 - s1 * s1 / n) / (n - 1)) FILTER (grp = 'pilot') AS var_p, max((s2 - s1 * s1 / n) / (n - 1)) FILTER (grp = 'control') AS var_c
   FROM B GROUP BY iter)"""


@query(
    "ab_06_type_one_error",
    "error double, mean_t double, n bigint",
    boot_sql(f"SELECT c_custkey, grp, v FROM {SPEND_SQL}", "c_custkey", "grp", MOMENT_SUMS, 6, 60)
    + f""", {ITER_MOMENTS}, T AS ({pooled_sql("SELECT * FROM M")})
       SELECT avg(CAST({t_p_sql("t", "dof")} < 0.05 AS INT)) AS error, avg(t) AS mean_t, count(*) AS n FROM T""",
)
def type_one_error(t):
    return bootstrap.type_one_error(spend(t), "c_custkey", "grp", "v", "pilot", "control", 60, seed=6)


@query(
    "ab_07_type_two_error",
    "effect double, error double, mean_t double",
    boot_sql(f"SELECT c_custkey, grp, v FROM {SPEND_SQL}", "c_custkey", "grp", MOMENT_SUMS, 7, 60)
    + f""", {ITER_MOMENTS}, E AS (SELECT effect, n_p, n_c, mean_p * effect AS mean_p, mean_c, var_p * effect * effect AS var_p, var_c
         FROM M, (VALUES (1.0::DOUBLE), (1.05), (1.1), (1.2)) e(effect)), T AS ({pooled_sql("SELECT * FROM E", "effect")})
       SELECT effect, avg(CAST({t_p_sql("t", "dof")} >= 0.05 AS INT)) AS error, avg(t) AS mean_t FROM T GROUP BY 1""",
)
def type_two_error(t):
    return bootstrap.type_two_error(
        spend(t), "c_custkey", "grp", "v", "pilot", "control", [1.0, 1.05, 1.1, 1.2], 60, seed=7
    )


@query(
    "ab_08_sample_size",
    "effect double, sample_size bigint",
    f"""SELECT effect, ceil(power({Z_SUM!r}, 2) * 2 * power(s, 2) / power(m - m * effect, 2)) AS sample_size
        FROM (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events), (VALUES (1.01::DOUBLE), (1.03), (1.05), (1.1), (1.2)) e(effect)""",
)
def sample_size(t):
    return design.sample_size(t.events, "value", [1.01, 1.03, 1.05, 1.1, 1.2])


def grid_sql(error: float) -> str:
    z = NormalDist().inv_cdf(1 - error / 2) + NormalDist().inv_cdf(1 - error)
    return f"ceil(power({z!r}, 2) * 2 * power(s, 2) / power(m - m * effect, 2)) AS err_{round(error * 100)}"


@query(
    "ab_09_sample_size_grid",
    "event_type string, effect double, err_5 bigint, err_10 bigint, err_20 bigint",
    f"""SELECT event_type, effect, {", ".join(grid_sql(e) for e in (0.05, 0.1, 0.2))}
        FROM (SELECT event_type, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY 1), (VALUES (1.02::DOUBLE), (1.05), (1.1)) e(effect)""",
)
def sample_size_grid(t):
    return design.sample_size_grid(t.events, "value", [1.02, 1.05, 1.1], [0.05, 0.1, 0.2], ["event_type"])


@query(
    "ab_10_detectable_effect",
    "event_type string, mde double",
    f"SELECT event_type, {Z_SUM!r} * sqrt(2 * power(stddev_pop(value), 2)) / sqrt(count(value)) AS mde FROM events GROUP BY 1",
)
def detectable_effect(t):
    return design.detectable_effect(t.events, "value", by=["event_type"])


@query(
    "ab_11_power_by_segment",
    "event_type string, shift double, beta fixed, power double",
    f"""WITH z AS (SELECT event_type, shift, shift / (s * sqrt(2.0::DOUBLE / n)) AS z FROM (SELECT event_type, stddev_samp(value) AS s, count(*) AS n FROM events GROUP BY 1),
         (VALUES (0.0::DOUBLE), (2), (5), (10)) v(shift)), b AS (SELECT event_type, shift, {phi_sql(f"{Z95!r} - z")} - {phi_sql(f"-{Z95!r} - z")} AS beta FROM z)
       SELECT event_type, shift, beta, 1 - beta AS power FROM b""",
)
def power_by_segment(t):
    return design.power_by_segment(t.events, "value", ["event_type"], [0.0, 2.0, 5.0, 10.0])


STRATIFIED_SQL = """(SELECT c_custkey, c_mktsegment, c_acctbal, CASE WHEN p <= g THEN 'pilot' ELSE 'control' END AS grp FROM (
    SELECT c_custkey, c_mktsegment, c_acctbal, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '_12'), c_custkey) AS p,
    round_even(count(*) OVER (PARTITION BY c_mktsegment) / (count(*) OVER ()) * 50.0::DOUBLE, 0) AS g FROM customer) WHERE p <= 2 * g)"""


@query("ab_12_stratified_selection", "c_custkey bigint, c_mktsegment string, grp string", f"SELECT c_custkey, c_mktsegment, grp FROM {STRATIFIED_SQL}")
def stratified_selection(t):
    return stratified(t)


def stratified(t):
    df = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return design.stratified_groups(df, "c_custkey", ["c_mktsegment"], 50, seed=12).withColumnRenamed("group", "grp")


STRAT_SQL = f"""(SELECT grp, sum(c) AS n, sum(w * m) AS mean, sum(w * var) AS var FROM (SELECT grp, c_mktsegment, avg(v) AS m, var_samp(v) AS var, count(v) AS c FROM {SPEND_SQL} GROUP BY 1, 2)
   JOIN (SELECT c_mktsegment, count(*) / (SELECT count(*) FROM customer) AS w FROM customer GROUP BY 1) USING (c_mktsegment) GROUP BY 1)"""


@query("ab_13_stratified_moments", "grp string, n bigint, mean double, var double", f"SELECT grp, n, mean, var FROM {STRAT_SQL}")
def stratified_moments(t):
    return strat_moments(t)


def strat_moments(t):
    weights = design.stratum_weights(t.customer, ["c_mktsegment"])
    return design.stratified_moments(spend(t), "grp", ["c_mktsegment"], "v", weights)


@query(
    "ab_14_poststratified_effect",
    "delta double, se double, lower double, upper double",
    f"""SELECT delta, se, delta - 1.96 * se AS lower, delta + 1.96 * se AS upper FROM (SELECT max(mean) FILTER (grp = 'pilot') - max(mean) FILTER (grp = 'control') AS delta,
        sqrt(sum(var / n)) AS se FROM {STRAT_SQL})""",
)
def poststratified_effect(t):
    both = abtest.side_by_side(strat_moments(t), [], "grp", "pilot", "control", ["n", "mean", "var"])
    se = F.sqrt(F.col("var_p") / F.col("n_p") + F.col("var_c") / F.col("n_c"))
    return both.select((F.col("mean_p") - F.col("mean_c")).alias("delta"), se.alias("se")).withColumns(
        {"lower": F.col("delta") - 1.96 * F.col("se"), "upper": F.col("delta") + 1.96 * F.col("se")}
    )


WIDE_STRAT = "SELECT " + ", ".join(
    f"max({c}) FILTER (grp = '{g}')::DOUBLE AS {c}_{g[0]}" for c in ("n", "mean", "var") for g in ("pilot", "control")
) + f" FROM {STRAT_SQL}"


@query(
    "ab_15_poststratified_welch",
    "delta double, t double, dof double, p_value double",
    f"SELECT delta, t, dof, {t_p_sql('t', 'dof')} AS p_value FROM ({welch_sql(WIDE_STRAT)})",
)
def poststratified_welch(t):
    from tessera.functions.stats import t_two_sided

    out = abtest.t_test_of(strat_moments(t), [], "grp", "pilot", "control")
    return out.withColumn("p_value", t_two_sided(F.col("t"), F.col("dof")))


@query(
    "ab_16_stratified_bootstrap",
    "lower double, upper double, mean double, std double",
    boot_sql(f"SELECT c_custkey, grp, c_mktsegment, v FROM {SPEND_SQL}", "c_custkey", "grp, c_mktsegment", "sum(weight * v) AS s", 16, 60)
    + f""", S AS (SELECT c_mktsegment, count(*) / (SELECT count(*) FROM customer) AS w FROM customer GROUP BY 1),
       M AS (SELECT iter, grp, sum(w * s / n) AS m FROM B JOIN S USING (c_mktsegment) GROUP BY 1, 2),
       D AS (SELECT iter, max(m) FILTER (grp = 'pilot') - max(m) FILTER (grp = 'control') AS d FROM M GROUP BY 1) SELECT {CI} FROM D""",
)
def stratified_bootstrap(t):
    weights = design.stratum_weights(t.customer, ["c_mktsegment"])
    return bootstrap.stratified_bootstrap(
        spend(t), "c_custkey", "grp", "c_mktsegment", "v", weights, "pilot", "control", 60, seed=16
    )


@query(
    "ab_17_stratum_imbalance",
    "grp string, c_mktsegment string, n bigint, share double, off double",
    f"""SELECT grp, c_mktsegment, n, n / sum(n) OVER (PARTITION BY grp) AS share, abs(n / sum(n) OVER (PARTITION BY grp) - w) AS off
        FROM (SELECT grp, c_mktsegment, count(*) AS n FROM {STRATIFIED_SQL} GROUP BY 1, 2) JOIN (SELECT c_mktsegment, count(*) / (SELECT count(*) FROM customer) AS w FROM customer GROUP BY 1) USING (c_mktsegment)""",
)
def stratum_imbalance(t):
    weights = design.stratum_weights(t.customer, ["c_mktsegment"])
    return design.stratum_imbalance(stratified(t), "grp", ["c_mktsegment"], weights)


@query(
    "ab_18_clipped_t_test",
    "delta double, t double, dof double, p_value double",
    f"""SELECT delta, t, dof, {t_p_sql("t", "dof")} AS p_value FROM ({welch_sql(moments_sql(f"SELECT grp, least(v, (SELECT quantile_cont(v, 0.9) FROM {SPEND_SQL})) AS v FROM {SPEND_SQL}"))})""",
)
def clipped_t_test(t):
    return abtest.t_test(clean.clip_at_quantile(spend(t), "v", 0.9), "grp", "v", "pilot", "control")


CUPED_SQL = f"SELECT grp, v, x, v - (SELECT covar_samp(x, v) / var_pop(x) FROM {SPEND_SQL}) * x AS adj FROM {SPEND_SQL}"


@query(
    "ab_19_cuped_metric",
    "user_id bigint, metric double, metric_cov double, metric_cuped double",
    """WITH u AS (SELECT c_custkey AS user_id, coalesce(m, 0) AS metric, coalesce(c, 0) AS metric_cov FROM customer LEFT JOIN (SELECT user_id AS k,
         sum(value) FILTER (ts >= DATE '2024-01-16' AND ts < DATE '2024-01-30') AS m, sum(value) FILTER (ts >= DATE '2024-01-02' AND ts < DATE '2024-01-16') AS c FROM events GROUP BY 1) ON c_custkey = k)
       SELECT user_id, metric, metric_cov, metric - (SELECT covar_samp(metric_cov, metric) / var_pop(metric_cov) FROM u) * metric_cov AS metric_cuped FROM u""",
)
def cuped_metric(t):
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    periods = {
        "prepilot": {"begin": "2024-01-02", "end": "2024-01-16"},
        "pilot": {"begin": "2024-01-16", "end": "2024-01-30"},
    }
    return cuped.cuped_metric(t.events, "value", "user_id", users, "ts", periods, "metric")


def cuped_tests_sql(rows: str) -> str:
    parts = [
        f"SELECT '{name}' AS metric, delta, t, {t_p_sql('t', 'dof')} AS p_value, var_p, var_c FROM ({pooled_sql(moments_sql(f'SELECT grp, {col} AS v FROM ({rows})'))})"
        for name, col in (("plain", "v"), ("cuped", "adj"))
    ]
    return " UNION ALL ".join(parts)


@query(
    "ab_20_cuped_test",
    "metric string, delta double, t double, p_value double, var_p double, var_c double",
    cuped_tests_sql(CUPED_SQL),
)
def cuped_test(t):
    return cuped.cuped_test(spend(t), "grp", "v", "x", "pilot", "control")


@query(
    "ab_20_variance_reduction",
    "grp string, var_plain double, var_cuped double, ratio double",
    f"SELECT grp, var_samp(v) AS var_plain, var_samp(adj) AS var_cuped, var_samp(v) / var_samp(adj) AS ratio FROM ({CUPED_SQL}) GROUP BY 1",
)
def variance_reduction(t):
    return cuped.variance_reduction(spend(t), "grp", "v", "x")


PANEL_SQL = """(SELECT CASE WHEN l_suppkey % 2 = 1 THEN 'pilot' ELSE 'control' END AS grp, l_shipdate AS day, l_suppkey, avg(l_extendedprice) / 1000 AS v, avg(l_quantity) AS x
                FROM lineitem GROUP BY 1, 2, 3)"""


@query(
    "ab_21_external_covariate",
    "metric string, delta double, t double, p_value double, var_p double, var_c double",
    cuped_tests_sql(f"SELECT grp, v, x, v - (SELECT covar_samp(x, v) / var_pop(x) FROM {PANEL_SQL}) * x AS adj FROM {PANEL_SQL}"),
)
def external_covariate(t):
    grp = F.when(F.col("l_suppkey") % 2 == 1, "pilot").otherwise("control").alias("grp")
    panel = t.lineitem.groupBy(grp, "l_shipdate", "l_suppkey").agg(
        (F.avg("l_extendedprice") / 1000).alias("v"), F.avg("l_quantity").alias("x")
    )
    return cuped.cuped_test(panel, "grp", "v", "x", "pilot", "control")


@query("ab_22_model_covariate", "metric string, delta double, t double, p_value double, var_p double, var_c double")
def model_covariate(t):
    """The covariate is a ridge prediction fitted on customers of other hash groups."""
    df = spend(t).join(t.customer.select("c_custkey", "c_acctbal", "c_nationkey"), "c_custkey")
    outside = md5_mod(F.concat(F.col("c_custkey").cast("string"), F.lit("holdout")), 3) == 0
    scored = cuped.model_covariate(
        df.where(outside), df.where(~outside), ["x", "n", "c_acctbal", "c_nationkey"], "v"
    )
    return cuped.cuped_test(scored, "grp", "v", "prediction", "pilot", "control")


PERIOD = "ts >= DATE '2024-01-08' AND ts < DATE '2024-01-22'"


@query(
    "ab_23_linearised_metric",
    "user_id bigint, lin double, lin_fixed double",
    f"""WITH s AS (SELECT user_id AS k, sum(value) AS x, count(value) AS y FROM events WHERE {PERIOD} GROUP BY 1)
        SELECT c_custkey AS user_id, coalesce(x - (SELECT sum(x) / sum(y) FROM s JOIN customer ON k = c_custkey) * y, 0) AS lin, coalesce(x - 30.0 * y, 0) AS lin_fixed
        FROM customer LEFT JOIN s ON c_custkey = k""",
)
def linearised_metric(t):
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    period = {"begin": "2024-01-08", "end": "2024-01-22"}
    free = ratio.linearised_metric(t.events, "value", "user_id", users, "ts", period, "lin")
    fixed = ratio.linearised_metric(t.events, "value", "user_id", users, "ts", period, "lin_fixed", kappa=30.0)
    return free.join(fixed, "user_id")


USERS_SQL = f"(SELECT user_id, grp, sum(value) AS x, count(value) AS y FROM {GROUPED_EVENTS} GROUP BY 1, 2)"


def users_of(t):
    return ratio.user_sums(grouped_events(t), "user_id", "value", ["grp"])


def pooled_test_sql(rows: str) -> str:
    return f"SELECT delta, t, dof, {t_p_sql('t', 'dof')} AS p_value FROM ({pooled_sql(moments_sql(rows))})"


@query("ab_24_ratio_naive", "delta double, t double, dof double, p_value double", pooled_test_sql(f"SELECT grp, value AS v FROM {GROUPED_EVENTS}"))
def ratio_naive(t):
    return ratio.naive_test(grouped_events(t), "grp", "value", "pilot", "control")


@query("ab_25_ratio_user_average", "delta double, t double, dof double, p_value double", pooled_test_sql(f"SELECT grp, x / y AS v FROM {USERS_SQL}"))
def ratio_user_average(t):
    return ratio.average_test(users_of(t), "grp", "pilot", "control")


RATIO_DELTA = "sum(x) FILTER (grp = 'pilot') / sum(y) FILTER (grp = 'pilot') - sum(x) FILTER (grp = 'control') / sum(y) FILTER (grp = 'control')"
RATIO_BOOT = boot_sql(f"SELECT user_id, grp, x, y FROM {USERS_SQL}", "user_id", "grp", "sum(weight * x) AS x, sum(weight * y) AS y", 26, 100)


@query(
    "ab_26_ratio_bootstrap",
    "delta double, std double, p_value double",
    RATIO_BOOT
    + f""", D AS (SELECT max(x / y) FILTER (grp = 'pilot') - max(x / y) FILTER (grp = 'control') AS d FROM B GROUP BY iter),
       R AS (SELECT (SELECT {RATIO_DELTA} FROM SRC) AS delta, (SELECT stddev_pop(d) FROM D) AS std)
       SELECT delta, std, 2 * (1 - {phi_sql("abs(delta / std)")}) AS p_value FROM R""",
)
def ratio_bootstrap(t):
    return bootstrap.ratio_bootstrap(users_of(t), "user_id", "grp", "x", "y", "pilot", "control", 100, seed=26)


DELTA_SQL = f"""(SELECT r_p - r_c AS delta, (r_p - r_c) / sqrt(v_p + v_c) AS z FROM (SELECT max(r) FILTER (grp = 'pilot') AS r_p, max(r) FILTER (grp = 'control') AS r_c,
   max(v) FILTER (grp = 'pilot') AS v_p, max(v) FILTER (grp = 'control') AS v_c FROM (SELECT grp, avg(x) / avg(y) AS r,
   (var_pop(x) / power(avg(y), 2) + power(avg(x), 2) * var_pop(y) / power(avg(y), 4) - 2 * avg(x) * covar_samp(x, y) / power(avg(y), 3)) / count(*) AS v FROM {USERS_SQL} GROUP BY 1)))"""


@query("ab_27_ratio_delta_method", "delta double, z double, p_value double", f"SELECT delta, z, 2 * (1 - {phi_sql('abs(z)')}) AS p_value FROM {DELTA_SQL}")
def ratio_delta_method(t):
    return ratio.delta_test(users_of(t), "grp", "pilot", "control")


LIN_SQL = f"SELECT user_id, grp, x - (SELECT sum(x) / sum(y) FROM {USERS_SQL} WHERE grp = 'control') * y AS v FROM {USERS_SQL}"


@query("ab_28_ratio_linearised", "delta double, t double, dof double, p_value double", pooled_test_sql(LIN_SQL))
def ratio_linearised(t):
    return ratio.linearised_test(users_of(t), "grp", "pilot", "control")


LATE, EARLY = "ts >= DATE '2024-01-16'", "ts < DATE '2024-01-16'"
LIN_CUPED_SQL = f"""WITH s AS (SELECT user_id, grp, coalesce(sum(value) FILTER ({LATE}), 0) AS x, count(value) FILTER ({LATE}) AS y, coalesce(sum(value) FILTER ({EARLY}), 0) AS x0,
     count(value) FILTER ({EARLY}) AS y0 FROM {GROUPED_EVENTS} GROUP BY 1, 2),
   l AS (SELECT grp, x - (SELECT sum(x) / sum(y) FROM s WHERE grp = 'control') * y AS v, x0 - (SELECT sum(x0) / sum(y0) FROM s WHERE grp = 'control') * y0 AS c FROM s),
   a AS (SELECT grp, v, v - (SELECT covar_samp(c, v) / var_pop(c) FROM l) * c AS adj FROM l) """


@query(
    "ab_29_linearised_cuped",
    "metric string, delta double, t double, p_value double, var_p double, var_c double",
    LIN_CUPED_SQL + cuped_tests_sql("SELECT * FROM a"),
)
def linearised_cuped(t):
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    sums = (
        grouped_events(t)
        .groupBy("user_id", "grp")
        .agg(
            F.sum(F.when(late, F.col("value"))).alias("x"),
            F.count(F.when(late, F.col("value"))).alias("y"),
            F.sum(F.when(~late, F.col("value"))).alias("x0"),
            F.count(F.when(~late, F.col("value"))).alias("y0"),
        )
        .fillna(0.0, ["x", "x0"])
    )
    now = ratio.linearised(sums, "grp", "control", "v")
    before = sums.select("user_id", F.col("x0").alias("x"), F.col("y0").alias("y"), "grp")
    both = now.select("user_id", "grp", "v").join(
        ratio.linearised(before, "grp", "control", "c").select("user_id", "c"), "user_id"
    )
    return cuped.cuped_test(both, "grp", "v", "c", "pilot", "control")


@query(
    "ab_30_method_comparison",
    "method string, delta double, p_value double",
    " UNION ALL ".join(
        [
            f"SELECT 'naive' AS method, delta, p_value FROM ({pooled_test_sql(f'SELECT grp, value AS v FROM {GROUPED_EVENTS}')})",
            f"SELECT 'average', delta, p_value FROM ({pooled_test_sql(f'SELECT grp, x / y AS v FROM {USERS_SQL}')})",
            f"SELECT 'delta', delta, 2 * (1 - {phi_sql('abs(z)')}) FROM {DELTA_SQL}",
            f"SELECT 'linearised', delta, p_value FROM ({pooled_test_sql(LIN_SQL)})",
            f"""SELECT 'bootstrap', delta, 2 * (1 - {phi_sql("abs(delta / std)")}) FROM ({RATIO_BOOT}, D AS (SELECT max(x / y) FILTER (grp = 'pilot') - max(x / y) FILTER (grp = 'control') AS d FROM B GROUP BY iter)
                SELECT (SELECT {RATIO_DELTA} FROM SRC) AS delta, (SELECT stddev_pop(d) FROM D) AS std)""",
        ]
    ),
)
def method_comparison(t):
    return ratio.compare_methods(grouped_events(t), "user_id", "grp", "value", "pilot", "control", 100, seed=26)


@query(
    "ab_31_bucket_sums",
    "delta double, t double, dof double, p_value double",
    pooled_test_sql(f"SELECT grp, concat('0x', md5(CAST(user_id AS VARCHAR)))::UHUGEINT % 40 AS b, sum(value) AS v FROM {GROUPED_EVENTS} GROUP BY 1, 2"),
)
def bucket_sums(t):
    sums = ratio.bucket_sums(grouped_events(t), "grp", "user_id", "value", 40)
    return abtest.t_test(sums, "grp", "total", "pilot", "control", equal_var=True)


SPLITS = 60
SPLIT_ROWS = f"""SELECT split, CASE WHEN concat('0x', md5(c_custkey || '_split_' || split))::UHUGEINT % 2 = 1 THEN 'pilot' ELSE 'control' END AS grp, v
   FROM {SPEND_SQL}, range(0, {SPLITS}) r(split)"""


def splits(t):
    """Every customer in each of the hash splits: two groups per split."""
    from tessera.functions.hashing import text_key

    rows = spend(t).select("c_custkey", "v", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))).alias("split"))
    pilot = md5_mod(text_key(F.col("c_custkey"), "split", F.col("split")), 2) == 1
    return rows.withColumn("grp", F.when(pilot, "pilot").otherwise("control"))


@query(
    "ab_32_aa_p_value_ecdf",
    "p_value double, ecdf double, off fixed",
    f"""WITH p AS (SELECT {t_p_sql("t", "dof")} AS p_value FROM ({welch_sql(moments_sql(SPLIT_ROWS, "split"), "split")})),
        e AS (SELECT p_value, row_number() OVER (ORDER BY p_value) / (count(*) OVER ())::DOUBLE AS ecdf FROM p) SELECT p_value, ecdf, abs(ecdf - p_value) AS off FROM e""",
)
def aa_p_value_ecdf(t):
    return p_value_ecdf(abtest.t_test(splits(t), "grp", "v", "pilot", "control", ["split"]), "split", "p_value")


@query("ab_44_ltv_proxy_test", "delta double, t double, dof double, p_value double")
def ltv_proxy_test(t):
    """Model of later spend fitted on other customers, scored for both groups, zero-padded test."""
    df = spend(t).join(t.customer.select("c_custkey", "c_acctbal", "c_nationkey"), "c_custkey")
    history = md5_mod(F.concat(F.col("c_custkey").cast("string"), F.lit("history")), 2) == 0
    scored = cuped.model_covariate(df.where(history), df.where(~history & (F.col("n") > 0)), ["x", "n", "c_acctbal"], "v")
    sums = scored.groupBy("grp").agg(
        F.sum("prediction").alias("sum"), F.sum(F.col("prediction") * F.col("prediction")).alias("sumsq")
    )
    sizes = df.where(~history).groupBy("grp").agg(F.count("*").alias("n"))
    from tessera.functions.stats import t_two_sided

    padded = abtest.pad_with_zeros(sums, sizes, ["grp"])
    out = abtest.t_test_of(padded, [], "grp", "pilot", "control", equal_var=True)
    return out.withColumn("p_value", t_two_sided(F.col("t"), F.col("dof")))


COMPARE_ROWS = " UNION ALL ".join(f"SELECT '{c}' AS metric, grp, {c}::DOUBLE AS v FROM {SPEND_SQL}" for c in ("v", "x", "n"))


@query(
    "ab_45_column_comparison",
    "metric string, delta double, t double, dof double, p_value double",
    f"SELECT metric, delta, t, dof, {t_p_sql('t', 'dof')} AS p_value FROM ({welch_sql(moments_sql(COMPARE_ROWS, 'metric'), 'metric')})",
)
def column_comparison(t):
    df = spend(t).withColumn("n", F.col("n").cast("double"))
    return abtest.compare_columns(df, "grp", ["v", "x", "n"], "pilot", "control")


@query(
    "ab_46_distribution_overlap",
    "overlap double, trapezoid double",
    f"""WITH e AS (SELECT min(value) AS a, max(value) AS b FROM events), c AS (SELECT least(floor((value - a) / ((b - a) / 30)), 29) AS k, count(*) FILTER (grp = 'pilot') AS p,
          count(*) FILTER (grp = 'control') AS q FROM {GROUPED_EVENTS}, e GROUP BY 1),
        g AS (SELECT i, coalesce(p, 0) / (SELECT sum(p) FROM c)::DOUBLE AS p, coalesce(q, 0) / (SELECT sum(q) FROM c)::DOUBLE AS q FROM range(30) r(i) LEFT JOIN c ON k = i),
        l AS (SELECT least(p, q) AS low, lag(least(p, q)) OVER (ORDER BY i) AS bef FROM g) SELECT sum(low) AS overlap, sum((low + bef) / 2) AS trapezoid FROM l""",
)
def distribution_overlap(t):
    return abtest.histogram_overlap(grouped_events(t), "grp", "value", "pilot", "control", 30)


EFFECT_LONG = " UNION ALL ".join(
    f"SELECT c_custkey, CAST(grp = 'pilot' AS INT) AS w, '{c}' AS target, {c}::DOUBLE AS y FROM {SPEND_SQL}" for c in ("v", "n")
)


@query(
    "ab_47_effect_bootstrap",
    "target string, ate_low double, ate_high double, rel_low double, rel_high double",
    boot_sql(EFFECT_LONG, "c_custkey", "target, w", "sum(weight * y) AS s", 47, 60)
    + """, D AS (SELECT target, iter, max(s / n) FILTER (w = 1) - max(s / n) FILTER (w = 0) AS ate, max(s / n) FILTER (w = 1) / max(s / n) FILTER (w = 0) AS rel FROM B GROUP BY 1, 2)
       SELECT target, avg(ate) - 2 * stddev_pop(ate) AS ate_low, avg(ate) + 2 * stddev_pop(ate) AS ate_high, avg(rel) - 2 * stddev_pop(rel) AS rel_low,
       avg(rel) + 2 * stddev_pop(rel) AS rel_high FROM D GROUP BY 1""",
)
def effect_bootstrap(t):
    df = spend(t).withColumn("w", (F.col("grp") == "pilot").cast("int"))
    return bootstrap.effect_bootstrap(df, "c_custkey", "w", ["v", "n"], 60, seed=47)


PERMS = 40


def perm_sql(values: str) -> str:
    rows = f"""SELECT perm, metric, v, CASE WHEN row_number() OVER (PARTITION BY perm, metric ORDER BY md5(c_custkey || '_48_' || perm), c_custkey) <= half THEN 'pilot' ELSE 'control' END AS grp
      FROM ({values}), range(0, {PERMS}) r(perm), (SELECT count(*) // 2 AS half FROM customer)"""
    return f"SELECT perm, metric, delta, t, {t_p_sql('t', 'dof')} AS p_value FROM ({pooled_sql(moments_sql(rows, 'perm, metric'), 'perm, metric')})"


@query("ab_48_permutation_check", "perm bigint, metric string, delta double, t double, p_value double", perm_sql(f"SELECT c_custkey, 'adj' AS metric, v - (SELECT covar_samp(x, v) / var_pop(x) FROM {SPEND_SQL}) * x AS v FROM {SPEND_SQL}"))
def permutation_check(t):
    adjusted = cuped.adjust(spend(t), "v", "x", "adj")
    half = F.floor(scalar(t.customer.agg(F.count("*").alias("n")), "n") / 2)
    return bootstrap.permutation_tests(adjusted, "c_custkey", ["adj"], half, PERMS, seed=48)


MULTI = " UNION ALL ".join(f"SELECT c_custkey, '{c}' AS metric, {c}::DOUBLE AS v FROM {SPEND_SQL}" for c in ("v", "x", "n"))


@query(
    "ab_49_significant_metric_count",
    "hits bigint, n bigint, bound double",
    f"""WITH c AS (SELECT perm, sum(CAST(p_value < 0.05 AND delta > 0 AS INT)) AS hits FROM ({perm_sql(MULTI)}) GROUP BY 1)
        SELECT hits, count(*) AS n, (SELECT quantile_cont(hits, 0.95) FROM c) AS bound FROM c GROUP BY 1""",
)
def significant_metric_count(t):
    half = F.floor(scalar(t.customer.agg(F.count("*").alias("n")), "n") / 2)
    return bootstrap.significant_metrics(bootstrap.permutation_tests(spend(t), "c_custkey", ["v", "x", "n"], half, PERMS, seed=48))


@query(
    "ab_50_largest_aa_effect",
    "effect double",
    f"""SELECT max(m_p / m_c - 1) AS effect FROM (SELECT split, avg(v) FILTER (grp = 'pilot') AS m_p, avg(v) FILTER (grp = 'control') AS m_c FROM ({SPLIT_ROWS}) GROUP BY 1)""",
)
def largest_aa_effect(t):
    both = abtest.side_by_side(abtest.moments(splits(t), ["split"], "grp", "v"), ["split"], "grp", "pilot", "control", ["mean"])
    return both.agg(F.max(F.col("mean_p") / F.col("mean_c") - 1).alias("effect"))
