"""Feature tables, encoders and uplift."""

from pyspark.sql import functions as F

from tessera.catalog.c_joins import campaign_tables
from tessera.catalog.d_aggregates import RECEIPTS_SQL
from tessera.catalog.f_experiments import SPEND_SQL, spend
from tessera.catalog.registry import query
from tessera.functions.columns import bins_by_edges, quantile_edges
from tessera.functions.hashing import POISSON1_CDF
from tessera.operators import features, learners, sales, search, uplift, uplift_tree
from tessera.plans.prefix import exact_quantiles


@query(
    "fs_02_feature_table",
    "customer_id bigint, n90 double, s90 double, n365 double, gap365 double, wd3 double, store double, age double, flag double, spent double",
    f"""WITH r AS {RECEIPTS_SQL}, a AS (SELECT customer_id, count(*) AS n90, sum(purchase_sum) AS s90 FROM r WHERE date >= 1910 AND date < 2000 GROUP BY 1),
       b AS (SELECT customer_id, count(*) AS n365, CASE WHEN count(*) > 1 THEN (max(date) - min(date)) / (count(*) - 1) END AS gap365, count(*) FILTER (date % 7 = 3) AS wd3 FROM r WHERE date >= 1635 AND date < 2000 GROUP BY 1),
       f AS (SELECT customer_id, store_id AS store FROM r WHERE date >= 1635 AND date < 2000 GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, store_id DESC) = 1),
       o AS (SELECT customer_id, sum(purchase_amt) AS spent FROM r WHERE date >= 2000 AND date < 2030 GROUP BY 1)
       SELECT c_custkey AS customer_id, n90, s90, n365, gap365, wd3, store, c_nationkey AS age, CAST(c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AS INT) AS flag, coalesce(spent, 0) AS spent
       FROM customer LEFT JOIN a ON c_custkey = a.customer_id LEFT JOIN b ON c_custkey = b.customer_id LEFT JOIN f ON c_custkey = f.customer_id LEFT JOIN o ON c_custkey = o.customer_id""",
)
def feature_table(t):
    config = [
        {"name": "profile", "args": {"columns": ["age"]}},
        {"name": "purchases_agg", "args": {"date_to": 2000, "delta": 90}},
        {"name": "receipts_basic", "args": {"date_to": 2000, "delta": 365}},
        {"name": "day_of_week", "args": {"date_to": 2000, "delta": 365}},
        {"name": "favourite_store", "args": {"date_to": 2000, "delta": 365}},
        {"name": "campaign", "args": {"date_start_offer": 2000, "days_offer": 30}},
    ]
    names = {
        "purchases_90d__count": "n90",
        "purchase_sum_90d__sum": "s90",
        "date_count__365d": "n365",
        "mean_interval__365d": "gap365",
        "purchases_wd3_365d__count": "wd3",
        "favourite_store_365d": "store",
        "target_group_flag": "flag",
        "target_purchase_amt": "spent",
    }
    return features.feature_table(campaign_tables(t), config).withColumnsRenamed(names)


@query(
    "fs_03_transform_chain",
    "c_custkey bigint, profit double, segment_code bigint, balance_sign string",
    f"""SELECT c_custkey, 0.2 * v - 1.5 * CAST(grp = 'pilot' AS INT) AS profit, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS segment_code, CASE WHEN x > v THEN 'down' ELSE 'up' END AS balance_sign FROM {SPEND_SQL}""",
)
def transform_chain(t):
    df = spend(t).withColumn("w", (F.col("grp") == "pilot").cast("int"))
    labels = features.fit_labels(df, "c_mktsegment", "c_mktsegment")
    steps = [
        {"name": "expression", "args": {"expression": "0.2D * v - 1.5D * w", "result": "profit"}},
        {"name": "label_encode", "args": {"column": "c_mktsegment", "labels": labels, "result": "segment_code"}},
        {"name": "trend", "args": {"a": "x", "b": "v", "result": "balance_sign"}},
    ]
    trend = lambda d, a, b, result: d.withColumn(result, F.when(F.col(a) > F.col(b), "down").otherwise("up"))
    return features.transform_chain(df, steps, {"trend": trend})


@query(
    "fs_05_label_encoding",
    "o_orderkey bigint, code double",
    """WITH f AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY min(o_orderkey), o_orderpriority) - 1 AS code FROM orders
         WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' GROUP BY 1)
       SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN code END AS code FROM orders LEFT JOIN f ON o_orderpriority = v""",
)
def label_encoding(t):
    df = t.orders.withColumn("p", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    labels = features.fit_labels(df.where("p <> '5-LOW'"), "p", "o_orderkey")
    return features.label_encode(df, "p", labels, "code")


@query(
    "fs_06_leave_one_out",
    "o_orderkey bigint, train_code double, score_code double",
    """WITH d AS (SELECT o_orderkey, o_totalprice AS y, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders), m AS (SELECT k, sum(y) AS s, count(*) AS n FROM d WHERE k IS NOT NULL GROUP BY 1)
       SELECT o_orderkey, coalesce(CASE WHEN n > 1 THEN (s - y) / (n - 1) END, (SELECT avg(y) FROM d)) AS train_code, coalesce(s / n, (SELECT sum(s) / sum(n) FROM m)) AS score_code
       FROM d LEFT JOIN m ON d.k = m.k""",
)
def leave_one_out(t):
    df = t.orders.select(
        "o_orderkey", F.col("o_totalprice").alias("y"), F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k")
    )
    train = features.loo_encode(df, "k", "y", "train_code")
    score = features.loo_encode(df, "k", "y", "score_code", fitted=features.fit_target_means(df, "k", "y"), train=False)
    return train.join(score.select("o_orderkey", "score_code"), "o_orderkey")


@query(
    "fs_07_campaign_targets",
    "client_id bigint, price double, treated bigint",
    "SELECT o_custkey AS client_id, o_totalprice AS price, CAST(o_orderstatus = 'F' AS INT) AS treated FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1997-03-31'",
)
def campaign_targets(t):
    from tessera.sources.files import TableRegistry

    campaigns = t.orders.select(
        F.col("o_custkey").alias("client_id"),
        F.to_date("o_orderdate").alias("treatment_date"),
        F.col("o_totalprice").alias("price"),
        (F.col("o_orderstatus") == "F").cast("int").alias("treated"),
    )
    config = [
        {
            "name": "campaign_targets",
            "args": {"date_to": "1997-03-31", "columns": ["price", "treated"], "key": "client_id"},
        }
    ]
    return features.feature_table(TableRegistry({"campaigns": campaigns}), config)


@query(
    "fs_08_row_sample",
    "c_custkey bigint",
    "SELECT c_custkey FROM customer WHERE CAST(concat('0x', substr(md5(c_custkey || '_8'), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE < 0.3",
)
def row_sample(t):
    return features.hash_sample(t.customer, "c_custkey", 0.3, seed=8)


@query(
    "fs_09_prefix_columns",
    "o_custkey bigint, target__n bigint, target__s double",
    "SELECT o_custkey, count(*) AS target__n, sum(o_totalprice) AS target__s FROM orders GROUP BY 1",
)
def prefix_columns(t):
    df = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    return features.prefix_columns(df, ["n", "s"])


TREE_SQL = f"(SELECT CAST(grp = 'pilot' AS INT) AS w, v AS y, x, n::DOUBLE AS n, c_acctbal AS bal, c.c_custkey FROM {SPEND_SQL} s JOIN customer c ON s.c_custkey = c.c_custkey)"
TREE_FEATURES = ["x", "n", "bal"]
LIMITS = uplift_tree.Limits(max_depth=1, min_leaf=30, min_treated=10, min_control=10)


def tree_rows(t):
    """Spend since 2000 as the outcome, the hash group as treatment, earlier behaviour as features."""
    df = spend(t).join(t.customer.select("c_custkey", F.col("c_acctbal").alias("bal")), "c_custkey")
    return df.select(
        "c_custkey", (F.col("grp") == "pilot").cast("int").alias("w"), F.col("v").alias("y"), "x", F.col("n").cast("double").alias("n"), "bal"
    )


def gains_sql(features=TREE_FEATURES) -> str:
    parts = []
    for i, f in enumerate(features):
        parts.append(
            f"""SELECT '{f}' AS feature, {i} AS fi, th AS threshold, count(*) FILTER ({f} <= th) AS n_left, count(*) FILTER ({f} > th) AS n_right,
            count(*) FILTER ({f} <= th AND w = 1) AS lt, count(*) FILTER ({f} <= th AND w = 0) AS lc, count(*) FILTER ({f} > th AND w = 1) AS rt, count(*) FILTER ({f} > th AND w = 0) AS rc,
            avg(y) FILTER ({f} <= th AND w = 1) - avg(y) FILTER ({f} <= th AND w = 0) AS tau_left, avg(y) FILTER ({f} > th AND w = 1) - avg(y) FILTER ({f} > th AND w = 0) AS tau_right
            FROM TR, (SELECT DISTINCT unnest(CASE WHEN (SELECT count(DISTINCT {f}) FROM TR) > 10 THEN (SELECT quantile_cont({f}, [{", ".join(str(p / 100) for p in uplift_tree.MANY)}]) FROM TR)
              ELSE (SELECT quantile_cont(d, [0.1, 0.5, 0.9]) FROM (SELECT DISTINCT {f} AS d FROM TR)) END) AS th) q GROUP BY th"""
        )
    return f"""TR AS MATERIALIZED (SELECT * FROM {TREE_SQL}), G AS MATERIALIZED (SELECT feature, fi, threshold, n_left, n_right, tau_left, tau_right, abs(tau_left - tau_right) AS gain FROM ({" UNION ALL ".join(parts)})
       WHERE n_left >= 30 AND n_right >= 30 AND least(lt, rt, lc, rc) >= 10), S AS MATERIALIZED (SELECT * FROM G ORDER BY gain DESC, fi, threshold LIMIT 1)"""


SIDE = "(CASE S.feature WHEN 'x' THEN x WHEN 'n' THEN n ELSE bal END <= S.threshold)"


@query(
    "up_01_tree_fit",
    "node bigint, feature string, threshold double, n bigint, ate double",
    f"""WITH {gains_sql()} SELECT 0 AS node, feature, threshold, (SELECT count(*) FROM TR) AS n, (SELECT avg(y) FILTER (w = 1) - avg(y) FILTER (w = 0) FROM TR) AS ate FROM S
        UNION ALL SELECT CASE WHEN {SIDE} THEN 1 ELSE 2 END, NULL, NULL, count(*), avg(y) FILTER (w = 1) - avg(y) FILTER (w = 0) FROM TR, S GROUP BY 1""",
)
def tree_fit(t):
    return uplift_tree.fit_tree(tree_rows(t), TREE_FEATURES, "w", "y", LIMITS).table(t.spark)


@query("up_01_deep_tree", "node bigint, feature string, threshold double, n bigint, n_t bigint, n_c bigint, ate double")
def deep_tree(t):
    limits = uplift_tree.Limits(max_depth=3, min_leaf=30, min_treated=10, min_control=10)
    return uplift_tree.fit_tree(tree_rows(t), TREE_FEATURES, "w", "y", limits).table(t.spark)


@query(
    "up_02_node_effects",
    "c_nationkey bigint, n bigint, n_t bigint, n_c bigint, ate double",
    f"""SELECT c_nationkey, count(*) AS n, count(*) FILTER (w = 1) AS n_t, count(*) FILTER (w = 0) AS n_c, avg(y) FILTER (w = 1) - avg(y) FILTER (w = 0) AS ate
        FROM {TREE_SQL} JOIN customer USING (c_custkey) GROUP BY 1""",
)
def node_effects(t):
    return uplift_tree.node_effects(tree_rows(t).join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey"), "c_nationkey", "w", "y")


@query(
    "up_03_split_gains",
    "feature string, threshold double, n_left bigint, n_right bigint, tau_left double, tau_right double, gain double",
    f"WITH {gains_sql()} SELECT * FROM G",
)
def split_gains(t):
    return uplift_tree.split_gains(tree_rows(t).withColumn("node", F.lit(0)), "node", TREE_FEATURES, "w", "y", LIMITS)


@query(
    "up_04_tree_predict",
    "c_custkey bigint, uplift double",
    f"""WITH {gains_sql()}, L AS (SELECT {SIDE} AS side, avg(y) FILTER (w = 1) - avg(y) FILTER (w = 0) AS uplift FROM TR, S GROUP BY 1)
        SELECT c_custkey, uplift FROM TR CROSS JOIN S JOIN L ON {SIDE} = side""",
)
def tree_predict(t):
    rows = tree_rows(t)
    return uplift_tree.predict(rows, uplift_tree.fit_tree(rows, TREE_FEATURES, "w", "y", LIMITS))


@query("up_05_forest", "c_custkey bigint, uplift double")
def forest(t):
    rows = tree_rows(t)
    limits = uplift_tree.Limits(max_depth=5, min_leaf=100, min_treated=10, min_control=10)
    forest = uplift_tree.fit_forest(rows, "c_custkey", TREE_FEATURES, "w", "y", 10, 10, limits, criterion="ed", n_reg=10)
    return forest.predict(rows)


@query("up_06_s_learner", "c_custkey bigint, uplift double")
def s_learner(t):
    rows = tree_rows(t)
    return learners.SLearner(TREE_FEATURES, "w", "y", learners.boosted_trees(maxIter=5)).fit(rows).uplift(rows)


@query("up_07_t_learner", "c_custkey bigint, uplift double")
def t_learner(t):
    rows, model = tree_rows(t), learners.boosted_trees(maxIter=5)
    return learners.TLearner(TREE_FEATURES, "w", "y", model, model).fit(rows).uplift(rows)


@query("up_08_x_learner", "c_custkey bigint, uplift double")
def x_learner(t):
    rows = tree_rows(t)
    return learners.XLearner(TREE_FEATURES, "w", "y", model=learners.boosted_trees(maxIter=5)).fit(rows).uplift(rows)


@query("up_09_r_learner", "c_custkey bigint, uplift double")
def r_learner(t):
    rows, model = tree_rows(t), learners.boosted_trees(maxIter=5)
    return learners.RLearner(TREE_FEATURES, "w", "y", "c_custkey", 4, model=model).fit(rows).uplift(rows)


SCORED_SQL = f"(SELECT c_custkey, w, y, bal AS score FROM {TREE_SQL})"


def scored(t):
    return tree_rows(t).withColumn("score", F.col("bal"))


@query(
    "up_10_uplift_at_k",
    "rule string, k double, uplift double",
    f"""WITH a AS (SELECT w, y, row_number() OVER (PARTITION BY w ORDER BY score DESC, c_custkey) AS r, row_number() OVER (ORDER BY score DESC, c_custkey) AS q, count(*) OVER () AS n FROM {SCORED_SQL}),
        k AS (SELECT * FROM (VALUES (0.1::DOUBLE), (0.3), (0.5)) v(k))
        SELECT 'per_arm_total' AS rule, k, avg(y) FILTER (w = 1 AND r <= floor(n * k)) - avg(y) FILTER (w = 0 AND r <= floor(n * k)) AS uplift FROM a, k GROUP BY k
        UNION ALL SELECT 'overall', k, avg(y) FILTER (w = 1 AND q <= floor(n * k)) - avg(y) FILTER (w = 0 AND q <= floor(n * k)) FROM a, k GROUP BY k""",
)
def uplift_at_k(t):
    rules = [
        uplift.uplift_at_k(scored(t), "c_custkey", "score", "w", "y", [0.1, 0.3, 0.5], rule).withColumn("rule", F.lit(rule))
        for rule in ("per_arm_total", "overall")
    ]
    return rules[0].unionByName(rules[1])


POISSON_CASES = " + ".join(f"CAST(u >= {edge!r} AS INT)" for edge in POISSON1_CDF)


@query(
    "up_11_uplift_curve",
    "k double, mean double, std double",
    f"""WITH s AS (SELECT *, {POISSON_CASES} AS wt FROM (SELECT *, CAST(concat('0x', substr(md5(c_custkey || '_11_' || b), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS u FROM {SCORED_SQL}, range(0, 20) r(b))),
        c AS (SELECT b, w, y, wt, sum(wt) OVER (PARTITION BY b, w ORDER BY score DESC, c_custkey ROWS UNBOUNDED PRECEDING) AS upto, sum(wt) OVER (PARTITION BY b) AS size FROM s WHERE wt > 0),
        u AS (SELECT b, k, w, y, greatest(0, least(wt, floor(size * k) - (upto - wt))) AS used FROM c, (VALUES (0.1::DOUBLE), (0.2), (0.4)) v(k)),
        m AS (SELECT b, k, sum(used * y) FILTER (w = 1) / sum(used) FILTER (w = 1) - sum(used * y) FILTER (w = 0) / sum(used) FILTER (w = 0) AS d FROM u GROUP BY 1, 2)
        SELECT k, avg(d) AS mean, stddev_pop(d) AS std FROM m GROUP BY 1""",
)
def uplift_curve(t):
    return uplift.uplift_curve(scored(t), "c_custkey", "score", "w", "y", [0.1, 0.2, 0.4], 20, seed=11)


@query(
    "up_12_gain_curve",
    "c_custkey bigint, n bigint, gain double",
    f"""WITH r AS (SELECT c_custkey, row_number() OVER o AS n, sum(w) OVER q AS nt, sum(w * y) OVER q AS yt, sum(y) OVER q AS ya FROM {SCORED_SQL}
          WINDOW o AS (ORDER BY score DESC, c_custkey), q AS (ORDER BY score DESC, c_custkey ROWS UNBOUNDED PRECEDING))
        SELECT c_custkey, n, CASE WHEN nt > 0 AND n - nt > 0 THEN (yt / nt - (ya - yt) / (n - nt)) * n ELSE 0 END AS gain FROM r""",
)
def gain_curve(t):
    return uplift.gain_curve(scored(t), "c_custkey", "score", "w", "y")


@query(
    "up_13_score_report",
    "p5 double, p95 double, mean double, std double, share_above double",
    f"""SELECT quantile_cont(score, 0.05) AS p5, quantile_cont(score, 0.95) AS p95, avg(score) AS mean, stddev_samp(score) AS std, avg(CAST(score > 5000 AS INT)) AS share_above FROM {SCORED_SQL}""",
)
def score_report(t):
    return uplift.score_report(scored(t), "score", 5000)


@query("up_14_targeting", "c_custkey bigint", f"SELECT c_custkey FROM {SCORED_SQL} WHERE score > 5000")
def targeting(t):
    return uplift.targets_above(scored(t), "c_custkey", "score", 5000)


@query("up_15_search", "draw bigint, params string, fold bigint, score double, mean_score double, holdout_score double")
def sampled_search(t):
    space = {
        "max_depth": search.choice(2, 3, 4),
        "min_leaf": search.steps(30, 90, 30),
        "min_treated": search.choice(10),
        "min_control": search.choice(10),
        "criterion": search.choice("delta", "ed"),
        "n_reg": search.between(0, 20),
    }
    return search.search_forest(tree_rows(t), "c_custkey", TREE_FEATURES, "w", "y", space, n_iter=4, k_folds=3)


@query(
    "up_16_labelled_examples",
    "c_custkey bigint, sample string, w bigint, y double, score double",
    f"""SELECT c_custkey, CASE WHEN CAST(concat('0x', substr(md5(c_custkey || '_16'), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE < 0.7 THEN 'train' ELSE 'test' END AS sample, w, y, score FROM {SCORED_SQL}""",
)
def labelled_examples(t):
    from tessera.functions.hashing import uniform

    return learners.labelled_examples(scored(t), "c_custkey", uniform(F.col("c_custkey"), 16) < 0.7, "w", "y", "score")


@query("up_17_propensity", "p double, n bigint", f"SELECT avg(w) AS p, count(*) AS n FROM {SCORED_SQL}")
def propensity(t):
    return scored(t).agg(F.avg("w").alias("p"), F.count("*").alias("n"))


NAIVE_SQL = f"""(SELECT c_custkey, flag, 28 * amt - flag - CAST(amt > 0 AS INT) * disc AS uplift FROM (SELECT c_custkey, CAST(c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AS INT) AS flag,
   coalesce(amt, 0) AS amt, coalesce(disc, 0) AS disc FROM customer LEFT JOIN (SELECT customer_id, sum(purchase_amt) AS amt, sum(discount) AS disc FROM {RECEIPTS_SQL} WHERE date >= 1900 AND date < 2200 GROUP BY 1) ON c_custkey = customer_id))"""


@query(
    "up_18_naive_uplift_profile",
    "bin bigint, n bigint, treated_share double",
    f"""WITH e AS (SELECT list_distinct(quantile_cont(uplift, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS q FROM {NAIVE_SQL})
        SELECT greatest(1, len(list_filter(q, lambda z: z < uplift))) AS bin, count(*) AS n, avg(flag) AS treated_share FROM {NAIVE_SQL}, e GROUP BY 1""",
)
def naive_uplift_profile(t):
    config = [{"name": "campaign", "args": {"date_start_offer": 1900, "days_offer": 300}}]
    df = features.feature_table(campaign_tables(t), config).withColumn(
        "uplift",
        F.expr("28 * target_purchase_amt - target_group_flag - CAST(target_purchase_amt > 0 AS INT) * target_discount_sum"),
    )
    probs = {f"q{i}": i / 10 for i in range(11)}
    edges = quantile_edges(exact_quantiles(df, [], "uplift", probs), list(probs))
    return (
        df.withColumn("bin", bins_by_edges(F.col("uplift"), edges))
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.avg("target_group_flag").alias("treated_share"))
    )
