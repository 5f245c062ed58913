"""Pricing, forecasts, bandits, scoring and streams."""

from pyspark.sql import functions as F

from tessera.catalog.a_sources import scratch
from tessera.catalog.c_joins import PROMO_SQL, promo
from tessera.catalog.d_aggregates import RIVALS_SQL, own_and_rivals, grouped_events
from tessera.catalog.e_series import MONTHLY_SQL, monthly_prices
from tessera.catalog.h_multiple import DECIDE_SQL, HELD_SQL, LLR, PAIRS_SQL, SLOTS, held_slots
from tessera.catalog.registry import QUERIES, query
from tessera.functions.columns import half_open
from tessera.functions.hashing import uniform
from tessera.operators import bandit, forecast, joins, pricing, scoring, search, sequential
from tessera.plans.prefix import cut_lineage
from tessera.streaming import jobs, keyed

FEATURES = ["qty", "disc", "tax", "size", "month"]


def price_rows(t):
    """Line prices with simple features of the line and its part."""
    return t.lineitem.join(t.part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_extendedprice").alias("y"),
        F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
        F.col("p_size").cast("double").alias("size"),
        F.month("l_shipdate").cast("double").alias("month"),
    )


@query("pr_01_early_stop_regression", "trees bigint, rmse double")
def early_stop_regression(t):
    rows = cut_lineage(price_rows(t).withColumn("held", uniform(F.col("id"), "hold") < 0.3))
    model = forecast.fit_with_early_stop(rows, FEATURES, "y", "held", maxIter=8)
    error = forecast.rmse(model.transform(forecast.assemble(rows.where("held"), FEATURES)), "y")
    return t.spark.range(1).select(F.lit(model.getNumTrees).alias("trees"), F.lit(error).alias("rmse"))


@query("pr_02_fold_average", "id bigint, prediction double")
def fold_average(t):
    rows = price_rows(t)
    models, _ = forecast.fold_models(rows, "id", FEATURES, "y", 2, maxIter=4)
    return forecast.mean_prediction(rows, FEATURES, models)


@query("pr_03_importances", "feature string, importance double")
def importances(t):
    rows = price_rows(t).withColumn("held", uniform(F.col("id"), "hold") < 0.3)
    model = forecast.fit_with_early_stop(rows, FEATURES, "y", "held", maxIter=4)
    return forecast.importances(t.spark, model, FEATURES)


@query("pr_04_ablation", "variant string, rmse double, rows bigint")
def ablation(t):
    from tessera.operators.clean import clip_at_quantile

    variants = {
        "baseline": lambda d: d,
        "drop_small": lambda d: d.where("qty > 1"),
        "clip_target": lambda d: clip_at_quantile(d, "y", 0.95),
    }
    return forecast.ablation(price_rows(t), "id", FEATURES, "y", variants, 2, maxIter=3)


LAGS = ["lag1", "lag2", "lag3"]


@query("pr_05_recursive_forecast", "sku bigint, step bigint, prediction double")
def recursive_forecast(t):
    from tessera.operators.series import lag_block

    monthly = cut_lineage(monthly_prices(t))
    train = lag_block(monthly, "sku", "month", "price", 3).withColumnsRenamed({f"price_lag{i}": f"lag{i}" for i in (1, 2, 3)})
    rows = train.dropna().withColumn("held", uniform(F.col("sku"), "hold") < 0.2)
    model = forecast.fit_with_early_stop(rows, LAGS, "price", "held", maxIter=5)
    return forecast.recursive_forecast(forecast.lag_state(monthly, "sku", "month", "price", 3), "sku", model, LAGS, 3)


@query("pr_06_seasonal_forecast", "sku bigint, day bigint, yhat double, lower double, upper double")
def seasonal_forecast(t):
    series = t.lineitem.groupBy(
        F.col("l_partkey").alias("sku"), F.unix_date(F.to_date("l_shipdate")).alias("day")
    ).agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    last = series.agg(F.max("day").alias("day")).scalar()
    ahead = F.explode(F.sequence(last + 1, last + 28, F.lit(7)))
    future = series.select("sku").distinct().select("sku", ahead.alias("day"))
    return forecast.seasonal_forecast(series, future, "sku", "day", "price")


@query(
    "pr_07_seasonal_profile",
    "sku bigint, period string, label string, mean double, n bigint",
    """WITH r AS (SELECT l_partkey AS sku, l_shipdate AS d, l_extendedprice AS v FROM lineitem)
       SELECT sku, 'month' AS period, strftime(d, '%m') AS label, avg(v) AS mean, count(*) AS n FROM r GROUP BY 1, 3
       UNION ALL SELECT sku, 'year_month', strftime(d, '%Y-%m'), avg(v), count(*) FROM r GROUP BY 1, 3
       UNION ALL SELECT sku, 'year_week', isoyear(d) || '-' || lpad(CAST(week(d) AS VARCHAR), 2, '0'), avg(v), count(*) FROM r GROUP BY 1, 3""",
)
def seasonal_profile(t):
    rows = t.lineitem.select(F.col("l_partkey").alias("sku"), "l_shipdate", "l_extendedprice")
    return pricing.seasonal_profile(rows, "sku", "l_shipdate", "l_extendedprice")


WEEKLY_RIVALS_SQL = """(SELECT l_partkey AS sku, isoyear(l_shipdate) AS year, week(l_shipdate) AS week_num, max(l_extendedprice) FILTER (l_returnflag = 'R') AS net_1,
   max(l_extendedprice) FILTER (l_returnflag = 'A') AS net_2 FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2, 3)"""


def weekly_rivals(t):
    """Two rival price columns per part and ISO week, from returned and accepted lines."""
    rows = t.lineitem.where("l_returnflag <> 'N'").withColumnRenamed("l_partkey", "sku")
    level = lambda flag: F.max(F.when(F.col("l_returnflag") == flag, F.col("l_extendedprice")))
    return joins.week_keys(rows, "l_shipdate").groupBy("sku", "year", "week_num").agg(
        level("R").alias("net_1"), level("A").alias("net_2")
    )


@query(
    "pr_08_stacked_features",
    "sku bigint, month date, price double, discount double, rival_price double",
    f"""SELECT m.sku, m.month, m.price, coalesce(p.discount, 0) AS discount, coalesce(greatest(r.net_1, r.net_2), 0) AS rival_price FROM {MONTHLY_SQL} m
        LEFT JOIN {PROMO_SQL} p ON p.sku = m.sku AND p.year = isoyear(m.month) AND p.week_num = week(m.month)
        LEFT JOIN {WEEKLY_RIVALS_SQL} r ON r.sku = m.sku AND r.year = isoyear(m.month) AND r.week_num = week(m.month)""",
)
def stacked_features(t):
    return pricing.stacked_features(monthly_prices(t), promo(t), weekly_rivals(t), "sku", "month", ["net_1", "net_2"])


@query("pr_09_batch_prediction", "id bigint, sku bigint, price double")
def batch_prediction(t):
    level = t.lineitem.groupBy(F.col("l_partkey").alias("sku")).agg(
        F.avg("l_quantity").alias("qty"), F.avg("l_discount").alias("disc")
    )
    rows = t.lineitem.select(
        F.col("l_partkey").alias("sku"), F.col("l_extendedprice").alias("y"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    ).join(level, "sku").withColumn("held", uniform(F.col("id"), "hold") < 0.3)
    model = forecast.fit_with_early_stop(rows, ["qty", "disc"], "y", "held", maxIter=4)
    requests = rows.select("id", "sku")
    return forecast.predict_batch(requests, ["sku"], level, ["qty", "disc"], model)


@query(
    "pr_10_user_price_level",
    "event_id bigint, value_max6 double, value_min6 double, value_mean6 double",
    """SELECT event_id, max(value) OVER w AS value_max6, min(value) OVER w AS value_min6, avg(value) OVER w AS value_mean6 FROM events WHERE event_type IN ('purchase', 'click')
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def user_price_level(t):
    rows = t.events.withColumn("bought", F.col("event_type").isin("purchase", "click").cast("int"))
    return pricing.user_price_level(rows, "user_id", ["ts", "event_id"], "value", "bought")


@query(
    "pr_11_price_model_features",
    "id bigint, discount double, net_1 double, price_lag1 double, price_lag2 double, level double",
    f"""WITH m AS (SELECT sku, month, lag(price, 1) OVER (PARTITION BY sku ORDER BY month) AS price_lag1, lag(price, 2) OVER (PARTITION BY sku ORDER BY month) AS price_lag2 FROM {MONTHLY_SQL}),
        u AS (SELECT o_custkey, avg(o_totalprice) AS level FROM orders GROUP BY 1)
        SELECT l_orderkey * 10 + l_linenumber AS id, p.discount, r.net_1, m.price_lag1, m.price_lag2, u.level FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN {PROMO_SQL} p ON p.sku = l_partkey AND p.year = isoyear(l_shipdate) AND p.week_num = week(l_shipdate)
        LEFT JOIN {WEEKLY_RIVALS_SQL} r ON r.sku = l_partkey AND r.year = isoyear(l_shipdate) AND r.week_num = week(l_shipdate)
        LEFT JOIN m ON m.sku = l_partkey AND m.month = date_trunc('month', l_shipdate) LEFT JOIN u ON u.o_custkey = orders.o_custkey""",
)
def price_model_features(t):
    requests = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").alias("sku"),
        "o_custkey",
        "l_shipdate",
        F.trunc(F.to_date("l_shipdate"), "month").alias("month"),
    )
    users = t.orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("level"))
    return pricing.price_model_features(
        requests, monthly_prices(t), users, promo(t), weekly_rivals(t), "sku", "o_custkey", "month", "l_shipdate", 2
    )


@query(
    "pr_12_competitiveness_total",
    "n bigint, at_or_below double, n_below bigint",
    f"""SELECT count(*) AS n, avg(CAST(l_extendedprice / l_quantity <= rival AS INT)) AS at_or_below, sum(CAST(l_extendedprice / l_quantity <= rival AS INT)) AS n_below
        FROM lineitem JOIN {RIVALS_SQL} r ON l_partkey = sku AND year(l_shipdate) = y WHERE l_returnflag <> 'R'""",
)
def competitiveness_total(t):
    own, rivals = own_and_rivals(t)
    return pricing.competitiveness(own, rivals, ["sku", "y"], "price", "rival", [])


PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "pr_13_price_path",
    "month date, " + ", ".join(f"{p.lower()} double" for p in PART_TYPES),
    "SELECT date_trunc('month', l_shipdate) AS month, "
    + ", ".join(f"avg(l_extendedprice) FILTER (p_type = '{p}') AS {p.lower()}" for p in PART_TYPES)
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
)
def price_path(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.trunc(F.to_date("l_shipdate"), "month").alias("month"), "p_type", "l_extendedprice"
    )
    wide = pricing.path_pivot(rows, "month", "p_type", PART_TYPES, "l_extendedprice")
    return wide.withColumnsRenamed({p: p.lower() for p in PART_TYPES})


LOG_SQL = "(SELECT event_id, ts, user_id, event_type AS arm, CAST(value > 50 AS INT) AS reward, value FROM events)"


def pull_log(t):
    return t.events.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("arm"), (F.col("value") > 50).cast("int").alias("reward"), "value"
    )


ARMS_SQL = f"SELECT arm, count(*) AS pulls, sum(reward) AS rewards, avg(reward) AS mean FROM {LOG_SQL} GROUP BY 1"


@query("bd_01_arm_stats", "arm string, pulls bigint, rewards bigint, mean double", ARMS_SQL)
def arm_stats(t):
    return bandit.arm_stats(pull_log(t), "arm", "reward")


U = "CAST(concat('0x', substr(md5({}), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE"


@query(
    "bd_02_epsilon_greedy",
    "c_custkey bigint, choice string",
    f"""WITH s AS ({ARMS_SQL}), a AS (SELECT list(arm ORDER BY arm) AS arms, max_by(arm, mean) AS best FROM s)
        SELECT c_custkey, CASE WHEN {U.format("c_custkey || '_0_explore'")} < 0.2 THEN arms[CAST(concat('0x', md5(c_custkey || '_0_arm'))::UHUGEINT % len(arms)::UHUGEINT AS INT) + 1] ELSE best END AS choice FROM customer, a""",
)
def epsilon_greedy(t):
    return bandit.epsilon_greedy(t.customer.select("c_custkey"), "c_custkey", arm_stats(t), "arm", 0.2)


@query(
    "bd_03_ucb",
    "arm string, pulls bigint, score double",
    f"WITH s AS ({ARMS_SQL}) SELECT arm, pulls, mean + sqrt(2 * ln((SELECT sum(pulls) FROM s)) / pulls) AS score FROM s",
)
def ucb(t):
    return bandit.ucb(arm_stats(t), "arm")


@query("bd_04_posterior", "arm string, a double, b double", f"SELECT arm, 1 + sum(reward) AS a, 1 + sum(1 - reward) AS b FROM {LOG_SQL} GROUP BY 1")
def posterior(t):
    return bandit.posterior(pull_log(t), "arm", "reward")


@query("bd_04_thompson_choice", "c_custkey bigint, choice string")
def thompson_choice(t):
    return bandit.thompson(t.customer.select("c_custkey"), "c_custkey", posterior(t), "arm")


MEANS = {"view": 0.3, "click": 0.5, "purchase": 0.7, "signup": 0.4, "error": 0.1}


@query(
    "bd_05_cumulative_regret",
    "event_id bigint, i bigint, regret double",
    f"""SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS i, row_number() OVER (ORDER BY ts, event_id) * 0.7::DOUBLE - sum(CASE arm {" ".join(f"WHEN '{a}' THEN {p}::DOUBLE" for a, p in MEANS.items())} END)
        OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS regret FROM {LOG_SQL}""",
)
def cumulative_regret(t):
    return bandit.cumulative_regret(pull_log(t), ["ts", "event_id"], "arm", MEANS)


CONTEXT_SQL = f"(SELECT event_id, arm, reward, ln(1 + value) AS f1, hour(ts) / 24.0::DOUBLE AS f2 FROM {LOG_SQL})"


def bandit_rows(t):
    return pull_log(t).select(
        "event_id", "arm", "reward", F.log1p("value").alias("f1"), (F.hour("ts") / 24).alias("f2")
    )


XS = ["1.0", "f1", "f2"]


@query(
    "bd_06_linear_stats",
    "arm string, n bigint, yy double, " + ", ".join([f"xx_{i}_{j} double" for i in range(3) for j in range(i, 3)] + [f"xy_{i} double" for i in range(3)]),
    "SELECT arm, count(*) AS n, sum(reward * reward) AS yy, "
    + ", ".join([f"sum({XS[i]} * {XS[j]}) AS xx_{i}_{j}" for i in range(3) for j in range(i, 3)] + [f"sum({XS[i]} * reward) AS xy_{i}" for i in range(3)])
    + f" FROM {CONTEXT_SQL} GROUP BY 1",
)
def linear_stats(t):
    return bandit.sufficient_stats(bandit_rows(t), "arm", ["f1", "f2"], "reward")


# the ridge weights per arm: the 3 x 3 system solved by cofactors
WEIGHTS_SQL = f"""(SELECT arm, (c00 * y0 + c01 * y1 + c02 * y2) / det AS w0, (c01 * y0 + c11 * y1 + c12 * y2) / det AS w1, (c02 * y0 + c12 * y1 + c22 * y2) / det AS w2
   FROM (SELECT *, a * c00 + b * c01 + c * c02 AS det
         FROM (SELECT *, d * f - e * e AS c00, c * e - b * f AS c01, b * e - c * d AS c02, a * f - c * c AS c11, b * c - a * e AS c12, a * d - b * b AS c22
               FROM (SELECT arm, count(*) + 0.25::DOUBLE AS a, sum(f1) AS b, sum(f2) AS c, sum(f1 * f1) + 0.25::DOUBLE AS d, sum(f1 * f2) AS e, sum(f2 * f2) + 0.25::DOUBLE AS f,
                            sum(reward) AS y0, sum(f1 * reward) AS y1, sum(f2 * reward) AS y2 FROM {CONTEXT_SQL} GROUP BY 1))))"""


@query(
    "bd_06_linear_choice",
    "event_id bigint, choice string, expected fixed",
    f"""SELECT event_id, w.arm AS choice, w0 + w1 * f1 + w2 * f2 AS expected FROM {CONTEXT_SQL} r, {WEIGHTS_SQL} w
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY expected DESC NULLS LAST, w.arm) = 1""",
)
def linear_choice(t):
    weights = bandit.linear_weights(linear_stats(t), "arm", 2)
    return bandit.linear_choice(bandit_rows(t), ["f1", "f2"], weights)


@query(
    "bd_07_context",
    "event_id bigint, year bigint, week_num bigint, dates_int bigint, sale double, previous double, quality double",
    """WITH j AS (SELECT e.event_id, e.ts, e.user_id, coalesce(e.value, 0) AS sale, l.quality FROM events e LEFT JOIN labels l ON l.doc_id = e.event_id)
       SELECT event_id, isoyear(ts) AS year, week(ts) AS week_num, epoch_us(ts) // 86400000000 AS dates_int, sale, coalesce(lag(sale) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS previous, quality FROM j""",
)
def context(t):
    log = t.events.select("event_id", "ts", "user_id", F.col("event_type").alias("action"))
    predictions = t.labels.select(F.col("doc_id").alias("event_id"), "quality")
    sales = t.events.select("event_id", F.col("value").alias("sale"))
    return bandit.context(log, predictions, sales, ["event_id"], "user_id", "ts", "sale")


#: components of a vector in ``embeddings``
DIMENSIONS = 64


@query("ml_01_saved_model_scoring", "vec_id bigint, predicted_label string")
def saved_model_scoring(t):
    parts = [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(DIMENSIONS)]
    rows = t.embeddings.select("vec_id", F.concat(F.lit("class "), F.col("label")).alias("name"), *parts)
    path = scratch(t, "classifier")
    scoring.fit_classifier(rows, [f"e{i}" for i in range(DIMENSIONS)], "name", path, trees=5)
    return scoring.score_saved(rows, path)


@query("ml_02_parameter_sweep", "params string, mse double")
def parameter_sweep(t):
    rows = price_rows(t).withColumn("held", uniform(F.col("id"), "hold") < 0.3)
    grid = [{"numTrees": n, "maxDepth": 3} for n in (2, 5)]
    return scoring.sweep(rows.where("NOT held"), rows.where("held"), FEATURES, "y", grid)


@query("ml_03_hyper_parameters", "draw bigint, params string, rmse double, holdout_rmse double")
def hyper_parameters(t):
    space = {"maxDepth": search.steps(2, 8, 1), "numTrees": search.steps(5, 20, 5), "minInstancesPerNode": search.choice(1, 5, 20)}
    return search.search_regression(price_rows(t), "id", FEATURES, "y", space, n_iter=5)


def drops(t, df, name: str, order: str, edges: list[str], each_drop):
    """Write the rows in time order as several arrivals and run the stream after each."""
    path, checkpoint = scratch(t, f"{name}-in"), scratch(t, f"{name}-offsets")
    cuts = ["1900-01-01", *edges, "2100-01-01"]
    for begin, end in zip(cuts, cuts[1:]):
        df.where(half_open(order, begin, end)).write.mode("append").parquet(path)
        each_drop(t.spark.readStream.schema(df.schema).parquet(path), checkpoint)


@query(
    "st_01_sequential_stream",
    "event_type string, result double, length bigint",
    DECIDE_SQL.format(step=1, path=f"SELECT event_type, i, sum({LLR}) OVER (PARTITION BY event_type ORDER BY i) AS z FROM (SELECT *, a - b AS d FROM {PAIRS_SQL})"),
)
def sequential_stream(t):
    rows = grouped_events(t).select(
        F.col("event_type").alias("key"), "grp", F.col("ts").alias("time"), F.col("event_id").alias("tie"), "value"
    )
    decisions = keyed.sequential_decisions(t.spark, scratch(t, "sequential"))

    def arrived(stream, checkpoint):
        updates = keyed.sequential_updates(
            stream, "pilot", "control", sequential.normal_array(0, 60), sequential.normal_array(6, 60)
        )
        decisions.run_available(updates, checkpoint)

    drops(t, rows, "sequential", "time", ["2024-01-08", "2024-01-19"], arrived)
    return decisions.latest().withColumnRenamed("key", "event_type")


@query(
    "agg_01_stream",
    "day date, revenue double, number_purchases double, average_check double, average_number_items double",
    """WITH c AS (SELECT CAST(ts AS DATE) AS day, user_id, sum(value) AS chk, count(value) AS items FROM events GROUP BY 1, 2)
       SELECT day, sum(chk) AS revenue, count(user_id) AS number_purchases, avg(chk) AS average_check, avg(items) AS average_number_items FROM c
       WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1""",
)
def daily_sales_stream(t):
    """Daily metrics of events as they arrive, a user's day being a purchase; days that the watermark has passed."""
    path = scratch(t, "daily-out")
    run = lambda stream, checkpoint: keyed.append_available(keyed.daily_sales(stream, "value", "ts", "user_id", "1 hour"), path, checkpoint)
    drops(t, t.events.select("ts", "user_id", "value"), "daily", "ts", ["2024-01-08", "2024-01-19"], run)
    return t.spark.read.parquet(path)


# an answer takes the mean paid before its own arrival, so each arrival builds on the ones before
PRICE_LOOP_SQL = f"""WITH r AS (SELECT id, sku, d, p_retailprice AS listed, CAST({U.format("id || '_bought'")} < 0.5 AS DOUBLE) AS bought
      FROM (SELECT l_orderkey || '-' || l_partkey AS id, l_partkey AS sku, max(l_shipdate) AS d FROM lineitem GROUP BY 1, 2) LEFT JOIN part ON sku = p_partkey),
   a1 AS (SELECT id, sku, listed AS price, bought FROM r WHERE d < DATE '1998-01-01'),
   p1 AS (SELECT sku, avg(price) AS paid FROM a1 WHERE bought = 1 GROUP BY 1),
   a2 AS (SELECT id, sku, coalesce(paid, listed) AS price, bought FROM r LEFT JOIN p1 USING (sku) WHERE d >= DATE '1998-01-01' AND d < DATE '2000-01-01'),
   p2 AS (SELECT sku, avg(price) AS paid FROM (FROM a1 UNION ALL FROM a2) WHERE bought = 1 GROUP BY 1),
   a3 AS (SELECT id, sku, coalesce(paid, listed) AS price, bought FROM r LEFT JOIN p2 USING (sku) WHERE d >= DATE '2000-01-01')
   SELECT * FROM (FROM a1 UNION ALL FROM a2 UNION ALL FROM a3)"""


@query("st_02_price_loop", "id string, sku bigint, price double, bought double", PRICE_LOOP_SQL)
def price_loop(t):
    """Price = mean of what the history paid for the part, or the list price for new parts.

    A request is a part of an order; it arrives with its last line.
    """
    listed = t.part.select(F.col("p_partkey").alias("sku"), F.col("p_retailprice").alias("listed"))

    def price(batch, history):
        paid = history.where("bought = 1").groupBy("sku").agg(F.avg("price").alias("paid"))
        joined = batch.join(paid, "sku", "left").join(listed, "sku", "left")
        return joined.select("id", "sku", F.coalesce("paid", "listed").alias("price"))

    feedback = lambda answered: answered.select("id", (uniform(F.col("id"), "bought") < 0.5).cast("double").alias("bought"))
    job = jobs.PriceLoop(t.spark, scratch(t, "prices"), price, feedback, id_type="string")
    rows = t.lineitem.groupBy(
        F.concat_ws("-", "l_orderkey", "l_partkey").alias("id"), F.col("l_partkey").alias("sku")
    ).agg(F.max("l_shipdate").alias("l_shipdate"))
    drops(t, rows, "prices", "l_shipdate", ["1998-01-01", "2000-01-01"], lambda s, c: jobs.run_available(s, c, job.each))
    return job.history()


@query("st_03_arm_stats_stream", "arm string, pulls bigint, rewards bigint, mean double", ARMS_SQL)
def arm_stats_stream(t):
    out = jobs.Versions(t.spark, scratch(t, "arms"))
    each = lambda batch, number: out.write("stats", number, batch)
    drops(
        t, pull_log(t), "arms", "ts", ["2024-01-10", "2024-01-20"],
        lambda s, c: jobs.run_available(jobs.arm_stats_stream(s, "arm", "reward"), c, each, "complete"),
    )
    return out.latest("stats", "arm string, pulls bigint, rewards bigint, mean double")


LINEAR_OUT, LINEAR_SQL = QUERIES["bd_06_linear_stats"].columns, QUERIES["bd_06_linear_stats"].sql


@query("st_05_linear_stats_stream", ", ".join(f"{c} {kind}" for c, kind in LINEAR_OUT), LINEAR_SQL)
def linear_stats_stream(t):
    """What the linear bandit needs of the log, kept up to date as pulls arrive."""
    out = jobs.Versions(t.spark, scratch(t, "linear"))
    sufficient = lambda s: bandit.sufficient_stats(s, "arm", ["f1", "f2"], "reward")
    rows = bandit_rows(t).join(t.events.select("event_id", "ts"), "event_id")
    drops(
        t, rows, "linear", "ts", ["2024-01-10", "2024-01-20"],
        lambda s, c: jobs.run_available(sufficient(s), c, lambda batch, number: out.write("stats", number, batch), "complete"),
    )
    return out.latest("stats", sufficient(rows).schema.simpleString()[len("struct<"):-1].replace(":", " "))


@query(
    "st_04_assignment_stream",
    "user_id bigint, slot bigint, experiment_id string, grp string",
    f"""WITH h AS (SELECT DISTINCT user_id, CAST(concat('0x', md5(user_id || 's1'))::UHUGEINT % {SLOTS} AS INT) AS slot FROM events)
        SELECT user_id, slot, experiment_id, CASE WHEN concat('0x', md5(user_id || experiment_id || 's2'))::UHUGEINT % 2 = 1 THEN 'pilot' ELSE 'control' END AS grp FROM h JOIN {HELD_SQL} USING (slot)""",
)
def assignment_stream(t):
    slots, out = held_slots(t), scratch(t, "assigned")

    def each_drop(stream, checkpoint):
        made = jobs.assign_stream(stream.select("user_id"), "user_id", slots, SLOTS, "s1", "s2")
        made.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()

    first_seen = t.events.groupBy("user_id").agg(F.min("ts").alias("ts"))
    drops(t, first_seen, "assigned", "ts", ["2024-01-02"], each_drop)
    return t.spark.read.parquet(out).withColumnRenamed("group", "grp")
