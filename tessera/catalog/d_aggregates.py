"""Aggregations over sales, users, prices and experiment groups."""

from pyspark.sql import functions as F

from tessera.catalog.c_joins import campaign_tables, promo, PROMO_SQL
from tessera.catalog.registry import query
from tessera.functions.columns import bins_by_edges, bins_equal_width, epoch_micros, half_open, quantile_edges, scalar
from tessera.functions.hashing import md5_mod
from tessera.operators import joins, sales
from tessera.operators.features import feature_table
from tessera.plans.prefix import exact_quantiles

RECEIPTS_SQL = """(SELECT o_custkey AS customer_id, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS date,
  amt AS purchase_amt, o_totalprice AS purchase_sum, disc AS discount, store_id FROM orders JOIN
  (SELECT l_orderkey, sum(l_quantity) AS amt, sum(l_extendedprice * l_discount) AS disc, max(l_suppkey) AS store_id FROM lineitem GROUP BY 1)
  ON l_orderkey = o_orderkey)"""


@query(
    "agg_01_daily_sales_metrics",
    "day date, revenue double, number_purchases double, average_check double, average_number_items double",
    """WITH c AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey, sum(l_extendedprice) AS chk, count(l_extendedprice) AS items
         FROM orders JOIN lineitem ON o_orderkey = l_orderkey
         WHERE o_orderdate >= DATE '2001-01-01' AND o_orderdate < DATE '2001-09-01' AND l_returnflag IN ('A', 'N') GROUP BY 1, 2),
       a AS (SELECT d, sum(chk) AS revenue, count(*) AS number_purchases, avg(chk) AS average_check, avg(items) AS average_number_items FROM c GROUP BY 1)
       SELECT CAST(r.d AS DATE) AS day, coalesce(revenue, 0) AS revenue, coalesce(number_purchases, 0) AS number_purchases,
         coalesce(average_check, 0) AS average_check, coalesce(average_number_items, 0) AS average_number_items
       FROM range(DATE '2001-01-01', DATE '2001-09-01', INTERVAL 1 DAY) r(d) LEFT JOIN a ON a.d = r.d""",
)
def daily_sales(t):
    lines = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return sales.daily_sales_metrics(
        lines,
        "l_extendedprice",
        "o_orderdate",
        "o_orderkey",
        {"begin": "2001-01-01", "end": "2001-09-01"},
        {"l_returnflag": ["A", "N"]},
    )


@query(
    "agg_02_user_metric",
    "c_custkey bigint, metric double",
    """SELECT c_custkey, coalesce(s, 0) AS metric FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS s FROM orders
       WHERE o_orderdate >= DATE '1999-01-01' AND o_orderdate < DATE '1999-03-01' GROUP BY 1) ON o_custkey = c_custkey""",
)
def user_metric(t):
    rows = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return sales.user_metric(
        rows, "o_totalprice", "c_custkey", t.customer, "o_orderdate", {"begin": "1999-01-01", "end": "1999-03-01"}, "metric"
    )


@query(
    "agg_03_two_level",
    "month string, avg_check double, avg_items double",
    """SELECT month, avg(chk) AS avg_check, avg(items) AS avg_items FROM (SELECT strftime(l_shipdate, '%Y-%m') AS month, l_orderkey,
       sum(l_extendedprice) AS chk, count(*) AS items FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
)
def two_level(t):
    month = F.date_format("l_shipdate", "yyyy-MM").alias("month")
    receipt = t.lineitem.groupBy(month, "l_orderkey").agg(
        F.sum("l_extendedprice").alias("chk"), F.count("*").alias("items")
    )
    return receipt.groupBy("month").agg(F.avg("chk").alias("avg_check"), F.avg("items").alias("avg_items"))


BASIC = "sum max min mean".split()


@query(
    "agg_04_receipt_stats",
    "customer_id bigint, s double, mx double, mn double, av double, disc double, first_day double, last_day double, n double, gap double, since double, n60 double",
    f"""WITH r AS {RECEIPTS_SQL},
       x AS (SELECT customer_id, sum(purchase_sum) AS s, max(purchase_sum) AS mx, min(purchase_sum) AS mn, avg(purchase_sum) AS av, sum(discount) AS disc,
         min(date) AS first_day, max(date) AS last_day, count(*) AS n, CASE WHEN count(*) > 1 THEN (max(date) - min(date)) / (count(*) - 1) END AS gap,
         2000 - max(date) AS since FROM r WHERE date >= 1635 AND date < 2000 GROUP BY 1),
       y AS (SELECT customer_id, count(*) AS n60 FROM r WHERE date >= 1940 AND date < 2000 GROUP BY 1)
       SELECT * FROM x FULL JOIN y USING (customer_id)""",
)
def receipt_stats(t):
    config = [
        {"name": "receipts_basic", "args": {"date_to": 2000, "delta": 365}},
        {"name": "purchases_agg", "args": {"date_to": 2000, "delta": 60}},
    ]
    names = {
        "purchase_sum_sum__365d": "s",
        "purchase_sum_max__365d": "mx",
        "purchase_sum_min__365d": "mn",
        "purchase_sum_mean__365d": "av",
        "discount_sum__365d": "disc",
        "date_min__365d": "first_day",
        "date_max__365d": "last_day",
        "date_count__365d": "n",
        "mean_interval__365d": "gap",
        "time_since_last__365d": "since",
        "purchases_60d__count": "n60",
    }
    return feature_table(campaign_tables(t), config).withColumnsRenamed(names)


@query(
    "agg_05_config_aggregates",
    "l_suppkey bigint, l_quantity_sum double, l_quantity_max double, l_tax_mean double",
    "SELECT l_suppkey, sum(l_quantity) AS l_quantity_sum, max(l_quantity) AS l_quantity_max, avg(l_tax) AS l_tax_mean FROM lineitem GROUP BY 1",
)
def config_aggregates(t):
    return sales.grouped(t.lineitem, ["l_suppkey"], {"l_quantity": ["sum", "max"], "l_tax": ["mean"]})


@query(
    "agg_06_purchases_window",
    "customer_id bigint, n double, total double",
    f"SELECT customer_id, count(date) AS n, sum(purchase_sum) AS total FROM {RECEIPTS_SQL} WHERE date >= 1910 AND date < 2000 GROUP BY 1",
)
def purchases_window(t):
    out = feature_table(campaign_tables(t), [{"name": "purchases_agg", "args": {"date_to": 2000, "delta": 90}}])
    return out.withColumnsRenamed({"purchases_90d__count": "n", "purchase_sum_90d__sum": "total"})


@query(
    "agg_07_weekday_counts",
    "customer_id bigint, wd0 double, wd1 double, wd2 double, wd3 double, wd4 double, wd5 double, wd6 double, weekend double",
    f"""SELECT customer_id, {", ".join(f"count(*) FILTER (date % 7 = {d}) AS wd{d}" for d in range(7))},
        count(*) FILTER (date % 7 IN (5, 6)) / count(*) AS weekend FROM {RECEIPTS_SQL} WHERE date >= 1635 AND date < 2000 GROUP BY 1""",
)
def weekday_counts(t):
    config = [{"name": "day_of_week", "args": {"date_to": 2000, "delta": 365, "weekends": [5, 6]}}]
    names = {f"purchases_wd{d}_365d__count": f"wd{d}" for d in range(7)} | {"weekend_purchases_365d__ratio": "weekend"}
    return feature_table(campaign_tables(t), config).withColumnsRenamed(names)


@query(
    "agg_08_favourite_store",
    "customer_id bigint, store bigint",
    f"""SELECT customer_id, store_id AS store FROM {RECEIPTS_SQL} WHERE date >= 1000 AND date < 2000 GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, store_id DESC) = 1""",
)
def favourite_store(t):
    config = [{"name": "favourite_store", "args": {"date_to": 2000, "delta": 1000}}]
    return feature_table(campaign_tables(t), config).withColumnRenamed("favourite_store_1000d", "store")


@query(
    "agg_09_exact_distinct",
    "l_returnflag string, parts bigint, close_enough bigint",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, 1 AS close_enough FROM lineitem GROUP BY 1",
)
def exact_distinct(t):
    sketch = t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("about"))
    exact = t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))
    near = F.abs(F.col("about") / F.col("parts") - 1) < 0.1
    return exact.join(sketch, "l_returnflag").withColumn("close_enough", near.cast("int"))


@query(
    "agg_10_offer_targets",
    "customer_id bigint, amount double, discount double",
    f"SELECT customer_id, sum(purchase_amt) AS amount, sum(discount) AS discount FROM {RECEIPTS_SQL} WHERE date >= 2000 AND date < 2030 GROUP BY 1",
)
def offer_targets(t):
    receipts = campaign_tables(t).get("receipts").where(half_open("date", 2000, 2030))
    return receipts.groupBy("customer_id").agg(F.sum("purchase_amt").alias("amount"), F.sum("discount").alias("discount"))


@query(
    "agg_11_vendors_per_file",
    "src string, vendors bigint, lo double, hi double",
    """SELECT l_returnflag AS src, count(DISTINCT l_suppkey) AS vendors, min(l_extendedprice / l_quantity) AS lo, max(l_extendedprice / l_quantity) AS hi
       FROM lineitem GROUP BY 1""",
)
def vendors_per_file(t):
    files = {flag: t.lineitem.where(F.col("l_returnflag") == flag) for flag in ("A", "N", "R")}
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        joins.tagged_union(files, "src")
        .groupBy("src")
        .agg(F.count_distinct("l_suppkey").alias("vendors"), F.min(unit).alias("lo"), F.max(unit).alias("hi"))
    )


@query(
    "agg_12_counts_per_sku",
    "sku bigint, rows_n bigint, price_gaps bigint, promo_rows bigint, rival_rows bigint",
    f"""SELECT l_partkey AS sku, count(*) AS rows_n, count(*) FILTER (l_tax = 0) AS price_gaps, count(p.discount) AS promo_rows, count(r.lo) AS rival_rows
        FROM lineitem LEFT JOIN {PROMO_SQL} p ON l_partkey = sku AND isoyear(l_shipdate) = year AND week(l_shipdate) = week_num
        LEFT JOIN (SELECT l_partkey AS k, min(l_extendedprice) AS lo FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) > 10) r ON l_partkey = k
        GROUP BY 1""",
)
def counts_per_sku(t):
    lines = t.lineitem.withColumnRenamed("l_partkey", "sku")
    rivals = (
        lines.where("l_returnflag = 'R'")
        .groupBy("sku")
        .agg(F.min("l_extendedprice").alias("lo"), F.count("*").alias("c"))
        .where("c > 10")
    )
    joined = joins.join_weekly(lines, promo(t), "sku", "l_shipdate").join(rivals, "sku", "left")
    return joined.groupBy("sku").agg(
        F.count("*").alias("rows_n"),
        F.count_if(F.col("l_tax") == 0).alias("price_gaps"),
        F.count("discount").alias("promo_rows"),
        F.count("lo").alias("rival_rows"),
    )


@query(
    "agg_13_promo_effect",
    "sku bigint, with_promo double, without_promo double, diff double",
    f"""SELECT l_partkey AS sku, avg(l_quantity) FILTER (p.discount IS NOT NULL) AS with_promo, avg(l_quantity) FILTER (p.discount IS NULL) AS without_promo,
        avg(l_quantity) FILTER (p.discount IS NOT NULL) - avg(l_quantity) FILTER (p.discount IS NULL) AS diff
        FROM lineitem LEFT JOIN {PROMO_SQL} p ON l_partkey = sku AND isoyear(l_shipdate) = year AND week(l_shipdate) = week_num GROUP BY 1""",
)
def promo_effect(t):
    from tessera.operators.pricing import promo_effect as effect

    lines = t.lineitem.withColumnRenamed("l_partkey", "sku")
    return effect(joins.join_weekly(lines, promo(t), "sku", "l_shipdate"), "sku", "l_quantity", "discount")


RIVALS_SQL = """(SELECT l_partkey AS sku, year(l_shipdate) AS y, min(l_extendedprice / l_quantity) AS rival FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)"""


@query(
    "agg_14_competitiveness",
    "sku bigint, n bigint, at_or_below double",
    f"""SELECT l_partkey AS sku, count(*) AS n, avg(CAST(l_extendedprice / l_quantity <= rival AS INT)) AS at_or_below FROM lineitem
        JOIN {RIVALS_SQL} r ON l_partkey = sku AND year(l_shipdate) = y WHERE l_returnflag <> 'R' GROUP BY 1""",
)
def competitiveness(t):
    from tessera.operators.pricing import competitiveness as report

    own, rivals = own_and_rivals(t)
    return report(own, rivals, ["sku", "y"], "price", "rival", ["sku"])


def own_and_rivals(t):
    """Own unit prices, and the cheapest returned-item price per part and year as the rival price."""
    unit = (F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    lines = t.lineitem.select(
        F.col("l_partkey").alias("sku"), F.year("l_shipdate").alias("y"), unit, "l_returnflag", "l_orderkey", "l_linenumber"
    )
    return lines.where("l_returnflag <> 'R'"), lines.where("l_returnflag = 'R'").withColumnRenamed("price", "rival").select(
        "sku", "y", "rival"
    )


@query(
    "agg_15_price_summary",
    "day date, sku bigint, max_true double, avg_true double, min_true double, max_paid double, avg_paid double, min_paid double",
    """SELECT l_shipdate AS day, l_partkey AS sku, max(p / (1 - d)) AS max_true, avg(p / (1 - d)) AS avg_true, min(p / (1 - d)) AS min_true,
       max(p) AS max_paid, avg(p) AS avg_paid, min(p) AS min_paid FROM (SELECT *, l_extendedprice AS p, l_discount AS d FROM lineitem) GROUP BY 1, 2""",
)
def price_summary(t):
    from tessera.operators.pricing import price_summary as summary

    return summary(
        t.lineitem.select(F.col("l_shipdate").alias("day"), F.col("l_partkey").alias("sku"), "l_extendedprice", "l_discount"),
        ["day", "sku"],
        "l_extendedprice",
        "l_discount",
    )


@query(
    "agg_16_popularity",
    "kind string, id bigint, purchases bigint, others bigint",
    """SELECT 'part' AS kind, l_partkey AS id, count(*) AS purchases, count(DISTINCT o_custkey) AS others FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 2
       UNION ALL SELECT 'customer', o_custkey, count(*), count(DISTINCT l_partkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 2""",
)
def popularity(t):
    sold = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_partkey", "o_custkey")
    # one row per (part, customer) first: both sides of the report reuse the smaller table
    pairs = sold.groupBy("l_partkey", "o_custkey").agg(F.count("*").alias("n"))
    parts = pairs.groupBy(F.col("l_partkey").alias("id")).agg(F.sum("n").alias("purchases"), F.count("*").alias("others"))
    people = pairs.groupBy(F.col("o_custkey").alias("id")).agg(F.sum("n").alias("purchases"), F.count("*").alias("others"))
    return joins.tagged_union({"part": parts, "customer": people}, "kind")


@query(
    "agg_17_argmax_per_month",
    "month string, o_orderkey bigint, price double",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, o_totalprice AS price FROM orders
       QUALIFY row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def argmax_per_month(t):
    best = F.struct("o_totalprice", -F.col("o_orderkey"))
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.max_by("o_orderkey", best).alias("o_orderkey"), F.max("o_totalprice").alias("price")
    )


@query(
    "agg_18_quantiles",
    "l_returnflag string, q70_day double, q90 double, q95 double, q99 double",
    """SELECT l_returnflag, quantile_cont(epoch_us(l_shipdate) / 86400000000, 0.7) AS q70_day, quantile_cont(l_extendedprice, 0.9) AS q90,
       quantile_cont(l_extendedprice, 0.95) AS q95, quantile_cont(l_extendedprice, 0.99) AS q99 FROM lineitem GROUP BY 1""",
)
def quantiles(t):
    day = epoch_micros("l_shipdate") / 86400000000
    pair = lambda name, value: F.struct(F.lit(name).alias("metric"), value.alias("x"))
    long = t.lineitem.select("l_returnflag", F.inline(F.array(pair("day", day), pair("price", F.col("l_extendedprice")))))
    found = exact_quantiles(long, ["l_returnflag", "metric"], "x", {"q70": 0.7, "q90": 0.9, "q95": 0.95, "q99": 0.99})
    of = lambda metric, q: F.max(F.when(F.col("metric") == metric, F.col(q)))
    return found.groupBy("l_returnflag").agg(
        of("day", "q70").alias("q70_day"), *[of("price", q).alias(q) for q in ("q90", "q95", "q99")]
    )


@query(
    "agg_19_gap_stats",
    "sku bigint, max_gap double, median_gap double",
    """SELECT sku, max(g) AS max_gap, median(g) AS median_gap FROM (SELECT sku, date_diff('day', lag(d) OVER (PARTITION BY sku ORDER BY d), d) AS g
       FROM (SELECT DISTINCT l_partkey AS sku, CAST(l_shipdate AS DATE) AS d FROM lineitem)) GROUP BY 1""",
)
def gap_stats(t):
    from tessera.operators.pricing import gap_stats as stats

    return stats(t.lineitem.withColumnRenamed("l_partkey", "sku"), "sku", "l_shipdate")


GROUPED_EVENTS = """(SELECT *, CASE WHEN CAST(concat('0x', md5(CAST(user_id AS VARCHAR)))::UHUGEINT % 2 AS INT) = 1 THEN 'pilot' ELSE 'control' END AS grp FROM events)"""


def grouped_events(t):
    """Events with the user's hash group."""
    pilot = md5_mod(F.col("user_id").cast("string"), 2) == 1
    return t.events.withColumn("grp", F.when(pilot, "pilot").otherwise("control"))


@query(
    "agg_20_group_traffic",
    "grp string, traffic bigint, users bigint, revenue double, mean_value double",
    f"SELECT grp, count(*) AS traffic, count(DISTINCT user_id) AS users, sum(value) AS revenue, avg(value) AS mean_value FROM {GROUPED_EVENTS} GROUP BY 1",
)
def group_traffic(t):
    return (
        grouped_events(t)
        .groupBy("grp")
        .agg(
            F.count("*").alias("traffic"),
            F.count_distinct("user_id").alias("users"),
            F.sum("value").alias("revenue"),
            F.avg("value").alias("mean_value"),
        )
    )


@query(
    "agg_21_dashboard_pivot",
    "day date, control_click double, control_purchase double, pilot_click double, pilot_purchase double",
    f"""SELECT CAST(ts AS DATE) AS day, {", ".join(f"sum(value) FILTER (grp = '{g}' AND event_type = '{e}') AS {g}_{e}" for g in ("control", "pilot") for e in ("click", "purchase"))}
        FROM {GROUPED_EVENTS} GROUP BY 1""",
)
def dashboard_pivot(t):
    costs = {e: F.when(F.col("event_type") == e, F.col("value")) for e in ("click", "purchase")}
    return (
        grouped_events(t)
        .withColumns(costs)
        .groupBy(F.to_date("ts").alias("day"))
        .pivot("grp", ["control", "pilot"])
        .agg(*[F.sum(e).alias(e) for e in costs])
    )


@query(
    "agg_22_prepilot_vs_pilot",
    "c_custkey bigint, segment string, before double, during double",
    """SELECT c_custkey, c_mktsegment AS segment, before, during FROM customer LEFT JOIN (SELECT o_custkey,
       avg(o_totalprice) FILTER (o_orderdate < DATE '2000-01-01') AS before, avg(o_totalprice) FILTER (o_orderdate >= DATE '2000-01-01') AS during
       FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def prepilot_vs_pilot(t):
    pilot = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    levels = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.avg(F.when(~pilot, F.col("o_totalprice"))).alias("before"),
        F.avg(F.when(pilot, F.col("o_totalprice"))).alias("during"),
    )
    return t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment")).join(levels, "c_custkey", "left")


@query(
    "agg_23_stratum_profile",
    "segment string, bin bigint, n bigint, share double, mean_balance double",
    """SELECT c_mktsegment AS segment, CAST(least(5, greatest(1, ceil((c_nationkey - lo) / ((hi - lo) / 5)))) AS INT) AS bin, count(*) AS n,
       count(*) / (SELECT count(*) FROM customer) AS share, avg(c_acctbal) AS mean_balance
       FROM customer, (SELECT min(c_nationkey)::DOUBLE AS lo, max(c_nationkey)::DOUBLE AS hi FROM customer) GROUP BY 1, 2""",
)
def stratum_profile(t):
    ends = t.customer.agg(F.min("c_nationkey").cast("double").alias("a"), F.max("c_nationkey").cast("double").alias("b"))
    binned = t.customer.withColumn("bin", bins_equal_width(F.col("c_nationkey"), scalar(ends, "a"), scalar(ends, "b"), 5))
    counts = binned.groupBy(F.col("c_mktsegment").alias("segment"), "bin").agg(
        F.count("*").alias("n"), F.avg("c_acctbal").alias("mean_balance")
    )
    return counts.withColumn("share", F.col("n") / scalar(t.customer.agg(F.count("*").alias("c")), "c"))


@query(
    "agg_24_describe",
    "metric string, n double, mean double, std double, lo double, q25 double, q50 double, q75 double, hi double",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS metric, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS lo, quantile_cont({c}, 0.25) AS q25,
        quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS hi FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice")
    ),
)
def describe(t):
    long = t.lineitem.select("l_quantity", "l_extendedprice").unpivot([], ["l_quantity", "l_extendedprice"], "metric", "value")
    basic = long.groupBy("metric").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
    )
    return basic.join(exact_quantiles(long, ["metric"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}), "metric")


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "agg_25_correlations",
    "a string, b string, r double",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem" for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :]
    ),
)
def correlations(t):
    pairs = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :]]
    wide = t.lineitem.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], wide.columns, "pair", "r")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("a"), F.split_part("pair", F.lit("|"), F.lit(2)).alias("b"), "r")


@query(
    "agg_26_kendall",
    "tau double",
    """WITH c AS (SELECT l_linenumber AS x, l_discount AS y, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2),
       s AS (SELECT sum(a.n * b.n * sign(b.y - a.y)) AS s FROM c a JOIN c b ON a.x < b.x),
       tx AS (SELECT sum(t * (t - 1) / 2) AS v FROM (SELECT sum(n) AS t FROM c GROUP BY x)),
       ty AS (SELECT sum(t * (t - 1) / 2) AS v FROM (SELECT sum(n) AS t FROM c GROUP BY y)),
       al AS (SELECT t * (t - 1) / 2 AS v FROM (SELECT sum(n) AS t FROM c))
       SELECT s.s / sqrt((al.v - tx.v) * (al.v - ty.v)) AS tau FROM s, tx, ty, al""",
)
def kendall(t):
    return sales.kendall_tau_b(t.lineitem, "l_linenumber", "l_discount")


@query(
    "agg_27_effect_table",
    "target string, control_mean double, treated_mean double, effect double, relative double",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS target, avg({c}) FILTER (grp = 'control') AS control_mean, avg({c}) FILTER (grp = 'pilot') AS treated_mean,
        avg({c}) FILTER (grp = 'pilot') - avg({c}) FILTER (grp = 'control') AS effect,
        avg({c}) FILTER (grp = 'pilot') / avg({c}) FILTER (grp = 'control') - 1 AS relative
        FROM (SELECT *, CAST(event_type = 'purchase' AS INT) AS bought FROM {GROUPED_EVENTS})"""
        for c in ("value", "bought")
    ),
)
def effect_table(t):
    from tessera.operators.uplift import effect_table as table

    df = grouped_events(t).withColumn("bought", (F.col("event_type") == "purchase").cast("double"))
    return table(df, (F.col("grp") == "pilot").cast("int"), ["value", "bought"])


@query(
    "agg_28_means_by_decile",
    "w string, bin bigint, n bigint, mean_y double",
    f"""WITH e AS (SELECT list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS q FROM events)
        SELECT grp AS w, greatest(1, len(list_filter(q, lambda x: x < value))) AS bin, count(*) AS n, avg(CAST(event_type = 'purchase' AS INT)) AS mean_y
        FROM {GROUPED_EVENTS}, e GROUP BY 1, 2""",
)
def means_by_decile(t):
    probs = {f"q{i}": i / 10 for i in range(11)}
    edges = quantile_edges(exact_quantiles(t.events, [], "value", probs), list(probs))
    df = grouped_events(t).withColumn("bin", bins_by_edges(F.col("value"), edges))
    bought = (F.col("event_type") == "purchase").cast("int")
    return df.groupBy(F.col("grp").alias("w"), "bin").agg(F.count("*").alias("n"), F.avg(bought).alias("mean_y"))


@query(
    "agg_29_target_by_flag",
    "flag bigint, n bigint, total double, mean double, hi double",
    """SELECT CAST(c_mktsegment IN ('BUILDING', 'MACHINERY') AS INT) AS flag, count(*) AS n, sum(c_acctbal) AS total, avg(c_acctbal) AS mean, max(c_acctbal) AS hi
       FROM customer GROUP BY 1""",
)
def target_by_flag(t):
    flag = F.col("c_mktsegment").isin("BUILDING", "MACHINERY").cast("int").alias("flag")
    return t.customer.groupBy(flag).agg(
        F.count("*").alias("n"), F.sum("c_acctbal").alias("total"), F.avg("c_acctbal").alias("mean"), F.max("c_acctbal").alias("hi")
    )


@query(
    "agg_30_histogram",
    "bin bigint, lo double, hi double, n bigint",
    """WITH e AS (SELECT min(value) AS a, max(value) AS b FROM events), c AS (SELECT least(floor((value - a) / ((b - a) / 20)), 19) AS k, count(*) AS n FROM events, e GROUP BY 1)
       SELECT i AS bin, a + i * ((b - a) / 20) AS lo, a + (i + 1) * ((b - a) / 20) AS hi, coalesce(n, 0) AS n FROM range(20) r(i) CROSS JOIN e LEFT JOIN c ON k = i""",
)
def histogram(t):
    return sales.histogram(t.events, "value", 20)


@query(
    "agg_31_daily_summary",
    "day date, n bigint, customers bigint, lo double, av double, hi double",
    """SELECT o_orderdate AS day, count(*) AS n, count(DISTINCT o_custkey) AS customers, min(o_totalprice) AS lo, avg(o_totalprice) AS av, max(o_totalprice) AS hi
       FROM orders GROUP BY 1""",
)
def daily_summary(t):
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n"),
        F.count_distinct("o_custkey").alias("customers"),
        F.min("o_totalprice").alias("lo"),
        F.avg("o_totalprice").alias("av"),
        F.max("o_totalprice").alias("hi"),
    )


@query(
    "agg_32_never_purchased",
    "n bigint",
    "SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2000-01-01')",
)
def never_purchased(t):
    late = t.orders.where(half_open(F.col("o_orderdate"), "2000-01-01", "2100-01-01"))
    return t.customer.join(late, F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.count("*").alias("n"))


@query(
    "agg_33_hierarchy_items",
    "p_type string, colour string, items bigint, brands bigint",
    """SELECT coalesce(p_type, 'all') AS p_type, coalesce(split_part(p_name, ' ', 1), 'all') AS colour, count(DISTINCT p_partkey) AS items, count(DISTINCT p_brand) AS brands
       FROM part GROUP BY ROLLUP (p_type, split_part(p_name, ' ', 1))""",
)
def hierarchy_items(t):
    df = t.part.withColumn("colour", F.split_part("p_name", F.lit(" "), F.lit(1)))
    return (
        df.rollup("p_type", "colour")
        .agg(F.count_distinct("p_partkey").alias("items"), F.count_distinct("p_brand").alias("brands"))
        .fillna("all", ["p_type", "colour"])
    )


@query(
    "agg_34_skewness",
    "event_type string, skew double",
    """SELECT event_type, (avg(value ** 3) - 3 * avg(value) * avg(value ** 2) + 2 * avg(value) ** 3) / stddev_pop(value) ** 3 AS skew FROM events GROUP BY 1""",
)
def skew(t):
    return t.events.groupBy("event_type").agg(F.skewness("value").alias("skew"))


@query(
    "agg_35_value_shares",
    "c_mktsegment string, n bigint, share double",
    "SELECT c_mktsegment, count(*) AS n, count(*) / (SELECT count(*) FROM customer) AS share FROM customer GROUP BY 1",
)
def value_shares(t):
    return sales.shares(t.customer, ["c_mktsegment"])
