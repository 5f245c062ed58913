"""Joins and set operations."""

from pyspark.sql import functions as F

from tessera.catalog.registry import query
from tessera.functions.columns import half_open
from tessera.operators import joins, sales
from tessera.operators.slots import assign, slot_table


@query(
    "jn_01_inner_named_keys",
    "p_brand string, n bigint, revenue double",
    "SELECT p_brand, count(*) AS n, sum(l_extendedprice) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
)
def inner_named_keys(t):
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand")
        .agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("revenue"))
    )


@query(
    "jn_02_inner_shared_key",
    "doc_id bigint, lang string, quality bigint",
    "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)",
)
def inner_shared_key(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id")


@query(
    "jn_03_left_zero_fill",
    "c_custkey bigint, spend double, n bigint",
    """SELECT c_custkey, coalesce(spend, 0) AS spend, coalesce(n, 0) AS n FROM customer LEFT JOIN
       (SELECT o_custkey, sum(o_totalprice) AS spend, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey""",
)
def left_zero_fill(t):
    agg = (
        t.orders.where("o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum("o_totalprice").alias("spend"), F.count("*").alias("n"))
    )
    return joins.left_zero(t.customer.select("c_custkey"), agg, ["c_custkey"], ["spend", "n"])


PROMO_SQL = """(SELECT l_partkey AS sku, isoyear(l_shipdate) AS year, week(l_shipdate) AS week_num, max(l_discount) AS discount
                FROM lineitem WHERE l_discount >= 0.08 GROUP BY 1, 2, 3)"""


def promo(t):
    """Promotions: the deepest discount per part and ISO week, where it is at least 8 %."""
    return (
        joins.week_keys(t.lineitem.where("l_discount >= 0.08").withColumnRenamed("l_partkey", "sku"), "l_shipdate")
        .groupBy("sku", "year", "week_num")
        .agg(F.max("l_discount").alias("discount"))
    )


@query(
    "jn_04_left_join_on_week",
    "l_orderkey bigint, l_linenumber bigint, promo_discount double",
    f"""SELECT l_orderkey, l_linenumber, p.discount AS promo_discount FROM lineitem LEFT JOIN {PROMO_SQL} p
        ON l_partkey = sku AND isoyear(l_shipdate) = year AND week(l_shipdate) = week_num""",
)
def left_join_on_week(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("sku"), "l_shipdate")
    return joins.join_weekly(lines, promo(t), "sku", "l_shipdate").withColumnRenamed("discount", "promo_discount")


@query(
    "jn_05_listed_users",
    "user_id bigint, metric double",
    """SELECT c_custkey AS user_id, coalesce(s, 0) AS metric FROM customer LEFT JOIN
       (SELECT user_id, sum(value) AS s FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-12' GROUP BY 1) ON c_custkey = user_id""",
)
def listed_users(t):
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    return sales.user_metric(
        t.events, "value", "user_id", users, "ts", {"begin": "2024-01-05", "end": "2024-01-12"}, "metric"
    )


@query(
    "jn_06_full_outer_blocks",
    "k bigint, a double, b bigint, c double",
    """WITH x AS (SELECT o_custkey AS k, sum(o_totalprice) AS a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
            y AS (SELECT user_id AS k, count(*) AS b FROM events GROUP BY 1),
            z AS (SELECT s_suppkey AS k, s_acctbal AS c FROM supplier)
       SELECT k, a, b, c FROM x FULL JOIN y USING (k) FULL JOIN z USING (k)""",
)
def full_outer_blocks(t):
    x = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(F.sum("o_totalprice").alias("a"))
    y = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("b"))
    z = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("c"))
    return joins.full_outer([x, y, z], ["k"])


@query(
    "jn_07_date_spine",
    "day date, n bigint",
    """SELECT CAST(d AS DATE) AS day, coalesce(n, 0) AS n FROM range(DATE '2001-06-01', DATE '2001-10-01', INTERVAL 1 DAY) r(d)
       LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) ON od = d""",
)
def date_spine(t):
    n = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return sales.calendar(t.spark, "2001-06-01", "2001-10-01").join(n, "day", "left").fillna(0)


@query(
    "jn_08_left_chain",
    "customer_id bigint, target_group_flag bigint, target_purchase_amt double, target_discount_sum double",
    """SELECT c_custkey AS customer_id, coalesce(flag, 0) AS target_group_flag, coalesce(amt, 0) AS target_purchase_amt,
       coalesce(disc, 0) AS target_discount_sum FROM customer
       LEFT JOIN (SELECT c_custkey AS k, CAST(c_mktsegment IN ('BUILDING', 'MACHINERY') AS INT) AS flag FROM customer WHERE c_acctbal > 0) c ON c_custkey = k
       LEFT JOIN (SELECT o_custkey, sum(l_quantity) AS amt, sum(l_extendedprice * l_discount) AS disc FROM orders JOIN lineitem ON l_orderkey = o_orderkey
         WHERE date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) >= 2000 AND date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) < 2030 GROUP BY 1) r
       ON c_custkey = o_custkey""",
)
def left_chain(t):
    from tessera.operators.features import feature_table

    return feature_table(campaign_tables(t), [{"name": "campaign", "args": {"date_start_offer": 2000, "days_offer": 30}}])


def campaign_tables(t):
    """customers, campaigns and receipts with day numbers since 1995-01-01."""
    from tessera.sources.files import TableRegistry

    customers = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("age"), F.col("c_mktsegment").alias("location")
    )
    campaigns = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").cast("int").alias("target_group_flag"),
    )
    day = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date"))
    receipts = (
        t.orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"), day.alias("date"), "o_totalprice")
        .join(
            t.lineitem.groupBy("l_orderkey").agg(
                F.sum("l_quantity").alias("purchase_amt"),
                F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
                F.max("l_suppkey").alias("store_id"),
            ),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .select(
            "customer_id", "date", "purchase_amt", F.col("o_totalprice").alias("purchase_sum"), "discount", "store_id"
        )
    )
    return TableRegistry({"customers": customers, "campaigns": campaigns, "receipts": receipts})


@query(
    "jn_09_new_buyers",
    "o_custkey bigint",
    """SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-01-01'
       AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2001-01-01')""",
)
def new_buyers(t):
    later = t.orders.where(half_open(F.col("o_orderdate"), "2001-01-01", "2100-01-01"))
    before = t.orders.where(half_open(F.col("o_orderdate"), "2000-01-01", "2001-01-01"))
    return joins.only_in(later, before, "o_custkey")


@query(
    "jn_10_value_lookup",
    "l_partkey bigint, first_day date, n bigint",
    """SELECT l_partkey, m.d AS first_day, count(*) AS n FROM lineitem JOIN (SELECT l_partkey AS k, min(l_shipdate) AS d FROM lineitem GROUP BY 1) m
       ON l_partkey = k WHERE l_shipdate < m.d + INTERVAL 365 DAY GROUP BY 1, 2""",
)
def value_lookup(t):
    first = t.lineitem.groupBy("l_partkey").agg(F.min("l_shipdate").alias("first_day"))
    return (
        t.lineitem.join(first, "l_partkey")
        .where(F.col("l_shipdate") < F.col("first_day") + F.expr("INTERVAL 365 DAYS"))
        .groupBy("l_partkey", "first_day")
        .agg(F.count("*").alias("n"))
    )


@query(
    "jn_11_mode_without_self_join",
    "o_custkey bigint, favourite string",
    """SELECT o_custkey, favourite FROM (SELECT o_custkey, o_orderpriority AS favourite,
       row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority DESC) AS r FROM orders GROUP BY 1, 2) WHERE r = 1""",
)
def mode_without_self_join(t):
    return sales.mode_by(t.orders, ["o_custkey"], "o_orderpriority", "favourite")


@query(
    "jn_14_feedback_upsert",
    "o_orderkey bigint, price double",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, f.price) AS price FROM orders LEFT JOIN
       (SELECT l_orderkey, sum(l_extendedprice) AS price FROM lineitem GROUP BY 1) f ON o_orderkey = l_orderkey""",
)
def feedback_upsert(t):
    history = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    feedback = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("price"))
    return joins.prefer_existing(history, feedback, ["o_orderkey"], ["price"])


@query(
    "jn_15_reward_enrichment",
    "event_id bigint, action string, reward double, quality double, segment string",
    """SELECT event_id, event_type AS action, CAST(value > 100 AS INT) AS reward, coalesce(quality, -1) AS quality,
       coalesce(c_mktsegment, 'none') AS segment FROM events LEFT JOIN labels ON event_id = doc_id LEFT JOIN customer ON event_id = c_custkey""",
)
def reward_enrichment(t):
    rewards = t.events.select(
        "event_id", F.col("event_type").alias("action"), (F.col("value") > 100).cast("int").alias("reward")
    )
    predictions = t.labels.select(F.col("doc_id").alias("event_id"), "quality")
    context = t.customer.select(F.col("c_custkey").alias("event_id"), F.col("c_mktsegment").alias("segment"))
    return joins.enrich(
        rewards, [(predictions, ["event_id"]), (context, ["event_id"])], {"quality": -1, "segment": "none"}
    )


@query(
    "jn_16_experiment_assignment",
    "c_custkey bigint, slot bigint, experiment_id string, grp string",
    """WITH h AS (SELECT c_custkey, CAST(concat('0x', md5(c_custkey || 's1'))::UHUGEINT % 6 AS INT) AS slot FROM customer),
       e AS (SELECT * FROM (VALUES ('exp 1', 0), ('exp 1', 1), ('exp 2', 1), ('exp 2', 2), ('exp 3', 4)) v(experiment_id, s))
       SELECT c_custkey, slot, experiment_id, CASE WHEN concat('0x', md5(c_custkey || experiment_id || 's2'))::UHUGEINT % 2 = 1
       THEN 'pilot' ELSE 'control' END AS grp FROM h JOIN e ON slot = s""",
)
def experiment_assignment(t):
    slots = slot_table(t.spark, {"exp 1": [0, 1], "exp 2": [1, 2], "exp 3": [4]})
    return assign(t.customer.select("c_custkey"), "c_custkey", slots, 6, "s1", "s2").withColumnRenamed("group", "grp")


@query(
    "set_01_tagged_union",
    "src string, n bigint, with_brand bigint",
    """SELECT 'part' AS src, count(*) AS n, count(p_brand) AS with_brand FROM part UNION ALL SELECT 'supplier', count(*), 0 FROM supplier""",
)
def tagged_union(t):
    return (
        joins.tagged_union({"part": t.part, "supplier": t.supplier}, "src")
        .groupBy("src")
        .agg(F.count("*").alias("n"), F.count("p_brand").alias("with_brand"))
    )


@query(
    "set_02_intersection_size",
    "n bigint",
    "SELECT count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT user_id FROM events)",
)
def intersection_size(t):
    a = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    return a.intersect(t.events.select(F.col("user_id").alias("k"))).agg(F.count("*").alias("n"))


@query(
    "set_03_difference",
    "k bigint",
    "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate < DATE '1996-01-01'",
)
def difference(t):
    early = t.orders.where(half_open(F.col("o_orderdate"), "1900-01-01", "1996-01-01"))
    return joins.only_in(t.customer.select(F.col("c_custkey").alias("k")), early.select(F.col("o_custkey").alias("k")), "k")


@query("set_04_id_union", "k bigint", "SELECT user_id AS k FROM events UNION SELECT s_suppkey FROM supplier")
def id_union(t):
    return t.events.select(F.col("user_id").alias("k")).union(t.supplier.select("s_suppkey")).distinct()


@query(
    "set_05_append_recompute",
    "o_custkey bigint, n bigint, last_day date",
    "SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_day FROM orders GROUP BY 1",
)
def append_recompute(t):
    base = t.orders.where(half_open(F.col("o_orderdate"), "1900-01-01", "2001-01-01"))
    batch = t.orders.where(half_open(F.col("o_orderdate"), "2001-01-01", "2100-01-01"))
    return (
        base.unionByName(batch)
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last_day"))
    )
