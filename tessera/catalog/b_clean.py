"""Filters, projections, null handling, duplicates and audits."""

from pyspark.sql import functions as F

from tessera.catalog.registry import query
from tessera.functions.columns import (
    all_in,
    epoch_micros,
    half_open,
    members,
    row_max,
    row_sum,
    scalar,
    trailing,
)
from tessera.operators import clean
from tessera.operators.features import transform_chain


@query(
    "flt_01_half_open_period",
    "o_orderstatus string, n bigint",
    """SELECT o_orderstatus, count(*) AS n FROM orders
       WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-07-01' GROUP BY 1""",
)
def half_open_period(t):
    rows = t.orders.where(half_open(F.col("o_orderdate"), "1997-01-01", "1997-07-01"))
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "flt_02_trailing_window",
    "o_custkey bigint, n bigint, total double",
    """SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM orders
       WHERE o_orderdate >= DATE '2000-01-01' - INTERVAL 90 DAY AND o_orderdate < DATE '2000-01-01' GROUP BY 1""",
)
def trailing_window(t):
    return (
        t.orders.where(trailing("o_orderdate", "2000-01-01", 90))
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    )


@query(
    "flt_03_in_filters",
    "n bigint, qty double",
    """SELECT count(*) AS n, sum(l_quantity) AS qty FROM lineitem
       WHERE l_returnflag IN ('A', 'R') AND l_linenumber IN (1, 3, 5)""",
)
def in_filters(t):
    return t.lineitem.where(all_in({"l_returnflag": ["A", "R"], "l_linenumber": [1, 3, 5]})).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty")
    )


@query(
    "flt_04_membership",
    "o_custkey bigint, spend double",
    """SELECT o_custkey, sum(o_totalprice) AS spend FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""",
)
def membership(t):
    ids = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return members(t.orders, ids, "o_custkey").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend"))


@query(
    "flt_05_price_buckets",
    "bucket string, n bigint",
    """SELECT CASE WHEN p_retailprice BETWEEN 900 AND 920 THEN 'low' WHEN p_retailprice BETWEEN 920.01 AND 960 THEN 'mid'
       ELSE 'high' END AS bucket, count(*) AS n FROM part GROUP BY 1""",
)
def price_buckets(t):
    price = F.col("p_retailprice")
    bucket = F.when(price.between(900, 920), "low").when(price.between(920.01, 960), "mid").otherwise("high")
    return t.part.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "flt_06_domain_rule",
    "event_type string, kept bigint, mean_value double",
    """SELECT event_type, count(*) AS kept, avg(value) AS mean_value FROM events
       WHERE value > 1 AND value <= 250 GROUP BY 1""",
)
def domain_rule(t):
    return (
        t.events.where("value > 1 AND value <= 250")
        .groupBy("event_type")
        .agg(F.count("*").alias("kept"), F.avg("value").alias("mean_value"))
    )


@query(
    "flt_07_campaign_day",
    "customer_id bigint, offer_days bigint, target_group_flag bigint",
    """SELECT o_custkey AS customer_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS offer_days,
       CAST(o_orderstatus = 'F' AS INT) AS target_group_flag FROM orders WHERE o_orderdate = TIMESTAMP '1995-06-19'""",
)
def campaign_day(t):
    return t.orders.where(F.col("o_orderdate") == F.lit("1995-06-19").cast("timestamp_ntz")).select(
        F.col("o_custkey").alias("customer_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("offer_days"),
        (F.col("o_orderstatus") == "F").cast("int").alias("target_group_flag"),
    )


@query("prj_01_profile_columns", "c_custkey bigint, c_mktsegment string", "SELECT c_custkey, c_mktsegment FROM customer")
def profile_columns(t):
    return t.customer.select("c_custkey", "c_mktsegment")


@query(
    "prj_02_expression_column",
    "l_orderkey bigint, l_linenumber bigint, net double",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net FROM lineitem""",
)
def expression_column(t):
    steps = [{"name": "expression", "args": {"expression": "l_extendedprice * (1 - {d}) * (1 + l_tax)", "result": "net", "d": "l_discount"}}]
    return transform_chain(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"), steps)


@query(
    "prj_03_profit_target",
    "o_custkey bigint, profit double",
    """SELECT c_custkey AS o_custkey, 0.35 * coalesce(s.spend, 0) - (c_custkey % 2) - coalesce(s.disc, 0) AS profit
       FROM customer LEFT JOIN (SELECT o_custkey, sum(l_extendedprice) AS spend, sum(l_extendedprice * l_discount) AS disc
         FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderdate >= DATE '2001-01-01' GROUP BY 1) s
       ON c_custkey = s.o_custkey""",
)
def profit_target(t):
    o = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    spend = (
        o.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey")
        .agg(
            F.sum("l_extendedprice").alias("spend"),
            F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("disc"),
        )
    )
    return t.customer.select(F.col("c_custkey").alias("o_custkey")).join(spend, "o_custkey", "left").withColumn(
        "profit", F.expr("0.35D * coalesce(spend, 0) - o_custkey % 2 - coalesce(disc, 0)")
    )


@query(
    "prj_04_true_price",
    "l_orderkey bigint, l_linenumber bigint, true_price double",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / (1 - coalesce(nullif(l_discount, 0), 0)) AS true_price FROM lineitem",
)
def true_price(t):
    discount = F.nullif("l_discount", F.lit(0.0))
    share = F.coalesce(discount, F.lit(0.0))
    checked = F.when(share < 1, F.col("l_extendedprice") / (1 - share)).otherwise(
        F.raise_error(F.lit("a discount must be below 1"))
    )
    return t.lineitem.withColumn("true_price", checked)


@query(
    "prj_05_row_max",
    "l_orderkey bigint, l_linenumber bigint, strict_max double, skip_max double",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0 THEN greatest(l_tax, l_discount, l_quantity / 500) END AS strict_max,
       greatest(nullif(l_tax, 0), l_discount, l_quantity / 500) AS skip_max FROM lineitem""",
)
def row_maximum(t):
    df = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.col("l_discount").alias("disc"),
        (F.col("l_quantity") / 500).alias("qty"),
    )
    return df.withColumns(
        {"strict_max": row_max("tax", "disc", "qty"), "skip_max": row_max("tax", "disc", "qty", skip_nulls=True)}
    )


@query(
    "prj_06_row_sum",
    "l_orderkey bigint, l_linenumber bigint, total double",
    "SELECT l_orderkey, l_linenumber, coalesce(nullif(l_tax, 0), 0) + l_discount + l_quantity AS total FROM lineitem",
)
def row_total(t):
    df = t.lineitem.withColumn("tax", F.nullif("l_tax", F.lit(0.0)))
    return df.withColumn("total", row_sum("tax", "l_discount", "l_quantity"))


@query(
    "prj_07_domain_repair",
    "p_partkey bigint, size_fixed bigint, price_fixed double",
    """SELECT p_partkey, CASE WHEN p_size = 50 THEN 5 WHEN p_size = 1 THEN NULL ELSE p_size END + 0 AS size_fixed,
       CASE WHEN p_retailprice > 20 * p_size THEN p_retailprice * 0.62 ELSE p_retailprice END AS price_fixed
       FROM part WHERE p_size <> 1""",
)
def domain_repair(t):
    fixed = t.part.replace({50: 5}, subset=["p_size"]).withColumnRenamed("p_size", "size_fixed")
    return (
        fixed.join(t.part.select("p_partkey", "p_size"), "p_partkey")
        .where("p_size <> 1")
        .withColumn(
            "price_fixed",
            F.when(F.col("p_retailprice") > 20 * F.col("p_size"), F.col("p_retailprice") * 0.62).otherwise(
                F.col("p_retailprice")
            ),
        )
    )


@query(
    "prj_08_clip_at_quantile",
    "l_orderkey bigint, l_linenumber bigint, l_extendedprice double",
    """SELECT l_orderkey, l_linenumber, least(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.95) FROM lineitem)) AS l_extendedprice
       FROM lineitem""",
)
def clip_quantile(t):
    return clean.clip_at_quantile(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 0.95)


@query(
    "prj_09_minmax_epoch",
    "o_orderkey bigint, position double",
    """SELECT o_orderkey, (epoch_us(o_orderdate) - a) / CAST(b - a AS DOUBLE) AS position FROM orders,
       (SELECT min(epoch_us(o_orderdate)) AS a, max(epoch_us(o_orderdate)) AS b FROM orders) AS m""",
)
def minmax_epoch(t):
    df = t.orders.select("o_orderkey", epoch_micros("o_orderdate").alias("us"))
    ends = df.agg(F.min("us").alias("a"), F.max("us").alias("b"))
    a, b = scalar(ends, "a"), scalar(ends, "b")
    return df.withColumn("position", F.try_divide(F.col("us") - a, b - a))


@query(
    "prj_10_feature_prep",
    "c_custkey bigint, log_balance double, segment_no bigint, is_building bigint, nation_tail bigint",
    """SELECT c_custkey, ln(1 + greatest(c_acctbal, 0)) AS log_balance,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 ELSE 0 END AS segment_no,
       CAST(c_mktsegment = 'BUILDING' AS INT) AS is_building, CAST(substr(c_name, 10, 9) AS INT) AS nation_tail FROM customer""",
)
def feature_prep(t):
    seg = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey",
        F.log1p(F.greatest("c_acctbal", F.lit(0.0))).alias("log_balance"),
        F.when(seg == "AUTOMOBILE", 1).when(seg == "BUILDING", 2).when(seg == "FURNITURE", 3).otherwise(0).alias("segment_no"),
        (seg == "BUILDING").cast("int").alias("is_building"),
        F.substring("c_name", 10, 9).cast("int").alias("nation_tail"),
    )


WITH_GAPS = """(SELECT l_orderkey, l_linenumber, l_extendedprice, nullif(l_tax, 0) AS tax, nullif(l_discount, 0.1) AS disc,
                CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS line FROM lineitem)"""


def with_gaps(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.nullif("l_discount", F.lit(0.1)).alias("disc"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linenumber")).alias("line"),
    )


@query(
    "nul_01_impute",
    "l_orderkey bigint, l_linenumber bigint, tax double, disc double, line bigint",
    f"""WITH g AS {WITH_GAPS}, m AS (SELECT line, count(*) AS n FROM g WHERE line IS NOT NULL GROUP BY 1)
        SELECT l_orderkey, l_linenumber, coalesce(tax, (SELECT avg(tax) FROM g)) AS tax, coalesce(disc, 0.5) AS disc,
        coalesce(line, (SELECT line FROM m ORDER BY n DESC, line LIMIT 1)) AS line FROM g""",
)
def impute(t):
    return clean.impute(with_gaps(t), {"tax": "mean", "disc": 0.5, "line": "freq"})


@query(
    "nul_02_impute_then_correlate",
    "corr_mean double, corr_median double",
    f"""WITH g AS {WITH_GAPS}, s AS (SELECT avg(tax) AS m, median(tax) AS md FROM g)
        SELECT corr(coalesce(tax, m), l_extendedprice) AS corr_mean, corr(coalesce(tax, md), l_extendedprice) AS corr_median
        FROM g, s""",
)
def impute_then_correlate(t):
    g = with_gaps(t).withColumn("tax2", F.col("tax"))
    filled = clean.impute(g, {"tax": "mean", "tax2": "median"})
    return filled.agg(
        F.corr("tax", "l_extendedprice").alias("corr_mean"), F.corr("tax2", "l_extendedprice").alias("corr_median")
    )


@query(
    "nul_04_null_report",
    "l_linenumber bigint, tax bigint, disc bigint, line bigint",
    f"""SELECT l_linenumber, count(*) FILTER (tax IS NULL) AS tax, count(*) FILTER (disc IS NULL) AS disc,
        count(*) FILTER (line IS NULL) AS line FROM {WITH_GAPS} GROUP BY 1""",
)
def null_report(t):
    return clean.null_counts(with_gaps(t), ["tax", "disc", "line"], ["l_linenumber"])


@query(
    "nul_05_zero_padded_moments",
    "grp string, n bigint, mean double, var double",
    """SELECT c_mktsegment AS grp, count(*) AS n, avg(coalesce(s, 0)) AS mean, var_samp(coalesce(s, 0)) AS var
       FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS s FROM orders WHERE o_orderdate >= DATE '2001-01-01' GROUP BY 1) o
       ON c_custkey = o_custkey GROUP BY 1""",
)
def zero_padded_moments(t):
    from tessera.operators.abtest import pad_with_zeros

    buyers = (
        t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum("o_totalprice").alias("s"))
        .join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
    )
    sums = buyers.groupBy(F.col("c_mktsegment").alias("grp")).agg(
        F.sum("s").alias("sum"), F.sum(F.col("s") * F.col("s")).alias("sumsq")
    )
    sizes = t.customer.groupBy(F.col("c_mktsegment").alias("grp")).agg(F.count("*").alias("n"))
    return pad_with_zeros(sums, sizes, ["grp"])


@query(
    "dst_01_drop_duplicates",
    "o_custkey bigint, day date, o_orderkey bigint, o_totalprice double",
    """SELECT o_custkey, o_orderdate AS day, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1""",
)
def drop_duplicates(t):
    rows = t.orders.select("o_custkey", F.col("o_orderdate").alias("day"), "o_orderkey", "o_totalprice")
    return clean.first_by(rows, ["o_custkey", "day"], ["o_orderkey"])


@query(
    "dst_02_drop_constant_columns",
    "kept string, n bigint",
    """SELECT 'l_tax,l_quantity,l_orderkey' AS kept, count(*) AS n FROM lineitem""",
)
def drop_constant_columns(t):
    df = t.lineitem.select("l_tax", "l_quantity", F.lit("x").alias("const"), F.lit(None).cast("int").alias("empty"), "l_orderkey")
    kept = clean.drop_constant(df, ["l_tax", "l_quantity", "const", "empty"])
    return kept.agg(F.lit(",".join(kept.columns)).alias("kept"), F.count("l_orderkey").alias("n"))


@query(
    "chk_02_join_cardinality",
    "check_name string, violations bigint, ok bigint",
    """SELECT 'left unique' AS check_name, count(*) AS violations, CAST(count(*) = 0 AS INT) AS ok
       FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
       UNION ALL SELECT 'right unique', count(*), CAST(count(*) = 0 AS INT)
       FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)""",
)
def join_cardinality(t):
    left = t.orders.select(F.col("o_custkey").alias("k"))
    right = t.customer.select(F.col("c_custkey").alias("k"))
    return clean.cardinality_audit(left, right, ["k"], "1:1").withColumnRenamed("check", "check_name")


@query(
    "chk_03_join_asserts",
    "check_name string, expected bigint, actual bigint, ok bigint",
    """WITH j AS (SELECT o_orderkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS bal
                  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
       SELECT 'row count' AS check_name, (SELECT count(*) FROM orders) AS expected, count(*) AS actual,
              CAST((SELECT count(*) FROM orders) = count(*) AS INT) AS ok FROM j
       UNION ALL SELECT 'nulls in c_mktsegment', 0, count(*) FILTER (c_mktsegment IS NULL), CAST(count(*) FILTER (c_mktsegment IS NULL) = 0 AS INT) FROM j
       UNION ALL SELECT 'nulls in bal', 0, count(*) FILTER (bal IS NULL), CAST(count(*) FILTER (bal IS NULL) = 0 AS INT) FROM j""",
)
def join_asserts(t):
    c = t.customer.withColumn("bal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    joined = t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    return clean.join_audit(t.orders, joined, ["c_mktsegment", "bal"]).withColumnRenamed("check", "check_name")
