"""The places where callers bring their own functions."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.catalog.c_joins import campaign_tables
from tessera.catalog.d_aggregates import RECEIPTS_SQL, grouped_events
from tessera.catalog.e_series import MONTHLY_SQL, monthly_prices
from tessera.catalog.f_experiments import SPEND_SQL, boot_sql, spend
from tessera.catalog.h_multiple import DECIDE_SQL, PAIRS_SQL
from tessera.catalog.registry import query
from tessera.functions import vectors
from tessera.functions.columns import half_open
from tessera.operators import bootstrap, features, matching, neighbours, sales, sequential
from tessera.plans.resample import interval
from tessera.plans.runs import map_runs, numbers
from tessera.sources.pages import page_links


@query(
    "ud_01_user_aggregate",
    "l_suppkey bigint, favourite bigint, parts bigint",
    """SELECT l_suppkey, favourite, parts FROM (SELECT l_suppkey, l_linenumber AS favourite, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_linenumber DESC) AS r FROM lineitem GROUP BY 1, 2)
       JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1) USING (l_suppkey) WHERE r = 1""",
)
def user_aggregate(t):
    """Mode and distinct count, both with map-side partial results."""
    mode = sales.mode_by(t.lineitem, ["l_suppkey"], "l_linenumber", "favourite")
    return mode.join(t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts")), "l_suppkey")


@query("ud_02_user_expression", "event_id bigint, k bigint", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) * 2 + 1 AS k FROM events")
def user_expression(t):
    step = {"name": "expression", "args": {"expression": "CAST(get_json_object({p}, '$.k') AS BIGINT) * 2 + 1", "result": "k", "p": "props"}}
    return features.transform_chain(t.events, [step])


@query(
    "ud_03_user_density",
    "event_type string, result double, length bigint",
    DECIDE_SQL.format(step=1, path=f"SELECT event_type, i, sum((abs(d) - abs(d - 5)) / 40.0::DOUBLE) OVER (PARTITION BY event_type ORDER BY i) AS z FROM (SELECT *, a - b AS d FROM {PAIRS_SQL})"),
)
def user_density(t):
    """The sequential test with Laplace log-densities given as column functions."""
    laplace = lambda centre: lambda x: -F.abs(x - centre) / 40 - F.ln(F.lit(80.0))
    return sequential.wald(
        grouped_events(t), ["event_type"], "grp", ["ts", "event_id"], "value", "pilot", "control", laplace(0), laplace(5)
    )


@query(
    "ud_04_user_statistic",
    "lower double, upper double, mean double, std double",
    boot_sql(f"SELECT c_custkey, v FROM {SPEND_SQL}", "c_custkey", "", "sum(weight * v) AS s1, sum(weight * v * v) AS s2", 4, 40)
    + """, D AS (SELECT sqrt(s2 / n - (s1 / n) ** 2) / (s1 / n) AS d FROM B)
       SELECT quantile_cont(d, 0.025) AS lower, quantile_cont(d, 0.975) AS upper, avg(d) AS mean, stddev_pop(d) AS std FROM D""",
)
def user_statistic(t):
    """Bootstrap of a coefficient of variation, given by its sums."""
    v, n = F.col("v"), F.col("n")
    stat = F.sqrt(F.col("s2") / n - F.pow(F.col("s1") / n, F.lit(2.0))) / (F.col("s1") / n)
    reps = bootstrap.bootstrap_statistic(spend(t).drop("n"), ["c_custkey"], [], {"s1": v, "s2": v * v}, stat, 40, 4)
    return interval(reps, [], "stat")


@query(
    "ud_05_user_distance",
    "query_id bigint, id bigint, dist fixed, rank bigint",
    """WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS size FROM embeddings),
       e AS (SELECT vec_id, v, list_transform(v, lambda x: x / size) AS u FROM n WHERE size > 0)
       SELECT query_id, id, dist, rank FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, 1 - list_cosine_similarity(a.v, b.v) AS dist, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.u, b.u), 9), b.vec_id) AS rank
       FROM e a CROSS JOIN e b) WHERE rank <= 5""",
)
def user_distance(t):
    """Neighbours by the cosine distance, which orders vectors as L2 orders them at unit length."""
    unit = lambda v: F.when(vectors.norm(v) > 0, vectors.normalised(v))
    distance = lambda a, b: 1 - vectors.cosine(a, b)
    return neighbours.nearest_by(t.embeddings, t.embeddings, 5, "vec_id", "vec_id", "embedding", unit, distance)


@query(
    "ud_06_user_preprocessing",
    "token string, n bigint",
    """SELECT token, count(*) AS n FROM (SELECT unnest(list_filter(string_split(text, ' '), lambda w: length(w) > 8)) AS token FROM (SELECT DISTINCT text FROM benchmark)) GROUP BY 1""",
)
def user_preprocessing(t):
    long_words = lambda text: F.filter(F.split(text, " "), lambda w: F.length(w) > 8)
    return matching.vocabulary([t.benchmark], preprocess=long_words)


@query(
    "ud_07_user_block",
    "customer_id bigint, n30 double, dearest double",
    f"""WITH r AS {RECEIPTS_SQL} SELECT customer_id, n30, dearest FROM (SELECT customer_id, count(*) AS n30 FROM r WHERE date >= 1970 AND date < 2000 GROUP BY 1)
        FULL JOIN (SELECT customer_id, max(purchase_sum) AS dearest FROM r WHERE date < 1000 GROUP BY 1) USING (customer_id)""",
)
def user_block(t):
    """A caller's block joins the shared scan of the built-in ones."""

    def dearest(tables, until):
        return features.Aggregates(
            "receipts", ("customer_id",), {"dearest": ("max", F.col("purchase_sum"))}, half_open("date", -(10**9), until)
        )

    config = [
        {"name": "purchases_agg", "args": {"date_to": 2000, "delta": 30}},
        {"name": "dearest", "args": {"until": 1000}},
    ]
    out = features.feature_table(campaign_tables(t), config, {"dearest": dearest})
    return out.withColumnRenamed("purchases_30d__count", "n30")


@query(
    "ud_08_grouped_map",
    "sku bigint, n bigint, slope double",
    f"SELECT sku, count(*) AS n, regr_slope(price, date_diff('day', DATE '1995-01-01', CAST(month AS DATE))) AS slope FROM {MONTHLY_SQL} GROUP BY 1",
)
def grouped_map(t):
    """A caller's function per item over its monthly series (as long as the calendar)."""

    def trend(day: np.ndarray, price: np.ndarray) -> tuple[int, float | None]:
        known = day[~np.isnan(day)]
        x = day - (known.sum() / len(known) if len(known) else np.nan)
        with np.errstate(invalid="ignore"):
            slope = np.nansum(x * price) / np.nansum(x * x) if len(day) > 1 else np.nan
        return len(day), None if np.isnan(slope) else float(slope)

    def trends(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        days, prices = numbers(rows, "day"), numbers(rows, "price")
        ends = np.append(starts[1:], rows.num_rows)
        found = [trend(days[s:e], prices[s:e]) for s, e in zip(starts, ends)]
        n, slope = pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())
        return pa.table([rows.column("sku").take(pa.array(starts)), n, slope], ["sku", "n", "slope"])

    day = F.datediff("month", F.lit("1995-01-01").cast("date")).cast("double")
    rows = monthly_prices(t).select("sku", day.alias("day"), "price")
    return map_runs(rows, "sku", trends, "sku bigint, n bigint, slope double", ["day"])


@query(
    "ud_09_one_to_many",
    "link string, pages bigint, first_pos bigint",
    """SELECT link, count(DISTINCT page_id) AS pages, min(pos) AS first_pos FROM (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) - 1 AS pos FROM
       (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)) GROUP BY 1""",
)
def one_to_many(t):
    return page_links(t.pages).groupBy("link").agg(F.count_distinct("page_id").alias("pages"), F.min("pos").alias("first_pos"))
