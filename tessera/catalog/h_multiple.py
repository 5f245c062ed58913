"""Multiple testing, slots and sequential tests."""

from pyspark.sql import functions as F

from tessera.catalog.d_aggregates import GROUPED_EVENTS, grouped_events
from tessera.catalog.f_experiments import moments_sql, pooled_sql, t_p_sql
from tessera.catalog.registry import query
from tessera.functions.hashing import uniform
from tessera.operators import multiple, sequential, slots

U13 = "CAST(concat('0x', substr(md5({}), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE"
P_SQL = f"""(SELECT p_brand AS family, p_partkey AS test, CAST(p_size > 40 AS INT) AS truth, {U13.format("p_partkey || '_33'")} * CASE WHEN p_size > 40 THEN 0.01::DOUBLE ELSE 1 END AS p FROM part)"""
SIZED_SQL = f"(SELECT *, row_number() OVER (PARTITION BY family ORDER BY p, test) AS i, count(*) OVER (PARTITION BY family) AS m FROM {P_SQL})"


def p_values(t):
    """One p-value per part within its brand; parts above size 40 carry a true effect."""
    truth = (F.col("p_size") > 40).cast("int")
    p = uniform(F.col("p_partkey"), 33) * F.when(truth == 1, 0.01).otherwise(1.0)
    return t.part.select(F.col("p_brand").alias("family"), F.col("p_partkey").alias("test"), truth.alias("truth"), p.alias("p"))


def decided(t):
    return multiple.decisions(p_values(t), "family", "test", "p")


@query(
    "ab_33_baseline_and_bonferroni",
    "family string, test bigint, baseline bigint, bonferroni bigint",
    f"SELECT family, test, CAST(p < 0.05 AS INT) AS baseline, CAST(p <= 0.05::DOUBLE / m AS INT) AS bonferroni FROM {SIZED_SQL}",
)
def baseline_and_bonferroni(t):
    return decided(t)


@query(
    "ab_34_holm",
    "family string, test bigint, holm bigint",
    f"""SELECT family, test, CAST(i < coalesce(min(CASE WHEN NOT p < 0.05::DOUBLE / (m - i + 1) THEN i END) OVER (PARTITION BY family), m + 1) AS INT) AS holm FROM {SIZED_SQL}""",
)
def holm(t):
    return decided(t)


@query(
    "ab_35_benjamini_hochberg",
    "family string, test bigint, bh bigint, bh_stop bigint",
    f"""SELECT family, test, CAST(i <= coalesce(max(CASE WHEN p <= 0.05::DOUBLE * i / m THEN i END) OVER (PARTITION BY family), 0) AS INT) AS bh,
        CAST(i < coalesce(min(CASE WHEN NOT p <= 0.05::DOUBLE * i / m THEN i END) OVER (PARTITION BY family), m + 1) AS INT) AS bh_stop FROM {SIZED_SQL}""",
)
def benjamini_hochberg(t):
    return decided(t)


@query(
    "ab_36_adjusted_p_values",
    "family string, test bigint, bonferroni double, holm double, bh double",
    f"""SELECT family, test, least(1, p * m) AS bonferroni, least(1, max(p * (m - i + 1)) OVER (PARTITION BY family ORDER BY i)) AS holm,
        least(1, min(p * m / i) OVER (PARTITION BY family ORDER BY i DESC)) AS bh FROM {SIZED_SQL}""",
)
def adjusted_p_values(t):
    return multiple.adjusted(p_values(t), "family", "test", "p")


@query(
    "ab_37_error_rates",
    "method string, effects bigint, fwer double, any_missed double, fdr double, families bigint",
    f"""WITH d AS (SELECT family, truth, CAST(p < 0.05 AS INT) AS baseline, CAST(p <= 0.05::DOUBLE / m AS INT) AS bonferroni,
          CAST(i <= coalesce(max(CASE WHEN p <= 0.05::DOUBLE * i / m THEN i END) OVER (PARTITION BY family), 0) AS INT) AS bh FROM {SIZED_SQL}),
        l AS (UNPIVOT d ON baseline, bonferroni, bh INTO NAME method VALUE hit),
        f AS (SELECT method, family, sum(CASE WHEN truth = 0 THEN hit ELSE 0 END) AS fp, sum(CASE WHEN truth = 1 THEN hit ELSE 0 END) AS tp, sum(truth) AS effects FROM l GROUP BY 1, 2)
        SELECT method, effects, avg(CAST(fp > 0 AS INT)) AS fwer, avg(CAST(tp < effects AS INT)) AS any_missed, avg(fp / greatest(1, fp + tp)) AS fdr, count(*) AS families FROM f GROUP BY 1, 2""",
)
def error_rates(t):
    return multiple.error_rates(decided(t), "family", "truth", ["baseline", "bonferroni", "bh"])


HASH = "concat('0x', md5({}))::UHUGEINT"
# Suppliers act as experiments: each holds the slots of its first and last part, in conflict with the next and the seventh next supplier.
SLOTS = 50
HELD_SQL = f"""(SELECT DISTINCT 'exp ' || k AS experiment_id, CAST(p % {SLOTS} AS INT) AS slot FROM (SELECT l_suppkey AS k, unnest([min(l_partkey), max(l_partkey)]) AS p FROM lineitem GROUP BY 1))"""
EXPERIMENT_SQL = """(SELECT 'exp ' || s_suppkey AS experiment_id, s_nationkey % 3 + 1 AS count_slots, ['exp ' || (s_suppkey + 1), 'exp ' || (s_suppkey + 7)] AS conflict_experiments FROM supplier)"""


def held_slots(t):
    held = t.lineitem.groupBy("l_suppkey").agg(F.min("l_partkey").alias("first"), F.max("l_partkey").alias("last"))
    part = held.select("l_suppkey", F.explode(F.array("first", "last")).alias("part"))
    return part.select(
        F.concat(F.lit("exp "), F.col("l_suppkey")).alias("experiment_id"), (F.col("part") % SLOTS).cast("int").alias("slot")
    ).distinct()


def experiments(t):
    name = lambda k: F.concat(F.lit("exp "), k.cast("string"))
    key = F.col("s_suppkey")
    return t.supplier.select(
        name(key).alias("experiment_id"),
        (F.col("s_nationkey") % 3 + 1).alias("count_slots"),
        F.array(name(key + 1), name(key + 7)).alias("conflict_experiments"),
    )


@query(
    "ab_38_slot_assignment",
    "c_custkey bigint, slot bigint, experiment_id string, grp string",
    f"""WITH h AS (SELECT c_custkey, CAST(({HASH.format("CAST(c_custkey AS VARCHAR)")} % {SLOTS} + 17) % {SLOTS} AS INT) AS slot FROM customer)
        SELECT c_custkey, slot, experiment_id, CASE WHEN ({HASH.format("c_custkey || experiment_id")} % 2 + 1) % 2 = 1 THEN 'pilot' ELSE 'control' END AS grp FROM h JOIN {HELD_SQL} USING (slot)""",
)
def slot_assignment(t):
    users = t.customer.select("c_custkey")
    return slots.assign(users, "c_custkey", held_slots(t), SLOTS, "17", "31", additive=True).withColumnRenamed("group", "grp")


@query(
    "ab_39_free_slots",
    "experiment_id string, slot bigint, held bigint, place bigint, free bigint, enough bigint",
    f"""WITH a AS {HELD_SQL}, e AS {EXPERIMENT_SQL}, l AS (SELECT experiment_id, unnest(conflict_experiments) AS other FROM e),
        b AS (SELECT experiment_id, other FROM l UNION SELECT other, experiment_id FROM l), c AS (SELECT DISTINCT b.experiment_id, slot FROM b JOIN a ON a.experiment_id = other),
        n AS (SELECT slot, count(*) AS held FROM a GROUP BY 1),
        f AS (SELECT e.experiment_id, count_slots, s AS slot, coalesce(held, 0) AS held FROM e CROSS JOIN range({SLOTS}) r(s) LEFT JOIN n ON n.slot = s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.experiment_id = e.experiment_id AND c.slot = s))
        SELECT experiment_id, slot, held, row_number() OVER (PARTITION BY experiment_id ORDER BY held DESC, md5(experiment_id || '_' || slot || '_')) AS place,
        count(*) OVER (PARTITION BY experiment_id) AS free, CAST(count(*) OVER (PARTITION BY experiment_id) >= count_slots AS INT) AS enough FROM f""",
)
def free_slots(t):
    return slots.free_slots(experiments(t), held_slots(t), SLOTS)


@query(
    "ab_40_slot_uniformity",
    "slot bigint, n bigint, ratio double",
    f"""SELECT CAST({HASH.format("c_custkey || 's1'")} % 20 AS INT) AS slot, count(*) AS n, count(*) * 20 / (SELECT count(*) FROM customer) AS ratio FROM customer GROUP BY 1""",
)
def slot_uniformity(t):
    return slots.slot_uniformity(slots.with_slot(t.customer.select("c_custkey"), "c_custkey", 20, "s1"), 20)


@query(
    "ab_40_double_assignment",
    "o_custkey bigint, experiment_id string, n bigint",
    """SELECT o_custkey, o_orderpriority AS experiment_id, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
)
def double_assignment(t):
    return slots.double_assignments(t.orders.withColumnRenamed("o_orderpriority", "experiment_id"), "o_custkey")


@query(
    "ab_40_conflict_violations",
    "experiment_id string, other string, slot bigint",
    f"""WITH a AS {HELD_SQL} SELECT e.experiment_id, other, a.slot FROM (SELECT experiment_id, unnest(conflict_experiments) AS other FROM {EXPERIMENT_SQL}) e
        JOIN a ON a.experiment_id = e.experiment_id JOIN a b ON b.experiment_id = other AND b.slot = a.slot""",
)
def conflict_violations(t):
    return slots.conflict_violations(held_slots(t), experiments(t))


PAIRS_SQL = f"""(SELECT event_type, i, max(value) FILTER (grp = 'pilot') AS a, max(value) FILTER (grp = 'control') AS b FROM (SELECT event_type, grp, value,
   row_number() OVER (PARTITION BY event_type, grp ORDER BY ts, event_id) AS i FROM {GROUPED_EVENTS}) GROUP BY 1, 2 HAVING count(*) = 2)"""
LLR = "((d ** 2) - (d - 6) ** 2) / (2 * 60.0::DOUBLE ** 2)"
DECIDE_SQL = """SELECT event_type, CASE WHEN lo IS NOT NULL AND (hi IS NULL OR lo < hi) THEN 0 WHEN hi IS NOT NULL THEN 1 ELSE 0.5 END AS result,
   {step} * CASE WHEN lo IS NOT NULL AND (hi IS NULL OR lo < hi) THEN lo WHEN hi IS NOT NULL THEN hi ELSE n END AS length FROM (
   SELECT event_type, min(i) FILTER (z < ln(0.2::DOUBLE / 0.95)) AS lo, min(i) FILTER (z > ln(0.8::DOUBLE / 0.05)) AS hi, count(*) AS n FROM ({path}) GROUP BY 1)"""


def wald(t, batch_size=1):
    return sequential.wald(
        grouped_events(t),
        ["event_type"],
        "grp",
        ["ts", "event_id"],
        "value",
        "pilot",
        "control",
        sequential.normal(0, 60),
        sequential.normal(6, 60),
        0.05,
        0.2,
        batch_size,
    )


@query(
    "ab_41_sequential_test",
    "event_type string, result double, length bigint",
    DECIDE_SQL.format(step=1, path=f"SELECT event_type, i, sum({LLR}) OVER (PARTITION BY event_type ORDER BY i) AS z FROM (SELECT *, a - b AS d FROM {PAIRS_SQL})"),
)
def sequential_test(t):
    return wald(t)


@query(
    "ab_42_sequential_batches",
    "event_type string, result double, length bigint",
    DECIDE_SQL.format(
        step=50,
        path=f"""SELECT event_type, i, sum(s) OVER (PARTITION BY event_type ORDER BY i) AS z FROM (SELECT event_type, (i - 1) // 50 + 1 AS i, sum({LLR}) AS s
             FROM (SELECT *, a - b AS d FROM {PAIRS_SQL}) GROUP BY 1, 2 HAVING count(*) = 50)""",
    ),
)
def sequential_batches(t):
    return wald(t, 50)


@query(
    "ab_43_peeking",
    "event_type string, first_hit double, pairs bigint",
    f"""WITH r AS (SELECT event_type, i, count(*) OVER w AS n_p, avg(a) OVER w AS mean_p, var_samp(a) OVER w AS var_p, count(*) OVER w AS n_c, avg(b) OVER w AS mean_c, var_samp(b) OVER w AS var_c
          FROM {PAIRS_SQL} WINDOW w AS (PARTITION BY event_type ORDER BY i)), t AS ({pooled_sql("SELECT * FROM r WHERE i >= 2", "event_type, i")})
        SELECT event_type, min(i) FILTER ({t_p_sql("t", "dof")} < 0.05) AS first_hit, max(i) AS pairs FROM t GROUP BY 1""",
)
def peeking(t):
    return sequential.peeking(grouped_events(t), ["event_type"], "grp", ["ts", "event_id"], "value", "pilot", "control")
