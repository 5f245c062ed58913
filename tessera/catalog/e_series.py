"""Windows, sorts, bins and scalar functions."""

from pyspark.sql import functions as F

from tessera.catalog.registry import query
from tessera.functions import stats, text, vectors
from tessera.functions.columns import (
    bins_by_edges,
    bins_equal_width,
    digitize,
    epoch_micros,
    iso_year,
    quantile_edges,
    scalar,
    weekday0,
)
from tessera.functions.hashing import md5_mod
from tessera.operators import pricing, series
from tessera.plans.prefix import exact_quantiles, prefix
from tessera.sources.pages import cut_suffix, strip_tags

PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"


def tokens_sql(expr: str) -> str:
    cleaned = f"lower(translate({expr}, '{PUNCTUATION}', repeat(' ', 32)))"
    return f"list_filter(string_split_regex({cleaned}, '\\s+'), lambda w: w <> '')"


def phi_sql(z: str) -> str:
    """The normal distribution function by its power series, independent of the Spark form."""
    return (
        f"(0.5 + exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 120), "
        f"lambda k: power(({z})::DOUBLE, 2 * k + 1) * sqrt(pi()) / (power(2.0, k + 1) * exp(lgamma(k + 1.5))))))"
    )


MONTHLY_SQL = "(SELECT l_partkey AS sku, date_trunc('month', l_shipdate) AS month, avg(l_extendedprice / l_quantity) AS price FROM lineitem GROUP BY 1, 2)"


def monthly_prices(t):
    """Mean unit price per part and month: one row per (sku, month)."""
    return t.lineitem.groupBy(
        F.col("l_partkey").alias("sku"), F.trunc(F.to_date("l_shipdate"), "month").alias("month")
    ).agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))


@query(
    "win_01_lag_block",
    "sku bigint, month date, price_lag1 double, price_lag2 double, price_lag3 double",
    f"""SELECT sku, month, {", ".join(f"lag(price, {i}) OVER w AS price_lag{i}" for i in (1, 2, 3))} FROM {MONTHLY_SQL}
        WINDOW w AS (PARTITION BY sku ORDER BY month)""",
)
def lag_block(t):
    return series.lag_block(monthly_prices(t), "sku", "month", "price", 3)


@query(
    "win_02_rolling_rows",
    "event_id bigint, hi double, lo double, av double, before_av double",
    """SELECT event_id, max(value) OVER w AS hi, min(value) OVER w AS lo, avg(value) OVER w AS av,
       avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS before_av FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def rolling_rows(t):
    df = t.events.select("event_id", "user_id", "ts", "value")
    now = series.rolling(df, "user_id", ["ts", "event_id"], "value").withColumnsRenamed(
        {"value_max6": "hi", "value_min6": "lo", "value_mean6": "av"}
    )
    before = series.rolling(df, "user_id", ["ts", "event_id"], "value", include_current=False)
    return now.join(before.select("event_id", F.col("value_mean6").alias("before_av")), "event_id")


@query(
    "win_03_previous_value",
    "event_id bigint, before double",
    "SELECT event_id, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS before FROM events",
)
def previous_value(t):
    df = t.events.select("event_id", "user_id", "ts", "value")
    return series.previous(df, "user_id", ["ts", "event_id"], "value", "before")


@query(
    "win_04_days_since_previous",
    "sku bigint, month date, gap double",
    f"SELECT sku, month, date_diff('day', lag(month) OVER (PARTITION BY sku ORDER BY month), month) AS gap FROM {MONTHLY_SQL}",
)
def days_since_previous(t):
    return series.days_since_previous(monthly_prices(t), "sku", "month")


@query(
    "win_05_running_path",
    "event_type string, first_lower double, first_upper double, n bigint",
    """WITH p AS (SELECT event_type, row_number() OVER w AS i, sum(ln(value / 20)) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS z
         FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
       SELECT event_type, min(i) FILTER (z < -60) AS first_lower, min(i) FILTER (z > 4) AS first_upper, count(*) AS n FROM p GROUP BY 1""",
)
def running_path(t):
    path = prefix(
        t.events.select("event_type", "ts", "event_id", "value"),
        ["event_type"],
        ["ts", "event_id"],
        sums={"z": F.ln(F.col("value") / 20)},
        pos="i",
    )
    return series.first_crossing(path, ["event_type"], "i", "z", -60.0, 4.0)


@query(
    "win_06_standardise",
    "l_orderkey bigint, l_linenumber bigint, l_quantity double, l_extendedprice double",
    """SELECT l_orderkey, l_linenumber, (l_quantity - avg(l_quantity) OVER w) / CASE WHEN stddev_pop(l_quantity) OVER w > 0 THEN stddev_pop(l_quantity) OVER w ELSE 1 END AS l_quantity,
       (l_extendedprice - avg(l_extendedprice) OVER w) / CASE WHEN stddev_pop(l_extendedprice) OVER w > 0 THEN stddev_pop(l_extendedprice) OVER w ELSE 1 END AS l_extendedprice
       FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)""",
)
def standardise(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    return series.standardise(df, ["l_suppkey"], ["l_quantity", "l_extendedprice"])


@query(
    "win_07_temporal_split",
    "sku bigint, train bigint, test bigint",
    """WITH d AS (SELECT l_partkey AS sku, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS n FROM lineitem),
       q AS (SELECT sku, quantile_cont(n, 0.7) AS cut FROM d GROUP BY 1)
       SELECT sku, count(*) FILTER (n <= cut) AS train, count(*) FILTER (n > cut) AS test FROM d JOIN q USING (sku) GROUP BY 1""",
)
def temporal_split(t):
    df = t.lineitem.select(F.col("l_partkey").alias("sku"), F.unix_date(F.to_date("l_shipdate")).alias("n"))
    return (
        series.temporal_split(df, "sku", "n", 0.7)
        .groupBy("sku")
        .agg(F.count_if("is_train").alias("train"), F.count_if(~F.col("is_train")).alias("test"))
    )


@query(
    "win_08_random_split",
    "c_custkey bigint, part string",
    """SELECT c_custkey, CASE WHEN p <= round(n * 0.65::DOUBLE) THEN 'train' WHEN p <= round(n * 0.825::DOUBLE) THEN 'valid' ELSE 'test' END AS part FROM (
       SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '_7'), c_custkey) AS p, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)""",
)
def random_split(t):
    df = t.customer.select("c_custkey", "c_mktsegment")
    return series.random_split(df, "c_custkey", {"train": 0.65, "valid": 0.175, "test": 0.175}, ["c_mktsegment"], seed=7)


@query(
    "win_09_folds",
    "c_custkey bigint, fold bigint",
    "SELECT c_custkey, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '_0'), c_custkey) - 1) % 5 AS fold FROM customer",
)
def folds(t):
    return series.folds(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", 5, ["c_mktsegment"])


@query(
    "win_10_rank_in_group",
    "l_suppkey bigint, l_orderkey bigint, l_linenumber bigint, rank bigint, size bigint",
    """SELECT l_suppkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank,
       count(*) OVER (PARTITION BY l_suppkey) AS size FROM lineitem""",
)
def rank_in_group(t):
    df = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return series.ranked(
        df, ["l_suppkey"], [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"]
    ).withColumnRenamed("rank_total", "size")


SPARSE_SQL = f"(SELECT sku, month, CASE WHEN month(month) % 2 = 0 THEN price END AS price FROM {MONTHLY_SQL})"


@query(
    "nul_03_forward_fill",
    "sku bigint, month date, price double",
    f"SELECT sku, month, last_value(price IGNORE NULLS) OVER (PARTITION BY sku ORDER BY month ROWS UNBOUNDED PRECEDING) AS price FROM {SPARSE_SQL}",
)
def forward_fill(t):
    sparse = monthly_prices(t).withColumn("price", F.when(F.month("month") % 2 == 0, F.col("price")))
    return series.forward_fill(sparse, "sku", "month", ["price"])


@query(
    "nul_03_forward_fill_rows",
    "event_id bigint, last_purchase double",
    """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase
       FROM events""",
)
def forward_fill_rows(t):
    df = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase")
    )
    return series.forward_fill_rows(df, "user_id", ["ts", "event_id"], ["last_purchase"])


@query(
    "srt_01_top_and_bottom",
    "side string, o_orderkey bigint, o_totalprice double",
    """(SELECT 'top' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10) UNION ALL
       (SELECT 'bottom', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)""",
)
def top_and_bottom(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    top = rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).withColumn("side", F.lit("top"))
    return top.unionByName(rows.orderBy("o_totalprice", "o_orderkey").limit(10).withColumn("side", F.lit("bottom")))


@query(
    "srt_02_largest_difference",
    "sku bigint, diff double",
    """SELECT l_partkey AS sku, avg(l_quantity) FILTER (l_discount >= 0.08) - avg(l_quantity) FILTER (l_discount < 0.08) AS diff FROM lineitem GROUP BY 1
       ORDER BY abs(diff) DESC NULLS LAST, sku LIMIT 1""",
)
def largest_difference(t):
    lines = t.lineitem.withColumnRenamed("l_partkey", "sku").withColumn(
        "promo", F.when(F.col("l_discount") >= 0.08, F.col("l_discount"))
    )
    diffs = pricing.promo_effect(lines, "sku", "l_quantity", "promo")
    return diffs.orderBy(F.abs("diff").desc_nulls_last(), "sku").limit(1)


@query(
    "srt_03_top_fraction",
    "o_orderkey bigint, rank bigint",
    """SELECT o_orderkey, rank FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank, count(*) OVER () AS n FROM orders)
       WHERE rank <= floor(n * 0.2::DOUBLE)""",
)
def top_fraction(t):
    from tessera.sources.sinks import top_fractions

    return top_fractions(t.orders, "o_orderkey", "o_totalprice", [0.2])


@query(
    "bin_01_equal_width",
    "bin bigint, n bigint",
    """SELECT CAST(least(8, greatest(1, ceil((o_totalprice - a) / ((b - a) / 8)))) AS INT) AS bin, count(*) AS n FROM orders,
       (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders) GROUP BY 1""",
)
def equal_width(t):
    ends = t.orders.agg(F.min("o_totalprice").alias("a"), F.max("o_totalprice").alias("b"))
    bin_ = bins_equal_width(F.col("o_totalprice"), scalar(ends, "a"), scalar(ends, "b"), 8)
    return t.orders.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))


@query(
    "bin_02_quantile_bins",
    "bin bigint, n bigint, lo double, hi double",
    """WITH e AS (SELECT list_distinct(quantile_cont(l_discount, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS q FROM lineitem)
       SELECT greatest(1, len(list_filter(q, lambda x: x < l_discount))) AS bin, count(*) AS n, min(l_discount) AS lo, max(l_discount) AS hi FROM lineitem, e GROUP BY 1""",
)
def quantile_bins(t):
    probs = {f"q{i}": i / 10 for i in range(11)}
    edges = quantile_edges(exact_quantiles(t.lineitem, [], "l_discount", probs), list(probs))
    bin_ = bins_by_edges(F.col("l_discount"), edges)
    return (
        t.lineitem.select("l_discount", bin_.alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.min("l_discount").alias("lo"), F.max("l_discount").alias("hi"))
    )


@query(
    "bin_03_digitize",
    "grade bigint, n bigint",
    "SELECT CAST(value >= 5 AS INT) + CAST(value >= 20 AS INT) + CAST(value >= 60 AS INT) + CAST(value >= 150 AS INT) AS grade, count(*) AS n FROM events GROUP BY 1",
)
def digitized(t):
    return t.events.groupBy(digitize(F.col("value"), [5, 20, 60, 150]).alias("grade")).agg(F.count("*").alias("n"))


@query(
    "bin_04_split_thresholds",
    "feature string, threshold double",
    """SELECT DISTINCT 'balance' AS feature, unnest(quantile_cont(c_acctbal, [0.03, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.8, 0.9, 0.95, 0.97])) AS threshold FROM customer
       UNION ALL SELECT DISTINCT 'segment', unnest(quantile_cont(d, [0.1, 0.5, 0.9])) FROM (SELECT DISTINCT length(c_mktsegment) AS d FROM customer)""",
)
def split_thresholds(t):
    from tessera.operators.uplift_tree import thresholds

    df = t.customer.select(F.col("c_acctbal").alias("balance"), F.length("c_mktsegment").cast("double").alias("segment"))
    return thresholds(df, ["balance", "segment"])


@query(
    "fn_01_parse_datetime",
    "event_id bigint, day date, micros bigint",
    "SELECT event_id, CAST(ts AS DATE) AS day, epoch_us(ts) AS micros FROM events",
)
def parse_datetime(t):
    as_text = t.events.select("event_id", F.col("ts").cast("string").alias("ts"))
    parsed = as_text.withColumn("ts", F.to_timestamp_ntz("ts"))
    return parsed.select("event_id", F.to_date("ts").alias("day"), epoch_micros("ts").alias("micros"))


@query(
    "fn_02_date_keys",
    "o_orderkey bigint, y bigint, m bigint, iso_y bigint, w bigint, ym string, yw string",
    """SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, isoyear(o_orderdate) AS iso_y, week(o_orderdate) AS w,
       strftime(o_orderdate, '%Y-%m') AS ym, isoyear(o_orderdate) || '-' || lpad(CAST(week(o_orderdate) AS VARCHAR), 2, '0') AS yw FROM orders""",
)
def date_keys(t):
    d = "o_orderdate"
    week = F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    return t.orders.select(
        "o_orderkey",
        F.year(d).alias("y"),
        F.month(d).alias("m"),
        iso_year(d).alias("iso_y"),
        F.weekofyear(d).alias("w"),
        F.date_format(d, "yyyy-MM").alias("ym"),
        F.concat_ws("-", iso_year(d).cast("string"), week).alias("yw"),
    )


@query("fn_03_weekday", "wd bigint, n bigint", "SELECT isodow(o_orderdate) - 1 AS wd, count(*) AS n FROM orders GROUP BY 1")
def weekday(t):
    return t.orders.groupBy(weekday0("o_orderdate").alias("wd")).agg(F.count("*").alias("n"))


@query(
    "fn_04_cyclic_day",
    "phase bigint, n bigint",
    "SELECT date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 14 AS phase, count(*) AS n FROM orders GROUP BY 1",
)
def cyclic_day(t):
    day = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date"))
    return t.orders.groupBy(F.pmod(day, F.lit(14)).alias("phase")).agg(F.count("*").alias("n"))


@query(
    "fn_05_day_sequence",
    "c_nationkey bigint, day date, n bigint",
    """WITH a AS (SELECT c_nationkey, CAST(min(o_orderdate) AS DATE) AS lo FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1),
       s AS (SELECT c_nationkey, CAST(unnest(generate_series(lo, lo + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM a)
       SELECT s.c_nationkey, s.day, count(o.o_orderkey) AS n FROM s LEFT JOIN (SELECT c_nationkey, o_orderdate, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey) o
       ON s.c_nationkey = o.c_nationkey AND s.day = CAST(o.o_orderdate AS DATE) GROUP BY 1, 2""",
)
def day_sequence(t):
    sold = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_nationkey", F.to_date("o_orderdate").alias("day"), "o_orderkey"
    )
    spine = (
        sold.groupBy("c_nationkey")
        .agg(F.min("day").alias("lo"))
        .select("c_nationkey", F.explode(F.sequence("lo", F.date_add("lo", 30))).alias("day"))
    )
    return (
        spine.join(sold, ["c_nationkey", "day"], "left")
        .groupBy("c_nationkey", "day")
        .agg(F.count("o_orderkey").alias("n"))
    )


@query(
    "fn_06_text_pieces",
    "c_custkey bigint, number bigint, tag string",
    "SELECT c_custkey, CAST(substr(c_name, 10) AS BIGINT) AS number, left(c_mktsegment, 3) || '-' || c_nationkey AS tag FROM customer",
)
def text_pieces(t):
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 10, 100).cast("bigint").alias("number"),
        F.concat_ws("-", F.left("c_mktsegment", F.lit(3)), F.col("c_nationkey").cast("string")).alias("tag"),
    )


@query(
    "fn_07_tokens",
    "doc_id bigint, n_tokens bigint, n_distinct bigint, first_token string",
    f"""SELECT doc_id, len(w) AS n_tokens, len(list_distinct(w)) AS n_distinct, w[1] AS first_token FROM (SELECT doc_id, {tokens_sql("text")} AS w FROM documents)""",
)
def token_counts(t):
    df = t.documents.select("doc_id", text.tokens("text").alias("w"))
    return df.select(
        "doc_id",
        F.size("w").alias("n_tokens"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        F.try_element_at("w", F.lit(1)).alias("first_token"),
    )


@query(
    "fn_08_html_text",
    "page_id bigint, text string",
    """SELECT page_id, trim(split_part(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'gs'),
       '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g')), 'See full bio', 1)) AS text FROM pages""",
)
def html_text(t):
    return t.pages.select("page_id", cut_suffix(strip_tags(F.col("html")), "See full bio").alias("text"))


@query(
    "fn_09_md5_mod",
    "c_custkey bigint, m100 bigint, m6 bigint, mbig bigint",
    """SELECT c_custkey, h % 100 AS m100, h % 6 AS m6, h % 2147483647 AS mbig FROM (SELECT c_custkey, concat('0x', md5(CAST(c_custkey AS VARCHAR)))::UHUGEINT AS h FROM customer)""",
)
def md5_modulo(t):
    key = F.col("c_custkey").cast("string")
    return t.customer.select(
        "c_custkey", md5_mod(key, 100).alias("m100"), md5_mod(key, 6).alias("m6"), md5_mod(key, 2**31 - 1).alias("mbig")
    )


@query(
    "fn_10_math",
    "event_id bigint, a double, b double, c double, d double, e double, f double",
    "SELECT event_id, ln(value) AS a, ln(1 + value) AS b, log2(value) AS c, exp(-value / 100) AS d, sqrt(value) + value ** 1.5 AS e, ceil(abs(value - 50)) + least(greatest(value, 10), 200) AS f FROM events",
)
def math(t):
    v = F.col("value")
    return t.events.select(
        "event_id",
        F.ln(v).alias("a"),
        F.log1p(v).alias("b"),
        F.log2(v).alias("c"),
        F.exp(-v / 100).alias("d"),
        (F.sqrt(v) + F.pow(v, F.lit(1.5))).alias("e"),
        (F.ceil(F.abs(v - 50)) + F.least(F.greatest(v, F.lit(10.0)), F.lit(200.0))).alias("f"),
    )


@query(
    "fn_11_normal_cdf",
    "c_custkey bigint, p double",
    f"SELECT c_custkey, {phi_sql('(c_acctbal - 4500) / 1500')} AS p FROM customer",
)
def normal_cdf(t):
    return t.customer.select("c_custkey", stats.norm_cdf((F.col("c_acctbal") - 4500) / 1500).alias("p"))


@query(
    "fn_12_normal_log_density",
    "event_id bigint, lp double",
    "SELECT event_id, -(((value - 50) / 30) ** 2) / 2 - ln(30) - ln(2 * pi()) / 2 AS lp FROM events",
)
def normal_log_density(t):
    return t.events.select("event_id", stats.norm_log_density(F.col("value"), 50, 30).alias("lp"))


@query(
    "fn_13_vector_functions",
    "vec_id bigint, dist double, cosine double, size double, unit_first double",
    """WITH d AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
       m AS (SELECT label, list(a ORDER BY i) AS c FROM (SELECT label, i, avg(e[i]) AS a FROM d, range(1, 65) r(i) GROUP BY 1, 2) GROUP BY 1)
       SELECT vec_id, list_distance(e, c) AS dist, list_cosine_similarity(e, c) AS cosine, sqrt(list_inner_product(c, c)) AS size,
       c[1] / sqrt(list_inner_product(c, c)) AS unit_first FROM d JOIN m USING (label)""",
)
def vector_functions(t):
    centres = vectors.mean_vector(t.embeddings, ["label"], "embedding", "c")
    e, c = F.col("embedding"), F.col("c")
    return t.embeddings.join(centres, "label").select(
        "vec_id",
        vectors.l2(e, c).alias("dist"),
        vectors.cosine(e, c).alias("cosine"),
        vectors.norm(c).alias("size"),
        vectors.normalised(c)[0].alias("unit_first"),
    )


@query(
    "fn_14_json_round_trip",
    "conv_id bigint, turn bigint, role string, chars bigint",
    "SELECT conv_id, turn, role, length(text) AS chars FROM conversations",
)
def json_round_trip(t):
    packed = t.conversations.select(F.to_json(F.struct("conv_id", "turn", F.struct("role", "text").alias("said"))).alias("j"))
    rec = packed.select(F.from_json("j", "conv_id bigint, turn bigint, said struct<role: string, text: string>").alias("r"))
    return rec.select("r.conv_id", "r.turn", "r.said.role", F.length("r.said.text").alias("chars"))


@query(
    "fn_15_array_functions",
    "doc_id bigint, head string, has_the bigint, padded bigint, flat bigint",
    f"""SELECT doc_id, array_to_string(w[1:5], ' ') AS head, CAST(list_contains(w, 'the') AS INT) AS has_the,
        greatest(len(w), 40) AS padded, len(w) + 3 AS flat FROM (SELECT doc_id, {tokens_sql("text")} AS w FROM documents)""",
)
def array_functions(t):
    df = t.documents.select("doc_id", text.tokens("text").alias("w"))
    missing = F.greatest(F.lit(40) - F.size("w"), F.lit(0))
    return df.select(
        "doc_id",
        F.concat_ws(" ", F.slice("w", 1, 5)).alias("head"),
        F.array_contains("w", "the").cast("int").alias("has_the"),
        F.size(F.concat("w", F.array_repeat(F.lit("<pad>"), missing))).alias("padded"),
        F.size(F.flatten(F.array("w", F.array(F.lit("a"), F.lit("b"), F.lit("c"))))).alias("flat"),
    )


STOP_SQL = ", ".join(f"('{w}', '{lang}')" for lang, ws in text.STOP_WORDS.items() for w in ws)


@query(
    "fn_16_language_guess",
    "doc_id bigint, lang string, guess string, hits bigint",
    f"""WITH s AS (SELECT * FROM (VALUES {STOP_SQL}) v(word, guess)), w AS (SELECT doc_id, unnest({tokens_sql("text")}) AS word FROM documents),
        h AS (SELECT doc_id, guess, count(*) AS hits FROM w JOIN s USING (word) GROUP BY 1, 2),
        b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, guess DESC) = 1)
        SELECT d.doc_id, d.lang, b.guess, coalesce(b.hits, 0) AS hits FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id""",
)
def language_guess(t):
    return text.guess_language(t.documents.select("doc_id", "lang", "text"), "doc_id", "text")
