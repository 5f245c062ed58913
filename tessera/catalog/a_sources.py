"""Sources and sinks over the given tables."""

import uuid

from pyspark.sql import functions as F

from tessera.catalog.registry import query
from tessera.session import use_checkpoint_dir
from tessera.sources import files, pages, sinks


def scratch(t, name: str) -> str:
    """A fresh folder in the shared scratch space of the session."""
    return f"{use_checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


ENTITY_SQL = (
    "replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
)


def strip_sql(expr: str) -> str:
    bare = f"regexp_replace({expr}, '<[^>]*>', ' ', 'gs')"
    return f"trim(regexp_replace({ENTITY_SQL.format(bare)}, '\\s+', ' ', 'g'))"


@query(
    "src_01_csv_scan",
    "c_custkey bigint, c_nationkey bigint, c_acctbal double, c_mktsegment string",
    "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_scan(t):
    path = scratch(t, "customers-csv")
    sinks.write_csv(t.customer, path)
    return files.read_csv(
        t.spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )


@query(
    "src_02_parquet_scan",
    "l_returnflag string, n bigint, qty double",
    "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1",
)
def parquet_scan(t):
    return (
        files.read_parquet(t.spark, f"{t.folder}/lineitem.parquet")
        .groupBy("l_returnflag")
        .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    )


@query(
    "src_03_text_pairs_scan",
    "id_left string, id_right string, label string",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id_left, CAST(o_custkey AS VARCHAR) AS id_right, o_orderpriority AS label
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def text_pairs_scan(t):
    path = scratch(t, "pairs-tsv")
    pairs = t.orders.select(
        F.col("o_orderkey").alias("qid1"),
        F.col("o_custkey").alias("qid2"),
        F.col("o_orderpriority").alias("grade"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    )
    pairs.write.options(header=True, sep="\t").csv(path)
    return files.read_text_pairs(
        t.spark, path, {"qid1": "id_left", "qid2": "id_right", "grade": "label", "status": ""}
    )


@query(
    "src_04_json_records",
    "event_type string, n bigint, k_sum bigint",
    """SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k_sum
       FROM events GROUP BY 1""",
)
def json_records(t):
    path = scratch(t, "events-json")
    t.events.select("event_type", "props", F.col("ts").cast("string").alias("ts")).write.json(path)
    records = files.read_json_records(t.spark, path, "event_type string, props string, ts string", ["ts"])
    return (
        files.parse_json(records.where(F.col("ts").isNotNull()), "props", "k bigint")
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), F.sum("k").alias("k_sum"))
    )


@query(
    "src_05_word_vectors",
    "token string, dims bigint, first_value double, total double",
    """SELECT 'v' || vec_id AS token, len(embedding) AS dims, CAST(embedding[1] AS VARCHAR) AS first_value,
              list_sum(list_transform(embedding, lambda x: CAST(CAST(x AS VARCHAR) AS DOUBLE))) AS total FROM embeddings""",
)
def word_vectors(t):
    path = scratch(t, "vectors-txt")
    line = F.concat_ws(" ", F.concat(F.lit("v"), F.col("vec_id")), F.transform("embedding", lambda x: x.cast("string")))
    t.embeddings.select(line.alias("value")).write.text(path)
    v = files.read_word_vectors(t.spark, path)
    return v.select(
        "token",
        F.size("v").alias("dims"),
        F.col("v")[0].alias("first_value"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query(
    "src_06_table_registry",
    "n_name string, customers bigint",
    """SELECT n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1""",
)
def table_registry(t):
    registry = files.TableRegistry({"nation": t.nation})
    registry.register("customer", t.customer)
    n, c = registry.get("nation"), registry.get("customer")
    return (
        n.join(c, n.n_nationkey == c.c_nationkey, "left")
        .groupBy("n_name")
        .agg(F.count("c_custkey").alias("customers"))
    )


@query(
    "src_07_page_items",
    "page_id bigint, lang string, title string, heading string, body string, n_links bigint",
    f"""SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
          {strip_sql("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} AS title,
          {strip_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS heading,
          {strip_sql("regexp_extract(html, '<article>(.*?)</article>', 1, 's')")} AS body,
          len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_links FROM pages""",
)
def page_items(t):
    return pages.page_items(t.pages).withColumn("n_links", F.size("links"))


@query(
    "src_08_page_links",
    "page_id bigint, pos bigint, link string",
    """SELECT page_id, i - 1 AS pos, links[i] AS link FROM (
         SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages) p,
         LATERAL (SELECT unnest(range(1, least(len(links), 5) + 1)) AS i) r""",
)
def page_links(t):
    return pages.page_links(t.pages, top_k=5)


@query("snk_01_csv_sink", "n bigint, revenue double", "SELECT count(*) AS n, sum(l_extendedprice) AS revenue FROM lineitem")
def csv_sink(t):
    path = scratch(t, "lines-csv")
    sinks.write_csv(t.lineitem.select("l_orderkey", "l_extendedprice"), path)
    return files.read_csv(t.spark, path, "l_orderkey bigint, l_extendedprice double").agg(
        F.count("*").alias("n"), F.sum("l_extendedprice").alias("revenue")
    )


@query(
    "snk_02_feature_sink",
    "o_custkey bigint, orders_count bigint, orders_sum double",
    "SELECT o_custkey, count(*) AS orders_count, sum(o_totalprice) AS orders_sum FROM orders GROUP BY 1",
)
def feature_sink(t):
    path = scratch(t, "features")
    sinks.write_features(
        t.orders.groupBy("o_custkey").agg(
            F.count("*").alias("orders_count"), F.sum("o_totalprice").alias("orders_sum")
        ),
        path,
    )
    return files.read_parquet(t.spark, path)


@query(
    "snk_03_item_sink",
    "item_type string, n bigint, text_chars bigint",
    f"""SELECT 'page' AS item_type, count(*) AS n, sum(length({strip_sql("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")})) AS text_chars FROM pages
        UNION ALL SELECT 'link', sum(len(l)), sum(list_sum(list_transform(l, lambda x: length(x)))) FROM (
          SELECT regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)""",
)
def item_sink(t):
    path = scratch(t, "items")
    items = pages.page_items(t.pages).select(F.lit("page").alias("item_type"), F.col("title").alias("text"))
    links = pages.page_links(t.pages).select(F.lit("link").alias("item_type"), F.col("link").alias("text"))
    sinks.write_items(items.unionByName(links), path)
    return (
        t.spark.read.schema("text string, item_type string")
        .json(path)
        .groupBy("item_type")
        .agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("text_chars"))
    )


@query(
    "snk_04_json_submit",
    "l_orderkey bigint, l_linenumber bigint, record string",
    """SELECT l_orderkey, l_linenumber, '{"dates":"' || strftime(l_shipdate, '%Y-%m-%d') || '","SKU":' || l_partkey ||
          ',"price":' || CAST(floor(l_extendedprice) AS BIGINT) || '}' AS record FROM lineitem""",
)
def json_submit(t):
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.to_date("l_shipdate").alias("dates"),
        F.col("l_partkey").alias("SKU"),
        F.floor("l_extendedprice").alias("price"),
    )
    return sinks.json_records(rows, {"dates": "string", "SKU": "bigint", "price": "bigint"})


@query(
    "snk_05_ranked_cutoffs",
    "c_custkey bigint, cutoff double, rank bigint",
    """WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank, count(*) OVER () AS n
                  FROM customer WHERE c_acctbal > 0)
       SELECT c_custkey, cutoff, rank FROM r, (VALUES (0.05), (0.1), (0.3)) AS c(cutoff)
       WHERE rank <= floor(n * CAST(cutoff AS DOUBLE))""",
)
def ranked_cutoffs(t):
    return sinks.top_fractions(t.customer, "c_custkey", "c_acctbal", [0.05, 0.1, 0.3])
