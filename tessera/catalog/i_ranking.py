"""Ranking quality, text matching and vector search."""

from pyspark.sql import functions as F

from tessera.catalog.e_series import tokens_sql
from tessera.catalog.registry import query
from tessera.functions.text import guess_language
from tessera.functions.hashing import uniform
from tessera.operators import matching, neighbours, ranking
from tessera.plans.prefix import cut_lineage

RANK_SQL = """(SELECT o_custkey AS q, o_orderkey AS id, 5 - CAST(substr(o_orderpriority, 1, 1) AS INT) AS y, CAST(o_orderpriority <= '2-HIGH' AS INT) AS b,
   o_totalprice / 100000 + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS s FROM orders)"""


def rank_rows(t):
    """Customers as queries, their orders as documents: grade y, binary label b, score s."""
    return t.orders.select(
        F.col("o_custkey").alias("q"),
        F.col("o_orderkey").alias("id"),
        (5 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("y"),
        (F.col("o_orderpriority") <= "2-HIGH").cast("int").alias("b"),
        (F.col("o_totalprice") / 100000 + F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("s"),
    )


@query(
    "rk_01_swapped_pairs",
    "q bigint, swapped bigint",
    f"WITH r AS {RANK_SQL} SELECT a.q, count(*) FILTER (a.y > b.y AND a.s < b.s) AS swapped FROM r a JOIN r b ON a.q = b.q GROUP BY 1",
)
def swapped_pairs(t):
    return ranking.swapped_pairs(rank_rows(t), "q", "y", "s")


@query(
    "rk_02_gain",
    "id bigint, plain double, exp2 double",
    f"SELECT id, y AS plain, power(2, y) - 1 AS exp2 FROM {RANK_SQL}",
)
def gains(t):
    return rank_rows(t).select("id", ranking.gain(F.col("y")).alias("plain"), ranking.gain(F.col("y"), "exp2").alias("exp2"))


@query(
    "rk_03_dcg",
    "q bigint, dcg double, dcg_5 double",
    f"""SELECT q, sum(y / log2(i + 1)) AS dcg, sum((power(2, y) - 1) / log2(i + 1)) FILTER (i <= 5) AS dcg_5
        FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS i FROM {RANK_SQL}) GROUP BY 1""",
)
def dcg(t):
    rows = rank_rows(t)
    return ranking.dcg(rows, "q", "id", "y", "s").join(ranking.dcg(rows, "q", "id", "y", "s", 5, "exp2", "dcg_5"), "q")


@query(
    "rk_04_ndcg",
    "q bigint, ndcg double, ndcg_5 double",
    f"""SELECT q, coalesce(sum(y / log2(i + 1)) / nullif(sum(y / log2(j + 1)), 0), 0) AS ndcg,
        coalesce(sum((power(2, y) - 1) / log2(i + 1)) FILTER (i <= 5) / nullif(sum((power(2, y) - 1) / log2(j + 1)) FILTER (j <= 5), 0), 0) AS ndcg_5
        FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS i, row_number() OVER (PARTITION BY q ORDER BY y DESC, id) AS j FROM {RANK_SQL}) GROUP BY 1""",
)
def ndcg(t):
    rows = rank_rows(t)
    at5 = ranking.ndcg(rows, "q", "id", "y", "s", 5, "exp2").select("q", F.col("ndcg").alias("ndcg_5"))
    return ranking.ndcg(rows, "q", "id", "y", "s").join(at5, "q")


@query(
    "rk_05_precision_at_k",
    "q bigint, precision double, capped double",
    f"""SELECT q, count(*) FILTER (i <= 4 AND b = 1) / least(4, count(*)) AS precision, CASE WHEN sum(b) = 0 THEN -1 ELSE count(*) FILTER (i <= 4 AND b = 1) / least(4, count(*), sum(b)) END AS capped
        FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS i FROM {RANK_SQL}) GROUP BY 1""",
)
def precision_at_k(t):
    return ranking.precision_at_k(rank_rows(t), "q", "id", "b", "s", 4)


@query(
    "rk_06_reciprocal_rank",
    "q bigint, reciprocal_rank double",
    f"""SELECT q, 1 / min(i) FILTER (y = top) AS reciprocal_rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS i, max(y) OVER (PARTITION BY q) AS top FROM {RANK_SQL}) GROUP BY 1""",
)
def reciprocal_rank(t):
    return ranking.full_list_metrics(rank_rows(t), "q", "id", "y", "s")


@query(
    "rk_07_p_found",
    "q bigint, p_found double",
    f"""WITH r AS (SELECT q, y / 4.0::DOUBLE AS rel, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS i FROM {RANK_SQL}),
        l AS (SELECT q, rel, coalesce(product((1 - rel) * 0.85::DOUBLE) OVER (PARTITION BY q ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS look FROM r)
        SELECT q, sum(look * rel) AS p_found FROM l GROUP BY 1""",
)
def p_found(t):
    return ranking.full_list_metrics(rank_rows(t).withColumn("rel", F.col("y") / 4), "q", "id", "rel", "s")


@query(
    "rk_08_average_precision",
    "q bigint, average_precision double",
    f"""WITH r AS (SELECT q, b, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS i FROM {RANK_SQL}), c AS (SELECT q, b, i, sum(b) OVER (PARTITION BY q ORDER BY i) AS hits, sum(b) OVER (PARTITION BY q) AS n FROM r)
        SELECT q, CASE WHEN max(n) = 0 THEN -1 ELSE sum(b * hits / i) / max(n) END AS average_precision FROM c GROUP BY 1""",
)
def average_precision(t):
    return ranking.full_list_metrics(rank_rows(t), "q", "id", "b", "s")


@query(
    "rk_09_listwise_losses",
    "q bigint, cross_entropy double, kl double",
    f"""WITH z AS (SELECT q, y, s, sum(exp(y)) OVER (PARTITION BY q) AS zy, sum(exp(s)) OVER (PARTITION BY q) AS zs FROM {RANK_SQL})
        SELECT q, -sum(exp(y) / zy * ln(exp(s) / zs)) AS cross_entropy, sum(exp(y) / zy * (ln(exp(y) / zy) - ln(exp(s) / zs))) AS kl FROM z GROUP BY 1""",
)
def listwise_losses(t):
    return ranking.listwise_losses(rank_rows(t), "q", "y", "s")


@query(
    "rk_10_pair_label_sums",
    "q bigint, id bigint, n_lower bigint, n_equal bigint, n_higher bigint, gain_diff double, decay_diff double",
    f"""WITH r AS (SELECT *, 1 / log2(row_number() OVER (PARTITION BY q ORDER BY y DESC, id) + 1) AS d FROM {RANK_SQL})
        SELECT a.q, a.id, count(*) FILTER (b.y < a.y) AS n_lower, count(*) FILTER (b.y = a.y) AS n_equal, count(*) FILTER (b.y > a.y) AS n_higher,
        sum(power(2, a.y) - power(2, b.y)) AS gain_diff, sum(a.d - b.d) AS decay_diff FROM r a JOIN r b ON a.q = b.q GROUP BY 1, 2""",
)
def pair_label_sums(t):
    return ranking.pair_label_sums(rank_rows(t), "q", "id", "y")


@query(
    "rk_11_lambdas",
    "q bigint, id bigint, grad double",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY y DESC, id) AS i FROM {RANK_SQL}), n AS (SELECT q, sum((power(2, y) - 1) / log2(i + 1)) FILTER (i <= 5) AS ideal FROM r GROUP BY 1)
        SELECT a.q, a.id, CASE WHEN max(ideal) > 0 THEN sum((0.5 * (1 - sign(a.y - b.y)) - 1 / (1 + exp(a.s - b.s))) * abs((power(2, a.y) - power(2, b.y)) * (1 / log2(a.i + 1) - 1 / log2(b.i + 1)))) / max(ideal) ELSE 0 END AS grad
        FROM r a JOIN r b ON a.q = b.q JOIN n ON n.q = a.q GROUP BY 1, 2""",
)
def lambda_gradients(t):
    return ranking.lambdas(rank_rows(t), "q", "id", "y", "s", k=5, block=8, name="grad")


def ranker_rows(t):
    return rank_rows(t).join(
        t.orders.select(
            F.col("o_orderkey").alias("id"),
            (F.col("o_totalprice") / 100000).alias("price"),
            F.month("o_orderdate").cast("double").alias("month"),
            F.dayofmonth("o_orderdate").cast("double").alias("dom"),
        ),
        "id",
    )


@query("rk_12_lambdamart", "q bigint, ndcg double")
def lambdamart(t):
    rows = ranker_rows(t)
    held = uniform(F.col("q"), "valid") < 0.3
    features = ["price", "month", "dom"]
    model = ranking.LambdaMart(features, "q", "id", "y", n_trees=2).fit(rows.where(~held), rows.where(held))
    return ranking.ndcg(model.predict(rows), "q", "id", "y", "score", 10, "exp2")


@query("rk_13_linear_ranker", "q bigint, ndcg double")
def linear_ranker(t):
    rows, features = ranker_rows(t), ["price", "month", "dom"]
    weights = ranking.fit_linear_ranker(rows, "q", "id", "y", features)
    scored = rows.withColumn("score", ranking.linear_score(features, weights))
    return ranking.ndcg(scored, "q", "id", "y", "score", 10, "exp2")


@query(
    "jn_12_pair_counts",
    "q bigint, id bigint, n_lower bigint, n_higher bigint",
    f"""WITH r AS {RANK_SQL} SELECT a.q, a.id, count(*) FILTER (b.y < a.y) AS n_lower, count(*) FILTER (b.y > a.y) AS n_higher FROM r a JOIN r b ON a.q = b.q GROUP BY 1, 2""",
)
def pair_counts(t):
    return ranking.pair_label_sums(rank_rows(t), "q", "id", "y")


WORDS = f"(SELECT doc_id, unnest({tokens_sql('text')}) AS token FROM documents)"
VOCAB_SQL = f"""(SELECT token, count(*) AS n FROM (SELECT unnest({tokens_sql('text')}) AS token FROM (SELECT text FROM documents UNION SELECT text FROM benchmark)) GROUP BY 1 HAVING count(*) >= 3)"""


def vocab(t):
    return matching.vocabulary([t.documents, t.benchmark], min_count=3)


@query("tx_01_vocabulary", "token string, n bigint", f"SELECT token, n FROM {VOCAB_SQL}")
def vocabulary(t):
    return vocab(t)


IDS_SQL = f"(SELECT token, row_number() OVER (ORDER BY token) + 1 AS id FROM {VOCAB_SQL})"


@query(
    "tx_02_token_ids",
    "token string, id bigint, known bigint",
    f"SELECT token, id, CAST(token IN (SELECT unnest({tokens_sql('text')}) FROM benchmark) AS INT) AS known FROM {IDS_SQL}",
)
def token_ids(t):
    given = matching.vocabulary([t.benchmark]).select("token")
    return matching.token_ids(vocab(t), given)


@query(
    "tx_03_id_sequences",
    "doc_id bigint, size bigint, oov bigint, pads bigint, checksum bigint",
    f"""WITH w AS (SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, {tokens_sql('text')} AS l FROM documents)),
        c AS (SELECT doc_id, pos, coalesce(id, 1) AS code FROM w LEFT JOIN {IDS_SQL} i ON i.token = w.token)
        SELECT doc_id, greatest(count(*), 30) AS size, count(*) FILTER (code = 1) AS oov, greatest(30 - count(*), 0) AS pads, sum(pos * code) AS checksum FROM c GROUP BY 1""",
)
def id_sequences(t):
    seq = matching.id_sequences(t.documents, "doc_id", matching.token_ids(vocab(t)), pad_to=30)
    total = F.aggregate(
        F.transform("ids", lambda x, i: x * (i + 1)), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    return seq.select(
        "doc_id",
        F.size("ids").alias("size"),
        F.size(F.filter("ids", lambda x: x == 1)).alias("oov"),
        F.size(F.filter("ids", lambda x: x == 0)).alias("pads"),
        total.alias("checksum"),
    )


DIMS = 8


def vector_sql(token: str) -> str:
    return (
        f"list_transform(range(0, {DIMS}), lambda d: (CAST(concat('0x', substr(md5({token} || '_0_' || d), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE * 2 - 1) * 0.2::DOUBLE)"
    )


@query(
    "tx_04_seeded_vectors",
    "token string, dim bigint, value double",
    f"""SELECT token, d AS dim, v[d + 1] AS value FROM (SELECT token, {vector_sql('token')} AS v FROM {VOCAB_SQL}), range(0, {DIMS}) r(d)""",
)
def seeded_vectors(t):
    made = matching.token_vectors(vocab(t), None, DIMS)
    return made.select("token", F.posexplode_outer("v").alias("dim", "value"))


def text_vector_sql(table: str, key: str) -> str:
    """Mean vectors of all texts of a table by dimension; one vector for unknown words, zeros without words."""
    return f"""(SELECT {key}, d AS dim, coalesce(value, 0) AS value FROM (SELECT DISTINCT {key} FROM {table}) CROSS JOIN range(0, {DIMS}) r(d) LEFT JOIN
       (SELECT {key}, d, avg(coalesce(v[d + 1], unknown[d + 1])) AS value FROM (SELECT {key}, unnest({tokens_sql('text')}) AS token FROM {table}) w
        LEFT JOIN (SELECT token, {vector_sql('token')} AS v FROM {VOCAB_SQL}) USING (token), (SELECT {vector_sql("''")} AS unknown), range(0, {DIMS}) r(d) GROUP BY 1, 2) USING ({key}, d))"""


def word_vectors(t):
    return cut_lineage(matching.token_vectors(vocab(t), None, DIMS))


@query("tx_05_text_vectors", "doc_id bigint, dim bigint, value double", f"SELECT doc_id, dim, value FROM {text_vector_sql('documents', 'doc_id')}")
def text_vectors(t):
    return matching.text_vectors(t.documents, "doc_id", word_vectors(t), DIMS).select("doc_id", F.posexplode("vector").alias("dim", "value"))


PAIR_ROWS_SQL = "(SELECT o_custkey AS l, o_orderkey + 1000000000 AS r, greatest(0, 3 - CAST(substr(o_orderpriority, 1, 1) AS INT)) AS label FROM orders)"


def pair_rows(t):
    return t.orders.select(
        F.col("o_custkey").alias("l"),
        (F.col("o_orderkey") + 1000000000).alias("r"),
        F.greatest(F.lit(0), 3 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("label"),
    )


@query(
    "tx_06_training_triplets",
    "l bigint, first bigint, second bigint, target double",
    f"""WITH b AS (SELECT * FROM {PAIR_ROWS_SQL} WHERE l IN (SELECT l FROM {PAIR_ROWS_SQL} GROUP BY l HAVING min(label) < max(label))),
        p AS (SELECT *, row_number() OVER (PARTITION BY l, label ORDER BY md5(l || '_' || r || '_0'), r) AS i, count(*) OVER (PARTITION BY l, label) AS n FROM b),
        f AS (SELECT l, label, max(r) FILTER (i = 1) AS a, max(r) FILTER (i = 2) AS b FROM p WHERE i <= 2 GROUP BY 1, 2),
        g AS (SELECT f.l, f.label, f.a, f.b, (SELECT c.r FROM b c WHERE c.l = f.l AND c.label < f.label ORDER BY md5(c.l || '_' || c.r || '_0_negative'), c.r LIMIT 1) AS neg FROM f)
        SELECT l, a AS first, coalesce(b, neg) AS second, CASE WHEN b IS NOT NULL THEN 0.5 ELSE 1 END AS target FROM g WHERE coalesce(b, neg) IS NOT NULL""",
)
def training_triplets(t):
    return matching.training_triplets(pair_rows(t), "l", "r", "label")


@query(
    "tx_07_validation_pairs",
    "l bigint, r bigint, grade bigint",
    f"""WITH b AS {PAIR_ROWS_SQL}, s AS (SELECT l, count(*) AS size FROM b GROUP BY 1 HAVING count(*) >= 2), k AS (SELECT l, r, CASE WHEN label > 0 THEN 2 ELSE 1 END AS grade FROM b JOIN s USING (l)),
        e AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY md5(id || '_0'), id) - 1 AS at FROM (SELECT l AS id FROM b UNION SELECT r FROM b)),
        h AS MATERIALIZED (SELECT s.l, 15 - size AS need, CAST(concat('0x', md5(s.l || '_0'))::UHUGEINT % n::UHUGEINT AS BIGINT) AS start, n FROM s, (SELECT count(*) AS n FROM e) WHERE size < 15),
        m AS MATERIALIZED (SELECT l, need, i, (start + i) % n AS at FROM h, range(0, 16) t(i)),
        c AS (SELECT m.l, need, i, e.id FROM m JOIN e ON e.at = m.at),
        f AS (SELECT c.l, c.id, need, row_number() OVER (PARTITION BY c.l ORDER BY i) AS p FROM c ANTI JOIN k ON k.l = c.l AND k.r = c.id WHERE c.id <> c.l)
        SELECT l, r, grade FROM k UNION ALL SELECT l, id, 0 FROM f WHERE p <= need""",
)
def validation_pairs(t):
    return matching.validation_pairs(pair_rows(t), "l", "r", "label")


TURNS_SQL = """(SELECT a.conv_id * 1000 + a.turn AS l, b.conv_id * 1000 + b.turn AS r, a.text AS text_l, b.text AS text_r FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user')"""


def turns(t):
    """Each user turn beside the turn that answers it."""
    key = F.col("conv_id") * 1000 + F.col("turn")
    asked = t.conversations.where("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), key.alias("l"), F.col("text").alias("text_l")
    )
    answers = t.conversations.select("conv_id", "turn", key.alias("r"), F.col("text").alias("text_r"))
    return asked.join(answers, ["conv_id", "turn"]).select("l", "r", "text_l", "text_r")


@query(
    "tx_08_id_texts",
    "id bigint, chars bigint",
    f"""SELECT id, length(text) AS chars FROM (SELECT id, text, row_number() OVER (PARTITION BY id ORDER BY side, text) AS i FROM (SELECT r AS id, text_r AS text, 0 AS side FROM {TURNS_SQL} UNION ALL SELECT l, text_l, 1 FROM {TURNS_SQL})) WHERE i = 1""",
)
def id_texts(t):
    return matching.id_texts(turns(t), "l", "r", "text_l", "text_r").select("id", F.length("text").alias("chars"))


def turn_vectors(t):
    rows = turns(t)
    words = matching.vocabulary([t.conversations])
    vectors = cut_lineage(matching.token_vectors(words, None, DIMS))
    left = matching.vector_blocks(rows.select("l", F.col("text_l").alias("text")).distinct(), "l", vectors, matching.unknown_vector(DIMS))
    right = matching.vector_blocks(rows.select("r", F.col("text_r").alias("text")).distinct(), "r", vectors, matching.unknown_vector(DIMS))
    return rows.select("l", "r"), left, right


MATRIX_SQL = f"""(SELECT l, r, i, list_cosine_similarity(a.v, b.v) AS c FROM (SELECT l, r, unnest(list_transform({tokens_sql('text_l')}, lambda w: w)) AS tok, generate_subscripts({tokens_sql('text_l')}, 1) AS i FROM {TURNS_SQL}) x
   JOIN (SELECT token, {vector_sql('token')} AS v FROM (SELECT DISTINCT unnest({tokens_sql('text')}) AS token FROM conversations)) a ON a.token = tok
   JOIN (SELECT l, r, unnest({tokens_sql('text_r')}) AS tok2 FROM {TURNS_SQL}) y USING (l, r)
   JOIN (SELECT token, {vector_sql('token')} AS v FROM (SELECT DISTINCT unnest({tokens_sql('text')}) AS token FROM conversations)) b ON b.token = tok2)"""


@query(
    "tx_09_matching_matrix",
    "l bigint, r bigint, rows bigint, cols bigint, mean double, best double",
    f"""SELECT l, r, count(*) AS rows, max(n) AS cols, sum(total) / sum(n) AS mean, avg(top) AS best FROM (SELECT l, r, i, count(*) AS n, sum(c) AS total, max(c) AS top FROM {MATRIX_SQL} GROUP BY 1, 2, 3) GROUP BY 1, 2""",
)
def matching_matrix(t):
    pairs, left, right = turn_vectors(t)
    return matching.best_token_matches(pairs, "l", "r", left, right)


KERNEL_SQL = ", ".join(f"({i}, {mu!r}::DOUBLE, {s!r}::DOUBLE)" for i, (mu, s) in enumerate(matching.kernel_centres()))


@query(
    "tx_10_kernel_features",
    "l bigint, r bigint, kernel bigint, value double",
    f"""SELECT l, r, kernel, sum(ln(1 + s)) AS value FROM (SELECT l, r, i, kernel, sum(exp(-((c - mu) ** 2) / (2 * sg ** 2))) AS s FROM {MATRIX_SQL}, (VALUES {KERNEL_SQL}) k(kernel, mu, sg) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3""",
)
def kernel_features(t):
    pairs, left, right = turn_vectors(t)
    made = matching.kernel_features(pairs, "l", "r", left, right)
    return made.select("l", "r", F.posexplode("kernels").alias("kernel", "value"))


@query("tx_11_kernel_scorer", "l bigint, r bigint, score double")
def kernel_scorer(t):
    """Answers to the own question against answers to the next conversation's question."""
    pairs, left, right = turn_vectors(t)
    shifted = pairs.select((F.col("l") + 1000).alias("l"), "r").join(pairs.select("l"), "l", "left_semi")
    labelled = pairs.withColumn("label", F.lit(1.0)).unionByName(shifted.withColumn("label", F.lit(0.0)))
    made = cut_lineage(matching.kernel_features(labelled, "l", "r", left, right))
    weights = matching.fit_scorer(made, "kernels", 21, "label")
    return made.where("label = 1").withColumn("score", matching.kernel_score("kernels", weights))


@query(
    "vs_01_exact_neighbours",
    "query_id bigint, id bigint, dist double, rank bigint",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
       SELECT query_id, id, dist, rank FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_distance(a.v, b.v), 9) AS dist, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 9), b.vec_id) AS rank
       FROM e a JOIN e b ON a.vec_id <> b.vec_id) WHERE rank <= 10""",
)
def exact_neighbours(t):
    return neighbours.nearest(t.embeddings, t.embeddings, 10, "vec_id", "vec_id", "embedding", skip_self=True)


@query(
    "jn_13_distance_join",
    "query_id bigint, id bigint, dist double, rank bigint",
    """WITH q AS (SELECT label AS query_id, list(a ORDER BY i) AS v FROM (SELECT label, i, avg(embedding[i]::DOUBLE) AS a FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2) GROUP BY 1)
       SELECT query_id, id, dist, rank FROM (SELECT query_id, vec_id AS id, round(list_distance(v, embedding::DOUBLE[]), 9) AS dist, row_number() OVER (PARTITION BY query_id ORDER BY round(list_distance(v, embedding::DOUBLE[]), 9), vec_id) AS rank FROM q, embeddings) WHERE rank <= 20""",
)
def distance_join(t):
    from tessera.functions.vectors import mean_vector

    centres = mean_vector(t.embeddings, ["label"], "embedding", "embedding")
    return neighbours.nearest(centres, t.embeddings, 20, "label", "vec_id", "embedding")


@query("vs_02_hashed_neighbours", "query_id bigint, id bigint, dist double, rank bigint")
def hashed_neighbours(t):
    return neighbours.hashed_neighbours(t.embeddings, "vec_id", "embedding", 10, bucket=0.5, tables=4, radius=1.3)


def choice_sql(kind: str, direction: str) -> str:
    return f"""SELECT src, dst, '{kind}' AS kind, dist FROM (SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY md5(src || '_' || dst || '_{kind}_0'), dst) AS i FROM (
        SELECT a.vec_id AS src, b.vec_id AS dst, round(list_distance(a.v, b.v), 9) AS dist, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 9) {direction}, b.vec_id) AS r FROM e a JOIN e b ON a.vec_id <> b.vec_id) WHERE r <= 10) WHERE i <= 5"""


@query(
    "vs_03_small_world_graph",
    "src bigint, dst bigint, kind string, dist double",
    f"WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) {choice_sql('near', 'ASC')} UNION ALL {choice_sql('far', 'DESC')}",
)
def small_world_graph(t):
    return neighbours.small_world_graph(t.embeddings, "vec_id", "embedding")


@query(
    "vs_04_recall",
    "query_id bigint, recall double",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings), r AS (SELECT a.vec_id AS query_id, a.label AS la, b.label AS lb, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 9), b.vec_id) AS r FROM e a JOIN e b ON a.vec_id <> b.vec_id)
       SELECT query_id, count(*) FILTER (la = lb) / 10 AS recall FROM r WHERE r <= 10 GROUP BY 1""",
)
def recall(t):
    """How many of the true neighbours a search limited to the own label would find."""
    truth = cut_lineage(neighbours.nearest(t.embeddings, t.embeddings, 10, "vec_id", "vec_id", "embedding", skip_self=True))
    labels = t.embeddings.select("vec_id", "label")
    same = (
        truth.join(labels.withColumnRenamed("vec_id", "query_id"), "query_id")
        .join(labels.select(F.col("vec_id").alias("id"), F.col("label").alias("other")), "id")
        .where("label = other")
    )
    return neighbours.recall(same, truth, 10)


@query(
    "vs_05_graph_search",
    "query_id bigint, id bigint, dist double, rank bigint",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
       SELECT query_id, id, dist, rank FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_distance(a.v, b.v), 9) AS dist, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.v, b.v), 9), b.vec_id) AS rank
       FROM e a CROSS JOIN e b) WHERE rank <= 10""",
)
def graph_search(t):
    """What a walk through a neighbour graph approximates: every vector's ten nearest, itself included."""
    return neighbours.nearest(t.embeddings, t.embeddings, 10, "vec_id", "vec_id", "embedding")


CANDIDATES_SQL = f"""WITH dv AS (SELECT doc_id AS id, list(value ORDER BY dim) AS v FROM {text_vector_sql('documents', 'doc_id')} GROUP BY 1),
  qv AS (SELECT item_id AS query_id, list(value ORDER BY dim) AS v FROM {text_vector_sql('benchmark', 'item_id')} GROUP BY 1)"""


def text_index(t, words):
    return cut_lineage(matching.text_vectors(t.documents, "doc_id", words, DIMS))


def search_queries(t, words):
    """Benchmark texts that pass the language gate, with their vectors."""
    english = guess_language(t.benchmark, "item_id", "text").where("guess = 'en'").select("item_id", "text")
    return english, cut_lineage(matching.text_vectors(english, "item_id", words, DIMS))


def stop_sql() -> str:
    from tessera.catalog.e_series import STOP_SQL

    return f"""(SELECT item_id FROM (SELECT item_id, guess, row_number() OVER (PARTITION BY item_id ORDER BY count(*) DESC, guess DESC) AS i FROM
      (SELECT item_id, unnest({tokens_sql('text')}) AS word FROM benchmark) JOIN (SELECT * FROM (VALUES {STOP_SQL}) v(word, guess)) USING (word) GROUP BY 1, 2) WHERE i = 1 AND guess = 'en')"""


@query(
    "vs_06_search_candidates",
    "query_id bigint, id bigint, dist double, rank bigint",
    CANDIDATES_SQL
    + f""" SELECT query_id, id, dist, rank FROM (SELECT query_id, id, round(list_distance(qv.v, dv.v), 9) AS dist, row_number() OVER (PARTITION BY query_id ORDER BY round(list_distance(qv.v, dv.v), 9), id) AS rank
       FROM qv, dv WHERE query_id IN {stop_sql()}) WHERE rank <= 100""",
)
def search_candidates(t):
    words = word_vectors(t)
    return neighbours.nearest(search_queries(t, words)[1].withColumnRenamed("item_id", "doc_id"), text_index(t, words), 100, "doc_id", "doc_id", "vector")


@query("vs_06_two_stage_search", "item_id bigint, doc_id bigint, score double, rank bigint")
def two_stage_search(t):
    from pyspark.sql import Window

    words = word_vectors(t)
    english, vectors = search_queries(t, words)
    found = neighbours.nearest(vectors.withColumnRenamed("item_id", "doc_id"), text_index(t, words), 100, "doc_id", "doc_id", "vector")
    pairs = cut_lineage(found.select(F.col("query_id").alias("item_id"), F.col("id").alias("doc_id")))
    left = matching.vector_blocks(english, "item_id", words, matching.unknown_vector(DIMS))
    # only texts that are some query's candidate get token vectors
    wanted = pairs.select("doc_id").distinct()
    right = matching.vector_blocks(t.documents.join(wanted, "doc_id", "left_semi"), "doc_id", words, matching.unknown_vector(DIMS))
    made = matching.kernel_features(pairs, "item_id", "doc_id", left, right)
    # weights grow with the kernel's similarity level
    weights = [mu for mu, _ in matching.kernel_centres()]
    scored = made.withColumn("score", matching.kernel_score("kernels", weights))
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(w)).where("rank <= 10")


@query("vs_07_index_refresh", "size bigint", "SELECT count(DISTINCT doc_id) AS size FROM documents")
def index_refresh(t):
    from tessera.catalog.a_sources import scratch

    size = neighbours.refresh_index(text_index(t, word_vectors(t)), scratch(t, "text-index"))
    return t.spark.range(1).select(F.lit(size).alias("size"))
