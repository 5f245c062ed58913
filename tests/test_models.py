import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions.stats import beta_quantile, incomplete_beta
from tessera.operators import bandit, features, learners, matching, neighbours, ranking, search, uplift, uplift_tree
from tessera.operators.uplift_tree import FEW, MANY, Limits
from tessera.sources.files import TableRegistry


def grow(x, w, y, limits, node=0, depth=0, rows=None, out=None):
    """Plain recursive tree on numpy arrays."""
    out = {} if out is None else out
    rows = np.arange(len(y)) if rows is None else rows
    ate = lambda r: y[r][w[r] == 1].mean() - y[r][w[r] == 0].mean()
    out[node] = (len(rows), ate(rows), None, None)
    if depth == limits.max_depth:
        return out
    best = None
    for f in range(x.shape[1]):
        v = x[rows, f]
        u = np.unique(v)
        for th in np.unique(np.percentile(v, MANY) if len(u) > 10 else np.percentile(u, FEW)):
            parts = rows[v <= th], rows[v > th]
            if any(len(p) < limits.min_leaf or (w[p] == 1).sum() < limits.min_treated or (w[p] == 0).sum() < limits.min_control for p in parts):
                continue
            gain = abs(ate(parts[0]) - ate(parts[1]))
            if best is None or gain > best[0] + 1e-12:
                best = (gain, f, th, parts)
    if best:
        _, f, th, (left, right) = best
        out[node] = (len(rows), ate(rows), f, th)
        grow(x, w, y, limits, 2 * node + 1, depth + 1, left, out)
        grow(x, w, y, limits, 2 * node + 2, depth + 1, right, out)
    return out


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(1)
    n = 3000
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 4, n), rng.random(n)])
    w = rng.integers(0, 2, n)
    y = x[:, 0] + w * (x[:, 0] > 0.3) * 2 + w * (x[:, 1] == 2) + rng.normal(size=n)
    return x, w, y


def test_tree_equals_plain_recursion(spark, sample):
    x, w, y = sample
    limits = Limits(3, 100, 30, 30)
    df = spark.createDataFrame(pd.DataFrame({"id": range(len(y)), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "w": w, "y": y}))
    tree = uplift_tree.fit_tree(df, ["a", "b", "c"], "w", "y", limits)
    want = grow(x, w, y, limits)
    assert set(tree.nodes) == set(want)
    for node, (n, ate, f, th) in want.items():
        assert tree.nodes[node]["n"] == n and tree.nodes[node]["ate"] == pytest.approx(ate)
        if f is not None:
            assert tree.splits[node][0] == "abc"[f] and tree.splits[node][1] == pytest.approx(th)
    again = uplift_tree.Tree.from_table(tree.table(spark))
    assert again.splits == tree.splits
    forest = uplift_tree.fit_forest(df, "id", ["a", "b", "c"], "w", "y", 4, 2, limits)
    pred = forest.predict(df).toPandas()
    assert np.corrcoef(pred.uplift, (x[:, 0] > 0.3) * 2)[0, 1] > 0.5


def plain_scores(v, w, y, c, threshold, limits, criterion, n_reg):
    node = [np.average(y[w == arm], weights=c[w == arm]) for arm in (1, 0)]

    def distance(t, u):
        if criterion == "ed":
            return (t - u) ** 2
        if criterion == "kl":
            return t * np.log(t / u) + (1 - t) * np.log((1 - t) / (1 - u))
        return (t - u) ** 2 / u + (t - u) ** 2 / (1 - u)

    taus, total = [], 0
    for side in (v <= threshold, ~(v <= threshold)):
        n, n_t, n_c = c[side].sum(), c[side & (w == 1)].sum(), c[side & (w == 0)].sum()
        if n < limits.min_leaf or n_t < limits.min_treated or n_c < limits.min_control:
            return None
        t, u = ((c * y)[side & (w == arm)].sum() + m * n_reg for arm, m in zip((1, 0), node))
        t, u = t / (n_t + n_reg), u / (n_c + n_reg)
        taus.append(t - u)
        total += n / c.sum() * distance(t, u) if criterion != "delta" else 0
    return abs(taus[0] - taus[1]) if criterion == "delta" else total - distance(*node)


def plain_forest(x, w, y, draws, edges, names, subset, limits, criterion, n_reg):
    """Mean prediction of trees grown row by row."""

    def predict(rows, tree, node, depth):
        c, best = draws[rows, tree], None
        if depth < limits.max_depth:
            for f in subset(tree, node):
                f = names.index(f)
                for threshold in edges[f]:
                    score = plain_scores(x[rows, f], w[rows], y[rows], c, threshold, limits, criterion, n_reg)
                    if score is not None and score > (best[0] + 1e-12 if best else -np.inf):
                        best = (score, f, threshold)
        if best is None:
            arms = [rows[(w[rows] == arm) & (c > 0)] for arm in (1, 0)]
            out[rows, tree] = np.subtract(*[np.average(y[a], weights=draws[a, tree]) for a in arms])
            return
        left = x[rows, best[1]] <= best[2]
        predict(rows[left], tree, 2 * node + 1, depth + 1)
        predict(rows[~left], tree, 2 * node + 2, depth + 1)

    out = np.zeros(draws.shape)
    for tree in range(draws.shape[1]):
        predict(np.arange(len(y)), tree, 0, 0)
    return out.mean(axis=1)


@pytest.mark.parametrize("criterion, n_reg", [("delta", 0), ("ed", 10), ("kl", 10), ("chi", 5)])
def test_forest_equals_trees_grown_row_by_row(spark, sample, criterion, n_reg):
    x, w, y = sample
    x, w, y = x[:1200].copy(), w[:1200], (y[:1200] > 0.5).astype(float)
    x[::50, 0] = np.nan
    limits = Limits(3, 40, 10, 10)
    frame = pd.DataFrame({"id": range(len(y)), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "w": w, "y": y})
    df = spark.createDataFrame(frame).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    table = uplift_tree.quantise(df, "id", ["a", "b", "c"], "w", "y", 3, keep=["id"])
    edges = [table.edges[f] for f in "abc"]
    drawn = table.rows.orderBy("id").select("draws").collect()
    draws = np.array([r.draws for r in drawn], dtype=float)
    subset = lambda tree, node: uplift_tree._subset(["a", "b", "c"], 2, 0, tree, node)
    want = plain_forest(x, w, y, draws, edges, ["a", "b", "c"], subset, limits, criterion, n_reg)
    forest = uplift_tree.fit_forest(df, "id", ["a", "b", "c"], "w", "y", 3, 2, limits, criterion=criterion, n_reg=n_reg)
    got = forest.predict(df).orderBy("id").toPandas().uplift
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_uplift_at_k_rules(spark):
    df = spark.createDataFrame(
        [(i, float(10 - i), i % 2, float(i)) for i in range(10)], "id int, s double, w int, y double"
    )
    per_arm = uplift.uplift_at_k(df, "id", "s", "w", "y", [0.3]).first().uplift
    assert per_arm == pytest.approx(np.mean([1, 3, 5]) - np.mean([0, 2, 4]))
    overall = uplift.uplift_at_k(df, "id", "s", "w", "y", [0.3], "overall").first().uplift
    assert overall == pytest.approx(1 - np.mean([0, 2]))


TRUE, PRED = [4, 0, 2, 3, 1, 2], [0.7, 1.5, -0.3, 0.2, -1.1, 0.9]


@pytest.fixture(scope="module")
def ranked(spark):
    return spark.createDataFrame([(1, i, t, p) for i, (t, p) in enumerate(zip(TRUE, PRED))], "q int, id int, y int, s double")


def test_ranking_example(ranked):
    order = np.argsort(PRED)[::-1]
    gains = (2.0 ** np.array(TRUE)[order] - 1) / np.log2(np.arange(2, 8))
    assert ranking.dcg(ranked, "q", "id", "y", "s", None, "exp2").first().dcg == pytest.approx(gains.sum())
    pairs = [(i, j) for i in range(6) for j in range(6) if TRUE[i] > TRUE[j] and PRED[i] < PRED[j]]
    assert ranking.swapped_pairs(ranked, "q", "y", "s").first().swapped == len(pairs)


@pytest.mark.parametrize("block", [2, 1024])
def test_lambdas_by_hand(ranked, block):
    got = ranking.lambdas(ranked, "q", "id", "y", "s", block=block).toPandas().set_index("id")["lambda"].sort_index()
    y, s = np.array(TRUE, float), np.array(PRED)
    rank = np.empty(6)
    rank[sorted(range(6), key=lambda i: (-y[i], i))] = np.arange(1, 7)
    n = 1 / ((2 ** np.sort(y)[::-1] - 1) / np.log2(np.arange(2, 8))).sum()
    want = np.zeros(6)
    for i in range(6):
        for j in range(6):
            step = 0.5 * (1 - np.sign(y[i] - y[j])) - 1 / (1 + np.exp(s[i] - s[j]))
            want[i] += step * abs(n * (2 ** y[i] - 2 ** y[j]) * (1 / np.log2(1 + rank[i]) - 1 / np.log2(1 + rank[j])))
    np.testing.assert_allclose(got, want, atol=1e-12)


@pytest.mark.parametrize("far", [False, True])
@pytest.mark.parametrize("fitted", [50, 1000])
def test_exact_neighbours_with_copies(spark, far, fitted):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 5))
    v[100:130] = v[0]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id int, v array<double>")
    got = neighbours.nearest(df, df, 7, "id", "id", "v", far=far, skip_self=True, block=64, fitted=fitted).toPandas()
    d = np.round(np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1)), 9)
    for q, part in got.groupby("query_id"):
        others = [i for i in range(300) if i != q]
        want = sorted(others, key=lambda i: (-d[q, i] if far else d[q, i], i))[:7]
        assert part.sort_values("rank").id.tolist() == want


def plain_neighbours(q, v, k, far, skip):
    d = np.round(np.sqrt(((q[:, None] - v[None]) ** 2).sum(-1)), 9)
    others = lambda i: [j for j in range(len(v)) if not (skip and i == j)]
    return {i: sorted(others(i), key=lambda j: (-d[i, j] if far else d[i, j], j))[:k] for i in range(len(q))}


@pytest.mark.parametrize("far, scale, offset", [(False, 1, 0), (True, 1, 0), (False, 1e6, 1e9)])
def test_cells_give_exact_neighbours(spark, far, scale, offset):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 6)) * 10
    v = centres[rng.integers(0, 30, 1500)] + rng.normal(size=(1500, 6)) * 0.1
    v[200:300] = v[0]  # more copies than neighbours asked for
    v = v * scale + offset
    table = lambda rows: spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(rows)] + [(None, None, 0)], "id int, v array<double>, g int")
    got = neighbours.nearest(table(v[:60]), table(v).repartition(4), 9, "id", "id", "v", far=far, skip_self=True, block=64, fitted=500).toPandas()
    want = plain_neighbours(v[:60], v, 9, far, True)
    assert {q: part.sort_values("rank").id.tolist() for q, part in got.groupby("query_id")} == want
    # fewer rows than asked for, and none
    few = neighbours.nearest(table(v[:4]), table(v[:4]), 9, "id", "id", "v", far=far).toPandas()
    assert few.groupby("query_id").size().tolist() == [4] * 4
    assert neighbours.nearest(table(v[:4]), table(v[:0]), 9, "id", "id", "v").count() == 0


@pytest.mark.parametrize("n", [2000, 8000])
def test_few_groups_are_visited(spark, n):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8)) * 10
    v = centres[rng.integers(0, 40, n)] + rng.normal(size=(n, 8)) * 0.1
    start = neighbours._k_means(v, 80)
    own = neighbours._nearest_centre(v, start)
    away = np.sqrt(((v - start[own]) ** 2).sum(1))
    radius = np.array([away[own == c].max(initial=0) for c in range(len(start))])
    groups = neighbours._k_means(start, 20)
    cells = neighbours.Cells(start, neighbours._nearest_centre(start, groups), np.bincount(own, minlength=len(start)), radius)
    asked = spark.createDataFrame([(i, v[i].tolist(), 1.0) for i in range(200)], "query_id bigint, v array<double>, edge double")
    visited = sum(neighbours._visits(asked, cells, 10, False, known).agg(F.sum(F.size("groups"))).first()[0] for known in (False, True))
    assert visited <= 200 * 4  # of 20 groups


def test_neighbours_by_cosine(spark):
    from tessera.functions import vectors

    rng = np.random.default_rng(6)
    v = rng.normal(size=(400, 4))
    v[7] = 0
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "id int, v array<double>")
    unit = lambda c: F.when(vectors.norm(c) > 0, vectors.normalised(c))
    got = neighbours.nearest_by(df, df, 5, "id", "id", "v", unit, lambda a, b: 1 - vectors.cosine(a, b), skip_self=True, block=50, fitted=100).toPandas()
    sizes = np.sqrt((v * v).sum(1))
    for q, part in got.groupby("query_id"):
        others = [i for i in range(400) if i not in (q, 7)]
        want = sorted(1 - v[q] @ v[i] / sizes[q] / sizes[i] for i in others)[:5]
        np.testing.assert_allclose(part.sort_values("rank").dist, want, atol=1e-9)
    assert got.query_id.nunique() == 399


def test_graph_search_finds_most_neighbours(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rng.normal(size=(200, 3)))], "id int, v array<double>")
    graph = neighbours.small_world_graph(df, "id", "v")
    assert graph.count() == 200 * 10
    queries = df.where("id % 20 = 0")
    found = neighbours.graph_search(queries, "id", df, "id", "v", graph, k=5, beam=20)
    truth = neighbours.nearest(queries, df, 5, "id", "id", "v")
    assert neighbours.recall(found, truth, 5).agg(F.avg("recall")).first()[0] > 0.8


@pytest.fixture(scope="module")
def worded(spark):
    words = spark.createDataFrame([(f"w{i}",) for i in range(60)], "token string")
    return matching.token_vectors(words, None, 4)


def test_text_vectors_keep_all_words_and_texts(spark, worded):
    texts = [(1, "w1 w2 w2 other"), (2, ""), (3, None), (4, "none of these"), (None, "w1")]
    rows = matching.text_vectors(spark.createDataFrame(texts, "id int, text string"), "id", worded, 4).collect()
    got, v = {r.id: np.array(r.vector) for r in rows}, {r.token: np.array(r.v) for r in worded.collect()}
    unknown = np.array(matching.unknown_vector(4))
    made = spark.range(1).select(matching.seeded_vector(F.lit(""), 4).alias("v")).first().v
    np.testing.assert_allclose(unknown, made, atol=1e-15)
    want = {1: (v["w1"] + 2 * v["w2"] + unknown) / 4, 2: unknown * 0, 3: unknown * 0, 4: unknown, None: v["w1"]}
    assert set(got) == set(want)
    for key in want:
        np.testing.assert_allclose(got[key], want[key], atol=1e-12)


def test_kernels_over_blocks_of_long_texts(spark, worded):
    rng = np.random.default_rng(8)
    texts = [(0, " ".join(f"w{i}" for i in rng.integers(0, 70, 20_000))), (1, "w1 w2 zzz"), (2, "w5 " * 1300), (3, "")]
    df = spark.createDataFrame(texts, "l int, text string")
    unknown = matching.unknown_vector(4)
    left = matching.vector_blocks(df, "l", worded, unknown)
    right = matching.vector_blocks(df.withColumnRenamed("l", "r"), "r", worded, unknown)
    assert left.agg(F.max(F.size("vectors"))).first()[0] == matching.BLOCK_TOKENS
    pairs = spark.createDataFrame([(1, 0, "a"), (0, 1, "b"), (2, 0, "c"), (2, 0, "d"), (3, 0, "e"), (None, 1, "f")], "l int, r int, tag string")
    got = {r.tag: r.kernels for r in matching.kernel_features(pairs, "l", "r", left, right).collect()}
    best = {r.tag: r for r in matching.best_token_matches(pairs, "l", "r", left, right).collect()}
    assert set(got) == set(best) == set("abcd")
    v = {r.token: np.array(r.v) for r in worded.collect()}
    unit = lambda text: np.stack([x / np.linalg.norm(x) for x in (v.get(t, np.array(unknown)) for t in text.split())])
    for tag, (l, r) in {"a": (1, 0), "b": (0, 1), "c": (2, 0), "d": (2, 0)}.items():
        # equal tokens have equal rows, so distinct ones with their counts are enough here
        a, n = np.unique(unit(texts[l][1]).round(12), axis=0, return_counts=True)
        b, m = np.unique(unit(texts[r][1]).round(12), axis=0, return_counts=True)
        sims = a @ b.T
        want = [(n * np.log1p((m * np.exp(-((sims - mu) ** 2) / (2 * s**2))).sum(1))).sum() for mu, s in matching.kernel_centres()]
        np.testing.assert_allclose(got[tag], want, rtol=1e-6)
        assert (best[tag]["rows"], best[tag]["cols"]) == (n.sum(), m.sum())
        assert best[tag]["best"] == pytest.approx((n * sims.max(1)).sum() / n.sum())
        assert best[tag]["mean"] == pytest.approx((n[:, None] * m * sims).sum() / n.sum() / m.sum())


def test_validation_pairs_fill_up(spark):
    rows = [(i, 1000 + i * 10 + j, j % 2) for i in range(20) for j in range(1 + i % 5)]
    df = spark.createDataFrame(rows, "l int, r int, label int")
    out = matching.validation_pairs(df, "l", "r", "label", fill_to=15).toPandas()
    assert (out.groupby("l").size() == 15).all() and not out.duplicated(["l", "r"]).any()
    assert set(out.l) == {i for i in range(20) if i % 5 >= 1} and (out.l != out.r).all()


def test_blocks_with_other_keys_are_refused(spark):
    tables = TableRegistry({"customers": spark.range(3).select(F.col("id").alias("customer_id"), F.col("id").alias("age"))})
    other = {"by_age": lambda tables: features.Block(("age",), tables.get("customers").select("age").distinct())}
    config = [{"name": "profile", "args": {"columns": ["age"]}}, {"name": "by_age"}]
    with pytest.raises(ValueError):
        features.feature_table(tables, config, other)
    with pytest.raises(KeyError):
        features.feature_table(tables, [{"name": "nothing"}])


@pytest.mark.parametrize("a, b", [(1, 1), (2.5, 7), (300, 20), (0.4, 0.6), (1, 5000), (40_000, 60_000)])
def test_beta_quantile_inverts_the_distribution(a, b):
    p = np.concatenate([[0.0, 1.0, 1e-6, 1 - 1e-6], np.random.default_rng(1).random(500)])
    x = beta_quantile(a, b, p)
    np.testing.assert_allclose(incomplete_beta(a, b, x), p, atol=1e-9)
    assert (np.diff(x[np.argsort(p, kind="stable")]) >= 0).all() and x[0] == 0 and x[1] == 1
    if (a, b) == (1, 1):
        np.testing.assert_allclose(x, p, atol=1e-12)


def test_thompson_choices_follow_the_posterior(spark):
    post = spark.createDataFrame([("x", 3.0, 5.0), ("y", 6.0, 4.0), ("z", 1.0, 1.0)], "arm string, a double, b double")
    ids = spark.range(20_000).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = bandit.thompson(ids, "id", post, "arm").toPandas()
    rng = np.random.default_rng(2)
    draws = np.stack([rng.beta(a, b, 400_000) for a, b in [(3, 5), (6, 4), (1, 1)]], axis=1)
    want = np.bincount(draws.argmax(1), minlength=3) / 400_000
    np.testing.assert_allclose(got.choice.value_counts(normalize=True)[["x", "y", "z"]], want, atol=0.015)
    again = bandit.thompson(ids.repartition(7), "id", post, "arm").toPandas()
    assert got.fillna(-1).set_index("id").choice.to_dict() == again.fillna(-1).set_index("id").choice.to_dict()
    # without an arm, only its own decisions change
    fewer = bandit.thompson(ids, "id", post.where("arm <> 'z'"), "arm").toPandas()
    kept = got.choice != "z"
    assert (got.choice[kept] == fewer.choice[kept]).all()


def test_propensity_of_each_row_beats_the_constant(spark):
    rng = np.random.default_rng(3)
    n = 4000
    x = rng.normal(size=n)
    w = (rng.random(n) < 1 / (1 + np.exp(-2 * x))).astype(int)
    effect = 1.0 + (x > 0)
    y = 3 * x + w * effect + rng.normal(size=n) * 0.3
    frame = pd.DataFrame({"id": range(n), "x": x, "w": w, "y": y, "effect": effect})
    df = spark.createDataFrame(frame).cache()
    model = learners.boosted_trees(maxIter=8)

    def error(p):
        fitted = learners.RLearner(["x"], "w", "y", "id", 3, p=p, model=model).fit(df)
        return fitted.uplift(df).agg(F.avg(F.pow(F.col("uplift") - F.col("effect"), F.lit(2.0)))).first()[0]

    assert error(None) < 0.5 * error(learners.propensity(df, "w"))
    mixed = learners.XLearner(["x"], "w", "y", model=model).fit(df)
    scored = learners.with_propensity(df, ["x"], mixed.treated, "p").toPandas()
    assert np.abs(scored.p - np.clip(1 / (1 + np.exp(-2 * x)), 0.02, 0.98)).mean() < 0.05
    assert mixed.uplift(df).columns == [*df.columns, "uplift"]


def test_sampled_parameters_come_from_their_distributions():
    space = {"a": search.choice(2, 3, 5), "b": search.between(-1, 1), "c": search.log_between(1e-3, 10), "d": search.steps(10, 30, 5)}
    draws = search.sample_parameters(space, 3000, seed=4)
    assert draws == search.sample_parameters(space, 3000, seed=4) and draws[:5] == search.sample_parameters(space, 5, seed=4)
    assert draws != search.sample_parameters(space, 3000, seed=5)
    frame = pd.DataFrame(draws)
    assert set(frame.a) == {2, 3, 5} and set(frame.d) == {10, 15, 20, 25, 30}
    assert frame.b.between(-1, 1).all() and abs(frame.b.mean()) < 0.05
    assert abs(np.log10(frame.c).mean() + 1) < 0.1
    assert frame.d.value_counts().min() > 500


def test_search_finds_the_better_forest(spark, sample):
    x, w, y = sample
    df = spark.createDataFrame(pd.DataFrame({"id": range(len(y)), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "w": w, "y": y}))
    space = {"max_depth": search.choice(1, 3), "min_leaf": search.choice(50), "min_treated": search.choice(10), "min_control": search.choice(10)}
    got = search.search_forest(df, "id", ["a", "b", "c"], "w", "y", space, n_iter=3, k_folds=2, n_trees=3).toPandas()
    assert len(got) == 6 and got.draw.nunique() == 3
    means = got.groupby("draw").score.mean()
    np.testing.assert_allclose(got.groupby("draw").mean_score.first(), means)
    held = got[got.holdout_score.notna()]
    assert held.draw.unique().tolist() == [means.idxmax()]
    effect = y[w == 1].mean() - y[w == 0].mean()
    assert held.holdout_score.iloc[0] > effect + 0.3  # the best third profits more than all


def test_regression_search_scores_a_hold_out(spark):
    rng = np.random.default_rng(7)
    x = rng.random((1500, 2))
    y = np.sin(6 * x[:, 0]) + x[:, 1]
    df = spark.createDataFrame(pd.DataFrame({"id": range(1500), "a": x[:, 0], "b": x[:, 1], "y": y}))
    space = {"maxDepth": search.choice(1, 5), "numTrees": search.steps(3, 6, 1)}
    got = search.search_regression(df, "id", ["a", "b"], "y", space, n_iter=4).toPandas()
    best = got[got.holdout_rmse.notna()]
    assert best.draw.tolist() == [got.rmse.idxmin()]
    assert best.holdout_rmse.iloc[0] < y.std() / 2
