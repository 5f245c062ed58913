"""Work that has to spread over tasks and stay in proportion to its input."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import md5_mod, uniform
from tessera.functions.stats import beta_quantile
from tessera.llm.components import components
from tessera.operators import bandit, forecast, matching, neighbours, pricing, slots
from tessera.plans.runs import map_runs, numbers


def parts(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_thompson_spreads_rows_and_chooses_by_the_draws(spark):
    ids = spark.range(0, 400, 1, 1)
    shapes = {"a": (30.0, 20.0), "b": (31.0, 20.0), "c": (500.0, 350.0)}
    post = spark.createDataFrame([(k, *v) for k, v in shapes.items()], "arm string, a double, b double")
    chosen = bandit.thompson(ids, "id", post, "arm")
    assert chosen.select("id", "choice").rdd.getNumPartitions() == parts(spark)
    got = chosen.toPandas().set_index("id").choice.sort_index()
    u = ids.select("id", *[uniform(F.col("id").cast("string"), F.lit(arm), 0).alias(arm) for arm in shapes]).toPandas().set_index("id").sort_index()
    draws = np.stack([beta_quantile(*shape, u[arm].to_numpy()) for arm, shape in shapes.items()], axis=1)
    assert list(got) == [list(shapes)[i] for i in draws.argmax(axis=1)]


@pytest.mark.parametrize("additive", [False, True])
def test_assignment_spreads_users_of_one_file(spark, additive):
    users = spark.range(0, 200, 1, 1).withColumnRenamed("id", "user")
    held = slots.slot_table(spark, {f"e{i}": range(i, 50, 3) for i in range(9)})
    made = slots.assign(users, "user", held, 50, "17", "31", additive)
    assert made.select("user").rdd.getNumPartitions() >= parts(spark)
    digest = lambda text: int(hashlib.md5(text.encode()).hexdigest(), 16)
    salted = lambda text, salt, n: (digest(text) + int(salt)) % n if additive else digest(text + salt) % n
    want = {
        (u, salted(str(u), "17", 50), f"e{i}", "pilot" if salted(f"{u}e{i}", "31", 2) == 1 else "control")
        for u in range(200)
        for i in range(9)
        if salted(str(u), "17", 50) in range(i, 50, 3)
    }
    assert {tuple(r) for r in made.select("user", "slot", "experiment_id", "group").collect()} == want


def test_assignment_deals_users_evenly_and_counts_no_characters(spark):
    held = slots.slot_table(spark, {f"e{i}": range(50) for i in range(9)})
    made = slots.assign(spark.range(0, 2000, 1, 1).withColumnRenamed("id", "user"), "user", held, 50, "17", "31", True)
    rows = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 2000 * 9 and max(rows) < 1.3 * sum(rows) / parts(spark)
    # a substring of text walks over its characters, one of bytes does not
    plan = made.select("group")._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(cast(md5(" in plan and "substring(md5(cast(concat" not in plan


@pytest.mark.parametrize("n", [2, 4, 8, 16, 32, 7])
def test_md5_modulo_of_all_digits(spark, n):
    rows = spark.range(60).select(F.col("id").cast("string").alias("t"), md5_mod(F.col("id").cast("string"), n).alias("m")).collect()
    assert [r.m for r in rows] == [int(hashlib.md5(r.t.encode()).hexdigest(), 16) % n for r in rows]


def test_runs_are_whole_groups_across_batches(spark):
    rows = [(k, float(i)) for k in (None, 1, 2, 3) for i in range(11)]
    df = spark.createDataFrame(rows, "k bigint, v double").repartition(3)

    def sums(table: pa.Table, starts: np.ndarray) -> pa.Table:
        total = np.add.reduceat(numbers(table, "v"), starts)
        return pa.table([table.column("k").take(pa.array(starts)), pa.array(total)], ["k", "s"])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = map_runs(df, "k", sums, "k bigint, s double", ["v"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r.k or 0, r.s) for r in got) == [(k, 55.0) for k in range(4)]


def test_neighbours_travel_in_single_precision_to_few_groups(spark, monkeypatch):
    v = np.random.default_rng(5).normal(size=(600, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, v array<float>")
    kinds, groups = [], []
    search = neighbours._search
    monkeypatch.setattr(neighbours, "_search", lambda *a: (kinds.append(a[1].schema["v"].dataType.simpleString()), groups.append(len(a[2])), search(*a))[-1])
    got = neighbours.nearest(df, df, 4, "id", "id", "v", skip_self=True, fitted=100).toPandas()
    exact = np.sqrt(((v[:, None].astype(float) - v[None]) ** 2).sum(2)) + np.diag(np.full(600, np.inf))
    want = [list(np.lexsort((np.arange(600), np.round(row, neighbours.DIGITS)))[:4]) for row in exact]
    assert got.sort_values(["query_id", "rank"]).groupby("query_id").id.apply(list).tolist() == want
    assert set(kinds) == {"array<float>"} and max(groups) < parts(spark)


@pytest.mark.parametrize("shift", [0.0, 1e4])
@pytest.mark.parametrize("fitted", [100, 1000])
def test_nearest_and_farthest_come_from_one_comparison(spark, monkeypatch, shift, fitted):
    monkeypatch.setattr(neighbours, "PRODUCT", 2000)
    monkeypatch.setattr(neighbours, "TRIED", 16)
    rng = np.random.default_rng(8)
    v = shift + np.concatenate([rng.normal(size=(300, 5)), rng.normal(size=(200, 5)) * 1e-6 + 3, np.ones((40, 5))])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, v array<double>")
    compared, search = [], neighbours._search
    monkeypatch.setattr(neighbours, "_search", lambda *a: (compared.append(a[4]), search(*a))[-1])
    got = neighbours.nearest_sides(df, df, [(False, 4), (True, 3)], "id", "id", "v", skip_self=True, block=60, fitted=fitted).toPandas()
    dist = np.round(np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)), neighbours.DIGITS)
    for far, k in ((False, 4), (True, 3)):
        signed = (-dist if far else dist) + np.diag(np.full(len(v), np.inf))
        want = [list(np.lexsort((np.arange(len(v)), row))[:k]) for row in signed]
        some = got[got.far == far].sort_values(["query_id", "rank"])
        ids = some.groupby("query_id").id.apply(list).tolist()
        if not shift:
            assert ids == want
        # the last digits differ where vectors are far from the origin
        for i, (mine, best) in enumerate(zip(ids, want)):
            np.testing.assert_allclose(dist[i, mine], dist[i, best], atol=1e-8)
            assert len(set(mine)) == k and i not in mine
    assert compared in ([], [[(False, 4)], [(True, 3)], [(False, 4), (True, 3)]])


def test_true_neighbours_are_found_once(spark, tmp_path):
    from tessera.catalog import QUERIES

    v = np.random.default_rng(9).normal(size=(80, 4))
    rows = [(i, x.tolist(), i % 3) for i, x in enumerate(v)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    made = QUERIES["vs_04_recall"](spark, str(tmp_path))
    assert "MapInPandas" not in made._jdf.queryExecution().executedPlan().toString()
    dist = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)) + np.diag(np.full(80, np.inf))
    want = {i: sum(j % 3 == i % 3 for j in np.argsort(row)[:10]) / 10 for i, row in enumerate(dist)}
    assert {r.query_id: r.recall for r in made.collect()} == want


def test_hashed_neighbours_form_no_pairs_of_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PRODUCT", 500)
    v = np.random.default_rng(6).normal(size=(120, 5))
    v[50:60] = v[:10]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame([*rows, rows[3]], "id bigint, v array<double>")
    found = neighbours.hashed_neighbours(df, "id", "v", 4, 0.8, 3, 2.0)
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString().split("FlatMapGroups")[0]
    lsh = neighbours.BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=0.8, numHashTables=3, seed=0)
    table = df.select("id", neighbours.array_to_vector("v").alias("v"))
    model = lsh.fit(table)
    pairs = model.approxSimilarityJoin(table, table, 2.0, "dist").where("datasetA.id <> datasetB.id").toPandas()
    want = pd.DataFrame({"q": pairs.datasetA.map(lambda r: r["id"]), "id": pairs.datasetB.map(lambda r: r["id"]), "dist": pairs.dist})
    want = want.sort_values(["q", "dist", "id"]).groupby("q").head(4)
    got = found.toPandas().sort_values(["query_id", "rank"])
    assert got[["query_id", "id", "dist"]].to_numpy().tolist() == want.to_numpy().tolist()


@pytest.mark.parametrize("size", [16, 1600])
def test_blocks_of_a_bucket_look_no_further_than_the_first(spark, monkeypatch, size):
    monkeypatch.setattr(neighbours, "HASHED", size)
    v = np.random.default_rng(7).normal(size=(150, 5))
    v[140:] = v[:10]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, v array<double>")
    seen, cut = [], neighbours.cut_lineage
    monkeypatch.setattr(neighbours, "cut_lineage", lambda df: (seen.append(cut(df)), seen[-1])[-1])
    got = neighbours.hashed_neighbours(df, "id", "v", 3, 1.5, 3, 2.5).toPandas().sort_values(["query_id", "rank"])
    (edges,) = [df.toPandas() for df in seen if "edge" in df.columns]
    assert len(edges) == 150 and (edges.edge < 2.5).any()
    h = np.stack(edges.sort_values("id").h)
    met = (h[:, None] == h[None]).any(2) & ~np.eye(150, dtype=bool)
    dist = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    near = np.where(met & (dist < 2.5), dist, np.inf)
    want = [(i, j) for i, row in enumerate(near) for j in np.lexsort((np.arange(150), np.round(row, 12)))[:3] if np.isfinite(row[j])]
    assert list(zip(got.query_id, got.id)) == want


@pytest.mark.parametrize("gathered", [1, 8, 512])
def test_rows_that_share_an_earlier_bucket_are_not_compared(monkeypatch, gathered):
    monkeypatch.setattr(neighbours, "GATHERED", gathered)
    rng = np.random.default_rng(3)
    ha, hb = rng.integers(0, 3, (40, 2)), rng.integers(0, 3, (60, 2))
    apart = (ha[:, None] != hb[None]).all(2)
    compared = np.zeros((40, 60), dtype=int)
    for rows, cols in neighbours._strangers(ha, hb):
        compared[np.ix_(np.arange(40)[rows], np.arange(60)[cols])] += 1
    assert compared.max() == 1 and compared[apart].all()
    assert gathered > 1 or (compared == apart).all()


def test_gaps_of_days_need_no_ranges(spark):
    days = [("a", "2024-01-01"), ("a", "2024-01-04"), ("a", "2024-01-05"), ("a", "2024-01-05"), ("b", "2024-01-01"), (None, "2024-01-02"), (None, "2024-01-04")]
    made = pricing.gap_stats(spark.createDataFrame(days, "k string, d string"), "k", "d")
    assert "SortMergeJoin" not in made._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.max_gap, r.median_gap) for r in made.collect()} == {("a", 3, 2.0), ("b", None, None), (None, 2, 2.0)}


def test_component_rounds_broadcast_nothing(spark, monkeypatch):
    seen = []
    import tessera.llm.components as module

    keep = module.cut_lineage

    def cut(df):
        out = keep(df)
        seen.append((df._jdf.queryExecution().toString(), out.rdd.getNumPartitions()))
        return out

    monkeypatch.setattr(module, "cut_lineage", cut)
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101)], "u bigint, v bigint")
    got = {tuple(r) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}
    assert not any("BroadcastHashJoin" in plan for plan, _ in seen)


TEXTS = [(1, "b a a c zz"), (1, "c c q"), (2, ""), (3, None), (None, "a zz a"), (4, "q " * 9), (5, "a b")]


def worded(spark, n_first):
    counts = [("a", 9), ("b", 2), ("c", 5)] if n_first else [("a", 2), ("b", 9), ("c", 1)]
    return spark.createDataFrame(counts, "token string, n bigint")


def texts_of(key):
    return [text.split() for k, text in TEXTS if k == key and text]


@pytest.mark.parametrize("frequent", [1, 2, 1 << 16])
@pytest.mark.parametrize("n_first", [False, True])
def test_id_sequences_move_no_row_per_word(spark, monkeypatch, frequent, n_first):
    monkeypatch.setattr(matching, "FREQUENT", frequent)
    monkeypatch.setattr(matching, "HELD", 4)
    df = spark.createDataFrame(TEXTS, "id int, text string").coalesce(1)
    made = matching.id_sequences(df, "id", matching.token_ids(worded(spark, n_first)), pad_to=3)
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
    codes, got = {"a": 2, "b": 3, "c": 4}, {r.id: list(r.ids) for r in made.collect()}
    assert set(got) == {k for k, _ in TEXTS}
    for key, ids in got.items():
        want = [c for _, c in sorted((i, codes.get(w, matching.OOV)) for words in texts_of(key) for i, w in enumerate(words))]
        assert ids == want + [matching.PAD] * (3 - len(want))


@pytest.mark.parametrize("frequent", [1, 2, 1 << 16])
def test_text_vectors_move_no_row_per_word(spark, monkeypatch, frequent):
    monkeypatch.setattr(matching, "FREQUENT", frequent)
    vectors = matching.token_vectors(worded(spark, True), None, 4)
    made = matching.text_vectors(spark.createDataFrame(TEXTS, "id int, text string").coalesce(1), "id", vectors, 4)
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
    v, unknown = {r.token: np.array(r.v) for r in vectors.collect()}, np.array(matching.unknown_vector(4))
    got = {r.id: r.vector for r in made.collect()}
    assert set(got) == {k for k, _ in TEXTS}
    for key, vector in got.items():
        each = [v.get(w, unknown) for words in texts_of(key) for w in words]
        np.testing.assert_allclose(vector, np.mean(each, axis=0) if each else unknown * 0, atol=1e-12)


@pytest.mark.parametrize("frequent", [1, 1 << 16])
def test_blocks_of_vectors_keep_the_order(spark, monkeypatch, frequent):
    monkeypatch.setattr(matching, "FREQUENT", frequent)
    vectors, unknown = matching.token_vectors(worded(spark, True), None, 4), matching.unknown_vector(4)
    made = matching.vector_blocks(spark.createDataFrame(TEXTS[4:], "id int, text string"), "id", vectors, unknown, size=2)
    v = {r.token: list(r.v) for r in vectors.collect()}
    got = {(r.id, r.block): [list(x) for x in r.vectors] for r in made.collect()}
    words = {key: texts_of(key)[0] for key, _ in TEXTS[4:]}
    assert got == {(k, i // 2): [v.get(w, unknown) for w in l[i : i + 2]] for k, l in words.items() for i in range(0, len(l), 2)}


def test_token_matches_need_no_frames(spark):
    vectors, unknown = matching.token_vectors(worded(spark, True), None, 4), matching.unknown_vector(4)
    df = spark.createDataFrame([(1, "a b zz")], "l int, text string")
    left = matching.vector_blocks(df, "l", vectors, unknown)
    right = matching.vector_blocks(df.withColumnRenamed("l", "r"), "r", vectors, unknown)
    made = matching.kernel_features(spark.createDataFrame([(1, 1)], "l int, r int"), "l", "r", left, right)
    assert "MapInPandas" not in made._jdf.queryExecution().executedPlan().toString()
    assert len(made.first().kernels) == 21


def test_tasks_of_a_fit_do_not_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(forecast, "ROWS", 20)
    counts, keep = [], forecast.cut_lineage

    def cut(df):
        out = keep(df)
        counts.append([len(part) for part in out.rdd.glom().collect()])
        return out

    monkeypatch.setattr(forecast, "cut_lineage", cut)
    df = spark.range(0, 400, 1, 1).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 * 2.0).alias("y"), (F.col("id") % 5 == 0).alias("held"))
    forecast.fit_with_early_stop(df, ["x"], "y", "held", maxIter=2)
    forecast.fold_models(df, "id", ["x"], "y", 2, maxIter=1)
    assert len(counts) == 4 and all(sum(n) == 400 and max(n) <= 30 for n in counts[1::2])


def test_folds_of_many_rows_leave_no_copies(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(forecast, "ROWS", 20)
    seen, keep = [], forecast.written

    def written(df, *split):
        seen.append((df.columns, keep(df, *split)))
        return seen[-1][1]

    monkeypatch.setattr(forecast, "written", written)
    monkeypatch.setattr(forecast, "cut_lineage", lambda df: pytest.fail("rows are kept as a checkpoint"))
    monkeypatch.setattr("tessera.plans.prefix.use_checkpoint_dir", lambda spark: str(tmp_path))
    fitted, fit = [], forecast._fit_folds
    monkeypatch.setattr(forecast, "_fit_folds", lambda folded, *a: (fitted.append([tuple(r) for r in folded.select("y", "fold").collect()]), fit(folded, *a))[-1])
    df = spark.range(0, 400, 1, 3).select("id", (F.col("id") % 7).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    made = forecast.ablation(df, "id", ["x"], "y", {"all": lambda d: d, "some": lambda d: d.where("x > 0")}, 3, maxIter=1)
    assert [(r.variant, r.rows) for r in made.collect()] == [("all", 400), ("some", 342)]
    assert [columns for columns, _ in seen] == [["id", "x", "y"], ["y", "x", "_row"], ["y", "x", "_row"]]
    assert not list(tmp_path.iterdir())
    for ids, rows in zip((range(400), [i for i in range(400) if i % 7]), fitted):
        # the folds that the rows had when they were dealt as a table of few rows
        order = sorted(ids, key=lambda i: hashlib.md5(f"{i}_0".encode()).hexdigest())
        assert dict(rows) == {float(i): at % 3 for at, i in enumerate(order)}
