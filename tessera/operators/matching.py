"""Text matching: vocabularies, id sequences, sampling of pairs and kernel features."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_order, md5_mod, text_key, uniform
from tessera.functions.text import tokens
from tessera.plans.prefix import prefix

PAD, OOV = 0, 1
#: Tokens of a text that are matched at a time.
BLOCK_TOKENS = 512
#: The most frequent words, which are looked up where a text lies; all other words are joined.
FREQUENT = 1 << 16
#: Words, or rows of results, that a task holds at a time beside its batch.
HELD = 1 << 16


def vocabulary(texts: Sequence[DataFrame], column: str = "text", min_count: int = 1, preprocess: Callable[[Column], Column] = tokens) -> DataFrame:
    """(token, n) over the distinct texts of all tables, tokens with at least ``min_count``."""
    distinct = reduce(DataFrame.union, [t.select(column) for t in texts]).distinct()
    counts = distinct.select(F.explode(preprocess(F.col(column))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def token_ids(vocab: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """(token, id, known): ids 2, 3, ... in token order after PAD and OOV; known = has a vector.

    Counts ``n`` of the vocabulary are kept.
    """
    counts = [c for c in vocab.columns if c == "n"]
    ids = prefix(vocab.select("token", *counts), [], ["token"], pos="_pos").select("token", (F.col("_pos") + 1).alias("id"), *counts)
    if vectors is None:
        return ids.withColumn("known", F.lit(0))
    return ids.join(vectors.select("token", F.lit(1).alias("known")), "token", "left").fillna(0, ["known"])


def _frequent(values: DataFrame, value: str) -> tuple[pa.Array, pa.Array]:
    """The words with the highest counts ``n``, at most ``FREQUENT``, and their values."""
    order = [F.desc("n")] if "n" in values.columns else []
    rows = values.orderBy(*order, "token").limit(FREQUENT).select("token", value).toArrow()  # a bounded number of rows
    words, found = (rows.column(c).combine_chunks() for c in ("token", value))
    # a word that has several rows is joined to all of them; those of the last word may go on
    same = pc.equal(words[1:], words[:-1]).fill_null(True).to_numpy(zero_copy_only=False)
    once = pc.and_(words.is_valid(), found.is_valid()).to_numpy(zero_copy_only=False).copy()
    once[1:] &= ~same
    once[:-1] &= ~same
    once[FREQUENT - 1 :] = False
    return words.filter(pa.array(once)), found.filter(pa.array(once))


def _shares(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of about ``HELD`` words together, with the number of words of each."""
    lengths = pc.list_value_length(batch.column("words")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(lengths), 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + HELD, side="right")))
        yield batch.slice(start, stop - start), lengths[start:stop]
        start = stop


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)


def _of_equal(row: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal words of a row together, and where they begin in it."""
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((code, row))
    new = (np.diff(row[order]) != 0) | (np.diff(code[order]) != 0)
    return order, np.concatenate([[0], np.flatnonzero(new) + 1]).astype(np.int64)


def _never_a_word() -> Column:
    """A join key that is no word and in no two rows the same."""
    return F.concat(F.lit(" "), F.monotonically_increasing_id().cast("string"))


def _in_order(rows: DataFrame, id_col: str, values: DataFrame, value: str, missing: Column, size: int | None = None) -> DataFrame:
    """(id, block, seq): the values of each text's words in order, ``size`` words in a block.

    Frequent words are looked up in the batches; each text moves as one list, and only
    its other words are joined to ``values``, once per text and word. Words without a value have
    ``missing``. A text without words has one empty block.
    """
    kind = values.schema[value].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(values, value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = shared.value
        names = [id_col, "block", "seq", "token", "places"]
        for batch in batches:
            for part, lengths in _shares(batch):
                words, ids = part.column("words").flatten(), part.column(id_col)
                cut = max(1, int(lengths.max(initial=1))) if size is None else size
                per = np.maximum(1, -(-lengths // cut))  # blocks of each text
                owner = np.repeat(np.arange(len(lengths)), per)
                block = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
                filled = np.minimum(lengths[owner] - block * cut, cut)
                unit = np.repeat(np.arange(len(owner)), filled)
                at = np.arange(len(words)) - np.repeat(np.cumsum(filled) - filled, filled) + block[unit] * cut
                found = pc.index_in(words, value_set=known)
                lists = _lists(filled, held.take(found))
                none = len(owner)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owner)), pa.array(block), lists, pa.nulls(none, pa.string()), pa.nulls(none, pa.list_(pa.int32()))], names
                )
                rest = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
                if len(rest):
                    others, own = words.take(pa.array(rest)), unit[rest]
                    order, starts = _of_equal(own, others)
                    first = order[starts]
                    places = _lists(np.diff(np.append(starts, len(rest))), pa.array(at[rest][order].astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(owner[own[first]])), pa.array(block[own[first]]), pa.nulls(len(first), lists.type), others.take(pa.array(first)), places],
                        names,
                    )

    key = rows.schema[id_col].dataType.simpleString()
    placed = rows.mapInArrow(run, f"`{id_col}` {key}, block bigint, seq array<{kind}>, token string, places array<int>")
    found = values.select(F.col("token").alias("_word"), F.col(value).alias("_value"))
    placed = placed.withColumn("_word", F.coalesce("token", _never_a_word())).join(found, "_word", "left")
    other = F.when(F.col("token").isNotNull(), F.struct("places", F.coalesce("_value", missing).alias("v")))
    packed = placed.groupBy(id_col, "block").agg(F.collect_list("seq").alias("_seqs"), F.collect_list(other).alias("_others"))
    first = F.coalesce(F.col("block") * (size or 0), F.lit(0)).cast("int")
    looked_up = F.flatten(
        F.transform("_seqs", lambda l: F.filter(F.transform(l, lambda v, i: F.struct((first + i).alias("pos"), v.alias("v"))), lambda x: x["v"].isNotNull()))
    )
    joined = F.flatten(F.transform("_others", lambda o: F.transform(o["places"], lambda p: F.struct(p.alias("pos"), o["v"].alias("v")))))
    merged = F.transform(F.sort_array(F.concat(looked_up, joined)), lambda x: x["v"])
    whole = (F.size("_seqs") == 1) & (F.size("_others") == 0)
    return packed.select(id_col, "block", F.when(whole, F.col("_seqs")[0]).otherwise(merged).alias("seq"))


def id_sequences(df: DataFrame, id_col: str, ids: DataFrame, text: str = "text", max_len: int | None = None, pad_to: int = 0) -> DataFrame:
    """Token ids per text in order, OOV for unknown words, padded with PAD to ``pad_to``.

    ``ids`` are read twice. With counts ``n`` their most frequent words are looked up without a join.
    """
    words = tokens(F.col(text))
    rows = df.select(id_col, (words if max_len is None else F.slice(words, 1, max_len)).alias("words"))
    codes = ids.withColumn("id", F.col("id").cast("bigint"))
    # a text without a word is all padding
    packed = _in_order(rows, id_col, codes, "id", F.lit(OOV).cast("bigint"))
    short = F.greatest(F.lit(pad_to) - F.size("seq"), F.lit(0))
    return packed.select(id_col, F.concat("seq", F.array_repeat(F.lit(PAD).cast("bigint"), short)).alias("ids"))


def seeded_vector(token: Column, dims: int, seed: int = 0, bound: float = 0.2) -> Column:
    """A reproducible uniform vector in [-bound, bound) for a token without a trained one."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(dims - 1)),
        lambda d: (uniform(token, seed, d) * 2 - 1) * F.lit(bound),
    )


def token_vectors(vocab: DataFrame, vectors: DataFrame | None, dims: int, seed: int = 0) -> DataFrame:
    """(token, v): the given vector, or a seeded one where it is missing; counts ``n`` are kept."""
    made = seeded_vector(F.col("token"), dims, seed)
    rows = vocab.select("token", *[c for c in vocab.columns if c == "n"])
    if vectors is None:
        return rows.withColumn("v", made)
    return rows.join(vectors.select("token", "v"), "token", "left").withColumn("v", F.coalesce("v", made))


def unknown_vector(dims: int, seed: int = 0, bound: float = 0.2) -> list[float]:
    """The vector of all words outside the vocabulary: :func:`seeded_vector` of the empty token."""
    digests = [hashlib.md5(f"_{seed}_{d}".encode()).hexdigest() for d in range(dims)]
    return [(int(digest[:13], 16) / 2**52 * 2 - 1) * bound for digest in digests]


def text_vectors(df: DataFrame, id_col: str, vectors: DataFrame, dims: int, text: str = "text", seed: int = 0, name: str = "vector") -> DataFrame:
    """(id, vector): the mean token vector of every text.

    Words without a vector count with :func:`unknown_vector`, texts without words have zeros.
    Frequent words are added up in the batches; only the others are joined to ``vectors``,
    which are read twice, once per text and word.
    """
    unknown = unknown_vector(dims, seed)
    shared = df.sparkSession.sparkContext.broadcast(_frequent(vectors, "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = shared.value
        table = np.array([[unknown[d] if d >= len(v) or v[d] is None else v[d] for d in range(dims)] for v in (x or [] for x in held.to_pylist())])
        table = table.astype(float).reshape(-1, dims)
        names = [id_col, "token", "_n", "_sums"]
        for batch in batches:
            for part, lengths in _shares(batch):
                words, ids, count = part.column("words").flatten(), part.column(id_col), len(lengths)
                row = np.repeat(np.arange(count), lengths)
                found = pc.index_in(words, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
                own, place = row[found >= 0], found[found >= 0]
                sums = np.stack([np.bincount(own, weights=table[place, d], minlength=count) for d in range(dims)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.nulls(count, pa.string()), pa.array(np.bincount(own, minlength=count)), _lists(np.full(count, dims), pa.array(sums.ravel().astype(float)))], names
                )
                rest = np.flatnonzero(found < 0)
                if len(rest):
                    others = words.take(pa.array(rest))
                    order, starts = _of_equal(row[rest], others)
                    first = order[starts]
                    times = pa.array(np.diff(np.append(starts, len(rest))))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(row[rest][first])), others.take(pa.array(first)), times, pa.nulls(len(first), pa.list_(pa.float64()))], names
                    )

    key = df.schema[id_col].dataType.simpleString()
    counts = df.select(id_col, tokens(F.col(text)).alias("words")).mapInArrow(run, f"`{id_col}` {key}, token string, _n bigint, _sums array<double>")
    found = counts.withColumn("_word", F.coalesce("token", _never_a_word())).join(vectors.select(F.col("token").alias("_word"), "v"), "_word", "left")
    value = [F.coalesce(F.col("_sums")[d], F.col("_n") * F.coalesce(F.col("v")[d], F.lit(x))) for d, x in enumerate(unknown)]
    sums = found.groupBy(id_col).agg(*[F.sum(x).alias(f"_{d}") for d, x in enumerate(value)], F.sum("_n").alias("_n"))
    return sums.select(id_col, F.array(*[F.col(f"_{d}") / F.greatest("_n", F.lit(1)) for d in range(dims)]).alias(name))


def training_triplets(df: DataFrame, left: str, right: str, label: str, seed: int = 0) -> DataFrame:
    """(left, first, second, target) per left id and label, for left ids with several labels.

    Two rows of the label give 0.5; a single row is set above a row of a lower label with 1.
    """
    base = df.select(left, right, label)
    mixed = base.groupBy(left).agg((F.min(label) < F.max(label)).alias("_mixed"))
    kept = base.join(mixed.where("_mixed"), left).drop("_mixed")
    h = hash_order(F.col(left), F.col(right), seed)
    first_two = (
        kept.withColumn("_h", h)
        .withColumn("_i", F.row_number().over(Window.partitionBy(left, label).orderBy("_h", right)))
        .where("_i <= 2")
        .groupBy(left, label)
        .agg(F.max(F.when(F.col("_i") == 1, F.col(right))).alias("a"), F.max(F.when(F.col("_i") == 2, F.col(right))).alias("b"))
    )
    lowest = kept.groupBy(left, label).agg(
        F.min(F.struct(hash_order(F.col(left), F.col(right), seed, "negative").alias("h"), F.col(right).alias("id"))).alias("_neg")
    )
    # one row per label of a left id
    below = Window.partitionBy(left).orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    negatives = lowest.withColumn("_neg", F.min("_neg").over(below))
    joined = first_two.join(negatives, [left, label])
    return joined.select(
        left,
        F.col("a").alias("first"),
        F.coalesce(F.col("b"), F.col("_neg.id")).alias("second"),
        F.when(F.col("b").isNotNull(), 0.5).otherwise(1.0).alias("target"),
    ).where(F.col("second").isNotNull())


def validation_pairs(
    df: DataFrame, left: str, right: str, label: str, fill_to: int = 15, min_size: int = 2, seed: int = 0
) -> DataFrame:
    """(left, right, grade): 2 for a positive label, 1 for zero, 0 for fill-up negatives.

    Negatives are the next ids after a hashed start in the shuffled list of all ids. Of
    ``fill_to + 1`` consecutive ids at most the known partners and the id itself drop out,
    so enough remain and no id set is ever crossed with another.
    """
    base = df.select(left, right, label)
    sizes = base.groupBy(left).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") >= min_size)
    used = base.join(sizes, left)
    known = used.select(left, right, F.when(F.col(label) > 0, 2).otherwise(1).alias("grade"))
    everyone = base.select(F.col(left).alias("id")).union(base.select(right)).distinct()
    listed = prefix(
        everyone.withColumn("_h", hash_order(F.col("id"), seed)), [], ["_h", "id"], pos="_at", totals=True
    ).select("id", (F.col("_at") - 1).alias("_at"), F.col("_at_total").alias("_all"))
    total = listed.agg(F.max("_all").alias("n")).select("n").scalar()
    short = sizes.where(F.col("_size") < fill_to).withColumn("_all", total)
    start = md5_mod(text_key(F.col(left), seed), F.col("_all"))
    tries = short.withColumn("_start", start).select(
        left,
        (F.lit(fill_to) - F.col("_size")).alias("_need"),
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(fill_to).cast("bigint"), F.col("_all") - 1)),
                lambda i: F.pmod(F.col("_start") + i, F.col("_all")),
            )
        ).alias("_i", "_at"),
    )
    candidates = (
        tries.join(listed.select("id", "_at"), "_at")
        .where(F.col("id") != F.col(left))
        .join(known.select(left, F.col(right).alias("id")), [left, "id"], "left_anti")
    )
    # at most fill_to + 1 candidates per left id
    w = Window.partitionBy(left).orderBy("_i")
    fill = (
        candidates.withColumn("_r", F.row_number().over(w))
        .where(F.col("_r") <= F.col("_need"))
        .select(left, F.col("id").alias(right), F.lit(0).alias("grade"))
    )
    return known.unionByName(fill)


def id_texts(df: DataFrame, left: str, right: str, text_left: str, text_right: str) -> DataFrame:
    """(id, text) from both sides; the right side wins, then the smallest text."""
    sides = df.select(F.col(right).alias("id"), F.col(text_right).alias("text"), F.lit(0).alias("_side")).union(
        df.select(F.col(left), F.col(text_left), F.lit(1))
    )
    return sides.groupBy("id").agg(F.min(F.struct("_side", "text")).alias("_b")).select("id", F.col("_b.text").alias("text"))


def kernel_centres(n: int = 21, sigma: float = 0.1, exact: float = 0.001) -> list[tuple[float, float]]:
    """(mu, sigma) of the pooling kernels on [-1, 1]; the last one matches equality."""
    width = 2 / (n - 1)
    middles = [(j + 0.5) * width - 1 for j in range(n - 1)]
    return [(mu, sigma) for mu in middles] + [(1.0, exact)]


def vector_blocks(
    df: DataFrame, id_col: str, vectors: DataFrame, unknown: Sequence[float], text: str = "text", size: int = BLOCK_TOKENS, name: str = "vectors"
) -> DataFrame:
    """(id, block, vectors): the token vectors of a text in order, ``size`` tokens in a block.

    Words without a vector have ``unknown``; texts without words have no block.
    """
    rows = df.select(id_col, tokens(F.col(text)).alias("words"))
    blocks = _in_order(rows, id_col, vectors, "v", F.array(*[F.lit(x) for x in unknown]), size)
    return blocks.where(F.size("seq") > 0).select(id_col, "block", F.col("seq").alias(name))


def _per_query_token(
    pairs: DataFrame, left: str, right: str, left_blocks: DataFrame, right_blocks: DataFrame, measure: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """(left, right, block, i, m): ``measure`` of a query token's cosines with one block of document tokens.

    Each distinct pair meets block by block; a task holds the cosines of one pair of blocks.
    ``measure`` turns them into one row of numbers for each query token.
    """
    joined = (
        pairs.select(left, right)
        .distinct()
        .join(left_blocks.select(left, F.col("block").alias("_qb"), F.col("vectors").alias("_q")), left)
        .join(right_blocks.select(right, F.col("vectors").alias("_d")), right)
    )

    def unit(vectors: pa.ListScalar) -> np.ndarray:
        v = vectors.values.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors.values), -1).astype(float)
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    names = [left, right, "block", "i", "m"]

    def rows(batch: pa.RecordBatch, at: list[int], made: list[np.ndarray]) -> pa.RecordBatch:
        lengths = [len(m) for m in made]
        owner = pa.array(np.repeat(at, lengths))
        keys = [batch.column(c).take(owner) for c in (left, right, "_qb")]
        i = pa.array(np.concatenate([np.arange(n) for n in lengths]).astype(np.int32))
        m = np.concatenate(made)
        return pa.RecordBatch.from_arrays([*keys, i, _lists(np.full(len(m), m.shape[1]), pa.array(m.ravel()))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, d = batch.column("_q"), batch.column("_d")
            at, made, held = [], [], 0
            for row in range(batch.num_rows):
                at.append(row)
                made.append(measure(unit(q[row]) @ unit(d[row]).T))
                held += made[-1].size
                if held >= HELD:
                    yield rows(batch, at, made)
                    at, made, held = [], [], 0
            if made:
                yield rows(batch, at, made)

    kinds = [f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in (left, right)]
    return joined.select(left, right, "_qb", "_q", "_d").mapInArrow(run, f"{', '.join(kinds)}, block bigint, i int, m array<double>")


def kernel_features(
    pairs: DataFrame, left: str, right: str, left_blocks: DataFrame, right_blocks: DataFrame, kernels: int = 21
) -> DataFrame:
    """Kernel pooling features per (left, right) text pair: (pair columns, kernels array).

    ``left_blocks`` and ``right_blocks`` come from :func:`vector_blocks`; pairs of which a text has no
    token are left out. A kernel's sum over the document is added up over its blocks for
    each query token, before the logarithm and the sum over the query, so that no text has to
    fit in a task.
    """
    centres = kernel_centres(kernels)

    def measure(cosines: np.ndarray) -> np.ndarray:
        return np.stack([np.exp(-((cosines - mu) ** 2) / (2 * width**2)).sum(axis=1) for mu, width in centres], axis=1)

    tokens = _per_query_token(pairs, left, right, left_blocks, right_blocks, measure)
    sums = tokens.groupBy(left, right, "block", "i").agg(*[F.sum(F.col("m")[k]).alias(f"k{k}") for k in range(kernels)])
    pooled = sums.groupBy(left, right).agg(F.array(*[F.sum(F.log1p(f"k{k}")) for k in range(kernels)]).alias("kernels"))
    return pairs.join(pooled, [left, right]).select(*pairs.columns, "kernels")


def best_token_matches(pairs: DataFrame, left: str, right: str, left_blocks: DataFrame, right_blocks: DataFrame) -> DataFrame:
    """Row and column maxima summary of the cosine matching matrix per pair.

    (rows, cols, mean, best): its shape, mean cosine and mean over query tokens of the best
    match. Blocks and pairs without a token are as in :func:`kernel_features`.
    """

    def measure(cosines: np.ndarray) -> np.ndarray:
        return np.stack([np.full(len(cosines), cosines.shape[1]), cosines.sum(axis=1), cosines.max(axis=1)], axis=1)

    tokens = _per_query_token(pairs, left, right, left_blocks, right_blocks, measure)
    m = F.col("m")
    rows = tokens.groupBy(left, right, "block", "i").agg(F.sum(m[0]).alias("n"), F.sum(m[1]).alias("total"), F.max(m[2]).alias("top"))
    summary = rows.groupBy(left, right).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("n").cast("bigint").alias("cols"),
        (F.sum("total") / F.sum("n")).alias("mean"),
        F.avg("top").alias("best"),
    )
    return pairs.join(summary, [left, right]).select(*pairs.columns, "rows", "cols", "mean", "best")


def fit_scorer(features: DataFrame, column: str, n: int, label: str) -> list[float]:
    """Linear relevance weights over the kernel features."""
    wide = features.select(label, *[F.col(column)[i].alias(f"k{i}") for i in range(n)])
    x = VectorAssembler(inputCols=[f"k{i}" for i in range(n)], outputCol="_x").transform(wide)
    model = LogisticRegression(featuresCol="_x", labelCol=label, maxIter=20, regParam=0.01).fit(x)
    return [float(v) for v in model.coefficients]


def kernel_score(column: str, weights: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + F.col(column)[i] * F.lit(float(w))
    return total
