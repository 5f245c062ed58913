"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import PIECE_BYTES, pieces, tidy
from tessera.llm.columns import shielded
from tessera.plans.prefix import cut_lineage

#: Rows that the classifier is fitted on, at most (expected number).
FITTED_ROWS = 40_000
#: Terms that a task counts before it passes the counts on.
COUNTED = 200_000
#: Strong terms: evidence (G squared) and share of toxic rows among those with the term; weak terms.
STRONG, WEAK = (20.0, 0.7), (8.0, 0.3)
#: Voters; a row's votes are the bits of one number, so there are at most 2^16 patterns of votes.
VOTERS = 16
FEATURES = VOTERS + 6
#: Near copies share this part of their runs of so many words.
SIMILAR, SHINGLE = 0.8, 5
#: Pairs that one copy of a text is sent for.
SENT = 4096
#: Bands of three least hashes each, by which near copies are found.
BANDS = 8
_FACTORS, _SHIFTS = np.random.default_rng(2).integers(1, 1 << 63, (2, 3 * BANDS), dtype=np.uint64) | np.uint64(1)
_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 200_000


def held_out(doc_id: str = "doc_id"):
    """Whether labels of a row must not be learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def _terms(word: str) -> list[str]:
    """A word and its beginnings, as terms of the lexicons."""
    return [word, *(f"{word[:n]}-" for n in (4, 5, 6) if len(word) > n)]


@dataclass
class Lexicon:
    """Terms with their log-odds and whether they are strong."""

    weights: dict[str, tuple[float, bool]]

    def __post_init__(self):
        self.known: dict[str, tuple | None] = {}

    def __getstate__(self):
        return {"weights": self.weights, "known": {}}

    def _look_up(self, word: str) -> tuple | None:
        """(votes, strong words, strong beginnings, weak terms, weight) of a word; None if it has no term."""
        votes, counts, weight = 0, [0, 0, 0], 0.0
        for term in _terms(word):
            if found := self.weights.get(term):
                group = zlib.crc32(term.encode()) % 4
                begins = term.endswith("-")
                if found[1]:
                    votes |= 1 << (4 * begins + group)
                    counts[begins] += 1
                else:
                    votes |= 1 << (8 + group % 2)
                    counts[2] += 1
                weight = max(weight, found[0])
        if len(self.known) >= _REMEMBERED:
            self.known.clear()
        out = (votes, *counts, weight) if votes else None
        self.known[word] = out
        return out

    def features(self, text: str | None) -> tuple[int, list[float]]:
        """The votes on a text and the features of the classifier."""
        text = text or ""
        words = _WORD.findall(text.lower())
        votes, strong, begins, weak, total, top = 0, 0, 0, 0, 0.0, 0.0
        known = self.known
        for word in set(words):
            found = known[word] if word in known else self._look_up(word)
            if found:
                votes |= found[0]
                strong, begins, weak = strong + found[1], begins + found[2], weak + found[3]
                total, top = total + found[4], max(top, found[4])
        density = (strong + begins) / max(len(words), 20)
        patterns = (
            strong + begins >= 2,
            density >= 0.005,
            total >= 8,
            "*" in text and re.search(r"\w\*+\w", text) is not None,
            "!!" in text or "?!" in text,
            text.count("!") >= 3,
        )
        for at, fires in enumerate(patterns):
            votes |= bool(fires) << (10 + at)
        bits = [float(votes >> i & 1) for i in range(VOTERS)]
        counts = [float(np.log1p(x)) for x in (strong, begins, weak)]
        return votes, [*bits, *counts, min(total, 50.0) / 10, top, min(100 * density, 10.0)]


def _bounded(rows: DataFrame, key: str, most: int) -> DataFrame:
    """All rows if there are no more than ``most``, else the share of them that a hash of ``key`` picks."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 20)) < int(most / n * (1 << 20)))


def _signed(text: str | None) -> tuple[int | None, list[int]]:
    """A hash of all words of a text (None for less than two words) and its bands of least shingle hashes."""
    words = _WORD.findall((text or "").lower())
    if len(words) < 2:
        return None, []
    shingles = np.fromiter(_shingles(words), np.uint64)
    least = (shingles * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1) if len(shingles) < 4096 else np.array([(shingles * f + c).min() for f, c in zip(_FACTORS, _SHIFTS, strict=True)])
    bands = [xxhash.xxh64_intdigest(band.tobytes(), k) >> 1 for k, band in enumerate(least.reshape(BANDS, -1))]
    return xxhash.xxh64_intdigest(" ".join(words)) >> 1, bands


def _shingles(words: list[str]) -> set[int]:
    """Hashes of the distinct runs of SHINGLE words; of all words, if they are fewer."""
    runs = zip(*(words[i:] for i in range(min(SHINGLE, len(words)))), strict=False)
    return {xxhash.xxh64_intdigest(" ".join(run)) for run in runs}


def _similar(a: str, b: str) -> bool:
    """Whether two texts are near copies: shingles in common, of all shingles of either."""
    a, b = (_shingles(_WORD.findall(t.lower())) for t in (a, b))
    return len(a & b) >= SIMILAR * len(a | b)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text); rows that repeat a doc_id with its text have its key."""
    return docs.select("doc_id", F.xxhash64(F.lit("row"), "doc_id", "text").alias("key"), "text")


def _packed(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(key, toxic, body) of the texts of ``docs`` that ``known`` (doc_id, toxic) holds a label of, compressed.

    Texts move once, packed, and lie dealt by key for all that needs them; which keys have a
    label is found beforehand, without texts.
    """

    @tidy
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for piece in pieces(batch, "text"):
                bodies = pa.array([packer.compress((t or "").encode()) for t in piece.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column("key"), bodies], ["key", "body"])

    keyed = _keyed(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = keyed.select("doc_id", "key").join(known, "doc_id").groupBy("key").agg(F.max("toxic").alias("toxic"))
    bodies = keyed.select("key", "text").mapInArrow(pack, "key bigint, body binary").repartition(parts, "key")
    labelled = bodies.join(wanted.repartition(parts, "key"), "key")
    once = labelled.groupBy("key").agg(F.max("toxic").alias("toxic"), F.min("body").alias("body"))
    return once.persist(StorageLevel.DISK_ONLY)


def _different(texts: DataFrame) -> DataFrame:
    """(toxic, key, bands) of the packed texts, the one with the least key of those with the same words and label.

    Texts of less than two words are no copies of each other and have no bands.
    """

    @tidy
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "body", PIECE_BYTES // 4):
                signed = [_signed(t) for t in _texts(piece)]
                ids = [own if h is None else h for (h, _), own in zip(signed, piece.column("key").to_pylist(), strict=True)]
                added = [pa.array(ids, pa.int64()), pa.array([b for _, b in signed], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([piece.column("toxic"), piece.column("key"), *added], ["toxic", "key", "id", "bands"])

    signed = texts.mapInArrow(sign, "toxic int, key bigint, id bigint, bands array<bigint>")
    return cut_lineage(signed.groupBy("toxic", "id").agg(F.min("key").alias("key"), F.min("bands").alias("bands")).drop("id"))


def _compared(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key) of the ``pairs`` (key, lesser) that are near copies, all shingles compared.

    A text that many are compared with is sent in as many copies as keep its pairs in
    groups of SENT, so that no task gets all of them.
    """

    @tidy
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "body", PIECE_BYTES // 4):
                same = [_similar(a, b) for a, b in zip(_texts(piece), _texts(piece, "other"), strict=True)]
                yield piece.select(["key"]).filter(pa.array(same, pa.bool_()))

    wanted = pairs.groupBy("lesser").agg(F.floor(F.count("*") / SENT).cast("int").alias("more"))
    dealt = pairs.join(wanted, "lesser").withColumn("deal", F.pmod(F.xxhash64("key"), F.col("more") + 1).cast("int")).drop("more")
    lesser = texts.select(F.col("key").alias("lesser"), F.col("body").alias("other")).join(wanted, "lesser")
    lesser = lesser.select("lesser", "other", F.explode(F.sequence(F.lit(0), "more")).alias("deal"))
    others = dealt.join(lesser, ["lesser", "deal"]).select("key", "other")
    both = texts.select("key", "body").join(others, "key")
    return both.mapInArrow(verify, "key bigint").distinct()


def _singled(texts: DataFrame) -> DataFrame:
    """(key) of the packed texts without those with the words of, or nearly those of, a lesser one with their label.

    Which texts to compare is found by bands of least hashes: a pair at the threshold shares
    one of eight with 99.7 %. In each band texts are compared with one of the bucket only, in
    each with another. What the first band has shown to be a copy is not compared again.
    """
    different = _different(texts)
    banded = different.select("toxic", "key", F.posexplode("bands").alias("band", "value"))
    # another order of the keys in each band, so that texts meet several of their group
    least = F.min(F.struct(F.xxhash64("band", "key").alias("by"), "key")).getField("key")
    heads = banded.groupBy("toxic", "band", "value").agg(least.alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = banded.join(heads, ["toxic", "band", "value"]).where("key != head")
    pairs = pairs.groupBy(F.greatest("key", "head").alias("key"), F.least("key", "head").alias("lesser")).agg(F.min("band").alias("band"))
    pairs = cut_lineage(pairs)
    first = cut_lineage(_compared(texts, pairs.where("band = 0").drop("band")))
    rest = cut_lineage(_compared(texts, pairs.where("band > 0").drop("band").join(first, "key", "left_anti")))
    return different.select("key").join(first.unionByName(rest), "key", "left_anti")


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(toxic, key, text) of labelled rows (doc_id, text, toxic) without copies of a text of the same label.

    Texts with the same words count once. A text goes as well if a lesser one (by a hash of
    doc_id and text) shares at least SIMILAR of the distinct shingles of both, all of them
    compared. Texts of less than two words are no copies of each other, rows that repeat a
    doc_id with its text count once. Null texts count as empty ones.
    """

    @tidy
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "body", PIECE_BYTES // 4):
                yield pa.RecordBatch.from_arrays([piece.column("toxic"), piece.column("key"), pa.array(_texts(piece), pa.string())], ["toxic", "key", "text"])

    texts = _packed(rows, rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    return texts.join(_singled(texts), "key", "left_semi").mapInArrow(unpack, "toxic int, key bigint, text string")


def _texts(piece: pa.RecordBatch, column: str = "body") -> list[str]:
    """The packed texts of a piece."""
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(x).decode() for x in piece.column(column).to_pylist()]


def learn_lexicon(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Terms that labelled rows, all of them, show to go with toxic texts.

    Copies would make any word of a toxic text look like evidence, so of a text and its near
    copies with one label only one counts.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # clean rows in the lower 32 bits, toxic ones above
        seen: dict[str, int] = {}
        rows = 0

        def counts() -> pa.RecordBatch:
            both = np.fromiter(seen.values(), np.int64, len(seen))
            columns = [pa.array(seen, pa.string()), pa.array(both & 0xFFFFFFFF), pa.array(both >> 32)]
            return pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])

        for batch in batches:
            for piece in pieces(batch, "body", PIECE_BYTES // 4):
                for text, toxic in zip(_texts(piece), piece.column("toxic").to_pylist(), strict=True):
                    one = 1 << 32 if toxic else 1
                    rows += one
                    for term in {t for w in set(_WORD.findall(text.lower())) for t in _terms(w)}:
                        seen[term] = seen.get(term, 0) + one
                if len(seen) >= COUNTED:
                    yield counts()
                    seen.clear()
        seen[""] = rows
        yield counts()

    texts = _packed(docs, labels.select("doc_id", "toxic"))
    rows = texts.join(_singled(texts), "key", "left_semi").select("toxic", "body")
    counted = rows.mapInArrow(run, "term string, clean bigint, toxic bigint").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = cut_lineage(counted)
    texts.unpersist()
    all_rows = counted.where("term = ''").first()
    if not all_rows or not all_rows.clean or not all_rows.toxic:
        return Lexicon({})
    share = all_rows.toxic / (all_rows.clean + all_rows.toxic)
    has = F.col("clean") + F.col("toxic")
    part = lambda n, expected: F.when(n > 0, n * F.log(n / (has * expected))).otherwise(0.0)
    evidence = 2 * (part(F.col("toxic"), share) + part(F.col("clean"), 1 - share))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)) - float(np.log(share / (1 - share)))
    scored = counted.where("term != ''").select("term", evidence.alias("evidence"), odds.alias("odds"), (F.col("toxic") / has).alias("precision"))
    passes = lambda tier: (F.col("evidence") >= tier[0]) & (F.col("precision") >= tier[1])
    best = scored.where((F.col("odds") > 0) & (passes(STRONG) | passes(WEAK)))
    return Lexicon({r.term: (r.odds, bool(r.strong)) for r in best.withColumn("strong", passes(STRONG)).collect()})


def featurize(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``_votes`` and ``_features`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept = docs.select(*keep, F.col("text").alias("_text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text"):
                found = [shared.value.features(t) for t in piece.column("_text").to_pylist()]
                added = [pa.array([v for v, _ in found], pa.int32()), pa.array([x for _, x in found], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), *added], [*keep, "_votes", "_features"])
        shared.value.known.clear()  # the worker lives on

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["_votes int", "_features array<double>"])
    return kept.mapInArrow(run, schema)


@dataclass
class LabelModel:
    """Voters given the hidden label: each depends on the label and on the voter it goes with most.

    ``rates[c, j, v]`` is how often voter j fires in class c when its partner ``parent[j]``
    votes v; the partners form the tree of the strongest correlations within the classes.
    """

    prior: float
    parent: list[int]
    rates: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        bits = (votes[:, None] >> np.arange(VOTERS)) & 1
        out = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for j, p in enumerate(self.parent):
            state = bits[:, p] if p >= 0 else np.zeros(len(votes), dtype=np.int64)
            fires = self.rates[:, j, :][:, state]
            chance = np.where(bits[:, j], fires, 1 - fires)
            out += np.log(chance[1] / chance[0])
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -500, 500)))

    @classmethod
    def _estimate(cls, bits: np.ndarray, weight: np.ndarray, parent: list[int]) -> LabelModel:
        """Accuracies from weighted rows; weight[c]: how much each row belongs to class c."""
        rates = np.zeros((2, VOTERS, 2))
        for j, p in enumerate(parent):
            for v in (0, 1):
                rows = np.ones(len(bits), dtype=bool) if p < 0 else bits[:, p] == v
                # one row's worth of the voter's overall rate in the class keeps unseen cases apart
                overall = (weight @ bits[:, j] + 0.5) / (weight.sum(axis=1) + 1)
                rates[:, j, v] = (weight[:, rows] @ bits[rows, j] + overall) / (weight[:, rows].sum(axis=1) + 1)
        prior = (weight[1].sum() + 0.5) / (weight.sum() + 1)
        return cls(float(prior), parent, np.clip(rates, 1e-4, 1 - 1e-4))

    @classmethod
    def fit(cls, votes: np.ndarray, unknown: np.ndarray, known: np.ndarray, rounds: int = 25) -> LabelModel:
        """By expectation and maximisation over patterns of votes.

        ``unknown``: rows of each pattern without a label to learn from; ``known[c]``: rows with
        label c, which fix what the two classes mean.
        """
        bits = ((votes[:, None] >> np.arange(VOTERS)) & 1).astype(np.float64)
        model = cls._estimate(bits, known.astype(np.float64), [-1] * VOTERS)
        for parents in ("none", "tree"):
            parent = model.parent
            if parents == "tree":
                parent = cls._partners(bits, weight)
            for _ in range(rounds):
                toxic = model.posterior(votes)
                weight = known + unknown * np.stack([1 - toxic, toxic])
                model = cls._estimate(bits, weight, parent)
        return model

    @staticmethod
    def _partners(bits: np.ndarray, weight: np.ndarray) -> list[int]:
        """The spanning tree of greatest mutual information of voters within the classes."""
        information = np.zeros((VOTERS, VOTERS))
        for w in weight:
            total = w.sum()
            if total <= 0:
                continue
            for a, ones_a in ((bits, True), (1 - bits, False)):
                for b, ones_b in ((bits, True), (1 - bits, False)):
                    joint = (a * w[:, None]).T @ b / total
                    apart = np.outer((a * w[:, None]).sum(axis=0), (b * w[:, None]).sum(axis=0)) / total**2
                    information += total * np.where(joint > 0, joint * np.log(np.maximum(joint, 1e-300) / np.maximum(apart, 1e-300)), 0)
        parent, inside = [-1] * VOTERS, [0]
        while len(inside) < VOTERS:
            rest = [j for j in range(VOTERS) if j not in inside]
            i, j = max(((i, j) for i in inside for j in rest), key=lambda e: information[e])
            parent[j] = i
            inside.append(j)
        return parent


def _open(docs: DataFrame) -> DataFrame:
    """Rows whose label may be learned from; the texts of the others need not go to the labels."""
    return docs.where(~held_out())


def _fit(features: DataFrame, labels: DataFrame) -> DataFrame | None:
    """A function that adds ``score``; None if the labels don't hold both classes."""
    known = labels.select("doc_id", "toxic")
    patterns = features.select("doc_id", "_votes").join(known, "doc_id", "left").groupBy("_votes").agg(
        F.count(F.when(F.col("toxic").isNull(), 1)).alias("unknown"),
        F.count(F.when(F.col("toxic") == 0, 1)).alias("clean"),
        F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic"),
    )
    rows = sorted(tuple(r) for r in patterns.collect())  # at most 2^16
    votes, unknown, clean, toxic = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0)] * 4
    if not len(votes) or not clean.sum() or not toxic.sum():
        return None
    posterior = LabelModel.fit(votes, unknown, np.stack([clean, toxic])).posterior(votes)
    spark = features.sparkSession
    believed = spark.createDataFrame([(int(v), float(p)) for v, p in zip(votes, posterior, strict=True)], "_votes int, _toxic double")
    sample = _bounded(features.select("doc_id", "_votes", "_features"), "doc_id", FITTED_ROWS)
    sample = sample.join(F.broadcast(believed), "_votes")  # at most 2^16 rows
    # each row stands for both labels, as much as the label model believes in each
    both = sample.select(
        array_to_vector("_features").alias("features"),
        F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("_toxic").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("_toxic")).alias("weight")))).alias("_as"),
    ).select("features", "_as.label", "_as.weight")
    return LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50, standardization=True).fit(both)


def _usable(labels: DataFrame) -> DataFrame:
    """One label for each doc_id that may be learned from; 1 if its rows differ."""
    fair = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    return fair.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def _scored(features: DataFrame, model) -> DataFrame:
    if model is None:
        return features.withColumn("_score", F.lit(0.0))
    # names that no table is likely to have
    model = model.setFeaturesCol("_vector").setProbabilityCol("_probability").setRawPredictionCol("_raw").setPredictionCol("_class")
    scored = model.transform(features.withColumn("_vector", array_to_vector("_features")))
    return scored.withColumn("_score", F.get(vector_to_array("_probability"), F.lit(1))).drop("_vector", "_probability", "_raw", "_class")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    Lexicons come from labelled rows that are not held out; 16 lexicon and pattern voters
    vote on all texts; a generative model of the votes estimates the voters' accuracies and
    correlations and gives each text a posterior label; a logistic regression learns those.
    labels holds (doc_id, toxic), toxic being 0, 1 or null. Only texts are inputs of a score.

    A null or empty text has no votes and the score of such. Rows without a doc_id are
    scored, and held_out is null for them. Repeated rows get the same score each. If usable
    labels don't hold both classes, nothing can be learned and all scores are 0. An empty
    table gives no rows. Extra columns are ignored.
    """
    known = cut_lineage(_usable(labels))
    features = cut_lineage(featurize(docs, learn_lexicon(_open(docs), known), ["doc_id"]))
    scored = _scored(features, _fit(features, known))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, all columns."""
    docs, restore = shielded(docs, ["doc_id", "text"])
    known = cut_lineage(_usable(labels))
    lexicon = learn_lexicon(_open(docs), known)
    model = _fit(cut_lineage(featurize(docs, lexicon, ["doc_id"])), known)
    # the rows are featurized again, which spares a shuffle of all texts
    scored = _scored(featurize(docs, lexicon, docs.columns), model)
    return restore(scored.where("_score < 0.5"))
