"""Benchmark decontamination by spaced seeds, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.columns import shielded

#: Positions of a window that count. Any 13 aligned words of which two differ hold a window
#: of one of the masks that leaves out the two, so no overlap that is verified below is missed;
#: so do 10 to 12 words of which one differs.
MASKS = ("11101011", "11001111")
#: For items of these numbers of words, too short for those: masks and their places in the
#: item. Whichever word differs, one of them leaves it out.
SHORT = {7: (("1111", 0), ("1111", 3), ("1110111", 0)), 8: (("1111", 0), ("1111", 4)), 9: (("1111", 0), ("1111", 5))}
#: Words of an overlap, and how many of them may differ.
OVERLAP, DIFFERING = 13, 2
#: Benchmark items of fewer words say nothing.
LEAST_WORDS = 5
#: Seeds of the benchmark up to which they are sent to all executors (about 100 MB).
SENT_SEEDS = 500_000
# Scripts that put no spaces between words.
_UNSPACED = "".join(rf"\p{{Is{script}}}" for script in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
#: Where all of them lie; cheaper to look for than the scripts.
_MAY_BE_UNSPACED = r"[\u0e00-\u1fff\u2e80-\x{10ffff}]"


_WORDS_SQL = r"""list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words"""
_MASKS_SQL = " UNION ALL ".join(
    f"SELECT {k} AS m, {len(mask)} AS span, {[i for i, c in enumerate(mask) if c == '1']} AS places" for k, mask in enumerate(MASKS)
)
#: The same rows in SQL: windows of both tables meet on their unmasked words and are verified on the diagonal.
ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} FROM documents),
i AS (SELECT * FROM (SELECT item_id, {_WORDS_SQL} FROM benchmark) WHERE len(words) >= {LEAST_WORDS}),
masks AS ({_MASKS_SQL} UNION ALL
    SELECT DISTINCT len(words) + {len(MASKS)}, len(words), range(len(words)) FROM i WHERE len(words) < {min(map(len, MASKS))}),
dw AS (SELECT doc_id, m, x.pos AS pos, list_transform(places, lambda p: words[x.pos + p + 1]) AS seed
    FROM d, masks, LATERAL (SELECT unnest(range(len(words) - span + 1)) AS pos) x),
iw AS (SELECT item_id, m, span, x.pos AS item_pos, list_transform(places, lambda p: words[x.pos + p + 1]) AS seed
    FROM i, masks, LATERAL (SELECT unnest(range(len(words) - span + 1)) AS pos) x),
hits AS (SELECT doc_id, item_id, d.words AS words, i.words AS item, least({OVERLAP}, len(i.words)) AS overlap, dw.pos - item_pos AS shift,
        greatest(0, item_pos + span - least({OVERLAP}, len(i.words)), item_pos - dw.pos) AS first,
        least(item_pos, len(i.words) - least({OVERLAP}, len(i.words)), len(d.words) - (dw.pos - item_pos) - least({OVERLAP}, len(i.words))) AS last
    FROM dw JOIN iw USING (m, seed) JOIN d USING (doc_id) JOIN i USING (item_id)),
spans AS (SELECT DISTINCT doc_id, item_id, words, item, overlap, shift, unnest(range(first, last + 1)) AS a FROM hits),
checked AS (SELECT doc_id, item_id, overlap, len(list_filter(range(a, a + overlap), lambda n: item[n + 1] = words[n + shift + 1])) AS same FROM spans)
SELECT doc_id, item_id, CAST(max(same) AS INTEGER) AS equal_words, CAST(max(overlap) AS INTEGER) AS overlap_words
FROM checked WHERE overlap - same <= overlap * {DIFFERING} // {OVERLAP} GROUP BY ALL
"""


def _words(text: Column) -> Column:
    """64-bit ids of the words of a text: runs of letters and digits in lower case, single letters of scripts without spaces."""
    text = F.lower(F.coalesce(text, F.lit("")))
    apart = F.when(text.rlike(_MAY_BE_UNSPACED), F.regexp_replace(text, f"([{_UNSPACED}])", " $1 ")).otherwise(text)
    split = F.split(apart, "[^\\p{L}\\p{N}]+")
    # a text that starts or ends with other characters splits off an empty word there
    return F.transform(F.array_remove(split, ""), lambda w: F.xxhash64(w))


def _seeds(words: str, masks: list[str]) -> Column:
    """The hash of every window under every mask, mask after mask."""

    def under(number: int, mask: str) -> Column:
        places = [i for i, m in enumerate(mask) if m == "1"]
        starts = F.size(words) - len(mask)
        hashes = F.transform(
            F.sequence(F.lit(0), F.greatest(starts, F.lit(0))),
            lambda at: F.xxhash64(F.lit(number), *[F.get(words, at + i) for i in places]),
        )
        return F.when(starts >= 0, hashes).otherwise(F.array().cast("array<bigint>"))

    return F.concat(*[under(k, m) for k, m in enumerate(masks)])


def _windows(words: str, masks: list[str]) -> Column:
    """How many windows come before those of each mask."""
    upto, out = F.lit(0), []
    for mask in masks:
        out.append(upto)
        upto = upto + F.greatest(F.size(words) - len(mask) + 1, F.lit(0))
    return F.array(*out)


def _seeded(df: DataFrame, words: str, masks: list[str], keep: list[str]) -> DataFrame:
    """A row for each window of each mask: ``seed``, the mask's number and the window's place."""
    wide = df.select(*keep, words, _windows(words, masks).alias("_upto"), F.posexplode(_seeds(words, masks)).alias("_nth", "seed"))
    mask = F.expr(" + ".join(["0", *[f"if(_nth >= _upto[{k}], 1, 0)" for k in range(1, len(masks))]]))
    return wide.withColumn("_mask", mask).withColumn("at", F.expr("_nth - _upto[_mask]")).drop("_upto", "_nth")


def _verified() -> Column:
    """The most equal words of an overlap of 13 aligned words (or of the whole item, if shorter) that holds the seed."""
    overlap = F.least(F.lit(OVERLAP), F.size("_item"))
    shift = F.col("_at") - F.col("_item_at")
    first = F.greatest(F.lit(0), F.col("_item_at") + F.col("_span") - overlap, -shift)
    last = F.least(F.col("_item_at"), F.size("_item") - overlap, F.size("_words") - shift - overlap)
    spans = F.when(first <= last, F.sequence(first, last))
    same = F.transform(
        spans,
        lambda a: F.size(F.filter(F.sequence(a, a + overlap - 1), lambda i: F.get("_item", i) == F.get("_words", i + shift))),
    )
    return F.array_max(same)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, equal_words, overlap_words) for each document that holds words of a benchmark item.

    Windows of both tables are hashed under fixed masks that ignore some positions; equal
    hashes are hits, and each is verified word by word on its diagonal: it counts if 13 words
    in a row around it, all of them from one item, differ in two words at most (items of 5 to
    12 words: no more than one in six; items of seven to nine have masks of their own). Case,
    punctuation and white space don't matter. Letters of scripts without spaces count as words.

    Null and empty texts and items of fewer than five words find nothing. Rows without or
    with the same doc_id (item_id) are reported together. Extra columns are ignored. The
    benchmark's seeds are sent to all executors only up to a checked number of them; beyond
    it, hits come from a shuffled join and are verified after a join with the documents.
    """
    items = benchmark.select("item_id", _words(F.col("text")).alias("_item")).where(F.size("_item") >= LEAST_WORDS)
    short = [r.n for r in items.where(F.size("_item") <= max(SHORT)).select(F.size("_item").alias("n")).distinct().collect()]
    # items of up to six words, none of which may differ, are sought as a whole
    sought = {n: SHORT.get(n, (("1" * n, 0),)) for n in sorted(short)}
    masks = list(dict.fromkeys([*MASKS, *[mask for places in sought.values() for mask, _ in places]]))
    long = F.col("_mask") < len(MASKS)
    at_places = [(F.size("_item") == n) & (F.col("_mask") == masks.index(mask)) & (F.col("at") == at) for n, places in sought.items() for mask, at in places]
    longer = long & ~F.size("_item").isin(list(sought)) if sought else long
    seeds = _seeded(items, "_item", masks, ["item_id"]).where(reduce(or_, at_places, longer))
    seeds = seeds.select("item_id", "_item", F.col("at").alias("_item_at"), "seed", F.element_at(F.array(*[F.lit(len(m)) for m in masks]), F.col("_mask") + 1).alias("_span"))
    texts = docs.select("doc_id", _words(F.col("text")).alias("_words"))
    windows = _seeded(texts, "_words", masks, ["doc_id"]).withColumnRenamed("at", "_at")
    if seeds.count() <= SENT_SEEDS:
        hits = windows.join(F.broadcast(seeds), "seed")
    else:
        places = windows.select("doc_id", F.xxhash64("_words").alias("_text"), "_at", "seed").join(seeds, "seed").drop("seed")
        hits = places.join(texts.select(F.xxhash64("_words").alias("_text"), "_words").distinct(), "_text")
    overlap = F.least(F.lit(OVERLAP), F.size("_item"))
    checked = hits.select("doc_id", "item_id", _verified().alias("equal_words"), overlap.alias("overlap_words"))
    allowed = F.floor(F.col("overlap_words") * DIFFERING / OVERLAP)
    found = checked.where(F.col("overlap_words") - F.col("equal_words") <= allowed)
    return found.groupBy("doc_id", "item_id").agg(F.max("equal_words").alias("equal_words"), F.max("overlap_words").alias("overlap_words"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no words of the benchmark, all columns; rows that share a doc_id go together."""
    docs, restore = shielded(docs, ["doc_id", "text"])
    leaks = find_leaks(docs, benchmark).select(F.col("doc_id").alias("_leak")).distinct()
    return restore(docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("_leak")), "left_anti"))
