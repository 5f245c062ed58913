"""Repeated runs of lines, by prefix doubling of a suffix array over line ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.columns import shielded
from tessera.plans.prefix import cut_lineage, join_on_keys

_DOC = ["doc_id", "_sub"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Add ``_sub``, which tells texts apart that share a doc_id."""
    return docs.withColumn("_sub", F.xxhash64("text"))


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line: its place, the number of lines of its document, its id (128 bits) and length."""
    cut = docs.select(*_DOC, F.split("text", "\n", -1).alias("_lines")).select(*_DOC, F.size("_lines").alias("n"), F.posexplode("_lines").alias("pos", "_line"))
    ids = {"id1": F.xxhash64("_line"), "id2": F.xxhash64(F.lit(1), F.col("_line")), "chars": F.length("_line")}
    return cut.select(*_DOC, "n", "pos", *[v.alias(k) for k, v in ids.items()])


def _ranked(suffixes: DataFrame, names: list[str]) -> DataFrame:
    """Suffixes that share ``names`` with another one: their ``rank`` in sorted order, and whether they are ``later`` ones.

    Equal names get one rank; ranks are in the order of the names. Suffixes that stand alone
    leave: nothing is equal to them, nor to any suffix that has them as its next part. Names
    are counted before they are joined back, so a frequent line costs no more than its rows.
    """
    place = F.struct(*_DOC, "pos")
    groups = suffixes.groupBy(*names).agg(F.count("*").alias("copies"), F.min(place).alias("first")).where("copies > 1")
    groups = groups.orderBy(*names).withColumn("new_rank", F.monotonically_increasing_id())
    ranked = join_on_keys(suffixes, groups, names).withColumn("later", ~place.eqNullSafe(F.col("first")))
    # written down, as ranks must stay as they are once given
    return cut_lineage(ranked.drop(*names, "copies", "first").withColumnRenamed("new_rank", "rank"))


def repeated_runs(docs: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """(doc_id, _sub, pos) of each line in a later copy of a run; ``docs`` has ``_sub``.

    The suffixes of all documents (each line with those that follow) are ranked by their
    first line, then by twice as many lines each round: the rank of a suffix and the rank of
    the one that many lines on are its name for the next. Rounds end at ``min_lines``, as no
    deeper order changes what goes: neighbours in the suffix array whose longest common
    prefix reaches ``min_lines`` have one rank then, and each maximal interval of them is the
    set of copies of a run. All copies but the first, by (doc_id, line), lose the lines;
    overlapping intervals add up to maximal runs.
    """
    suffixes = _ranked(_lines(docs), ["id1", "id2"])
    alone = F.lit(True) if min_lines == 1 else F.col("chars") >= min_chars
    gone = suffixes.where(F.col("later") & alone).select(*_DOC, "pos")
    suffixes, depth = suffixes.select(*_DOC, "n", "pos", "rank"), 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        ahead = Window.partitionBy(*_DOC).orderBy("pos").rangeBetween(step, step)
        depth += step
        named = suffixes.withColumn("next", F.max("rank").over(ahead)).where(F.col("next").isNotNull() & (F.col("pos") + depth <= F.col("n")))
        suffixes = _ranked(named, ["rank", "next"]).select(*_DOC, "n", "pos", "rank", "later")
    if min_lines > 1:
        runs = suffixes.where("later").select(*_DOC, F.explode(F.sequence("pos", F.col("pos") + (min_lines - 1))).alias("pos"))
        gone = gone.unionByName(runs)
    return gone


def dedup_lines(docs: DataFrame, min_lines: int = 3, min_chars: int = 40) -> DataFrame:
    """All columns of ``docs`` with later copies of line runs cut from text, and n_lines, n_removed, n_runs.

    A run is ``min_lines`` or more lines in a row, or a single line of ``min_chars`` or more
    characters, that are the same, character by character, as an earlier place of any
    document or of the same one. Places are in the order of (doc_id, line), null ids first,
    texts that share a doc_id by their hash. Lines end at a line feed. Runs are judged on the
    input, not on what is left. n_runs: maximal stretches of removed lines.

    A null text stays null and has no lines; an empty text is one empty line. A text that
    loses all lines is empty. Repeated rows (one doc_id, one text) count as one document and
    lose the same lines. An empty table gives no rows. Of the columns of ``docs`` those with the
    names of the three counts are replaced, others pass through.
    """
    docs, restore = shielded(docs, ["doc_id", "text"])
    keyed = _keyed(docs)
    gone = repeated_runs(keyed.select("doc_id", "text", "_sub"), min_lines, min_chars)
    per_doc = gone.groupBy(*_DOC).agg(F.collect_set("pos").alias("_gone"))
    joined = join_on_keys(keyed, per_doc, _DOC, "left")
    lines = F.split("text", "\n", -1)
    removed = F.coalesce(F.col("_gone"), F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("_cut", i)), "\n"))
    followed = F.size(F.array_intersect(removed, F.transform(removed, lambda p: p + 1)))
    added = {
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint"),
        "n_removed": F.size(removed).cast("bigint"),
        "n_runs": (F.size(removed) - followed).cast("bigint"),
    }
    cut = joined.withColumns(added | {"_cut": F.when(F.col("_gone").isNotNull(), lines)}).withColumn("text", kept)
    return restore(cut, list(added))


#: The same in SQL for runs of three lines or single lines of 40 characters.
ORACLE = """
WITH lines AS (
  SELECT doc_id, n, pos, ls[pos + 1] AS line FROM (
    SELECT doc_id, ls, len(ls) AS n, unnest(range(len(ls))) AS pos
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
runs AS (
  SELECT doc_id, n, pos, line,
         lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
firsts AS (
  SELECT doc_id, n, pos, line,
         row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1 AND length(line) >= 40 AS alone,
         pos + 3 <= n AND row_number() OVER (PARTITION BY line, line2, line3, pos + 3 <= n ORDER BY doc_id, pos) > 1 AS three
  FROM runs),
marked AS (
  SELECT doc_id, pos, line,
         alone OR bool_or(three) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS gone
  FROM firsts),
edges AS (
  SELECT doc_id, pos, line, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens
  FROM marked)
SELECT d.doc_id, coalesce(count(e.pos), 0) AS n_lines,
       count(*) FILTER (WHERE e.gone) AS n_removed, count(*) FILTER (WHERE e.opens) AS n_runs,
       CASE WHEN any_value(d.text) IS NOT NULL
            THEN sha256(coalesce(string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (WHERE NOT e.gone), '')) END AS kept_sha256
FROM documents d LEFT JOIN edges e ON e.doc_id = d.doc_id
GROUP BY d.doc_id
"""
