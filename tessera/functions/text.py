"""Text preparation on columns."""

from __future__ import annotations

import string
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words per language.
STOP_WORDS = {
    "de": ["der", "die", "und", "das", "den", "mit", "ist", "nicht", "ein", "für", "auf", "zu"],
    "en": ["the", "of", "and", "to", "in", "that", "is", "for", "on", "with", "was", "it"],
    "es": ["el", "los", "que", "en", "y", "con", "por", "para", "una", "del", "las", "se"],
    "fr": ["le", "les", "un", "une", "et", "dans", "est", "du", "pour", "sur", "au", "qui"],
}


def clean_text(text: Column | str) -> Column:
    """Lower case with every ASCII punctuation mark turned into a space."""
    text = F.col(text) if isinstance(text, str) else text
    marks = string.punctuation
    return F.lower(F.translate(text, marks, " " * len(marks)))


def tokens(text: Column | str) -> Column:
    """Words of the cleaned text, in order."""
    return F.filter(F.split(clean_text(text), r"\s+"), lambda w: w != "")


def language_scores(df: DataFrame, id_col: str, text: str, words: Mapping[str, Sequence[str]] = STOP_WORDS) -> DataFrame:
    """Stop-word hits per text and language.

    Words are counted per text before the join; the word table is a fixed few dozen rows.
    """
    rows = [(w, lang) for lang, ws in words.items() for w in ws]
    known = df.sparkSession.createDataFrame(rows, "word string, guess string")
    return (
        df.select(id_col, F.explode(tokens(text)).alias("word"))
        .join(F.broadcast(known), "word")
        .groupBy(id_col, "guess")
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def guess_language(df: DataFrame, id_col: str, text: str, words: Mapping[str, Sequence[str]] = STOP_WORDS) -> DataFrame:
    """Best language per text; the alphabetically last one on ties, null without hits."""
    best = (
        language_scores(df, id_col, text, words)
        .groupBy(id_col)
        .agg(F.max_by("guess", F.struct("hits", "guess")).alias("guess"), F.max("hits").alias("hits"))
    )
    return df.join(best, id_col, "left").fillna(0, ["hits"])


def prepared(text: str, preprocess: Callable[[Column], Column] = tokens) -> Column:
    """Apply a caller's text preparation, a function from column to array column."""
    return preprocess(F.col(text))
