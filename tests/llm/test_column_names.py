"""Columns of the caller that have the names operators use for themselves."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, simhash, surrogates, toxicity

CLASHING = ["_sub", "_gone", "_cut", "_leak", "_match", "_new", "_of", "_again", "_votes", "_features", "_score", "_text", "_vector", "_Sub2", "a.b"]
CLASHING += ["_other_0", "_other_2", "rank", "n"]


@pytest.fixture(scope="module")
def clashing(spark):
    texts = ["one line of text\nanother line here\nand a third line", "mail me at some.one@mail.org please", None, ""]
    plain = [(i, f"a quiet afternoon of number {i} by the sea") for i in range(20, 60)]
    docs = spark.createDataFrame([*enumerate(texts), (9, texts[0]), *plain], "doc_id bigint, text string")
    return docs.select("doc_id", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING], "text")


def _stages(spark):
    benchmark = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)))], "item_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), *[(i, 0) for i in range(20, 60)]], "doc_id bigint, toxic int")
    return {
        "line_dedup": line_dedup.dedup_lines,
        "simhash": simhash.keep_first,
        "decontaminate": lambda docs: decontaminate.drop_leaks(docs, benchmark),
        "toxicity": lambda docs: toxicity.drop_toxic(docs, labels),
        "surrogates": lambda docs: surrogates.replace(docs, "key"),
    }


@pytest.mark.parametrize("name", ["line_dedup", "simhash", "decontaminate", "toxicity", "surrogates"])
def test_columns_with_names_of_an_operator_pass_through(spark, clashing, name):
    got = _stages(spark)[name](clashing)
    assert got.columns[: len(clashing.columns)] == clashing.columns
    rows = got.collect()
    assert rows
    for r in rows:
        values = r.asDict()
        assert all(values[c] == f"{c}:{r.doc_id}" for c in CLASHING)
