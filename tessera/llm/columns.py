"""The caller's columns beside those that an operator makes for itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _named(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def shielded(df: DataFrame, own: Sequence[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with all columns but ``own`` under names of no meaning, and a function that gives them theirs back.

    That function takes the result and the names of added columns, which come last and take
    the place of columns of the same name.
    """
    names = {c: c if c in own else f"_other_{i}" for i, c in enumerate(df.columns)}

    def restore(out: DataFrame, added: Sequence[str] = ()) -> DataFrame:
        kept = [_named(n).alias(c) for c, n in names.items() if c not in added]
        return out.select(*kept, *added)

    return df.select(*[_named(c).alias(n) for c, n in names.items()]), restore
