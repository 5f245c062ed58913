"""Reproducible pseudo-random columns: every draw is an md5 of ids, never engine state."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_key(*parts: Column | str | int) -> Column:
    """Join ids, labels and seeds into one hashable text, separated by ``_``."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws("_", *[c.cast("string") for c in cols])


def md5_mod(text: Column, n: Column | int) -> Column:
    """The 128-bit md5 of ``text`` modulo ``n`` (n < 2**31), as a whole number."""
    digest = F.md5(text)
    if isinstance(n, int) and n in (2, 4, 8, 16):  # the last digit decides; bytes need not be counted as characters
        last = F.substring(digest.cast("binary"), 32, 1).cast("string")
        return F.pmod(F.instr(F.lit("123456789abcdef"), last).cast("bigint"), F.lit(n).cast("bigint"))
    n = n if isinstance(n, Column) else F.lit(n)
    n = n.cast("bigint")
    rest = F.lit(0).cast("bigint")
    for i in range(4):
        word = F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint")
        # (rest * 2**32 + word) mod n, with both factors kept below 2**31
        shifted = F.pmod(rest * F.pmod(F.lit(2**32).cast("bigint"), n), n)
        rest = F.pmod(shifted + word, n)
    return rest


def uniform(*parts: Column | str | int) -> Column:
    """A uniform draw in [0, 1) from the first 52 bits of the md5 of the joined parts."""
    digest = F.md5(text_key(*parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def hash_order(*parts: Column | str | int) -> Column:
    """A shuffled sort key: the md5 text of the joined parts."""
    return F.md5(text_key(*parts))


def _poisson1_cdf(least: float = 2.0**-52) -> list[float]:
    """P(Poisson(1) <= k) for k = 0, 1, ... as long as a draw of 52 bits can lie above."""
    term, total, out = math.exp(-1), 0.0, []
    while 1 - (total + term) >= least:
        total += term
        out.append(total)
        term /= len(out)
    return out


POISSON1_CDF = _poisson1_cdf()


def poisson1(draw: Column) -> Column:
    """A Poisson(1) count from a uniform draw of up to 52 bits."""
    count = F.lit(0)
    for edge in POISSON1_CDF:
        count = count + (draw >= F.lit(edge)).cast("int")
    return count
