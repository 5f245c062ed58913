"""Declarative feature tables, transform chains and category encoders."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import half_open, scalar
from tessera.functions.hashing import uniform
from tessera.operators.sales import mode_by
from tessera.plans.prefix import join_on_keys, prefix
from tessera.sources.files import TableRegistry


@dataclass(frozen=True)
class Aggregates:
    """A feature block that is one grouped aggregate over the rows of ``where``.

    ``aggs`` maps a feature to (function name, input column); ``derived`` are expressions
    over the features. Blocks with the same source and keys share a scan.
    """

    source: str
    keys: tuple[str, ...]
    aggs: Mapping[str, tuple[str, Column]]
    where: Column | None = None
    derived: Mapping[str, Column] = field(default_factory=dict)
    keep: tuple[str, ...] = ()


@dataclass(frozen=True)
class Block:
    """A feature block given as a whole DataFrame with one row per key."""

    keys: tuple[str, ...]
    table: DataFrame


BLOCKS: dict[str, Callable] = {}


def block(name: str):
    """Register a function (tables, **args) -> Aggregates | Block under a name."""

    def add(fn):
        BLOCKS[name] = fn
        return fn

    return add


def _merged(source: DataFrame, keys: Sequence[str], parts: Sequence[Aggregates]) -> DataFrame:
    """All blocks of one source in one scan: each aggregate sees only its block's rows."""
    aggs, rows = [], None
    for i, p in enumerate(parts):
        cond = F.lit(True) if p.where is None else p.where
        rows = cond if rows is None else rows | cond
        aggs.append(F.count_if(cond).alias(f"_here{i}"))
        for name, (fn, col) in p.aggs.items():
            aggs.append(getattr(F, fn)(F.when(cond, col)).alias(name))
    out = source.where(rows).groupBy(*keys).agg(*aggs)
    picked = []
    for i, p in enumerate(parts):
        if p.derived:
            out = out.withColumns(dict(p.derived))
        names = p.keep or [*p.aggs, *p.derived]
        # a key without rows in this block has no features, as after an outer join
        picked += [F.when(F.col(f"_here{i}") > 0, F.col(n)).alias(n) for n in names]
    return out.select(*keys, *picked)


def feature_table(
    tables: TableRegistry, config: Sequence[Mapping], blocks: Mapping[str, Callable] | None = None
) -> DataFrame:
    """Outer-join the configured blocks on their shared keys.

    ``config`` is a list of ``{"name": ..., "args": {...}}``. Blocks with other keys are
    refused before anything is planned.
    """
    known = BLOCKS if blocks is None else {**BLOCKS, **blocks}
    unknown = [c["name"] for c in config if c["name"] not in known]
    if unknown:
        raise KeyError(f"unknown feature blocks: {unknown}")
    made = [known[c["name"]](tables, **c.get("args", {})) for c in config]
    keys = made[0].keys
    if any(m.keys != keys for m in made):
        raise ValueError(f"feature blocks have different keys: {sorted({m.keys for m in made})}")
    by_source: dict[str, list[Aggregates]] = {}
    frames: list[DataFrame] = []
    for m in made:
        if isinstance(m, Aggregates):
            by_source.setdefault(m.source, []).append(m)
        else:
            frames.append(m.table)
    for source, parts in by_source.items():
        frames.append(_merged(tables.get(source), list(keys), parts))
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, list(keys), "full")
    return out


@block("purchases_agg")
def purchases_agg(tables, date_to: int, delta: int, key="customer_id", date="date", value="purchase_sum"):
    return Aggregates(
        "receipts",
        (key,),
        {
            f"purchases_{delta}d__count": ("count", F.col(date)),
            f"{value}_{delta}d__sum": ("sum", F.col(value)),
        },
        half_open(date, date_to - delta, date_to),
    )


@block("receipts_basic")
def receipts_basic(
    tables, date_to: int, delta: int, key="customer_id", date="date", value="purchase_sum", discount="discount"
):
    """Size, price level, first and last day, mean gap and time since the last receipt."""
    s = f"__{delta}d"
    aggs = {f"{value}_{fn}{s}": (fn, F.col(value)) for fn in ("sum", "max", "min", "mean")}
    aggs |= {
        f"{discount}_sum{s}": ("sum", F.col(discount)),
        f"date_min{s}": ("min", F.col(date)),
        f"date_max{s}": ("max", F.col(date)),
        f"date_count{s}": ("count", F.col(date)),
    }
    first, last, n = F.col(f"date_min{s}"), F.col(f"date_max{s}"), F.col(f"date_count{s}")
    derived = {
        f"mean_interval{s}": F.when(n > 1, (last - first) / (n - 1)),
        f"time_since_last{s}": F.lit(date_to) - last,
    }
    return Aggregates("receipts", (key,), aggs, half_open(date, date_to - delta, date_to), derived)


@block("day_of_week")
def day_of_week(
    tables, date_to: int, delta: int, weekends: Sequence[int] = (), key="customer_id", date="date", weekday=None
):
    """Receipts per weekday (all seven columns) and, if asked for, the weekend share."""
    day = F.pmod(F.col(date), F.lit(7)) if weekday is None else weekday
    names = [f"purchases_wd{d}_{delta}d__count" for d in range(7)]
    aggs = {n: ("count", F.when(day == d, F.col(date))) for d, n in enumerate(names)}
    derived = {}
    if weekends:
        part = sum((F.col(names[d]) for d in weekends), F.lit(0))
        derived[f"weekend_purchases_{delta}d__ratio"] = part / sum((F.col(n) for n in names), F.lit(0))
    return Aggregates("receipts", (key,), aggs, half_open(date, date_to - delta, date_to), derived)


@block("favourite_store")
def favourite_store(tables, date_to: int, delta: int, key="customer_id", date="date", store="store_id"):
    rows = tables.get("receipts").where(half_open(date, date_to - delta, date_to))
    return Block((key,), mode_by(rows, [key], store, f"favourite_store_{delta}d"))


@block("profile")
def profile(tables, columns: Sequence[str], key="customer_id"):
    return Block((key,), tables.get("customers").select(key, *columns))


@block("campaign")
def campaign(tables, date_start_offer: int, days_offer: int, key="customer_id", date="date"):
    """Offer flag and sums over the offer days for every customer, 0 where nothing is known."""
    offer = (
        tables.get("receipts")
        .where(half_open(date, date_start_offer, date_start_offer + days_offer))
        .groupBy(key)
        .agg(F.sum("purchase_amt").alias("target_purchase_amt"), F.sum("discount").alias("target_discount_sum"))
    )
    table = (
        tables.get("customers")
        .select(key)
        .join(tables.get("campaigns").select(key, "target_group_flag"), key, "left")
        .join(offer, key, "left")
        .fillna(0)
    )
    return Block((key,), table)


@block("campaign_targets")
def campaign_targets(tables, date_to, columns: Sequence[str], key="customer_id", date="treatment_date"):
    """Targets of campaigns treated up to the cutoff day."""
    rows = tables.get("campaigns").where(F.col(date) <= F.lit(date_to))
    return Block((key,), rows.select(key, *columns))


TRANSFORMS: dict[str, Callable] = {}


def transform(name: str):
    def add(fn):
        TRANSFORMS[name] = fn
        return fn

    return add


def transform_chain(df: DataFrame, steps: Sequence[Mapping], extra: Mapping[str, Callable] | None = None) -> DataFrame:
    """Apply ``{"name": ..., "args": {...}}`` steps in order; ``extra`` adds user functions."""
    known = {**TRANSFORMS, **(extra or {})}
    for step in steps:
        if step["name"] not in known:
            raise KeyError(f"unknown transform {step['name']!r}")
        df = df.transform(known[step["name"]], **step.get("args", {}))
    return df


@transform("expression")
def expression(df: DataFrame, expression: str, result: str, **names: str) -> DataFrame:
    """A column from SQL text; ``{placeholders}`` take column names."""
    return df.withColumn(result, F.expr(expression.format(**names)))


@transform("prefix_columns")
def prefix_columns(df: DataFrame, columns: Sequence[str], text: str = "target__") -> DataFrame:
    return df.withColumnsRenamed({c: f"{text}{c}" for c in columns})


@transform("hash_sample")
def hash_sample(df: DataFrame, id_col: str, frac: float, seed: int = 0) -> DataFrame:
    """Reproducible row sample: rows whose hash falls below ``frac``."""
    return df.where(uniform(F.col(id_col), seed) < F.lit(frac))


def fit_labels(df: DataFrame, column: str, order: str) -> DataFrame:
    """(value, label): labels 0, 1, ... in order of first appearance."""
    seen = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first"))
    return prefix(seen, [], ["_first", column], pos="_pos").select(column, (F.col("_pos") - 1).alias("label"))


@transform("label_encode")
def label_encode(df: DataFrame, column: str, labels: DataFrame, result: str | None = None) -> DataFrame:
    """Replace values by labels; null and unseen values become null."""
    out = df.join(labels.withColumnRenamed("label", "_label"), column, "left")
    return out.withColumn(result or column, F.col("_label")).drop("_label")


def fit_target_means(df: DataFrame, column: str, target: str) -> DataFrame:
    """(value, total, n) of the target per category."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.sum(target).alias("_total"), F.count(target).alias("_n"))
    )


@transform("loo_encode")
def loo_encode(
    df: DataFrame, column: str, target: str, result: str, fitted: DataFrame | None = None, train: bool = True
) -> DataFrame:
    """Mean target of the category: without the row itself on training rows, whole otherwise.

    Unknown or missing categories and categories of one row get the global mean.
    """
    means = fit_target_means(df, column, target) if fitted is None else fitted
    if fitted is None:
        everything = scalar(df.agg(F.avg(target).alias("m")), "m")
    else:
        everything = scalar(fitted.agg((F.sum("_total") / F.sum("_n")).alias("m")), "m")
    joined = join_on_keys(df, means, [column], "left")
    if train:
        value = F.when(F.col("_n") > 1, (F.col("_total") - F.col(target)) / (F.col("_n") - 1))
    else:
        value = F.col("_total") / F.col("_n")
    return joined.withColumn(result, F.coalesce(value, everything)).drop("_total", "_n")
