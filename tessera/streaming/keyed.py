"""Streams whose state Spark keeps by key: the sequential test and daily sales with a watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.operators.sequential import bounds
from tessera.streaming.jobs import _stored

#: A log-density of an array of differences.
ArrayDensity = Callable[[np.ndarray], np.ndarray]

_STATE = "used bigint, z double, result double, length bigint, pilot binary, control binary"
_UPDATE = "key string, used bigint, z double, result double, length bigint"


def sequential_updates(
    stream: DataFrame, pilot: str, control: str, null: ArrayDensity, alternative: ArrayDensity, alpha: float = 0.05, beta: float = 0.2
) -> DataFrame:
    """(key, used, z, result, length) of each experiment that a batch has moved, in update mode.

    ``stream`` holds key, grp, time, tie and value. The state of a key is the number of pairs
    used, the path's value, the decision and the values that wait for a partner, in the
    order of (time, tie) within a batch. A decision stays: from then on the key's rows are
    passed over, nothing waits any more and no update comes. Until then one side's surplus
    waits, so groups should be of like size. Rows of other groups and null values are left
    out. The path of a key is one sequence of steps and runs in one task;
    :class:`tessera.streaming.jobs.SequentialStream` spreads a single huge key instead.
    """
    lower, upper = bounds(alpha, beta)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        used, z, result, length, *waiting = state.get if state.exists else (0, 0.0, 0.5, 0, b"", b"")
        if result != 0.5:
            return
        rows = pd.concat(list(batches)).sort_values(["time", "tie"], kind="stable")
        sides = [
            np.concatenate([np.frombuffer(old, dtype="<f8"), rows.loc[(rows["grp"] == who) & rows["value"].notna(), "value"].to_numpy("<f8")])
            for who, old in zip((pilot, control), waiting)
        ]
        n = min(map(len, sides))
        d = sides[0][:n] - sides[1][:n]
        path = z + np.cumsum(alternative(d) - null(d))
        out = np.flatnonzero((path < lower) | (path > upper))
        if len(out):
            result, length = (0.0 if path[out[0]] < lower else 1.0), used + int(out[0]) + 1
            sides = [side[:0] for side in sides]
        else:
            length, sides = used + n, [side[n:] for side in sides]
        used, z = used + n, float(path[-1]) if n else z
        state.update((used, z, result, length, *(side.tobytes() for side in sides)))
        yield pd.DataFrame({"key": [key[0]], "used": [used], "z": [z], "result": [result], "length": [length]})

    rows = stream.select("key", "grp", "time", "tie", F.col("value").cast("double").alias("value"))
    return rows.groupBy("key").applyInPandasWithState(step, _UPDATE, _STATE, "update", GroupStateTimeout.NoTimeout)


class Updates:
    """What an update-mode stream has said last about each key, kept by batch.

    A batch writes its own folder, so that one run again changes nothing; a new object on the
    same folder and checkpoint goes on where the old one stopped.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str = "key"):
        self.spark, self.folder, self.schema, self.key = spark, folder.rstrip("/"), schema, key

    def run_available(self, updates: DataFrame, checkpoint: str) -> StreamingQuery:
        """Process everything that has arrived, then stop."""

        def each(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.folder}/updates/batch={number}")

        writer = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).foreachBatch(each).start()
        query.awaitTermination()
        return query

    def latest(self) -> DataFrame:
        rows = _stored(self.spark, f"{self.folder}/updates", f"{self.schema}, batch bigint")
        last = F.max_by(F.struct(*[F.col(c) for c in rows.columns if c not in (self.key, "batch")]), "batch").alias("_last")
        return rows.groupBy(self.key).agg(last).select(self.key, "_last.*")


def sequential_decisions(spark: SparkSession, folder: str) -> Updates:
    """The decisions of :func:`sequential_updates`."""
    return Updates(spark, folder, _UPDATE)


def daily_sales(stream: DataFrame, cost: str, time: str, sale_id: str, delay: str) -> DataFrame:
    """(day, revenue, number_purchases, average_check, average_number_items) of finished days, in append mode.

    A day is finished, and told once, when the latest time seen is more than ``delay`` past its
    end; rows that come later than that are left out and counted, see :func:`late_rows`.
    Lines are summed per (day, sale) first, which makes the distinct sales a plain count. State
    is one row for each sale of an open day. Days without sales don't appear; rows without
    a sale add to the revenue alone.
    """
    rows = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    checks = rows.groupBy(F.window("_time", "1 day").alias("_day"), F.col(sale_id).alias("_sale")).agg(
        F.sum(cost).alias("_check"), F.count(cost).alias("_items")
    )
    known = F.col("_sale").isNotNull()
    days = checks.groupBy(F.window(F.window_time("_day"), "1 day").alias("_day")).agg(
        F.sum("_check").alias("revenue"),
        F.count("_sale").cast("double").alias("number_purchases"),
        F.avg(F.when(known, F.coalesce("_check", F.lit(0.0)))).alias("average_check"),
        F.avg(F.when(known, F.col("_items"))).alias("average_number_items"),
    )
    metrics = ["revenue", "number_purchases", "average_check", "average_number_items"]
    return days.select(F.to_date("_day.start").alias("day"), *[F.coalesce(m, F.lit(0.0)).alias(m) for m in metrics])


def late_rows(query: StreamingQuery) -> int:
    """(day, sale) groups of rows that came too late, over the batches that the query still remembers.

    Spark sums a batch's late rows per group in each task before it drops them.
    """
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's finished rows to Parquet files at ``path``, each exactly once, then stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
