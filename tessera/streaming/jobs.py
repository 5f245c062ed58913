"""Incremental forms of the sequential test, bandit statistics, assignment and pricing.

State that must be exact across batches lives in tables beside the stream's checkpoint:
batch n reads what the batches before it wrote and writes its own, so a batch that is run
again after a failure gives the same result. Nothing is kept in the driver: a new object on
the same folder goes on where the old one stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sequential import LogDensity, bounds
from tessera.operators.slots import assign
from tessera.plans.prefix import join_on_keys, prefix


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything that has arrived, batch by batch, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    query.awaitTermination()


class Versions:
    """The state after the last two batches: batch n replaces batch n-2.

    A batch that fails while it writes leaves the version it read from untouched.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _slot(self, name: str, batch: int) -> str:
        return f"{self.folder}/{name}/{batch % 2}"

    def write(self, name: str, batch: int, df: DataFrame) -> None:
        df.withColumn("_batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(self._slot(name, batch))

    def read(self, name: str, batch: int, schema: str) -> DataFrame:
        """The version batch ``batch`` wrote; before the first batch an empty table."""
        if batch < 0:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(f"{schema}, _batch bigint").parquet(self._slot(name, batch))
        return stored.where(F.col("_batch") == batch).drop("_batch")

    def latest(self, name: str, schema: str) -> DataFrame:
        """The newest version with rows, found in storage; an empty table if there is none."""
        stored = _stored(self.spark, f"{self.folder}/{name}/*", f"{schema}, _batch bigint")
        newest = stored.agg(F.max("_batch").alias("n")).scalar()
        return stored.where(F.col("_batch") == newest).drop("_batch")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What lies under ``path``; an empty table before anything was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class SequentialStream:
    """Sequential test on arriving observations; a decision, once taken, stays.

    Per batch the new rows join the rows still waiting for a partner, get ranks that go on
    from the pairs already used, and extend the log-likelihood path with the distributed
    running sum. Carried per experiment: pairs used, path value, decision and its length.
    """

    STATE = "key string, used bigint, z double, result double, length bigint"
    WAITING = "key string, grp string, time timestamp_ntz, tie bigint, value double"

    def __init__(self, spark, folder: str, pilot: str, control: str, null: LogDensity, alternative: LogDensity, alpha=0.05, beta=0.2):
        self.versions = Versions(spark, folder)
        self.pilot, self.control, self.null, self.alternative = pilot, control, null, alternative
        self.lower, self.upper = bounds(alpha, beta)

    def each(self, batch: DataFrame, number: int) -> None:
        state = self.versions.read("state", number - 1, self.STATE)
        waiting = self.versions.read("waiting", number - 1, self.WAITING)
        rows = waiting.unionByName(batch.select("key", "grp", "time", "tie", "value"))
        ranked = prefix(rows, ["key", "grp"], ["time", "tie"], pos="i")
        of = lambda who, c: F.max(F.when(F.col("grp") == who, F.col(c)))
        sides = ranked.groupBy("key", "i").agg(of(self.pilot, "value").alias("a"), of(self.control, "value").alias("b"))
        d = F.col("a") - F.col("b")
        pairs = sides.where("a IS NOT NULL AND b IS NOT NULL").select(
            "key", "i", (self.alternative(d) - self.null(d)).alias("llr")
        )
        path = prefix(pairs, ["key"], ["i"], sums={"_z": F.col("llr")}, pos=None)
        carried = join_on_keys(path, state, ["key"], "left").select(
            "key",
            (F.col("i") + F.coalesce("used", F.lit(0))).alias("i"),
            (F.col("_z") + F.coalesce("z", F.lit(0.0))).alias("z"),
        )
        new = carried.groupBy("key").agg(
            F.max("i").alias("_used"),
            F.max_by("z", "i").alias("_z"),
            F.min(F.when(F.col("z") < self.lower, F.col("i"))).alias("lo"),
            F.min(F.when(F.col("z") > self.upper, F.col("i"))).alias("hi"),
        )
        # one row of each side per key, a null key included
        both = state.unionByName(new, allowMissingColumns=True).groupBy("key").agg(
            *[F.max(c).alias(c) for c in ("used", "z", "result", "length", "_used", "_z", "lo", "hi")]
        )
        lower_first = F.col("lo").isNotNull() & (F.col("hi").isNull() | (F.col("lo") < F.col("hi")))
        open_ = F.col("result").isNull() | (F.col("result") == 0.5)
        found = F.when(lower_first, 0.0).when(F.col("hi").isNotNull(), 1.0).otherwise(0.5)
        used = F.coalesce("_used", "used")
        at = F.when(lower_first, F.col("lo")).when(F.col("hi").isNotNull(), F.col("hi")).otherwise(used)
        after = both.select(
            "key",
            used.alias("used"),
            F.coalesce("_z", "z").alias("z"),
            F.when(open_, found).otherwise(F.col("result")).alias("result"),
            F.when(open_, at).otherwise(F.col("length")).alias("length"),
        )
        self.versions.write("state", number, after)
        matched = pairs.groupBy("key").agg(F.max("i").alias("_done"))
        left = join_on_keys(ranked, matched, ["key"], "left").where(F.col("i") > F.coalesce("_done", F.lit(0)))
        self.versions.write("waiting", number, left.select("key", "grp", "time", "tie", "value"))

    def decisions(self) -> DataFrame:
        return self.versions.latest("state", self.STATE)


def arm_stats_stream(stream: DataFrame, arm: str, reward: str) -> DataFrame:
    """Running statistics per arm as a streaming aggregate (complete or update mode)."""
    return stream.groupBy(arm).agg(
        F.count(F.lit(1)).alias("pulls"), F.sum(reward).alias("rewards"), F.avg(reward).alias("mean")
    )


def assign_stream(users: DataFrame, user: str, slots: DataFrame, count_slots: int, salt_slot: str, salt_group: str) -> DataFrame:
    """Slots and groups of arriving users: a stateless stream-static join."""
    return assign(users, user, slots, count_slots, salt_slot, salt_group)


class PriceLoop:
    """Price each request batch and keep what came back.

    A batch adds its own answers and its own feedback, ``<folder>/answers/batch=<n>`` and
    ``<folder>/feedback/batch=<n>``, and rewrites nothing older. The history joins them: the
    first feedback on an id counts. A batch sees the history of the batches before it.
    """

    def __init__(
        self, spark, folder: str, price: Callable[[DataFrame, DataFrame], DataFrame], feedback: Callable[[DataFrame], DataFrame], id_type="bigint"
    ):
        self.spark, self.folder, self.price, self.feedback = spark, folder.rstrip("/"), price, feedback
        self.answered = f"id {id_type}, sku bigint, price double"
        self.returned = f"id {id_type}, bought double"

    def each(self, batch: DataFrame, number: int) -> None:
        answers = f"{self.folder}/answers/batch={number}"
        self.price(batch, self.history(number)).select("id", "sku", "price").write.mode("overwrite").parquet(answers)
        written = self.spark.read.schema(self.answered).parquet(answers)
        known = self.feedback(written).where("bought IS NOT NULL").select("id", "bought")
        known.write.mode("overwrite").parquet(f"{self.folder}/feedback/batch={number}")

    def history(self, before: int | None = None) -> DataFrame:
        """(id, sku, price, bought) of all batches, or of those before a batch number."""

        def stored(name, schema):
            rows = _stored(self.spark, f"{self.folder}/{name}", f"{schema}, batch bigint")
            return rows if before is None else rows.where(F.col("batch") < before)

        first = stored("feedback", self.returned).groupBy("id").agg(F.min_by("bought", "batch").alias("bought"))
        return stored("answers", self.answered).join(first, "id", "left").select("id", "sku", "price", "bought")
