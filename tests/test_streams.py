import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import sequential
from tessera.streaming import jobs, keyed


def test_stream_equals_batch_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    rng = np.random.default_rng(8)
    n = 600
    pdf = pd.DataFrame(
        {
            "key": rng.choice(np.array(["a", "b", "c", None], dtype=object), n, p=[0.5, 0.3, 0.1, 0.1]),
            "grp": rng.choice(["pilot", "control"], n),
            "time": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="min"),
            "tie": np.arange(n),
            "value": rng.normal(size=n),
        }
    )
    df = spark.createDataFrame(pdf).withColumn("time", F.col("time").cast("timestamp_ntz"))
    null, alternative = sequential.normal(0, 1.4), sequential.normal(0.3, 1.4)
    job = jobs.SequentialStream(spark, str(tmp_path / "state"), "pilot", "control", null, alternative)
    assert job.decisions().count() == 0
    for i, (lo, hi) in enumerate([(0, 50), (50, 400), (400, 600)]):
        # a new object each time: nothing may live in the driver
        job = jobs.SequentialStream(spark, str(tmp_path / "state"), "pilot", "control", null, alternative)
        part = df.where(f"tie >= {lo} AND tie < {hi}")
        job.each(part, i)
        job.each(part, i)
    got = {r.key: (r.result, r.length) for r in job.decisions().collect()}
    batch = sequential.wald(df, ["key"], "grp", ["time", "tie"], "value", "pilot", "control", null, alternative)
    assert got == {r.key: (r.result, r.length) for r in batch.collect()}


def test_price_loop_keeps_known_answers(spark, tmp_path):
    price = lambda batch, history: batch.withColumn("price", F.lit(5.0)).select("id", "sku", "price")
    feedback = lambda answered: answered.select("id", F.lit(1.0).alias("bought"))
    loop = jobs.PriceLoop(spark, str(tmp_path), price, feedback)
    assert loop.history().count() == 0
    rows = spark.range(10).select("id", (F.col("id") % 3).alias("sku"))
    loop.each(rows.where("id < 6"), 0)
    loop = jobs.PriceLoop(spark, str(tmp_path), price, feedback)
    loop.each(rows.where("id >= 6"), 1)
    loop.each(rows.where("id >= 6"), 1)
    assert loop.history(1).count() == 6 and loop.history().count() == 10
    assert loop.history().where("bought = 1").count() == 10


def test_keyed_state_goes_on_after_a_restart(spark, tmp_path):
    rng = np.random.default_rng(9)
    n = 900
    pdf = pd.DataFrame(
        {
            "key": rng.choice(np.array(["a", "b", "c", "never", None], dtype=object), n),
            "grp": rng.choice(["pilot", "control", "other"], n, p=[0.5, 0.4, 0.1]),
            "time": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) // 3, unit="min"),
            "tie": np.arange(n),
            "value": rng.normal(size=n) + 0.2,
        }
    )
    pdf.loc[pdf["key"] == "never", "grp"] = "pilot"
    df = spark.createDataFrame(pdf).withColumn("time", F.col("time").cast("timestamp_ntz"))
    for lo, hi in [(0, 40), (40, 45), (45, 500), (500, 900)]:
        df.where(f"tie >= {lo} AND tie < {hi}").repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        # a new query and new objects each time: all there is lies in the checkpoint and the folder
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        updates = keyed.sequential_updates(stream, "pilot", "control", sequential.normal_array(0, 1.4), sequential.normal_array(0.5, 1.4))
        decisions = keyed.sequential_decisions(spark, str(tmp_path / "out"))
        decisions.run_available(updates, str(tmp_path / "checkpoint"))
    got = {r.key: (r.result, r.length) for r in decisions.latest().collect()}
    null, alternative = sequential.normal(0, 1.4), sequential.normal(0.5, 1.4)
    batch = sequential.wald(df, ["key"], "grp", ["time", "tie"], "value", "pilot", "control", null, alternative)
    assert got == {r.key: (r.result, r.length) for r in batch.collect()} | {"never": (0.5, 0)}
    assert any(result != 0.5 for result, _ in got.values())
    # decided keys have told nothing since
    last = spark.read.parquet(str(tmp_path / "out" / "updates")).groupBy("key").agg(F.count_if(F.col("result") != 0.5).alias("n"))
    assert {r.n for r in last.collect()} <= {0, 1}


def test_daily_stream_tells_finished_days_once_and_counts_late_rows(spark, tmp_path):
    def arrive(rows):
        schema = "ts string, sale string, cost double"
        made = spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(made.schema).parquet(str(tmp_path / "in"))
        days = keyed.daily_sales(stream, "cost", "ts", "sale", "2 hours")
        return keyed.append_available(days, str(tmp_path / "out"), str(tmp_path / "checkpoint"))

    def told():
        rows = spark.read.parquet(str(tmp_path / "out")).orderBy("day").collect()
        return [(str(r.day), *(round(x, 6) for x in r[1:])) for r in rows]

    assert keyed.late_rows(arrive([("2024-01-01 10:00", "a", 2.0), ("2024-01-01 11:00", "a", 4.0), ("2024-01-01 12:00", None, 1.0)])) == 0
    assert told() == []
    # an hour past midnight the day is still open, also to a row of its own
    assert keyed.late_rows(arrive([("2024-01-02 01:00", "b", 5.0)])) == 0
    assert keyed.late_rows(arrive([("2024-01-01 23:00", "c", 3.0)])) == 0
    assert told() == []
    arrive([("2024-01-02 03:00", "b", 1.0), ("2024-01-02 04:00", "d", None)])
    assert told() == [("2024-01-01", 10.0, 2.0, 4.5, 1.5)]
    assert keyed.late_rows(arrive([("2024-01-01 09:00", "a", 100.0), ("2024-01-03 09:00", "e", 1.0)])) == 1
    assert told() == [("2024-01-01", 10.0, 2.0, 4.5, 1.5), ("2024-01-02", 6.0, 2.0, 3.0, 1.0)]
