from pyspark.sql import functions as F

from siftwork.streaming import jobs


def test_a_resumed_run_does_nothing_twice(spark, tmp_path):
    shape = "id long, ts timestamp"
    df = spark.range(6).select("id", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("ts"))
    src, out, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    for part in (df.where("id < 3"), df.where("id >= 3")):
        part.coalesce(1).write.mode("append").parquet(src)
        jobs.run_once(jobs.read_folder(spark, src, shape), lambda b, _: b.write.mode("append").parquet(out), log)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(6))


def test_late_rows_are_dropped_from_windows(spark, tmp_path):
    src, out, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    rows = [("2024-01-01 00:10:00",), ("2024-01-01 05:00:00",)], [("2024-01-01 00:20:00",), ("2024-01-01 09:00:00",)]
    for part in rows:
        spark.createDataFrame(part, "t string").select(F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(src)
        jobs.run_once(jobs.window_counts(jobs.read_folder(spark, src, "ts timestamp"), "ts", "1 hour", "30 minutes", []), lambda b, _: b.write.mode("append").parquet(out), log)
    assert {(r.start.hour, r.n) for r in spark.read.parquet(out).collect()} == {(0, 1), (5, 1)}
