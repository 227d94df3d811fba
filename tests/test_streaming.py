from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.streaming import pulls


def test_windows_and_pulls(spark, tmp_path):
    rows = [(1, "a", 0), (1, "a", 0), (2, "a", 3600), (3, "b", 90000), (4, "b", 900000)]
    df = spark.createDataFrame(rows, "i int, k string, s long").withColumn("t", F.timestamp_seconds(F.col("s") + 1000000))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    once = pulls.pull_once(spark, str(tmp_path / "in"), df.schema, ["i", "k"], "t")
    assert sorted(r.i for r in pulls.run_available(once, "once").collect()) == [1, 2, 3, 4]
    counts = pulls.windowed_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "t", "k")
    got = {(r.k, r.n) for r in pulls.run_available(counts, "counts", "complete").collect()}
    assert got == {("a", 3), ("b", 1)}


def test_takeover(spark, tmp_path):
    rows = [("x", "h1", 0), ("x", "h2", 600), ("x", "h2", 4000), ("y", "h1", 0)]
    df = spark.createDataFrame(rows, "k string, host string, s long").withColumn("t", F.timestamp_seconds(F.col("s") + 1000000))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = pulls.heartbeat_owners(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "k", "host", "t")
    got = {r.k: (r.owner, r.takeovers) for r in pulls.run_available(out, "owners", "update").collect()}
    assert got == {"x": ("h2", 1), "y": ("h1", 0)}
