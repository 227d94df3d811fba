"""Streams over the tables: re-issued rows, leases that end by timer, sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.plans.registry import query
from tallyspark.sources.sinks import scratch
from tallyspark.sources.tables import table
from tallyspark.streaming import leases as L
from tallyspark.streaming import pulls, upserts


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 2 WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 7 = 0 THEN 3 WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS issue FROM orders""")
def reissued_rows(spark, d):
    """Orders issued up to three times and an outdated issue that comes last, streamed into a keyed dataset that is compacted
    in between: each key once, by its latest issue."""
    at, orders = scratch(spark, "issues"), table(spark, d, "orders")
    key = F.col("o_orderkey")
    issue = lambda keep, price, stamp: orders.filter(keep).select("o_orderkey", (F.col("o_totalprice") + price).alias("price"), F.lit(stamp).alias("issue"))
    first, second = [issue(F.lit(True), 0, 1), issue(key % 5 == 0, 1, 2)], [issue(key % 7 == 0, 2, 3), issue(key % 10 == 0, -100, 0)]
    for part in (first, second):
        for rows in part:
            rows.write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(first[0].schema).option("maxFilesPerTrigger", 4).parquet(f"{at}/in")
        upserts.upserted(stream, f"{at}/out", ["o_orderkey"], "issue", f"{at}/checkpoint").awaitTermination()
        upserts.compact(spark, f"{at}/out", ["o_orderkey"], "issue")
    return upserts.current(spark, f"{at}/out", ["o_orderkey"], "issue")


@query("""WITH e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events), n AS (SELECT *, CASE WHEN ms - lag(ms) OVER w <= 36000000 THEN 0 ELSE 1 END AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ms)),
 i AS (SELECT user_id, sum(s) OVER (PARTITION BY user_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS i, ms FROM n), l AS (SELECT user_id, i, min(ms) AS a, max(ms) + 36000000 AS b FROM i GROUP BY ALL), x AS (SELECT *, max(i) OVER (PARTITION BY user_id) AS last, (SELECT max(ms) - 60000 FROM e) AS mark FROM l)
 SELECT user_id, 'h' || user_id AS owner, 'claimed' AS event, a::BIGINT AS "at" FROM x UNION ALL SELECT user_id, 'h' || user_id, 'dropped', b::BIGINT FROM x WHERE i < last OR b <= mark""")
def leases(spark, d):
    """Users who hold themselves by an event every ten hours, and lose themselves by a timer where none comes."""
    own, at = L.with_timers(spark), scratch(spark, "leases")
    shape = table(spark, d, "events").schema
    beats = own.readStream.schema(shape).parquet(f"{d}/events.parquet*").select("user_id", F.concat(F.lit("h"), F.col("user_id").cast("string")).alias("host"), F.col("ts").cast("timestamp").alias("ts"))
    held = pulls.landed(L.lease_events(beats, "user_id", "host", "ts", 36_000), at)
    return spark.read.schema(held.schema).parquet(f"{at}/rows").select("user_id", "owner", "event", F.unix_millis("at").alias("at"))


@query("""WITH n AS (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), i AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM n),
 x AS (SELECT user_id, epoch_us(min(ts)) AS began, epoch_us(max(ts)) + 1800000000 AS ended, count(*) AS n FROM i GROUP BY user_id, i) SELECT user_id, began, ended, n FROM x WHERE ended <= (SELECT epoch_us(max(ts)) - 86400000000 FROM events)""")
def closed_sessions(spark, d):
    """Sessions of users that the watermark has passed: events at most half an hour apart."""
    shape = table(spark, d, "events").schema
    events = spark.readStream.schema(shape).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    out = pulls.landed(pulls.sessions(events, "ts", "user_id"), scratch(spark, "sessions"))
    return out.select("user_id", F.unix_micros("session_start").alias("began"), F.unix_micros("session_end").alias("ended"), "n")
