"""Ordinary relational coverage on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

_REV = "l_extendedprice * (1 - l_discount)"


def _revenue():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


@query(f"SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum({_REV}), 2) AS revenue, round(avg(l_discount), 9) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(spark, d):
    li = table(spark, d, "lineitem").filter("l_shipdate <= timestamp '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(_revenue()), 2).alias("revenue"), F.round(F.avg("l_discount"), 9).alias("avg_disc"), F.count("*").alias("n"))


@query(f"""SELECT n_name, round(sum({_REV}), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA' GROUP BY 1""")
def local_supplier_volume(spark, d):
    t = lambda n: table(spark, d, n)
    j = t("region").filter("r_name = 'ASIA'").join(t("nation"), F.col("r_regionkey") == F.col("n_regionkey")).join(t("supplier"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("lineitem"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    j = j.join(t("customer"), (F.col("c_custkey") == F.col("o_custkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    return j.groupBy("n_name").agg(F.round(F.sum(_revenue()), 2).alias("revenue"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45) GROUP BY 1")
def semi_join(spark, d):
    big = table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").join(big, "o_orderkey", "left_semi").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_join(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_counts(spark, d):
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ROLLUP (p_brand, p_type)")
def rollup_counts(spark, d):
    return table(spark, d, "part").rollup("p_brand", "p_type").agg(F.count("*").alias("n"))


@query("SELECT o_custkey AS k FROM orders INTERSECT ALL SELECT c_custkey FROM customer")
def intersect_all(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("k")).intersectAll(table(spark, d, "customer").select("c_custkey"))


@query("SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer")
def except_all(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("k")).exceptAll(table(spark, d, "customer").select("c_custkey"))


@query("SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS k FROM part) WHERE k <= 3")
def top_k_per_group(spark, d):
    w = W.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return table(spark, d, "part").withColumn("k", F.row_number().over(w)).filter("k <= 3").select("p_brand", "p_partkey", "p_retailprice")


@query("SELECT o_custkey, o_orderkey, lag(o_totalprice) OVER w AS before, lead(o_totalprice) OVER w AS after, ntile(4) OVER w AS quarter, round(percent_rank() OVER w, 9) AS place, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS status_rank FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def ranking_family(spark, d):
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.lag("o_totalprice").over(w).alias("before"), F.lead("o_totalprice").over(w).alias("after"), F.ntile(4).over(w).cast("long").alias("quarter"), F.round(F.percent_rank().over(w), 9).alias("place"), F.dense_rank().over(W.partitionBy("o_custkey").orderBy("o_orderstatus")).cast("long").alias("status_rank"))


@query("SELECT event_id, (SELECT max(e2.ts) FROM events e2 WHERE e2.user_id = e.user_id AND e2.event_type = 'purchase' AND e2.ts <= e.ts) AS last_purchase FROM events e WHERE event_type = 'view'")
def as_of_join(spark, d):
    """Each view with its user's last purchase, as one window over the events instead of a range join."""
    w = W.partitionBy("user_id").orderBy("ts").rangeBetween(W.unboundedPreceding, W.currentRow)
    events = table(spark, d, "events").withColumn("last_purchase", F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).over(w))
    return events.filter("event_type = 'view'").select("event_id", "last_purchase")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_windows(spark, d):
    return table(spark, d, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


@query("SELECT c_mktsegment, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def pivot_status(spark, d):
    j = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    return j.groupBy("c_mktsegment").pivot("o_orderstatus", ["F", "O"]).count().na.fill(0)
