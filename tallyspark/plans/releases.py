"""Ordered datasets, entries of files and verification bundles: written from the tables, read back and judged."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import evidence as E
from tallyspark.plans.registry import query
from tallyspark.sources import releases as R
from tallyspark.sources.sinks import scratch
from tallyspark.sources.tables import table


@query("SELECT l_suppkey % 20 AS shard, count(*) AS rows, count(*) AS source_rows, true AS same, true AS in_order FROM lineitem GROUP BY 1")
def ordered_concat(spark, d):
    """Shards of lines as one ordered dataset: each shard's rows are those of its source, and files and row groups follow the
    shards by what their footers say."""
    lines = table(spark, d, "lineitem").select((F.col("l_suppkey") % 20).alias("shard"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    at = scratch(spark, "ordered")
    R.write_ordered(lines, ["shard", "l_orderkey", "l_linenumber", "l_partkey"], at, 20_000)
    foot = R.footers(spark, at, ["shard"])
    order = R.groups_out_of_order(foot, "shard").agg((F.count("*") == 0).alias("ordered")).join(foot.agg(F.count_if(F.col("row_group").isNull()).alias("broken")))
    in_order = order.select((F.col("ordered") & (F.col("broken") == 0)).alias("in_order"))
    return R.survived(spark.read.parquet(at), lines, ["shard"]).join(F.broadcast(in_order))


def _lines(spark, d, last):
    """Lines in files by order and place; `last` is the column that moves rows within their order."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    at = scratch(spark, "lines")
    R.write_ordered(lines.withColumn("place", last), ["l_orderkey", "place"], at, 3_000)
    return R.placed(spark, at)


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, 2::BIGINT AS before FROM l WHERE l_orderkey % 31 = 5 AND l_linenumber = 1 AND l_orderkey IN (SELECT l_orderkey FROM l WHERE l_linenumber = 2)""")
def rows_out_of_place(spark, d):
    """Rows below the row before them in their files; the first two lines of some orders were written the other way round."""
    n = F.col("l_linenumber")
    rows = _lines(spark, d, F.when((F.col("l_orderkey") % 31 == 5) & (n <= 2), 3 - n).otherwise(n))
    return R.out_of_place(rows, ["l_orderkey", "l_linenumber"], 500).select("l_orderkey", n.cast("long").alias("l_linenumber"), F.col("_before.l_linenumber").cast("long").alias("before"))


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), s AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS k FROM l) SELECT l_orderkey, 3::BIGINT AS serial, 2::BIGINT AS due FROM s WHERE l_orderkey % 29 = 7 AND k = 2""")
def serials_in_file_order(spark, d):
    """Serials that don't follow the row before them in their files; some orders leave out their second number."""
    from pyspark.sql import Window as W

    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    k = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber"))
    lines = lines.withColumn("serial", (k + F.when((F.col("l_orderkey") % 29 == 7) & (k > 1), 1).otherwise(0)).cast("long"))
    at = scratch(spark, "serials")
    R.write_ordered(lines, ["l_orderkey", "l_linenumber"], at, 3_000)
    return R.serial_breaks(R.placed(spark, at), ["l_orderkey"], "serial", 500).select("l_orderkey", "serial", F.col("due").cast("long").alias("due"))


@query("""SELECT DISTINCT s_nationkey AS shard, CASE s_nationkey % 5 WHEN 1 THEN 'bytes differ' WHEN 2 THEN 'sha256 differ' WHEN 3 THEN 'rows differ' WHEN 4 THEN 'unexpected file' END AS invariant FROM supplier WHERE s_nationkey % 5 > 0 UNION ALL SELECT 99, 'missing file'""")
def files_against_manifest(spark, d):
    """Suppliers in a folder for each nation, their files' entries published, and the files held against a manifest in which
    sizes, hashes, rows and files of four nations in five are wrong."""
    at = scratch(spark, "shards")
    table(spark, d, "supplier").withColumn("shard", F.col("s_nationkey")).repartition("shard").write.partitionBy("shard").parquet(at)
    R.publish(R.entries_of(spark, at), f"{at}-manifest")
    shard = F.regexp_extract("file", "shard=(\\d+)", 1).cast("int")
    kept, k = R.published(spark, f"{at}-manifest"), shard % 5
    wrong = kept.filter(k != 4).withColumns({"bytes": F.when(k == 1, F.col("bytes") + 1).otherwise(F.col("bytes")), "rows": F.when(k == 3, F.col("rows") + 1).otherwise(F.col("rows")), "sha256": F.when(k == 2, F.reverse("sha256")).otherwise(F.col("sha256"))})
    gone = kept.limit(1).withColumn("file", F.lit("shard=99/part-0"))
    return R.audit(kept, wrong.unionByName(gone)).select(F.regexp_extract("key", "shard=(\\d+)", 1).cast("int").alias("shard"), "invariant").distinct()


_EVIDENCE = """
r AS (SELECT l_suppkey % 25 AS s, l_orderkey % 40 AS p, l_linestatus = 'F' AS m, l_returnflag = 'R' AS x FROM lineitem),
c AS (SELECT s, p, count(*) AS n, count(*) FILTER (m) AS main, count(*) FILTER (NOT m) AS addition, count(*) FILTER (x) AS deleted FROM r GROUP BY 1, 2),
e AS (SELECT *, CASE WHEN p % 3 <> 0 THEN main + CASE WHEN p % 7 = 0 THEN 1 WHEN p % 11 = 0 THEN 9 ELSE 0 END END AS printed, CASE WHEN p % 4 <> 1 THEN n - deleted END AS net,
 CASE WHEN s % 5 = 1 AND p = 3 THEN NULL WHEN s % 5 = 2 AND p % 13 = 5 THEN n + 1 ELSE n END AS boxes FROM c)
"""


@query(f"""WITH {_EVIDENCE}
 SELECT 'part without boxes' AS invariant, s || '/' || p AS key, '' AS detail FROM e WHERE boxes IS NULL
 UNION ALL SELECT 'boxes differ from rows', s || '/' || p, boxes || ' for ' || n FROM e WHERE boxes <> n
 UNION ALL SELECT 'printed total of an unknown part', s || '/77', '' FROM (SELECT DISTINCT s FROM e WHERE s % 5 = 3)
 UNION ALL SELECT 'invalid printed total', s || '/' || p, printed::VARCHAR FROM e WHERE printed <= 0
 UNION ALL SELECT 'parts_measured', s::VARCHAR, (k + 1) || ' for ' || k FROM (SELECT s, count(*) FILTER (abs(main - printed) <= 2) AS k FROM e WHERE s % 5 = 4 GROUP BY 1)
 UNION ALL SELECT 'missing bundle', s::VARCHAR, '' FROM (SELECT DISTINCT s FROM e WHERE s = 10) UNION ALL SELECT 'unreadable bundle', s::VARCHAR, '' FROM (SELECT DISTINCT s FROM e WHERE s = 20)""")
def evidence_violations(spark, d):
    """Bundles of shards against their rows: boxes must cover the parts, printed totals stay within them, and the figures that
    an entry keeps come out again."""
    c = F.col
    rows = table(spark, d, "lineitem").select((c("l_suppkey") % 25).alias("s"), (c("l_orderkey") % 40).alias("p"), (c("l_linestatus") == "F").alias("m"), (c("l_returnflag") == "R").alias("x"))
    parts = rows.groupBy("s", "p").agg(F.count("*").alias("n"), F.count_if("m").alias("main"), F.count_if(~c("m")).alias("addition"), F.count_if("x").alias("deleted"))
    parts = parts.withColumns({"printed": F.when(c("p") % 3 != 0, c("main") + F.when(c("p") % 7 == 0, 1).when(c("p") % 11 == 0, 9).otherwise(0)), "net": F.when(c("p") % 4 != 1, c("n") - c("deleted"))})
    parts = parts.withColumn("boxes", F.when((c("s") % 5 == 1) & (c("p") == 3), None).when((c("s") % 5 == 2) & (c("p") % 13 == 5), c("n") + 1).otherwise(c("n")))
    none = F.lit(None).cast("long")
    stray = parts.filter("s % 5 = 3").select("s").distinct().select("s", F.lit(77).cast("long").alias("p"), F.lit(0).cast("long").alias("n"), none.alias("boxes"), F.lit(5).cast("long").alias("printed"), none.alias("net"))
    documents = E.bundles(parts.select("s", "p", "n", "boxes", "printed", "net").unionByName(stray), "s", "p", "boxes", "printed", "net", "n")
    documents = documents.filter("s <> 10").withColumn("doc", F.when(c("s") == 20, F.substring("doc", 1, 30)).otherwise(c("doc")))
    entries = E.residuals_of(parts, "s", "main", "addition", "deleted", "printed", "net").withColumn("parts_measured", c("parts_measured") + F.when(c("s") % 5 == 4, 1).otherwise(0))
    return E.judge(rows, documents, entries, parts.select("s", "p", "net"), "s", "p", c("m"), ~c("m"), c("x"), "net")
