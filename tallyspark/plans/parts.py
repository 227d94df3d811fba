"""Part tables over orders, listings of pages, failures and pairings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import canonical, match, parts
from tallyspark.plans.canonical import _noisy
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table


@query("""WITH r AS (SELECT l_orderkey AS k, count(*) AS extracted, count(*) FILTER (l_returnflag = 'N') AS main, count(*) FILTER (l_linestatus = 'F') AS male FROM lineitem GROUP BY 1), t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 6 END AS total FROM orders WHERE o_orderkey % 5 <> 0), c AS (SELECT o_orderkey AS k, 4::BIGINT AS closing FROM orders WHERE o_orderkey % 8 <> 0)
 SELECT k, extracted, main, male, total, closing, extracted - coalesce(total, closing) AS gap, extracted = coalesce(total, closing) AS matches FROM r LEFT JOIN t USING (k) LEFT JOIN c USING (k)""")
def part_checks(spark, d):
    k, c = F.col("k"), F.col
    o = table(spark, d, "orders").select(c("o_orderkey").alias("k"))
    totals = o.filter(k % 5 != 0).withColumn("total", F.when(k % 4 != 0, k % 6))
    closing = o.filter(k % 8 != 0).withColumn("closing", F.lit(4).cast("long"))
    counts = {"extracted": F.lit(True), "main": c("l_returnflag") == "N", "male": c("l_linestatus") == "F"}
    return parts.part_checks(table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "k"), totals, closing, ["k"], counts, "total", "closing")


@query("""WITH a AS (SELECT avg((quality IS NOT NULL)::INT) AS labelled, avg((length(text) > 500)::INT) AS long, count(DISTINCT text) / count(*) FILTER (trim(text) <> '') AS ids FROM documents LEFT JOIN labels USING (doc_id))
 SELECT unnest(['labelled', 'long', 'distinct_ids']) AS metric, unnest([labelled, long, ids]) AS value FROM a""")
def field_report(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return parts.field_report(rows, {"labelled": F.col("quality").isNotNull(), "long": F.length("text") > 500}, "text")


@query("SELECT length(html)::BIGINT AS size, '2026-01-01T00:00:00Z' AS stamp, url FROM pages WHERE page_id % 7 <> 0 AND NOT regexp_matches(url, '\\s')")
def object_listing(spark, d):
    size = F.length("html").cast("string")
    lines = F.when(F.col("page_id") % 7 == 0, "TOTAL: 9 objects").otherwise(F.concat_ws("  ", size, F.lit("2026-01-01T00:00:00Z"), "url"))
    return parts.listing(table(spark, d, "pages").select(lines.alias("line")), "line")


@query("""SELECT c_custkey, n, CASE WHEN n IS NULL THEN 'no_orders' ELSE '' END AS flags FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def failures_kept(spark, d):
    done = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return parts.with_failures(done, table(spark, d, "customer"), ["c_custkey"], "no_orders")


@query("""WITH l AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'user'), r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'assistant')
 SELECT l.conv_id, l.turn, r.turn AS r_turn FROM l JOIN r ON l.conv_id = r.conv_id AND l.k = r.k""")
def zipped_rows(spark, d):
    c = table(spark, d, "conversations")
    return parts.zip_join(c.filter("role = 'user'").select("conv_id", "turn"), c.filter("role = 'assistant'").select("conv_id", "turn"), ["conv_id"], ["turn"])


@query("""WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n, median(l_quantity) AS m FROM lineitem GROUP BY ALL) SELECT l_suppkey, l_returnflag, n / t AS share, trunc(m)::INTEGER AS middle FROM (SELECT *, sum(n) OVER (PARTITION BY l_suppkey) AS t, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS k FROM c) WHERE k = 1""")
def modal_labels(spark, d):
    return parts.modal_label(table(spark, d, "lineitem"), ["l_suppkey"], "l_returnflag", "l_quantity")


@query("SELECT n_name, array_to_string(list_sort(list_distinct(list(c_mktsegment))), ',') AS segments FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 2 GROUP BY 1")
def gazetteer(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation").filter("n_regionkey = 2"), F.col("n_nationkey") == F.col("c_nationkey"))
    return parts.grouped_lists(rows, ["n_name"], ["c_mktsegment"]).select("n_name", F.array_join("c_mktsegment", ",").alias("segments"))


@query()
def substitutions(spark, d):
    """What the canonical values change, the most frequent first."""
    return canonical.substitutions(canonical.dominant(canonical.clusters(_noisy(spark, d), "field", "p_brand", "value"), []))


@query()
def match_calibration(spark, d):
    """How often an accepted match is the part's own name, for names with a letter too many."""
    part = table(spark, d, "part")
    targets = part.select("p_brand", F.concat("p_name", F.lit("s")).alias("target"))
    truth = part.select("p_brand", F.concat("p_name", F.lit("s")).alias("target"), F.col("p_name").alias("known")).distinct()
    return match.calibrate(match.scoped_best(targets, part.select("p_brand", F.col("p_name").alias("candidate")), ["p_brand"]), truth, ["p_brand", "target"])
