"""Geometry joins: parts as rectangles, lines as points, events as words."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import spatial as P
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

_POINTS = "pt AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pid, l_suppkey % 10 AS img, l_quantity AS x, l_discount * 500 AS y FROM lineitem)"
_RECTS = "rc AS (SELECT p_partkey AS ord, p_partkey % 10 AS img, (p_size % 40)::DOUBLE AS \"left\", (p_partkey % 37)::DOUBLE AS top, (p_size % 40 + 6)::DOUBLE AS \"right\", (p_partkey % 37 + 5)::DOUBLE AS bottom FROM part)"


def _points(spark, d):
    c = F.col
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return table(spark, d, "lineitem").select(F.struct(*keys).alias("pid"), (c("l_suppkey") % 10).alias("img"), c("l_quantity").alias("x"), (c("l_discount") * 500).alias("y"))


def _rects(spark, d):
    c = F.col
    left, top = (c("p_size") % 40).cast("double"), (c("p_partkey") % 37).cast("double")
    return table(spark, d, "part").select(c("p_partkey").alias("ord"), (c("p_partkey") % 10).alias("img"), left.alias("left"), top.alias("top"), (left + 6).alias("right"), (top + 5).alias("bottom"))


@query(f"WITH {_POINTS}, {_RECTS}, h AS (SELECT pid, ord, row_number() OVER (PARTITION BY pid ORDER BY ord) AS k FROM pt JOIN rc ON pt.img = rc.img AND x >= \"left\" AND x < \"right\" AND y >= top AND y < bottom) SELECT ord, count(*) AS n FROM h WHERE k = 1 GROUP BY 1")
def point_in_rect(spark, d):
    hits = P.point_in_rect(_points(spark, d), _rects(spark, d), ["img"], "x", "y", "ord", "pid", cell=8.0)
    return hits.groupBy("ord").agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT p_partkey AS id, p_partkey % 20 AS img, (p_size * 3)::DOUBLE AS top, (p_size * 3 + 4)::DOUBLE AS bottom FROM part), b AS (SELECT s_suppkey AS band, s_suppkey % 20 AS img, (s_suppkey % 50 * 3 + 1)::DOUBLE AS bt, (s_suppkey % 50 * 3 + 7)::DOUBLE AS bb FROM supplier)
 SELECT id, band, greatest(0, least(bottom, bb) - greatest(top, bt)) / (bottom - top) AS overlap FROM w JOIN b USING (img) WHERE greatest(0, least(bottom, bb) - greatest(top, bt)) / (bottom - top) >= 0.5""")
def band_overlap(spark, d):
    c = F.col
    words = table(spark, d, "part").select(c("p_partkey").alias("id"), (c("p_partkey") % 20).alias("img"), (c("p_size") * 3).cast("double").alias("top"), (c("p_size") * 3 + 4).cast("double").alias("bottom"))
    k = c("s_suppkey")
    bands = table(spark, d, "supplier").select(k.alias("band"), (k % 20).alias("img"), (k % 50 * 3 + 1).cast("double").alias("band_top"), (k % 50 * 3 + 7).cast("double").alias("band_bottom"))
    return P.band_overlap(words, bands, ["img"]).select("id", "band", "overlap")


@query(f"WITH {_RECTS}, n AS (SELECT *, row_number() OVER (PARTITION BY img ORDER BY ord) AS k FROM rc) SELECT a.img, a.ord AS id, b.ord AS other FROM n a JOIN n b ON a.img = b.img AND b.k - a.k BETWEEN 1 AND 3 AND a.\"left\" < b.\"right\" AND b.\"left\" < a.\"right\" AND a.top < b.bottom AND b.top < a.bottom")
def tile_overlap(spark, d):
    return P.neighbour_overlaps(_rects(spark, d).withColumnRenamed("ord", "id"), ["img"], ["id"]).select("img", "id", "other")


@query("""WITH e AS (SELECT s_suppkey, s_nationkey AS k, s_acctbal AS want FROM supplier), f AS (SELECT c_nationkey AS k, c_acctbal AS have FROM customer), m AS (SELECT k, want, min(abs(want - have)) AS g FROM e JOIN f USING (k) WHERE abs(want - have) <= 40 GROUP BY ALL)
 SELECT s_suppkey, e.want, min(have) AS have FROM e LEFT JOIN m ON e.k = m.k AND e.want = m.want LEFT JOIN f ON f.k = e.k AND abs(e.want - have) = g GROUP BY ALL""")
def nearest_within(spark, d):
    expected = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), F.col("s_acctbal").alias("want"))
    found = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("have"))
    return P.nearest_within(expected, found, ["k"], "want", "have", 40.0).select("s_suppkey", "want", "have")


@query("""WITH r AS (SELECT DISTINCT p_brand, p_size % 3 AS page, round(p_retailprice / 20) AS v FROM part), f AS (SELECT p_brand, count(DISTINCT page) AS pages, min(page) AS first FROM r GROUP BY 1)
 SELECT a.p_brand, a.v FROM r a JOIN f ON a.p_brand = f.p_brand AND a.page = f.first JOIN r b ON b.p_brand = a.p_brand AND abs(a.v - b.v) <= 1 GROUP BY a.p_brand, a.v, pages HAVING count(DISTINCT b.page) = pages""")
def on_every_page(spark, d):
    rows = table(spark, d, "part").select("p_brand", (F.col("p_size") % 3).alias("page"), F.round(F.col("p_retailprice") / 20).alias("v"))
    return P.on_every_page(rows, ["p_brand"], "page", "v", 1.0)


@query()
def line_grouping(spark, d):
    """Events of a user as words on a page, grouped into lines."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    words = table(spark, d, "events").select("user_id", F.concat_ws("#", "event_type", "event_id").alias("text"), (F.col("event_id") % 97).cast("double").alias("left"), (k * 4).alias("top"), (k * 4 + 6).alias("bottom"))
    return P.group_lines(words, ["user_id"])
