"""Agreement, accuracy, association, routing and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import measure as M
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

_ARMS = """arms AS (SELECT arm, p_partkey AS k, CASE WHEN arm = 'b' AND p_partkey % 9 = 0 THEN '' ELSE p_type END AS t, CASE WHEN arm = 'c' AND p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS b FROM part, (SELECT unnest(['a', 'b', 'c']) AS arm) WHERE NOT (arm = 'b' AND p_partkey % 10 = 3)),
 common AS (SELECT k FROM arms GROUP BY 1 HAVING count(DISTINCT arm) = 3), f AS (SELECT arm, k, unnest(['t', 'b']) AS field, unnest([t, b]) AS v FROM arms WHERE k IN (SELECT k FROM common))"""


def _arms(spark, d):
    c = F.col
    rows = table(spark, d, "part").withColumn("arm", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c")))).filter(~((c("arm") == "b") & (c("p_partkey") % 10 == 3)))
    return rows.select("arm", c("p_partkey").alias("k"), F.when((c("arm") == "b") & (c("p_partkey") % 9 == 0), "").otherwise(c("p_type")).alias("t"), F.when((c("arm") != "c") | (c("p_partkey") % 5 != 0), c("p_brand")).alias("b"))


@query(f"WITH {_ARMS}, u AS (SELECT k, field, count(DISTINCT coalesce(v, '?')) AS n FROM f GROUP BY ALL) SELECT field, count(*) AS n, count(*) FILTER (n = 1) AS unanimous, count(*) FILTER (n = 1) / count(*) AS share FROM u GROUP BY 1")
def unanimous_share(spark, d):
    return M.unanimous(_arms(spark, d), ["k"], "arm", ["t", "b"], 3)


@query(f"WITH {_ARMS} SELECT arm, field, count(*) FILTER (v IS NULL OR v = '') AS blank, count(*) AS n, count(*) FILTER (v IS NULL OR v = '') / count(*) AS rate FROM f GROUP BY ALL")
def blank_rates(spark, d):
    return M.blank_rates(_arms(spark, d), ["k"], "arm", ["t", "b"], 3)


@query(f"""WITH {_ARMS}, p AS (SELECT x.k, unnest(['t', 'b']) AS field, unnest([coalesce(x.t, ''), coalesce(x.b, '')]) AS a, unnest([coalesce(y.t, ''), coalesce(y.b, '')]) AS c FROM arms x JOIN arms y ON x.k = y.k AND x.arm = 'b' AND y.arm = 'c')
 SELECT field, count(*) AS n, count(*) FILTER (a = c) AS exact, count(*) FILTER (a = '' AND c = '') AS both_blank, count(*) FILTER (a = c) / count(*) AS rate FROM p GROUP BY 1""")
def engine_agreement(spark, d):
    arms = _arms(spark, d)
    return M.agreement(arms.filter("arm = 'b'"), arms.filter("arm = 'c'"), ["k"], ["t", "b"])


@query(f"""WITH {_ARMS}, v AS (SELECT k, coalesce(b, '?') AS b, count(*) AS votes, min(CASE arm WHEN 'a' THEN 2 WHEN 'b' THEN 1 ELSE 3 END) AS p FROM arms GROUP BY ALL) SELECT k, b, votes FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY votes DESC, p) AS r FROM v) WHERE r = 1""")
def majority_vote(spark, d):
    c = F.col
    rows = _arms(spark, d).select("k", F.coalesce("b", F.lit("?")).alias("b"), F.when(c("arm") == "a", 2).when(c("arm") == "b", 1).otherwise(3).alias("p"))
    return M.vote(rows, ["k"], "b", "p")


@query("""WITH r AS (SELECT doc_id, lang, source, toxic, CASE WHEN doc_id % 13 = 0 THEN NULL WHEN n_chars % 4 = 0 THEN 1 - toxic ELSE toxic END AS read FROM documents JOIN labels USING (doc_id)),
 a AS (SELECT lang, count(*) AS n, count(*) FILTER (read IS NOT DISTINCT FROM toxic) AS "right", count(*) FILTER (read IS NULL) AS blank, count(*) FILTER (read IS NOT NULL AND read <> toxic) AS wrong FROM r GROUP BY 1)
 SELECT *, "right" / n AS accuracy, round(greatest(0, ("right" / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) - 1.96 * sqrt("right" / n * (1 - "right" / n) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n)), 9) AS low,
 round(least(1, ("right" / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) + 1.96 * sqrt("right" / n * (1 - "right" / n) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n)), 9) AS high FROM a""")
def accuracy_with_interval(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    both = docs.join(labels, "doc_id")
    c = F.col
    read = both.select("doc_id", "lang", F.when(c("doc_id") % 13 != 0, F.when(c("n_chars") % 4 == 0, 1 - c("toxic")).otherwise(c("toxic"))).alias("toxic"))
    out = M.accuracy(labels, read, ["doc_id"], "toxic", ["lang"]).withColumn("w", M.wilson(c("right"), c("n")))
    return out.select("lang", "n", "right", "blank", "wrong", "accuracy", F.round("w.low", 9).alias("low"), F.round("w.high", 9).alias("high"))


_FAIL = "fl AS (SELECT unnest(['big', 'cheap', 'returned']) AS failure, unnest([(l_quantity > 45)::INTEGER, (l_extendedprice < 5000)::INTEGER, (l_returnflag = 'R')::INTEGER]) AS bad, l_linestatus, l_returnflag, l_linenumber FROM lineitem)"
_ASSOC = f"""{_FAIL}, fe AS (SELECT failure, bad, unnest(['l_linestatus', 'l_returnflag', 'l_linenumber']) AS feature, unnest([l_linestatus, l_returnflag, l_linenumber::VARCHAR]) AS value FROM fl),
 base AS (SELECT failure, avg(bad) AS base FROM fl GROUP BY 1), g AS (SELECT failure, feature, value, count(*) AS support, sum(bad)::BIGINT AS failed FROM fe GROUP BY ALL),
 a AS (SELECT failure, feature, value, support, failed, failed / support AS rate, base, failed / support / base AS lift FROM g JOIN base USING (failure) WHERE base > 0 AND base <= 0.9 AND support >= 30 AND NOT (failure = 'returned' AND feature = 'l_returnflag'))"""


def _failures():
    c = F.col
    return [("big", c("l_quantity") > 45), ("cheap", c("l_extendedprice") < 5000), ("returned", c("l_returnflag") == "R")]


@query(f"WITH {_ASSOC} SELECT failure, feature, value, support, failed, rate, base, lift FROM a WHERE lift >= 1.0")
def lift(spark, d):
    return M.associations(table(spark, d, "lineitem"), _failures(), ["l_linestatus", "l_returnflag", "l_linenumber"], least_lift=1.0, circular=[("returned", "l_returnflag")])


@query(f"WITH {_ASSOC}, b AS (SELECT failure, max(lift) AS l FROM a WHERE lift >= 1 GROUP BY 1), n AS (SELECT failure, sum(bad)::BIGINT AS affected, avg(bad) AS share FROM fl GROUP BY 1) SELECT failure, affected, share, coalesce(l, 1.0) AS best_lift, coalesce(l, 1.0) >= 1.5 AS tractable FROM n LEFT JOIN b USING (failure)")
def priorities(spark, d):
    return M.priorities(table(spark, d, "lineitem"), _failures(), ["l_linestatus", "l_returnflag", "l_linenumber"], circular=[("returned", "l_returnflag")])


@query("""WITH b AS (SELECT (l_quantity > 45)::INTEGER AS big, (l_extendedprice < 5000)::INTEGER AS cheap, (l_returnflag = 'R')::INTEGER AS ret FROM lineitem), t AS (SELECT *, big + cheap + ret AS k FROM b)
 SELECT 'big' AS family, sum(big)::BIGINT AS n, count(*) FILTER (big = 1 AND k = 1) AS only FROM t UNION ALL SELECT 'cheap', sum(cheap)::BIGINT, count(*) FILTER (cheap = 1 AND k = 1) FROM t UNION ALL SELECT 'returned', sum(ret)::BIGINT, count(*) FILTER (ret = 1 AND k = 1) FROM t UNION ALL SELECT 'any', count(*) FILTER (k > 0), count(*) FILTER (k = 1) FROM t""")
def router(spark, d):
    return M.routing(table(spark, d, "lineitem"), _failures())


@query("""WITH a AS (SELECT count(*) FILTER (l_quantity > 45) AS flagged_n, count(*) FILTER (l_quantity > 45 AND l_extendedprice > 40000) AS x, count(*) FILTER (NOT l_quantity > 45) AS base_n, count(*) FILTER (NOT l_quantity > 45 AND l_extendedprice > 40000) AS y FROM lineitem)
 SELECT flagged_n, x / flagged_n AS flagged_rate, base_n, y / base_n AS base_rate, CASE WHEN y > 0 THEN (x / flagged_n) / (y / base_n) WHEN x > 0 THEN 'inf'::DOUBLE ELSE 1.0 END AS ratio FROM a""")
def separation(spark, d):
    return M.separation(table(spark, d, "lineitem"), F.col("l_quantity") > 45, F.col("l_extendedprice") > 40000)


@query("""WITH h AS (SELECT o_orderkey % 2 AS half, round(avg(o_totalprice), 6) AS price, avg((o_orderstatus = 'F')::INTEGER) AS filled, count(*)::DOUBLE AS cost FROM orders GROUP BY 1), b AS (SELECT * FROM h WHERE half = 0), a AS (SELECT * FROM h WHERE half = 1)
 SELECT 'target' AS gate, 'filled' AS metric, b.filled AS "before", a.filled AS "after", a.filled - b.filled >= 0.01 AS passed FROM a, b UNION ALL SELECT 'guard', 'price', b.price, a.price, a.price - b.price >= -0.02 FROM a, b UNION ALL SELECT 'guard', 'absent', NULL, NULL, false UNION ALL SELECT 'cost', 'cost', b.cost, a.cost, a.cost <= b.cost * 1.1 FROM a, b""")
def regression_gates(spark, d):
    o = table(spark, d, "orders")

    def metrics(half):
        one = o.filter(F.col("o_orderkey") % 2 == half).agg(F.round(F.avg("o_totalprice"), 6).alias("price"), F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("filled"), F.count("*").cast("double").alias("cost"))
        return one.select(F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("price", "filled", "cost")))))

    return M.gates(metrics(0), metrics(1), "filled", 0.01, ["price", "absent"], cost="cost")
