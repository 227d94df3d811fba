"""Reconciliation, release invariants, set operations and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import match, reconcile, sampling
from tallyspark.plans.registry import query
from tallyspark.sources import tables as S
from tallyspark.sources.tables import table

_COMPARED = """
r AS (SELECT l_orderkey AS k, count(*) AS found FROM lineitem WHERE l_orderkey % 11 <> 3 GROUP BY 1),
t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 5 THEN NULL ELSE 3 + o_orderkey % 3 END AS printed, true AS t FROM orders WHERE o_orderkey % 17 <> 2),
c AS (SELECT coalesce(r.k, t.k) AS k, coalesce(found, 0) AS found, printed, CASE WHEN t.t IS NULL THEN 'phantom' WHEN printed IS NULL THEN 'unmeasured' WHEN found IS NULL THEN 'missing' WHEN found = printed THEN 'exact' ELSE 'off' END AS status, coalesce(found, 0) - printed AS diff FROM r FULL JOIN t ON r.k = t.k)
"""


def _compared(spark, d):
    k = F.col("k")
    rows = table(spark, d, "lineitem").filter("l_orderkey % 11 <> 3").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("found"))
    totals = table(spark, d, "orders").filter("o_orderkey % 17 <> 2").select(F.col("o_orderkey").alias("k")).select("k", F.when(k % 13 != 5, 3 + k % 3).alias("printed"))
    return reconcile.against_totals(rows, totals, ["k"], "found", "printed")


@query(f"WITH {_COMPARED} SELECT k, found, printed, status, diff FROM c")
def reconcile_totals(spark, d):
    return _compared(spark, d)


@query(f"WITH {_COMPARED} SELECT status, count(*) AS n FROM c GROUP BY 1")
def phantom_unmeasured(spark, d):
    return _compared(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query(f"WITH {_COMPARED} SELECT k, found, printed, status, diff FROM c WHERE diff <> 0")
def residual_list(spark, d):
    return reconcile.residuals(_compared(spark, d), ["k"], "printed")


@query(f"""WITH {_COMPARED}, m AS (SELECT *, printed IS NOT NULL AND status <> 'phantom' AS m FROM c), a AS (SELECT count(*) FILTER (m) AS measured, count(*) FILTER (m AND diff = 0) AS matching, coalesce(sum(abs(diff)) FILTER (m), 0)::BIGINT AS short,
 coalesce(max(abs(diff) / printed) FILTER (m AND printed <> 0), 0) AS worst_fraction, sum(found)::BIGINT AS main_rows FROM m)
 SELECT *, CASE WHEN measured = 0 THEN 'no evidence' WHEN worst_fraction > 0.25 THEN 'one part off' WHEN short > 0.002 * main_rows THEN 'short overall' ELSE 'publish' END AS verdict FROM a""")
def publish_verdict(spark, d):
    return reconcile.shortfall(_compared(spark, d), "found", "printed")


@query("""WITH c AS (SELECT l_orderkey AS k, count(*) FILTER (l_returnflag = 'N') AS main, count(*) FILTER (l_returnflag = 'A') AS added, count(*) FILTER (l_returnflag = 'R') AS detected FROM lineitem GROUP BY 1)
 SELECT k, main, added, detected, o_orderkey % 4 AS net, main + added - o_orderkey % 4 AS implied FROM c JOIN orders ON k = o_orderkey WHERE o_orderkey % 5 <> 0""")
def struck_off(spark, d):
    flag = F.col("l_returnflag")
    rows = table(spark, d, "lineitem").withColumn("k", F.col("l_orderkey"))
    net = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 4).alias("net"))
    return reconcile.implied_against_detected(rows, net, ["k"], flag == "N", flag == "A", flag == "R", "net")


@query("""WITH g AS (SELECT o_custkey, count(*) - avg(o_totalprice) / 50000 AS gap FROM orders GROUP BY 1), s AS (SELECT avg(gap) AS mean, stddev_pop(gap) AS sd FROM g)
 SELECT o_custkey, round(gap, 6) AS gap, sd > 0 AND abs(gap - mean) > 2 * sd AS outlier FROM g, s""")
def gap_outliers(spark, d):
    g = table(spark, d, "orders").groupBy("o_custkey").agg((F.count("*") - F.avg("o_totalprice") / 50000).alias("gap"))
    return reconcile.outliers(g, "gap", 2.0).select("o_custkey", F.round("gap", 6).alias("gap"), "outlier")


@query("""SELECT n_regionkey, count(*) FILTER (n_nationkey % 4 <> 0) AS external_checks, count(*) FILTER (n_nationkey % 4 <> 0) > 0 AND count(*) FILTER (n_nationkey % 4 <> 0 AND NOT n_nationkey % 7 <> 6) = 0 AS ok FROM nation GROUP BY 1""")
def external_verdicts(spark, d):
    n = F.col("n_nationkey")
    return reconcile.verdict(table(spark, d, "nation").withColumns({"passed": n % 7 != 6, "external": n % 4 != 0}), ["n_regionkey"])


@query("""SELECT 'missing' AS side, k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F') UNION ALL SELECT 'unexpected', k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus <> 'F' EXCEPT SELECT c_custkey FROM customer)""")
def set_differences(spark, d):
    return reconcile.set_difference(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").filter("o_orderstatus <> 'F'").select(F.col("o_custkey").alias("k")))


@query("""SELECT 'left' AS side, * FROM (SELECT o_custkey AS k, o_orderstatus AS s FROM orders EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0)
 UNION ALL SELECT 'right', * FROM (SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 <> 0 EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders)""")
def bag_differences(spark, d):
    o = table(spark, d, "orders")
    pick = lambda x: x.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"))
    return reconcile.bag_difference(pick(o), pick(o.filter("o_orderkey % 3 <> 0")))


@query("""WITH x AS (SELECT DISTINCT l_suppkey, (l_quantity * l_linenumber % 97)::BIGINT AS n FROM lineitem), i AS (SELECT *, n - row_number() OVER (PARTITION BY l_suppkey ORDER BY n) AS i FROM x),
 r AS (SELECT l_suppkey, min(n) AS a, max(n) AS b FROM i GROUP BY l_suppkey, i) SELECT l_suppkey, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ', ' ORDER BY a) AS ranges FROM r GROUP BY 1""")
def number_ranges(spark, d):
    return reconcile.pages_as_ranges(table(spark, d, "lineitem").select("l_suppkey", (F.col("l_quantity") * F.col("l_linenumber") % 97).cast("long").alias("n")), ["l_suppkey"], "n")


@query("""SELECT invariant, key FROM (SELECT unnest([CASE WHEN NOT l_quantity BETWEEN 1 AND 49 THEN 'quantity_range' END, CASE WHEN NOT l_returnflag IN ('A', 'N') THEN 'flag_domain' END, CASE WHEN NOT l_discount < 0.1 THEN 'discount_range' END]) AS invariant, l_orderkey || '/' || l_linenumber AS key FROM lineitem) WHERE invariant IS NOT NULL
 UNION ALL SELECT 'unique_lines', l_orderkey || '/' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
 UNION ALL SELECT 'text_in_one_source', sha256(text) FROM documents GROUP BY text HAVING count(DISTINCT source) > 1""")
def release_violations(spark, d):
    li = table(spark, d, "lineitem")
    c = F.col
    rows = reconcile.violations(li, F.concat_ws("/", "l_orderkey", "l_linenumber"), [("quantity_range", c("l_quantity").between(1, 49)), ("flag_domain", c("l_returnflag").isin("A", "N")), ("discount_range", c("l_discount") < 0.1)])
    docs = table(spark, d, "documents").select("source", F.sha2("text", 256).alias("h"))
    return rows.unionByName(reconcile.not_unique(li, ["l_orderkey", "l_linenumber"], "unique_lines")).unionByName(reconcile.shared_across(docs, "h", "source", "text_in_one_source"))


@query("""WITH c AS (SELECT o_orderkey, o_custkey, list({n: l_linenumber, p: l_partkey, s: l_suppkey, q: l_quantity} ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS x FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
 SELECT o_orderkey, u.n AS l_linenumber, u.p AS l_partkey, u.s AS l_suppkey, u.q AS l_quantity FROM (SELECT o_orderkey, unnest(x) AS u FROM c)""")
def nest_and_flatten(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    nested = S.nest(table(spark, d, "orders").select("o_orderkey", "o_custkey"), lines, ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "lines", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    return S.flatten(nested, ["o_orderkey"], "lines")


@query("""SELECT l_orderkey, CAST(CASE WHEN l_linenumber % 3 = 0 THEN k ELSE l_linenumber END AS INTEGER) AS number, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_quantity, l_linenumber) AS k FROM lineitem)""")
def numbered_sections(spark, d):
    c = F.col
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_linenumber", F.when(c("l_linenumber") % 3 == 0, 0).otherwise(c("l_linenumber")).alias("number"))
    nested = S.nest(lines.select("l_orderkey").distinct(), lines, ["l_orderkey"], ["l_partkey", "l_suppkey", "l_quantity", "l_linenumber", "number"], "x", ["l_partkey", "l_suppkey", "l_quantity", "l_linenumber"])
    return S.numbered_children(nested, ["l_orderkey"], "x", "number").select("l_orderkey", F.col("number").cast("int").alias("number"), "l_partkey")


@query("""SELECT event_id, 0::INTEGER AS page, event_type AS text, k AS "left", user_id::INTEGER AS top, k + 5 AS "right", user_id::INTEGER + 2 AS bottom FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)""")
def words_of_responses(spark, d):
    k = F.regexp_extract("props", "([0-9]+)", 1)
    vertex = '{"x":%s,"y":%s}'
    box = F.format_string(f"[{vertex},{vertex}]", k, F.col("user_id").cast("string"), (k.cast("int") + 5).cast("string"), (F.col("user_id") + 2).cast("string"))
    symbols = F.concat(F.lit('[{"text":"'), F.substring("event_type", 1, 2), F.lit('"},{"text":"'), F.expr("substring(event_type, 3)"), F.lit('"}]'))
    blank = F.lit(',{"symbols":[{"text":" "}],"box":[{"x":1}]}')
    doc = F.concat(F.lit('[{"blocks":[{"paragraphs":[{"words":[{"symbols":'), symbols, F.lit(',"box":'), box, F.lit("}"), blank, F.lit("]}]}]}]"))
    return S.words_of(table(spark, d, "events").select("event_id", doc.alias("doc")), ["event_id"], "doc")


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 10 <> 0 UNION ALL SELECT c_custkey, 'new', c_acctbal + 1 FROM customer WHERE c_custkey % 10 = 0""")
def keyed_upsert(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return S.upsert(c, c.filter("c_custkey % 10 = 0").select("c_custkey", F.lit("new").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal")), ["c_custkey"])


@query("SELECT doc_id FROM documents WHERE doc_id % 5 = 1 OR doc_id % 7 = 2")
def incremental_todo(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.lit("2").alias("version"))
    cached = docs.filter("doc_id % 5 <> 1").withColumn("sha", F.when(F.col("doc_id") % 7 == 2, F.lit("old")).otherwise(F.col("sha")))
    return S.stale(docs, cached, ["doc_id"], ["sha", "version"]).select("doc_id")


_LOOKUP = """
o AS (SELECT 'name' AS field, c_name AS native, 1 AS f, 'r' || c_custkey AS roman, CASE WHEN c_custkey % 4 = 0 THEN 'manual' WHEN c_custkey % 4 = 1 THEN 'official' ELSE 'machine' END AS source, '' AS variant, CASE WHEN c_custkey % 4 = 0 THEN 'manual' WHEN c_custkey % 4 = 1 THEN 'official' ELSE '' END AS authority, '' AS note FROM customer WHERE c_custkey % 5 <> 0),
e AS (SELECT 'name' AS field, c_name AS native, c_custkey % 9 AS frequency FROM customer WHERE c_custkey % 6 <> 0),
f AS (SELECT 'name' AS field, c_name AS native, CASE WHEN c_custkey % 3 = 0 THEN 'fresh' || c_custkey ELSE '' END AS roman, 'model' AS source FROM customer WHERE c_custkey % 2 = 0),
m AS (SELECT e.field, e.native, frequency, coalesce(o.authority IN ('manual', 'official'), false) AS fixed, o.roman AS o_roman, o.source AS o_source, f.roman AS f_roman, f.source AS f_source, o.variant, o.authority, o.note FROM e LEFT JOIN o USING (field, native) LEFT JOIN f USING (field, native)),
l AS (SELECT field, native, frequency, coalesce(CASE WHEN NOT fixed AND coalesce(f_roman, '') <> '' THEN f_roman ELSE o_roman END, '') AS roman, coalesce(CASE WHEN NOT fixed AND coalesce(f_roman, '') <> '' THEN f_source ELSE o_source END, '') AS source, coalesce(variant, '') AS variant,
 coalesce(nullif(authority, ''), coalesce(CASE WHEN NOT fixed AND coalesce(f_roman, '') <> '' THEN f_source ELSE o_source END, '')) AS authority, coalesce(note, '') AS note FROM m)
"""


def _lookup(spark, d):
    c, k = table(spark, d, "customer").withColumn("field", F.lit("name")).withColumnRenamed("c_name", "native"), F.col("c_custkey")
    blank = F.lit("")
    who = F.when(k % 4 == 0, "manual").when(k % 4 == 1, "official")
    old = c.filter(k % 5 != 0).select("field", "native", F.lit(1).alias("frequency"), F.concat(F.lit("r"), k.cast("string")).alias("roman"), F.coalesce(who, F.lit("machine")).alias("source"), blank.alias("variant"), F.coalesce(who, blank).alias("authority"), blank.alias("note"))
    entries = c.filter(k % 6 != 0).select("field", "native", (k % 9).alias("frequency"))
    fills = c.filter(k % 2 == 0).select("field", "native", F.when(k % 3 == 0, F.concat(F.lit("fresh"), k.cast("string"))).otherwise(blank).alias("roman"), F.lit("model").alias("source"))
    return match.merge_lookup(old, entries, fills)


@query(f"WITH {_LOOKUP} SELECT * FROM l")
def lookup_merge(spark, d):
    return _lookup(spark, d)


@query(f"""WITH {_LOOKUP}, a AS (SELECT 'name' AS field, c_name AS native, CASE WHEN c_custkey % 8 = 0 THEN 'Off' || c_custkey ELSE '' END AS spelling FROM customer),
 x AS (SELECT l.*, coalesce(spelling, '') <> '' AND spelling <> roman AS new, spelling FROM l LEFT JOIN a USING (field, native))
 SELECT field, native, frequency, CASE WHEN new THEN spelling ELSE roman END AS roman, CASE WHEN new THEN 'official' ELSE source END AS source, CASE WHEN new AND authority = 'manual' AND roman <> '' THEN roman ELSE variant END AS variant, CASE WHEN new THEN 'official' ELSE authority END AS authority, note FROM x""")
def lookup_adopt(spark, d):
    k = F.col("c_custkey")
    official = table(spark, d, "customer").select(F.lit("name").alias("field"), F.col("c_name").alias("native"), F.when(k % 8 == 0, F.concat(F.lit("Off"), k.cast("string"))).otherwise("").alias("spelling"))
    return match.adopt(_lookup(spark, d), official)


@query("""WITH a AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE n_chars % 90 END AS age, CASE WHEN doc_id % 4 = 0 THEN '' ELSE source END AS house, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS sex, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'f' END AS flags FROM documents),
 b AS (SELECT doc_id, n_chars % 80 AS n_age, source AS n_house, CASE WHEN doc_id % 7 = 0 THEN 'xx' ELSE lang END AS n_sex FROM documents WHERE doc_id % 11 <> 0),
 j AS (SELECT a.*, n_age, n_house, n_sex, age IS NULL AND n_age IS NOT NULL AS ra, coalesce(house, '') = '' AND coalesce(n_house, '') <> '' AS rh, coalesce(sex, '') = '' AND coalesce(n_sex, '') <> '' AS rs, age IS NOT NULL AND n_age IS NOT NULL AND age <> n_age AS da, coalesce(house, '') <> '' AND coalesce(n_house, '') <> '' AND house <> n_house AS dh, coalesce(sex, '') <> '' AND coalesce(n_sex, '') <> '' AND sex <> n_sex AS ds FROM a LEFT JOIN b USING (doc_id))
 SELECT doc_id, CASE WHEN ra OR da THEN n_age ELSE age END AS age, CASE WHEN rh THEN n_house ELSE house END AS house, CASE WHEN rs THEN n_sex ELSE sex END AS sex, CASE WHEN da THEN age END AS age_first_pass,
 concat_ws(',', nullif(flags, ''), CASE WHEN ra THEN 'recovered_age' END, CASE WHEN rh THEN 'recovered_house' END, CASE WHEN rs THEN 'recovered_sex' END, CASE WHEN da THEN 'disagreed_age' END, CASE WHEN dh THEN 'disagreed_house' END, CASE WHEN ds THEN 'disagreed_sex' END, CASE WHEN da THEN 'overruled_age' END) AS flags FROM j""")
def second_pass_merge(spark, d):
    docs, k = table(spark, d, "documents"), F.col("doc_id")
    first = docs.select("doc_id", F.when(k % 3 != 0, F.col("n_chars") % 90).alias("age"), F.when(k % 4 == 0, "").otherwise(F.col("source")).alias("house"), F.when(k % 5 != 0, F.col("lang")).alias("sex"), F.when(k % 2 == 0, "").otherwise("f").alias("flags"))
    second = docs.filter("doc_id % 11 <> 0").select("doc_id", (F.col("n_chars") % 80).alias("age"), F.col("source").alias("house"), F.when(k % 7 == 0, "xx").otherwise(F.col("lang")).alias("sex"))
    return match.second_pass(first, second, ["doc_id"])


@query("""WITH p AS (SELECT DISTINCT o_custkey FROM orders ORDER BY 1 LIMIT 30) SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders WHERE o_custkey IN (SELECT * FROM p)) WHERE k <= 3""")
def cluster_sample(spark, d):
    return sampling.cluster_sample(table(spark, d, "orders"), "o_custkey", ["o_orderkey"], 30, 90).select("o_custkey", "o_orderkey")


@query("SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS k FROM orders) WHERE k % 7 = 0 AND k < 35")
def systematic_sample(spark, d):
    return sampling.systematic_sample(table(spark, d, "orders"), "o_orderpriority", ["o_orderkey"], 7, 5).select("o_orderpriority", "o_orderkey")


@query("SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 100")
def seeded_sample(spark, d):
    return sampling.seeded_sample(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 42, 100)
