"""Routing, reports, costs, fleets, promises, tokens and table geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions import fuzzy
from tallyspark.functions import tokens as K
from tallyspark.operators import grid, measure, reports, routing
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

_REASONED = """
b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, concat_ws(',', CASE WHEN l_quantity > 45 THEN 'big' END, CASE WHEN l_discount = 0 THEN 'full' END, CASE WHEN l_tax > 0.07 THEN 'taxed' END) AS flags,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey END AS a, CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE l_suppkey END AS c, CASE WHEN l_linenumber = 3 THEN '' ELSE l_returnflag END AS t FROM lineitem),
r AS (SELECT *, list_concat(list_filter(['taxed', 'big'], lambda x: list_contains(string_split(flags, ','), x)), CASE WHEN l_returnflag <> '' AND t = '' THEN ['flag_unknown'] ELSE [] END,
  CASE WHEN (a IS NULL)::INT + (c = 0)::INT + (t = '')::INT >= 2 THEN list_filter([CASE WHEN a IS NULL THEN 'no_a' END, CASE WHEN c = 0 THEN 'no_c' END, CASE WHEN t = '' THEN 'no_t' END], lambda x: x IS NOT NULL) ELSE [] END) AS reasons FROM b)
"""


def _reasoned(spark, d):
    c = F.col
    rows = table(spark, d, "lineitem").withColumns(
        {
            "flags": F.concat_ws(",", F.when(c("l_quantity") > 45, "big"), F.when(c("l_discount") == 0, "full"), F.when(c("l_tax") > 0.07, "taxed")),
            "a": F.when(c("l_partkey") % 7 != 0, c("l_partkey")),
            "c": F.when(c("l_suppkey") % 5 == 0, 0).otherwise(c("l_suppkey")),
            "t": F.when(c("l_linenumber") == 3, "").otherwise(c("l_returnflag")),
        }
    )
    return rows.withColumn("reasons", routing.reasons(routing.doubts(c("flags"), ["taxed", "big"]), routing.value_without_label("l_returnflag", "t", "flag_unknown"), routing.missing_core(["a", "c", "t"])))


@query(f"WITH {_REASONED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, array_to_string(reasons, ',') AS reasons FROM r WHERE len(reasons) > 0")
def escalation_reasons(spark, d):
    out = _reasoned(spark, d).filter(F.size("reasons") > 0)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {_REASONED}, e AS (SELECT unnest(reasons) AS reason FROM r) SELECT reason, count(*) AS n FROM e GROUP BY 1 ORDER BY n DESC, reason LIMIT 3")
def top_reasons(spark, d):
    return routing.top_reasons(_reasoned(spark, d), "reasons", 3)


@query(f"WITH {_REASONED}, e AS (SELECT unnest(string_split(flags, ',')) AS flag FROM b), s AS (SELECT flag, count(*) AS n FROM e WHERE flag <> '' GROUP BY 1) SELECT coalesce(s.flag, w.flag) AS flag, coalesce(n, 0)::BIGINT AS n, coalesce(n, 0) / (SELECT count(*) FROM b) AS rate FROM s FULL JOIN (SELECT unnest(['big', 'never']) AS flag) w ON s.flag = w.flag")
def flag_rates(spark, d):
    return reports.flag_rates(_reasoned(spark, d), F.split("flags", ","), ["big", "never"])


@query("""WITH i AS (SELECT conv_id, bool_and(length(text) < 900 OR role = 'user') AS ok FROM conversations WHERE conv_id % 3 <> 0 GROUP BY 1) SELECT DISTINCT c.conv_id, coalesce(ok, false) AS readable FROM conversations c LEFT JOIN i USING (conv_id)""")
def readable_parts(spark, d):
    c = table(spark, d, "conversations")
    images = c.filter("conv_id % 3 <> 0").withColumn("words", F.when(F.col("role") == "user", 1).otherwise(0))
    return routing.readable(c.select("conv_id").distinct(), images, ["conv_id"], F.length("text") < 900, F.col("words"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') AND c_acctbal > 0")
def all_conditions(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return routing.all_conditions(table(spark, d, "customer").filter("c_acctbal > 0"), ["c_custkey"], o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'")).select("c_custkey")


@query("SELECT user_id, CAST(ts AS DATE)::VARCHAR AS day, count(*) AS n FROM events GROUP BY ALL HAVING count(*) < 3")
def underfull_pages(spark, d):
    return routing.underfull(table(spark, d, "events").withColumn("day", F.col("ts").cast("date").cast("string")), ["user_id", "day"], 3)


_RULES = [("l_returnflag", "big"), ("l_returnflag", "*"), ("l_linestatus", "*"), ("l_linenumber", "cheap"), ("l_linenumber", "*")]


@query()
def proposals(spark, d):
    """What to try for the associations found: each rule once, exact ones before general ones."""
    c = F.col
    failures = [("big", c("l_quantity") > 45), ("cheap", c("l_extendedprice") < 5000)]
    found = measure.associations(table(spark, d, "lineitem"), failures, ["l_linestatus", "l_returnflag", "l_linenumber"], least_lift=1.0)
    found = found.withColumn("order_", F.struct((-F.round("lift", 9)).alias("l"), "failure", "feature", "value"))
    return routing.first_rules(found, _RULES, ["order_"])


@query("""WITH s AS (SELECT trim(CASE WHEN event_id % 9 = 0 THEN '' ELSE substr(event_type, 1, (event_id % 8)::INT) END) AS value FROM events) SELECT CASE WHEN value = '' THEN 'empty' WHEN length(value) < 4 THEN 'short' ELSE 'garbled' END AS shape, value, count(*) AS n FROM s GROUP BY ALL ORDER BY n DESC, shape, value LIMIT 6""")
def read_shapes(spark, d):
    e = F.col("event_id")
    rows = table(spark, d, "events").withColumn("read", F.when(e % 9 != 0, F.expr("substring(event_type, 1, CAST(event_id % 8 AS INT))")).otherwise(""))
    return reports.shapes(rows, "read", 4, 6)


@query("WITH s AS (SELECT sum((l_linestatus = 'F')::INT)::BIGINT AS male, sum((l_linestatus = 'O')::INT)::BIGINT AS female FROM lineitem) SELECT male, female, male / (male + female) AS share, abs(male / (male + female) - 0.5) <= 0.02 AS passed FROM s")
def share_against_published(spark, d):
    return reports.population_share(table(spark, d, "lineitem"), F.col("l_linestatus") == "F", F.col("l_linestatus") == "O", 0.5)


@query("WITH g AS (SELECT l_suppkey, avg((l_discount <> 0)::INT) AS x, avg((l_tax <> 0)::INT) AS y FROM lineitem GROUP BY 1) SELECT l_suppkey, least(x, y) AS lowest, least(x, y) >= 0.9 AS passed FROM g")
def populated_floor(spark, d):
    return reports.populated(table(spark, d, "lineitem"), ["l_suppkey"], ["l_discount", "l_tax"], 0.9)


@query("""WITH g AS (SELECT o_orderpriority, sum(o_custkey % 50)::BIGINT AS pages, sum(ceil((o_custkey % 50) / 4))::BIGINT AS calls FROM orders GROUP BY 1) SELECT o_orderpriority, pages, calls, round(calls * 0.0015::DOUBLE, 6) AS cost, round(round_even(921000.0::DOUBLE / (pages / greatest(calls, 1)), 0) * 0.0015, 6) AS projected FROM g""")
def extrapolated_costs(spark, d):
    out = reports.extrapolated_cost(table(spark, d, "orders"), ["o_orderpriority"], F.col("o_custkey") % 50, 4, 0.0015, 921000)
    return out.withColumns({"cost": F.round("cost", 6), "projected": F.round("projected", 6)})


@query("""WITH e AS (SELECT user_id, ts, value, event_type FROM events), l AS (SELECT user_id, max(ts) AS beat, count(DISTINCT event_type) AS hosts FROM e WHERE value > 60 GROUP BY 1), d AS (SELECT DISTINCT user_id FROM e WHERE value < 1), h AS (SELECT DISTINCT user_id FROM e), n AS (SELECT max(ts) AS now FROM events)
 SELECT coalesce(h.user_id, d.user_id, l.user_id) AS user_id, CASE WHEN d.user_id IS NOT NULL THEN 'done' WHEN beat IS NOT NULL AND epoch(now) - epoch(beat) > 86400 THEN 'stale' WHEN beat IS NOT NULL THEN 'running' WHEN h.user_id IS NOT NULL THEN 'waiting' ELSE 'unknown' END AS state, coalesce(hosts, 0) AS hosts FROM h FULL JOIN d ON h.user_id = d.user_id FULL JOIN l ON coalesce(h.user_id, d.user_id) = l.user_id, n""")
def fleet_states(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    now = F.lit(e.agg(F.max("ts")).first()[0])
    claims = e.filter("value > 60").select("user_id", F.col("ts").alias("beat"), F.col("event_type").alias("host"))
    return reports.fleet(e.filter("value < 1"), e, claims, "user_id", now, 86400)


@query("""SELECT unnest(['price_positive', 'known_status', 'early_date']) AS "check", unnest([count(*) FILTER (NOT o_totalprice > 0) = 0, count(*) FILTER (NOT o_orderstatus IN ('F', 'O')) = 0, count(*) FILTER (NOT o_orderdate < TIMESTAMP '1998-01-01') = 0]) AS passed,
 unnest([count(*) FILTER (NOT o_totalprice > 0), count(*) FILTER (NOT o_orderstatus IN ('F', 'O')), count(*) FILTER (NOT o_orderdate < TIMESTAMP '1998-01-01')]) AS failing FROM orders""")
def dataset_promises(spark, d):
    c = F.col
    return reports.promises(table(spark, d, "orders"), [("price_positive", c("o_totalprice") > 0), ("known_status", c("o_orderstatus").isin("F", "O")), ("early_date", c("o_orderdate") < F.lit("1998-01-01").cast("timestamp"))])


@query("""WITH w AS (SELECT p_brand, unnest(regexp_extract_all(lower(p_name), '([a-z]+)')) AS word FROM part) SELECT word, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS tokens FROM w GROUP BY 1""")
def inverted_index(spark, d):
    return reports.inverted_index(table(spark, d, "part"), "p_brand", "p_name").withColumn("tokens", F.array_join("tokens", ","))


@query("SELECT event_type, median(value) AS median, round(avg(value), 9) AS mean, min(value) AS least, max(value) AS most, count(*) AS n FROM events GROUP BY 1")
def timings(spark, d):
    return reports.timings(table(spark, d, "events"), ["event_type"], "value").withColumn("mean", F.round("mean", 9))


@query("SELECT l_suppkey, array_to_string(list_sort(list_distinct(list(l_linenumber))), ',') AS pages FROM lineitem GROUP BY 1")
def truth_pages(spark, d):
    return reports.sorted_set(table(spark, d, "lineitem"), ["l_suppkey"], "l_linenumber", "pages").withColumn("pages", F.array_join("pages", ","))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 5 AS m, o_orderkey % 3 AS f, o_orderkey % 5 + o_orderkey % 3 + (o_orderkey % 4 = 0)::INT AS t, o_orderkey % 5 AS m2, o_orderkey % 3 + (o_orderkey % 7 = 0)::INT AS f2, o_orderkey % 5 + o_orderkey % 3 + (o_orderkey % 8 = 0)::INT AS t2 FROM orders)
 SELECT k, CASE WHEN m + f = t THEN '0' WHEN m2 + f2 = t2 THEN '1' WHEN m + f IN (t, t2) OR m2 + f2 IN (t, t2) THEN 'mixed' ELSE '' END AS taken, CASE WHEN m + f = t THEN t WHEN m2 + f2 = t2 THEN t2 WHEN m + f IN (t, t2) THEN m + f WHEN m2 + f2 IN (t, t2) THEN m2 + f2 END AS settled FROM o""")
def balanced_readings(spark, d):
    k = F.col("o_orderkey")
    total = k % 5 + k % 3
    rows = table(spark, d, "orders").select(k.alias("k"), (k % 5).alias("m"), (k % 3).alias("f"), (total + F.when(k % 4 == 0, 1).otherwise(0)).alias("t"), (k % 5).alias("m2"), (k % 3 + F.when(k % 7 == 0, 1).otherwise(0)).alias("f2"), (total + F.when(k % 8 == 0, 1).otherwise(0)).alias("t2"))
    return reports.repaired_total(rows, ["m", "f"], "t", [{"m": "m2", "f": "f2", "t": "t2"}]).select("k", "taken", "settled")


@query("""WITH r AS (SELECT doc_id, regexp_extract_all(text, '([äöüßñóíéèêç]+)') AS r FROM documents), k AS (SELECT doc_id, r, len(list_filter(r, lambda x: x IN ('ü', 'é', 'ó'))) AS known FROM r)
 SELECT doc_id, len(list_filter(r, lambda x: x NOT IN ('ä', 'è')))::INT AS core, CASE WHEN len(r) = 0 THEN 'already-latin' WHEN known = len(r) THEN 'lexicon' WHEN known > 0 THEN 'lexicon+model' ELSE 'model' END AS provenance FROM k""")
def script_runs(spark, d):
    script = "[äöüßñóíéèêç]+"
    return table(spark, d, "documents").select("doc_id", F.size(K.core_runs("text", ["ä", "è"], script)).alias("core"), K.provenance("text", ["ü", "é", "ó"], "model", script).alias("provenance"))


@query("""SELECT doc_id, regexp_matches(text, '(?i)(^|[^A-Za-z])part([^A-Za-z]|$)') OR (regexp_matches(text, '(?i)(^|[^A-Za-z])the([^A-Za-z]|$)') AND NOT (contains(text, 'and') AND contains(text, 'was')) AND (contains(text, 'ing') OR contains(text, 'tion'))) AS translated FROM documents""")
def translation_guards(spark, d):
    text = F.col("text")
    hit = K.translated(text, text, "the", ["ing", "tion"], [["and"], ["was"]]) | K.translated(text, text, "part", [""], [])
    return table(spark, d, "documents").select("doc_id", hit.alias("translated"))


@query("SELECT doc_id, CASE WHEN lower(trim(lang)) IN ('en', 'n/a') THEN '' ELSE trim(lang) END AS known, CASE WHEN contains(text, 'thing') THEN 'T' WHEN contains(text, 'thin') THEN 'S' WHEN contains(text, 'der') THEN 'D' ELSE '' END AS word FROM documents")
def listed_words(spark, d):
    return table(spark, d, "documents").select("doc_id", K.unknown_as_blank("lang", ["en", "n/a"]).alias("known"), K.first_listed("text", [("thing", "T"), ("thin", "S"), ("der", "D")]).alias("word"))


@query()
def loops_removed(spark, d):
    """Length of each document with runaway repetition cut to one turn."""
    return table(spark, d, "documents").select("doc_id", F.length(fuzzy.without_loops("text")).alias("n"))


@query("SELECT c_custkey, translate(c_custkey::VARCHAR, '0123456789', 'ABCDEFGHIJ') AS minted FROM customer")
def minted_names(spark, d):
    return table(spark, d, "customer").select("c_custkey", K.minted(F.col("c_custkey")).alias("minted"))


def _rules(spark, d):
    """Vertical rules of pages: three columns whose borders are tight clusters; every fifth page lacks its dividers."""
    k = F.col("s_suppkey")
    places = F.array(*(F.struct(F.lit(at).alias("at"), F.lit(div).alias("div")) for at, div in ((39, 0), (427, 1), (541, 0), (554, 0), (567, 0), (955, 1), (1069, 0), (1082, 0), (1094, 0), (1483, 1), (1597, 0), (1610, 0))))
    rows = table(spark, d, "supplier").select((k % 10).alias("part"), k.alias("page"), F.inline(places))
    return rows.filter(~((F.col("page") % 5 == 0) & (F.col("div") == 1))).select("part", "page", (F.col("at") + F.col("page") % 3).alias("at"))


@query("""WITH r AS (SELECT s_suppkey AS page, unnest([39, 427, 541, 554, 567, 955, 1069, 1082, 1094, 1483, 1597, 1610]) + s_suppkey % 3 AS pos, unnest([0, 1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0]) AS div FROM supplier), u AS (SELECT page, pos FROM r WHERE NOT (page % 5 = 0 AND div = 1)),
 n AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= greatest(4, (max(pos) OVER (PARTITION BY page) - min(pos) OVER (PARTITION BY page)) * 0.03) THEN 0 ELSE 1 END AS s FROM u WINDOW w AS (PARTITION BY page ORDER BY pos)), c AS (SELECT page, pos, sum(s) OVER (PARTITION BY page ORDER BY pos ROWS UNBOUNDED PRECEDING) AS c FROM n)
 SELECT page, c::BIGINT - 1 AS k, min(pos) AS first, max(pos) AS last FROM c GROUP BY ALL""")
def rule_clusters(spark, d):
    out = grid.rule_clusters(_rules(spark, d), ["part", "page"], "at")
    return out.select("page", F.posexplode("clusters").alias("k", "c")).select("page", F.col("k").cast("long").alias("k"), "c.first", "c.last")


@query("""SELECT s_suppkey AS page, c AS col, CASE c WHEN 0 THEN 39 WHEN 1 THEN 567 ELSE 1094 END + s_suppkey % 3 AS "left", CASE WHEN s_suppkey % 5 <> 0 THEN CASE c WHEN 0 THEN 427 WHEN 1 THEN 955 ELSE 1483 END ELSE CASE c WHEN 0 THEN 39 + floor(502 * 0.773) WHEN 1 THEN 567 + floor(502 * 0.773) ELSE 1094 + floor(503 * 0.773) END END::BIGINT + s_suppkey % 3 AS divider,
 CASE c WHEN 0 THEN 541 WHEN 1 THEN 1069 ELSE 1597 END + s_suppkey % 3 AS "right" FROM supplier, range(3) t(c)""")
def box_columns(spark, d):
    out = grid.box_columns(grid.rule_clusters(_rules(spark, d), ["part", "page"], "at"), ["part", "page"])
    return out.select("page", F.col("col").cast("long").alias("col"), "left", "divider", "right")


@query("""WITH b AS (SELECT s_suppkey % 10 AS part, s_suppkey AS page, c::INTEGER AS col, CASE c WHEN 0 THEN 39 WHEN 1 THEN 567 ELSE 1094 END + s_suppkey % 3 AS "left", CASE WHEN c = 0 THEN 427 WHEN c = 1 THEN 955 WHEN s_suppkey % 5 = 0 THEN 1482 ELSE 1483 END + s_suppkey % 3 AS divider, CASE c WHEN 0 THEN 541 WHEN 1 THEN 1069 ELSE 1597 END + s_suppkey % 3 AS "right" FROM supplier, range(3) t(c) WHERE s_suppkey % 7 <> 0),
 u AS (SELECT part, col, 'left' AS side, "left" AS v FROM b UNION ALL SELECT part, col, 'divider', divider FROM b UNION ALL SELECT part, col, 'right', "right" FROM b),
 n AS (SELECT a.part, a.col, a.side, a.v, count(*) AS n FROM (SELECT DISTINCT * FROM u) a JOIN u o ON o.part = a.part AND o.col = a.col AND o.side = a.side AND abs(a.v - o.v) <= 2 GROUP BY ALL),
 t AS (SELECT part, col, side, first(v ORDER BY n DESC, v) AS v FROM n GROUP BY ALL), w AS (SELECT part, col, max(v) FILTER (side = 'left') AS "left", max(v) FILTER (side = 'divider') AS divider, max(v) FILTER (side = 'right') AS "right" FROM t GROUP BY ALL)
 SELECT part, page, col, "left", divider, "right", true AS own FROM b UNION ALL SELECT w.part, s_suppkey, col, "left", divider, "right", false FROM supplier JOIN w ON w.part = s_suppkey % 10 WHERE s_suppkey % 7 = 0""")
def recovered_pages(spark, d):
    """Pages whose columns can't be read take the ones that their part's full pages share."""
    boxes = grid.box_columns(grid.rule_clusters(_rules(spark, d).filter("page % 7 <> 0 OR at < 900"), ["part", "page"], "at"), ["part", "page"])
    pages = _rules(spark, d).select("part", "page").distinct()
    return grid.recovered_columns(boxes, pages, ["part"], "page", 2.0)


@query("""SELECT s_suppkey // 11 AS part, s_suppkey AS page, CASE WHEN s_suppkey % 11 = 3 THEN 'left' WHEN s_suppkey % 11 = 5 AND s_suppkey % 2 = 0 THEN 'left' WHEN s_suppkey % 11 = 5 THEN 'promoted' WHEN s_suppkey % 11 = 7 THEN 'left' WHEN s_suppkey % 11 = 9 THEN 'inherited' ELSE 'own' END AS how FROM supplier""")
def promoted_pages(spark, d):
    """Pages of parts: full ones, closing tables, a last page that draws only the first column (and, on every second one,
    no rows), info pages, and pages with a stray rule for a divider."""
    k = F.col("s_suppkey")
    jitter = (k % 3).cast("double")
    rules = lambda *at: F.transform(F.array(*map(F.lit, at)), lambda x: x + jitter)
    full = rules(39.0, 427.0, 541.0, 554.0, 567.0, 955.0, 1069.0, 1082.0, 1094.0, 1483.0, 1597.0, 1610.0)
    stray = rules(39.0, 101.0, 541.0, 554.0, 567.0, 955.0, 1069.0, 1082.0, 1094.0, 1483.0, 1597.0, 1610.0)
    v = F.when(k % 11 == 3, rules(300.0, 800.0, 1400.0)).when(k % 11 == 5, rules(39.0, 427.0, 554.0)).when(k % 11 == 9, stray).otherwise(full)
    h = F.when((k % 11 == 5) & (k % 2 == 0), F.array(F.lit(100.0), F.lit(180.0))).otherwise(F.array(*map(F.lit, (500.0, 915.0, 940.0, 1355.0))))
    pages = table(spark, d, "supplier").select(F.floor(k / 11).alias("part"), k.alias("page"), (k % 11).alias("m"), h.alias("h"), v.alias("v"))
    return grid.recover_pages(pages, "part", "page", ~F.col("m").isin(3, 5, 7), F.col("m") == 7, "h", "v").select("part", "page", "how")
