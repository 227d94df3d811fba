"""The check battery of part records and the invariants of a release, over records that the orders' keys are turned into."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators import checks as C
from tallyspark.operators import modes
from tallyspark.operators import reconcile as V
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

#: Each column of a record out of an order's key k, as an expression that both engines read alike.
_RECORD = {
    "ac_no": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 11 = 1 THEN 'x' ELSE concat(' ', CAST(k % 130 AS STRING)) END",
    "part_no": "CASE WHEN k % 13 = 4 THEN '' ELSE CAST(k % 40 AS STRING) END",
    "ac_no_file": "k % 130 + CASE WHEN k % 17 = 3 THEN 1 ELSE 0 END",
    "part_no_file": "k % 40",
    "electors_male": "k % 50",
    "electors_female": "CASE WHEN k % 19 <> 5 THEN k % 60 END",
    "electors_third_gender": "k % 2",
    "electors_total": "k % 50 + k % 60 + k % 2 + CASE WHEN k % 23 = 7 THEN 1 ELSE 0 END",
    "start_serial": "CASE WHEN k % 37 = 9 THEN 200 ELSE 1 END",
    "end_serial": "CASE WHEN k % 31 <> 1 THEN k % 50 + k % 60 + k % 2 - CASE WHEN k % 29 = 3 THEN 2 ELSE 0 END END",
    "pin_code": "CASE k % 5 WHEN 0 THEN concat('78', lpad(CAST(k % 10000 AS STRING), 4, '0')) WHEN 1 THEN ' 793001 ' WHEN 2 THEN '110001' WHEN 3 THEN '78 012' END",
    "qualifying_date": "CASE WHEN k % 9 = 2 THEN '2025-01-01' ELSE '2026-01-01' END",
    "publication_date": "CASE WHEN k % 9 = 4 THEN NULL WHEN k % 9 = 5 THEN '' ELSE '2026-02-10' END",
    "revision_year": "CASE WHEN k % 7 = 1 THEN 2025 ELSE 2026 END",
    "district": "CASE WHEN k % 12 = 7 THEN '' WHEN k % 6 = 5 THEN 'D9' ELSE concat('D', CAST(k % 130 % 7 AS STRING)) END",
    "ps_name": "CASE WHEN k % 6 = 1 THEN '  ' ELSE concat('P', CAST(k AS STRING)) END",
    "ps_address": "CASE WHEN k % 8 <> 3 THEN 'A' END",
    "template_match": "CASE k % 8 WHEN 0 THEN 'True' WHEN 1 THEN NULL WHEN 2 THEN 'false' WHEN 3 THEN '' ELSE 'true' END",
    "extraction_confidence": "CASE WHEN k % 10 = 3 THEN 'low' WHEN k % 10 = 4 THEN NULL ELSE 'HIGH' END",
    "lang": "CASE WHEN k % 3 = 0 THEN 'ASM' WHEN k % 3 = 1 THEN ' ' ELSE 'BEN' END",
}
_MODES = ("qualifying_date", "publication_date", "revision_year")


def _checked(spark, d) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).select("k", *(F.expr(e).alias(n) for n, e in _RECORD.items()))
    found = modes.modal_table(rows, {**dict.fromkeys(_MODES), "district": "ac_no_file"}, ["k"])
    # an aggregate gives its row even where no value is known
    whole = found.filter("scope = ''").agg(*(F.max(F.when(F.col("field") == n, F.col("mode"))).cast(rows.schema[n].dataType).alias(f"m_{n}") for n in _MODES))
    district = found.filter("field = 'district'").select(F.col("scope").cast("long").alias("ac_no_file"), F.col("mode").alias("m_district"))
    rows = rows.join(F.broadcast(whole)).join(district, "ac_no_file", "left")
    rows = rows.withColumn("m_parts", F.when(F.col("ac_no_file") % 7 != 0, 20 + F.col("ac_no_file") % 30))
    battery = C.part_battery({"parts_per_ac": F.col("m_parts"), "district": F.col("m_district"), **{n: F.col(f"m_{n}") for n in _MODES}})
    return C.roll_up(C.run_checks(rows, battery), review=C.REVIEWED)


_INT = lambda x: f"CASE WHEN regexp_matches(trim({x}::VARCHAR), '^[+-]?[0-9]+$') THEN trim({x}::VARCHAR)::BIGINT END"
_RULES = [
    ("ac_no_matches_filename", f"{_INT('ac_no')} = ac_no_file", "true"),
    ("part_no_matches_filename", f"{_INT('part_no')} = part_no_file", "true"),
    ("gender_sum_matches_total", "electors_male + electors_female + electors_third_gender = electors_total", "true"),
    ("serial_order", "end_serial >= start_serial", "true"),
    ("serial_span_covers_total", "end_serial - start_serial + 1 >= electors_total", "electors_total IS NOT NULL AND start_serial IS NOT NULL AND end_serial IS NOT NULL"),
    ("pin_code_plausible", "regexp_full_match(trim(coalesce(pin_code, '')), '7[89][0-9]{4}')", "true"),
    ("ac_no_in_range", f"({_INT('ac_no')}) BETWEEN 1 AND 126", "true"),
    ("part_no_within_ac", f"({_INT('part_no')}) BETWEEN 1 AND m_parts", f"m_parts IS NOT NULL AND ({_INT('part_no')}) IS NOT NULL"),
    *((f"{n}_matches_corpus", f"{n} = m_{n}", f"m_{n} IS NOT NULL") for n in _MODES),
    ("district_matches_ac_mode", "district = m_district", "m_district IS NOT NULL"),
    *((f"{n}_present", f"trim(coalesce({n}, '')) <> ''", "true") for n in ("ps_name", "district", "ps_address")),
    ("template_match", "template_match IN ('true', 'True', '')", "true"),
    ("confidence_not_low", "upper(coalesce(extraction_confidence, '')) <> 'LOW'", "true"),
]
_HARD = [n for n, _, _ in _RULES[:4]]
_PART_SQL = (
    "WITH o AS (SELECT o_orderkey AS k FROM orders), p AS (SELECT k, "
    + ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS {n}" for n, e in _RECORD.items())
    + "), "
    + ", ".join(f"mode_{n} AS (SELECT {n} AS m_{n} FROM p WHERE coalesce({n}::VARCHAR, '') <> '' GROUP BY 1 ORDER BY count(*) DESC, min(k) LIMIT 1)" for n in _MODES)
    + ", md AS (SELECT ac_no_file, district AS m_district FROM (SELECT *, row_number() OVER (PARTITION BY ac_no_file ORDER BY c DESC, f) AS r FROM (SELECT ac_no_file, district, count(*) AS c, min(k) AS f FROM p WHERE district <> '' GROUP BY ALL)) WHERE r = 1)"
    + ", q AS (SELECT p.*, m_district, "
    + ", ".join(f"m_{n}" for n in _MODES)
    + ", CASE WHEN p.ac_no_file % 7 <> 0 THEN 20 + p.ac_no_file % 30 END AS m_parts FROM p LEFT JOIN md USING (ac_no_file) "
    + " ".join(f"LEFT JOIN mode_{n} ON true" for n in _MODES)
    + "), c AS (SELECT *, list_filter(["
    + ", ".join(f"CASE WHEN {runs} AND NOT coalesce({ok}, false) THEN '{n}' END" for n, ok, runs in _RULES)
    + "], lambda x: x IS NOT NULL) AS bad, "
    + " + ".join(f"CASE WHEN {runs} THEN 1 ELSE 0 END" for _, _, runs in _RULES)
    + " AS n FROM q), r AS (SELECT *, len(list_filter(bad, lambda x: x IN ("
    + ", ".join(f"'{n}'" for n in (*_HARD, *C.REVIEWED))
    + "))) > 0 AS needs_review FROM c) "
)


@query(_PART_SQL.replace("(SELECT k, ", "(SELECT o.k, ").replace(" AS lang), ", " AS lang FROM o), ") + "SELECT k, (n - len(bad))::INTEGER AS checks_passed, n::INTEGER AS checks_total, array_to_string(list_sort(bad), ';') AS flags, needs_review FROM r")
def part_battery(spark, d):
    """The seventeen checks of a part record."""
    return _checked(spark, d).select("k", "checks_passed", "checks_total", "flags", "needs_review")


_SHOWN = ["ac_no_matches_filename", "part_no_matches_filename", "gender_sum_matches_total", "serial_span_covers_total"]


@query(_PART_SQL.replace("(SELECT k, ", "(SELECT o.k, ").replace(" AS lang), ", " AS lang FROM o), ") + """SELECT CASE WHEN grouping(g) = 1 THEN 'overall' ELSE 'group' END AS grain, CASE WHEN grouping(g) = 1 THEN '' ELSE g END AS lang, count(*) AS n, count(*) FILTER (needs_review) AS review, count(*) FILTER (len(bad) = 0) AS clean, """ + ", ".join(f"round_even(avg(CASE WHEN list_contains(bad, '{n}') THEN 0.0 ELSE 1.0 END), 4) AS no_{n}" for n in _SHOWN) + " FROM (SELECT *, coalesce(nullif(trim(lang), ''), 'UNKNOWN') AS g FROM r) GROUP BY GROUPING SETS ((), (g))")
def part_battery_summary(spark, d):
    """Agreement rates overall and by language; a blank language is UNKNOWN."""
    return C.summary(_checked(spark, d), "lang", _SHOWN)


@query("""WITH l AS (SELECT *, l_orderkey % 50 AS ac FROM lineitem), o AS (SELECT *, o_orderkey % 50 AS ac FROM orders), v AS (
 SELECT 'shipped' AS i, 1 AS x FROM l WHERE l_shipdate IS NULL
 UNION ALL SELECT 'quantity range', 1 FROM l WHERE NOT coalesce(l_quantity BETWEEN 1 AND 48, false) UNION ALL SELECT 'returned is closed', 1 FROM l WHERE (l_returnflag = 'R') <> (l_linestatus = 'F' AND l_returnflag = 'R')
 UNION ALL SELECT 'open lines carry no tax over 7 %', 1 FROM l WHERE l_linestatus = 'O' AND l_tax > 0.07 UNION ALL SELECT 'flags and review', 1 FROM o WHERE (o_orderstatus = 'P') <> (o_orderpriority = '1-URGENT')
 UNION ALL SELECT 'status domain', 1 FROM (SELECT DISTINCT o_orderstatus AS s FROM orders) WHERE s NOT IN ('F', 'O') UNION ALL SELECT 'one date', 1 FROM l GROUP BY l_orderkey HAVING count(DISTINCT l_shipdate) > 1
 UNION ALL SELECT 'line numbers', 1 FROM l GROUP BY l_orderkey HAVING min(l_linenumber) <> 1 OR max(l_linenumber) <> count(*) OR count(DISTINCT l_linenumber) <> count(*)
 UNION ALL SELECT 'unique lines', 1 FROM l GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
 UNION ALL SELECT 'part and supplier', 1 FROM (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM l) GROUP BY a HAVING count(*) > 1 UNION ALL SELECT 'part and supplier', 1 FROM (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM l) GROUP BY b HAVING count(*) > 1
 UNION ALL SELECT 'claimed lines', 1 FROM (SELECT o_orderkey AS k, o_orderkey % 8 AS c FROM orders) c FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM l GROUP BY 1) n ON c.k = n.k WHERE coalesce(n, 0) IS DISTINCT FROM c
 UNION ALL SELECT 'coverage', 1 FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM l)) UNION ALL SELECT 'coverage', 1 FROM (SELECT DISTINCT l_orderkey FROM l WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
 UNION ALL SELECT 'priority filled', 1 FROM o GROUP BY ac HAVING avg(CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 1.0 ELSE 0.0 END) < 0.85 UNION ALL SELECT 'text once', 1 FROM documents WHERE text IS NOT NULL GROUP BY sha256(text) HAVING count(DISTINCT doc_id) > 1)
 SELECT i AS invariant, count(*) AS n FROM v GROUP BY 1""")
def release_catalogue(spark, d):
    """How often each invariant of a release is broken; no rows would be a pass. Lines and orders are grouped once by order,
    and what both say of an order meets in one join."""
    c, k = F.col, F.col("l_orderkey")
    lines = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").withColumn("ac", c("o_orderkey") % 50).withColumn("priority", F.when(c("o_orderpriority") != "3-MEDIUM", c("o_orderpriority")))
    docs = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("sha"))
    ok = {"shipped": c("l_shipdate").isNotNull(), "quantity range": c("l_quantity").between(1, 48), "returned is closed": (c("l_returnflag") == "R") == ((c("l_linestatus") == "F") & (c("l_returnflag") == "R")), "open lines carry no tax over 7 %": (c("l_linestatus") != "O") | (c("l_tax") <= 0.07)}
    broken = {n: F.count_if(~F.coalesce(x, F.lit(False))) for n, x in ok.items()}
    numbers = lines.repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), *(x.alias(n) for n, x in broken.items()))
    per_order = numbers.groupBy("l_orderkey").agg(
        F.sum("n").alias("rows"), F.count_if(c("n") > 1).alias("unique lines"), (F.min("first") != F.max("last")).cast("long").alias("one date"), *(F.sum(f"`{n}`").alias(n) for n in broken),
        ((F.min("l_linenumber") != 1) | (F.max("l_linenumber") != F.sum("n")) | (F.count("*") != F.sum("n"))).cast("long").alias("line numbers"),
    )
    both = per_order.join(orders.groupBy("o_orderkey").agg(F.max(c("o_orderkey") % 8).alias("claimed")), c("o_orderkey") == k, "full").withColumn("id", F.coalesce(k, c("o_orderkey")))
    rules = [*((n, F.max(f"`{n}`")) for n in ("unique lines", "one date", "line numbers", *broken)), ("claimed lines", F.max((~F.coalesce("rows", F.lit(0)).eqNullSafe(c("claimed"))).cast("long"))), ("coverage", F.max((k.isNull() | c("o_orderkey").isNull()).cast("long")))]
    filled = F.avg(F.when(c("priority").isNotNull(), 1.0).otherwise(0.0))
    found = V.by_group(both, ["id"], rules).unionByName(V.by_group(orders, ["ac"], [("flags and review", F.count_if(~F.coalesce((c("o_orderstatus") == "P") == (c("o_orderpriority") == "1-URGENT"), F.lit(False)))), ("priority filled", F.when(filled < 0.85, 1))]))
    rest = [V.outside(orders, "o_orderstatus", ["F", "O"], "status domain"), V.not_one_to_one(lines, "l_partkey", "l_suppkey", "part and supplier"), V.shared_across(docs, "sha", "doc_id", "text once")]
    every = reduce(DataFrame.unionByName, [r.withColumn("n", F.lit(1).cast("long")) for r in rest], found)
    return every.groupBy("invariant").agg(F.sum("n").alias("n"))
