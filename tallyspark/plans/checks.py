"""Check batteries, floors, fill rates, distributions and duplicates over the graded tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions import text as T
from tallyspark.operators import checks as C
from tallyspark.operators import modes, quality
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

_CHECKED = """
o AS (SELECT o.*, l.n, l.qty, l.price FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS qty, sum(l_extendedprice) AS price FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey),
c AS (SELECT *, n IS NOT NULL AND n > 0 AS has_lines, coalesce(n <= 6, false) AS few_lines, coalesce(price >= o_totalprice, false) AS price_covers, o_orderstatus IN ('F', 'O', 'P') AS known_status FROM o),
k AS (SELECT *, CASE WHEN n IS NOT NULL THEN 4 ELSE 2 END AS checks_total,
  list_filter([CASE WHEN n IS NOT NULL AND NOT few_lines THEN 'few_lines' END, CASE WHEN NOT has_lines THEN 'has_lines' END, CASE WHEN NOT known_status THEN 'known_status' END, CASE WHEN n IS NOT NULL AND NOT price_covers THEN 'price_covers' END], lambda x: x IS NOT NULL) AS bad FROM c)
"""


def _checked(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("price"))
    rows = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    has = F.col("n").isNotNull()
    battery = [
        C.Check("has_lines", "hard", has & (F.col("n") > 0)),
        C.Check("few_lines", "soft", F.col("n") <= 6, has),
        C.Check("price_covers", "soft", F.col("price") >= F.col("o_totalprice"), has),
        C.Check("known_status", "hard", F.col("o_orderstatus").isin("F", "O", "P")),
    ]
    return C.roll_up(C.run_checks(rows, battery))


@query(f"WITH {_CHECKED} SELECT o_orderkey, CAST(checks_total - len(bad) AS INTEGER) AS checks_passed, CAST(checks_total AS INTEGER) AS checks_total, array_to_string(bad, ';') AS flags, NOT has_lines OR NOT known_status AS needs_review FROM k")
def check_battery(spark, d):
    return _checked(spark, d).select("o_orderkey", "checks_passed", "checks_total", "flags", "needs_review")


@query(f"""WITH {_CHECKED}, r AS (SELECT *, NOT has_lines OR NOT known_status AS review FROM k)
SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'overall' ELSE 'group' END AS grain, CASE WHEN grouping(o_orderpriority) = 1 THEN '' ELSE o_orderpriority END AS o_orderpriority, count(*) AS n,
 count(*) FILTER (review) AS review, count(*) FILTER (len(bad) = 0) AS clean, round_even(avg(CASE WHEN list_contains(bad, 'few_lines') THEN 0.0 ELSE 1.0 END), 4) AS no_few_lines, round_even(avg(CASE WHEN list_contains(bad, 'price_covers') THEN 0.0 ELSE 1.0 END), 4) AS no_price_covers
FROM r GROUP BY GROUPING SETS ((), (o_orderpriority))""")
def part_checks_summary(spark, d):
    return C.summary(_checked(spark, d), "o_orderpriority", ["few_lines", "price_covers"])


@query("""WITH c AS (SELECT p_brand, p_type, count(*) AS n, min(p_partkey) AS f FROM part WHERE p_type <> '' GROUP BY ALL),
 r AS (SELECT *, n / sum(n) OVER (PARTITION BY p_brand) AS share, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, f) AS k FROM c)
 SELECT p_brand, p_type AS mode, n, share FROM r WHERE k = 1""")
def modes_by_group(spark, d):
    return modes.modal(table(spark, d, "part"), "p_type", ["p_partkey"], ["p_brand"])


@query("WITH c AS (SELECT c_mktsegment AS mode, count(*) AS n, min(c_custkey) AS f FROM customer WHERE c_mktsegment <> '' GROUP BY 1) SELECT mode, n, n / (SELECT sum(n) FROM c) AS share FROM c ORDER BY n DESC, f LIMIT 1")
def mode_overall(spark, d):
    return modes.modal(table(spark, d, "customer"), "c_mktsegment", ["c_custkey"])


_ROWS = "SELECT d.doc_id, d.lang, d.text, l.quality, l.toxic, CAST(d.n_chars % 150 AS INTEGER) AS age FROM documents d LEFT JOIN labels l USING (doc_id)"


def _rows(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select("doc_id", "lang", "text", "quality", "toxic", (F.col("n_chars") % 150).cast("int").alias("age"))


@query(f"""WITH r AS ({_ROWS}), f AS (SELECT unnest(['quality', 'toxic', 'age']) AS field, unnest([quality::VARCHAR, toxic::VARCHAR, age::VARCHAR]) AS v FROM r),
 m AS (SELECT unnest(['truthy', 'nonblank', 'nonblank_nonzero']) AS mode)
 SELECT mode, field, sum(CASE WHEN v IS NULL OR v = '' THEN 0 WHEN mode <> 'nonblank' AND v = '0' THEN 0 ELSE 1 END)::BIGINT AS filled, count(*) AS n,
 sum(CASE WHEN v IS NULL OR v = '' THEN 0 WHEN mode <> 'nonblank' AND v = '0' THEN 0 ELSE 1 END) / count(*) AS rate FROM f, m GROUP BY ALL""")
def fill_rates_three_ways(spark, d):
    rows, out = _rows(spark, d), None
    for mode in ("truthy", "nonblank", "nonblank_nonzero"):
        one = quality.fill_rates(rows, ["quality", "toxic", "age"], mode).withColumn("mode", F.lit(mode))
        out = one if out is None else out.unionByName(one)
    return out


_PROBLEMS = """[CASE WHEN regexp_matches(text, '[0-9]') THEN 'text_has_digits' END, CASE WHEN length(text) NOT BETWEEN 50 AND 20000 THEN 'text_implausible_length' END,
 CASE WHEN age IS NOT NULL AND age NOT BETWEEN 18 AND 120 THEN 'age_out_of_range' END, CASE WHEN lang <> 'en' AND regexp_matches(text, 'http') THEN 'text_has_link' END]"""


def _with_problems(spark, d):
    c = F.col
    return _rows(spark, d).withColumn(
        "problems",
        C.problem_list([
            ("text_has_digits", c("text").rlike("[0-9]")),
            ("text_implausible_length", ~F.length("text").between(50, 20000)),
            ("age_out_of_range", c("age").isNotNull() & ~c("age").between(18, 120)),
            ("text_has_link", (c("lang") != "en") & c("text").contains("http")),
        ]),
    )


@query(f"WITH r AS ({_ROWS}) SELECT doc_id, array_to_string(list_filter({_PROBLEMS}, lambda x: x IS NOT NULL), ',') AS problems FROM r")
def problem_lists(spark, d):
    return _with_problems(spark, d).select("doc_id", F.array_join("problems", ",").alias("problems"))


@query(f"WITH r AS ({_ROWS}), p AS (SELECT unnest({_PROBLEMS}) AS problem FROM r) SELECT problem, count(*) AS n FROM p WHERE problem IS NOT NULL GROUP BY 1")
def definite_errors(spark, d):
    return C.battery_counts(_with_problems(spark, d))


@query(f"""WITH r AS ({_ROWS}), p AS (SELECT *, list_filter({_PROBLEMS}, lambda x: x IS NOT NULL) AS ps FROM r),
 f AS (SELECT unnest(['text', 'age', 'quality']) AS field, unnest([text, age::VARCHAR, quality::VARCHAR]) AS v, ps FROM p)
 SELECT field, count(*) FILTER (v IS NOT NULL AND v <> '' AND v <> '0' AND len(list_filter(ps, lambda x: contains(x, field))) = 0) AS sound, count(*) AS n, count(*) FILTER (v IS NOT NULL AND v <> '' AND v <> '0' AND len(list_filter(ps, lambda x: contains(x, field))) = 0) / count(*) AS rate FROM f GROUP BY 1""")
def sound_rates(spark, d):
    return quality.sound_rates(_with_problems(spark, d), ["text", "age", "quality"])


_FLOOR = """
v AS (SELECT lang, source, doc_id, text, CAST(n_chars % 150 AS INTEGER) AS age FROM documents),
f AS (SELECT lang, detector, hit, seen, example FROM (SELECT lang, unnest(['latin_only', 'shouting', 'age', 'label_edge']) AS detector,
  unnest([lang <> 'en' AND NOT regexp_matches(text, '[^ -~\\n]'), regexp_matches(text, '^[A-Z]{4}'), age NOT BETWEEN 18 AND 120, regexp_matches(text, '(?i)^\\s*(the|le|der)([^A-Za-z]|$)')]) AS hit,
  unnest([lang <> 'en', true, true, true]) AS seen, unnest([source, source, age::VARCHAR, lang]) AS example FROM v))
"""


def _detectors():
    c, text = F.col, F.col("text")
    return [
        quality.Detector("latin_only", ~text.rlike(r"[^ -~\n]"), c("lang") != "en", c("source")),
        quality.Detector("shouting", text.rlike("^[A-Z]{4}"), F.lit(True), c("source")),
        quality.Detector("age", ~c("age").between(18, 120), F.lit(True), c("age")),
        quality.Detector("label_edge", text.rlike(r"(?i)^\s*(the|le|der)([^A-Za-z]|$)"), F.lit(True), c("lang")),
    ]


@query(f"""WITH {_FLOOR}, e AS (SELECT lang, detector, list(DISTINCT example ORDER BY example)[1:4] AS examples FROM f WHERE hit AND seen GROUP BY ALL),
 g AS (SELECT lang, detector, count(*) FILTER (hit AND seen) AS condemned, count(*) FILTER (seen) AS total FROM f GROUP BY ALL)
 SELECT g.lang, g.detector, condemned, total, CASE WHEN total > 0 THEN condemned / total ELSE 0 END AS rate, coalesce(array_to_string(examples, ','), '') AS examples FROM g LEFT JOIN e USING (lang, detector)""")
def floor_detectors(spark, d):
    rows = table(spark, d, "documents").withColumn("age", (F.col("n_chars") % 150).cast("int"))
    return quality.floor_scan(rows, _detectors(), ["lang"]).withColumn("examples", F.array_join("examples", ","))


@query(f"WITH {_FLOOR} SELECT detector, count(*) FILTER (hit AND seen) AS condemned, count(*) FILTER (seen) AS total, CASE WHEN count(*) FILTER (seen) > 0 THEN count(*) FILTER (hit AND seen) / count(*) FILTER (seen) ELSE 0 END AS rate FROM f GROUP BY 1")
def floor_combined(spark, d):
    rows = table(spark, d, "documents").withColumn("age", (F.col("n_chars") % 150).cast("int"))
    return quality.combine_floors(quality.floor_scan(rows, _detectors(), ["lang"]))


@query("""WITH n AS (SELECT text, count(*) AS n FROM documents WHERE text <> '' GROUP BY 1), w AS (SELECT * FROM n WHERE regexp_matches(text, '^[A-Z]'))
 SELECT 'all' AS variant, sum(n - 1)::BIGINT AS surplus, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_in_repeats, count(*) FILTER (n > 1) AS repeated, sum(n)::BIGINT AS non_empty FROM n
 UNION ALL SELECT 'well_formed', sum(n - 1)::BIGINT, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT, count(*) FILTER (n > 1), sum(n)::BIGINT FROM w""")
def duplicate_counts(spark, d):
    docs = table(spark, d, "documents")
    return quality.duplicates(docs, "text").withColumn("variant", F.lit("all")).unionByName(quality.duplicates(docs, "text", "^[A-Z]").withColumn("variant", F.lit("well_formed")))


@query("WITH g AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL) SELECT count(*) AS groups, count(*) FILTER (n = 1) AS single, count(*) FILTER (n = 1) / count(*) AS share FROM g")
def single_occupants(spark, d):
    return quality.single_occupants(table(spark, d, "lineitem"), ["l_suppkey", "l_partkey"])


@query("SELECT CAST(floor(l_quantity / 10) * 10 AS INTEGER) AS decade, count(*) AS n FROM lineitem GROUP BY 1")
def decade_histogram(spark, d):
    return quality.histogram(table(spark, d, "lineitem"), (F.floor(F.col("l_quantity") / 10) * 10).cast("int"), "decade")


@query("WITH d AS (SELECT CAST(l_quantity AS BIGINT) % 10 AS k FROM lineitem), c AS (SELECT r.k, count(d.k) AS n FROM range(10) r(k) LEFT JOIN d ON d.k = r.k GROUP BY 1) SELECT sum(n)::BIGINT AS n, (max(n) - min(n)) / sum(n) AS spread FROM c")
def last_digit_spread(spark, d):
    return quality.digit_spread(table(spark, d, "lineitem"), F.col("l_quantity"))


@query("WITH a AS (SELECT o_custkey, list(o_totalprice ORDER BY o_totalprice) AS x FROM orders GROUP BY 1) SELECT o_custkey, len(x) AS n, x[len(x) // 2 + 1] AS upper_median FROM a")
def upper_medians(spark, d):
    return modes.upper_medians(table(spark, d, "orders"), ["o_custkey"], "o_totalprice")


@query("""WITH v AS (SELECT p_brand, p_partkey, p_retailprice, (SELECT count(*) FROM part q WHERE q.p_brand = p.p_brand AND q.p_retailprice BETWEEN p.p_retailprice - 25 AND p.p_retailprice + 25) AS neighbours FROM part p)
 SELECT p_brand, p_retailprice AS mode, neighbours FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY neighbours DESC, p_partkey) AS k FROM v) WHERE k = 1""")
def tolerance_modes(spark, d):
    return modes.tolerance_mode(table(spark, d, "part"), "p_retailprice", ["p_brand"], 25.0, "p_partkey")


@query("SELECT doc_id, regexp_matches(text, '(?i)^\\s*(the|of|and)([^A-Za-z]|$)') OR regexp_matches(text, '(?i)(^|[^A-Za-z])(the|of|and)\\s*$') AS leaked FROM documents")
def leaked_labels(spark, d):
    return table(spark, d, "documents").select("doc_id", T.leaked_label("text", ["the", "of", "and"]).alias("leaked"))
