"""Roll-ups of runs, costs and second readings, and the small row predicates around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import checks as C
from tallyspark.operators import predicates as P
from tallyspark.operators import rollups as R
from tallyspark.operators import sampling
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table

_PARTS = "p AS (SELECT o_orderkey AS k, o_custkey AS ac, count(l_orderkey) AS found, CASE WHEN o_orderkey % 13 <> 5 THEN 1 + o_orderkey % 5 END AS printed, count(*) FILTER (l_returnflag = 'N') / greatest(count(l_orderkey), 1) AS share FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)"


def _parts(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == k, "left")
    out = rows.groupBy(k.alias("k"), F.col("o_custkey").alias("ac")).agg(F.count("l_orderkey").alias("found"), F.count_if(F.col("l_returnflag") == "N").alias("_n"))
    return out.select("k", "ac", "found", F.when(F.col("k") % 13 != 5, 1 + F.col("k") % 5).alias("printed"), (F.col("_n") / F.greatest("found", F.lit(1))).alias("share"))


@query(f"""WITH {_PARTS}, g AS (SELECT *, found - printed AS gap FROM p), s AS (SELECT avg(gap) AS m, stddev_pop(gap) AS sd FROM g)
 SELECT count(*) AS parts, count(printed) AS measured, count(*) FILTER (gap = 0) AS matches, sum(found)::BIGINT AS rows, sum(printed)::BIGINT AS printed, round(avg(share), 9) AS mean_share, round(avg(gap), 9) AS mean_gap, round(any_value(sd), 9) AS sd_gap, count(*) FILTER (sd > 0 AND abs(gap - m) > 2 * sd) AS outliers FROM g, s""")
def corpus_summary(spark, d):
    out = R.corpus_summary(_parts(spark, d), "found", "printed", F.col("share"), sigmas=2.0)
    return out.withColumns({c: F.round(c, 9) for c in ("mean_share", "mean_gap", "sd_gap")})


@query(f"""WITH {_PARTS}, a AS (SELECT ac, count(*) AS parts, count(*) FILTER (found > 0) AS done, sum(found)::BIGINT AS rows, coalesce(sum(printed), 0)::BIGINT AS printed FROM p GROUP BY 1)
 SELECT *, CASE WHEN done = 0 THEN 'empty' WHEN done < parts THEN 'partial' WHEN abs(rows - printed) > 0.2 * printed THEN 'off' ELSE 'done' END AS verdict FROM a""")
def status_rollup(spark, d):
    return R.status_rollup(_parts(spark, d), ["ac"], F.col("found") > 0, F.col("found"), F.col("printed"), 0.2)


@query(f"""WITH {_PARTS} SELECT count(*) AS parts, count(*) FILTER (found = 0) AS failed, sum(found)::BIGINT AS rows, sum(printed)::BIGINT AS pages, sum(ceil(found / 4))::BIGINT AS billed, round(sum(ceil(found / 4)) * 0.0015, 9) AS dollars FROM p""")
def run_summary(spark, d):
    out = R.run_summary(_parts(spark, d), F.col("found") == 0, "found", "printed", F.ceil(F.col("found") / 4), 0.0015)
    return out.withColumn("dollars", F.round("dollars", 9))


@query(f"WITH {_PARTS} SELECT ac, count(*) AS parts, count(printed) AS measured, sum(printed)::BIGINT AS total FROM p GROUP BY 1")
def published_totals(spark, d):
    return R.published_totals(_parts(spark, d).select("k", "ac", "printed"), ["k"], ["ac"], "printed")


@query("SELECT source, count(*) AS calls, round(sum(length(text)) * 0.3 / 1000000 + sum(n_chars) * 2.5 / 1000000, 6) AS cost FROM documents GROUP BY 1")
def usage_costs(spark, d):
    calls = table(spark, d, "documents").select("source", F.length("text").alias("read"), F.col("n_chars").alias("written"))
    return R.usage_cost(calls, ["source"], {"read": 0.3, "written": 2.5}).withColumn("cost", F.round("cost", 6))


@query("SELECT user_id, sum(ceil(k / 30))::BIGINT AS images FROM (SELECT user_id, event_type, count(*) AS k FROM events GROUP BY ALL) GROUP BY 1")
def images_billed(spark, d):
    """Composites of thirty boxes, summed over the parts of each user."""
    boxes = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("k"))
    return boxes.groupBy("user_id").agg(F.sum(F.ceil(F.col("k") / 30)).alias("images"))


_FLEET = """s AS (SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'done' WHEN bool_or(event_type = 'signup') THEN 'running' ELSE 'waiting' END AS state FROM events GROUP BY 1), c AS (SELECT user_id, event_id % 5 AS host FROM events WHERE event_type = 'signup'), u AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error')"""


@query(f"""WITH {_FLEET} SELECT 'state ' || state AS metric, count(*) AS value FROM s GROUP BY 1 UNION ALL SELECT 'machines', count(DISTINCT host) FROM c UNION ALL SELECT 'claimed twice', count(*) FROM (SELECT user_id FROM c GROUP BY 1 HAVING count(DISTINCT host) > 1)
 UNION ALL SELECT 'not uploaded', count(*) FROM s WHERE state = 'done' AND user_id NOT IN (SELECT user_id FROM u)""")
def fleet_summary(spark, d):
    e = table(spark, d, "events")
    kind = F.col("event_type")
    states = e.groupBy("user_id").agg(F.when(F.bool_or(kind == "purchase"), "done").when(F.bool_or(kind == "signup"), "running").otherwise("waiting").alias("state"))
    return R.fleet_summary(states, e.filter(kind == "signup").select("user_id", (F.col("event_id") % 5).alias("host")), e.filter(kind == "error"), "user_id")


_PASSES = """a AS (SELECT doc_id, lang, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE source END AS source, doc_id % 3 = 0 AS flagged FROM documents), b AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'xx' ELSE lang END AS lang, source, concat_ws(',', CASE WHEN doc_id % 5 = 0 THEN 'disagreed_lang' END, CASE WHEN doc_id % 10 = 0 THEN 'overruled_lang' END) AS flags FROM documents)"""


def _passes(spark, d):
    k, docs = F.col("doc_id"), table(spark, d, "documents")
    a = docs.select("doc_id", "lang", F.when(k % 4 != 0, F.col("source")).alias("source"), (k % 3 == 0).alias("flagged"))
    b = docs.select("doc_id", F.when(k % 5 == 0, "xx").otherwise(F.col("lang")).alias("lang"), "source", F.concat_ws(",", F.when(k % 5 == 0, "disagreed_lang"), F.when(k % 10 == 0, "overruled_lang")).alias("flags"))
    return a, b


@query(f"""WITH {_PASSES}, e AS (SELECT flagged, unnest(['lang', 'source']) AS field, unnest([a.lang, a.source]) AS x, unnest([b.lang, b.source]) AS y FROM a JOIN b USING (doc_id)), f AS (SELECT * FROM e WHERE coalesce(x, '') <> '' OR coalesce(y, '') <> ''),
 g AS (SELECT field, count(*) FILTER (flagged) AS flagged_rows, count(*) FILTER (NOT flagged) AS unflagged_rows, count(*) FILTER (flagged AND x IS NOT DISTINCT FROM y) / nullif(count(*) FILTER (flagged), 0) AS flagged_rate, count(*) FILTER (NOT flagged AND x IS NOT DISTINCT FROM y) / nullif(count(*) FILTER (NOT flagged), 0) AS unflagged_rate FROM f GROUP BY 1)
 SELECT *, flagged_rate / nullif(unflagged_rate, 0) AS ratio FROM g""")
def agreement_by_flag(spark, d):
    a, b = _passes(spark, d)
    return R.agreement_by_flag(a, b, ["doc_id"], F.col("flagged"), ["lang", "source"])


@query(f"""WITH {_PASSES}, e AS (SELECT flags, unnest(['lang', 'source']) AS field, unnest([a.lang, a.source]) AS x, unnest([b.lang, b.source]) AS y FROM a JOIN b USING (doc_id))
 SELECT field, count(*) FILTER (coalesce(x, '') <> '') AS before, count(*) FILTER (coalesce(y, '') <> '') AS after, count(*) FILTER (coalesce(x, '') = '' AND coalesce(y, '') <> '') AS recovered, count(*) FILTER (contains(flags, 'disagreed_' || field)) AS disagreed, count(*) FILTER (contains(flags, 'overruled_' || field)) AS overruled FROM e GROUP BY 1""")
def second_pass_summary(spark, d):
    a, b = _passes(spark, d)
    return R.second_pass_summary(a, b, ["doc_id"], ["lang", "source"])


_QUALITY = "r AS (SELECT d.*, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)), m AS (SELECT *, list_filter([CASE WHEN n_chars > 2000 THEN 'long' END, CASE WHEN regexp_matches(text, '[0-9]') THEN 'digits' END], lambda x: x IS NOT NULL) AS p FROM r)"


@query(f"""WITH {_QUALITY} SELECT 'rows' AS metric, count(*)::DOUBLE AS value FROM m UNION ALL SELECT 'sound', avg(CASE WHEN len(p) = 0 THEN 1 ELSE 0 END) FROM m UNION ALL SELECT 'filled lang', count(nullif(lang, '')) / count(*) FROM m UNION ALL SELECT 'filled quality', count(quality) / count(*) FROM m
 UNION ALL SELECT 'problem ' || x, count(*) / (SELECT count(*) FROM m) FROM (SELECT unnest(p) AS x FROM m) GROUP BY x UNION ALL SELECT 'external customers', count(*)::DOUBLE FROM customer""")
def quality_report(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    problems = C.problem_list([("long", F.col("n_chars") > 2000), ("digits", F.col("text").rlike("[0-9]"))])
    external = table(spark, d, "customer").agg(F.lit("external customers").alias("metric"), F.count("*").cast("double").alias("value"))
    return R.quality_report(rows, ["lang", "quality"], problems, external)


@query()
def fuzzy_agreement(spark, d):
    """Two readings of part names and types: exact, by skeleton and by similarity, and the means over fields."""
    p = F.col("p_partkey")
    rows = table(spark, d, "part").select(F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("a"), F.when(p % 3 == 0, F.concat(F.col(f), F.lit("é"))).when(p % 3 == 1, F.reverse(f)).otherwise(F.col(f)).alias("b")) for f in ("p_name", "p_type")))))
    out = R.fuzzy_agreement(rows, "field", "a", "b")
    return out.withColumns({c: F.round(c, 9) for c in ("exact", "skeleton", "similarity", "both_blank")})


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN '' ELSE props END AS ward, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN '' ELSE coalesce(regexp_extract(props, '([0-9]+)', 1), '') END AS ward_num FROM events""")
def derived_columns(spark, d):
    """A number taken out of a text; what is null or blank there is null or blank here."""
    kind = F.col("event_type")
    rows = table(spark, d, "events").select("event_id", F.when(kind == "view", None).when(kind == "click", "").otherwise(F.col("props")).alias("ward"))
    return rows.withColumn("ward_num", P.inherit_missing("ward", F.regexp_extract("ward", "([0-9]+)", 1)))


@query("""WITH b AS (SELECT user_id, count(*) AS boxes, count(*) FILTER (event_type IN ('view', 'click')) AS cached FROM events GROUP BY 1) SELECT user_id, boxes, cached FROM b WHERE boxes - cached > 3""")
def partial_caches(spark, d):
    """Parts whose boxes outnumber their cached reads by more than three."""
    e = table(spark, d, "events")
    return P.partial_cache(e.select("user_id"), e.filter(F.col("event_type").isin("view", "click")).select("user_id"), ["user_id"], 3)


@query("""SELECT CASE WHEN n_name IN ('NATION_1', 'NATION_2') THEN 'diagnose' WHEN n_name IN ('NATION_2', 'NATION_3') THEN 'validate' ELSE 'regression' END AS split, count(*) AS n FROM nation GROUP BY 1""")
def split_by_membership(spark, d):
    rows = table(spark, d, "nation").withColumn("split", P.split_of("n_name", [("diagnose", ["NATION_1", "NATION_2"]), ("validate", ["NATION_2", "NATION_3"])], "regression"))
    return rows.groupBy("split").agg(F.count("*").alias("n"))


_TITLES = "CASE o_orderkey % 4 WHEN 0 THEN 'Summary   of' || chr(10) || 'Electors' WHEN 1 THEN 'mother roll of ' || o_orderkey WHEN 2 THEN 'মূল  তালিকা' ELSE o_orderpriority END"


@query(f"""WITH t AS (SELECT o_orderkey, trim(regexp_replace({_TITLES}, '\\s+', ' ', 'g')) AS t FROM orders) SELECT o_orderkey, regexp_matches(t, '(?i)summary\\s+of\\s+electors|ভোটাৰৰ\\s+সংখ্যা|ভোটারের\\s+সংখ্যা') AS is_title, regexp_matches(t, '(?i)মূল\\s*তালিকা|mother\\s*roll|basic\\s*roll') AS is_main FROM t""")
def summary_pages(spark, d):
    k = F.col("o_orderkey")
    title = F.when(k % 4 == 0, "Summary   of\nElectors").when(k % 4 == 1, F.concat(F.lit("mother roll of "), k.cast("string"))).when(k % 4 == 2, "মূল  তালিকা").otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", P.is_summary_title(title).alias("is_title"), P.is_main_row(title).alias("is_main"))


@query("""WITH r AS (SELECT d.doc_id, list_filter([CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END, CASE WHEN n_chars > 3000 THEN '(long)' END], lambda x: x IS NOT NULL) AS reasons FROM documents d LEFT JOIN labels l USING (doc_id) WHERE source <> 'src1')
 SELECT unnest(reasons) AS reason, count(*) AS n FROM r GROUP BY 1""")
def redo_reasons(spark, d):
    """Why rows are read again; those whose layout failed (one source) are not."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    marked = P.to_redo(rows, F.col("source") == "src1", ["quality", "toxic"], [("(long)", F.col("n_chars") > 3000)])
    return marked.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT c_custkey AS k, unnest(['x', 'y', 'z']) AS arm, unnest([c_name, CASE WHEN c_custkey % 3 > 0 THEN c_name ELSE '' END, CASE WHEN c_custkey % 4 > 0 THEN c_name END]) AS v FROM customer) SELECT k FROM a WHERE coalesce(v, '') <> '' GROUP BY 1 HAVING count(DISTINCT arm) = 3""")
def answered_by_all(spark, d):
    k, name = F.col("c_custkey"), F.col("c_name")
    arms = table(spark, d, "customer").select(k.alias("k"), F.inline(F.array(*(F.struct(F.lit(a).alias("arm"), v.alias("v")) for a, v in (("x", name), ("y", F.when(k % 3 > 0, name).otherwise("")), ("z", F.when(k % 4 > 0, name)))))))
    return P.answered_by_all(arms, ["k"], "arm", "v", 3)


@query("""SELECT p_partkey AS part, p_size AS page, CASE WHEN p_partkey % 3 = 0 THEN 'ok' WHEN p_partkey % 3 = 1 THEN 'wrong' END AS mark FROM part""")
def marks_on_rows(spark, d):
    """Review marks, kept under crop names, on the rows that the crops were cut for."""
    p = F.col("p_partkey")
    rows = table(spark, d, "part").select(p.alias("part"), F.col("p_size").alias("page"), F.lit(1).alias("row"), F.lit(2).alias("col"))
    crop = F.format_string("p%d_pg%d_r1c2", p, "p_size")
    marks = table(spark, d, "part").filter("p_partkey % 3 < 2").select(crop.alias("crop"), F.when(p % 3 == 0, "ok").otherwise("wrong").alias("mark"))
    return P.marked(rows, marks, "crop").select("part", "page", "mark")


@query("""WITH r AS (SELECT o_orderkey, o_orderstatus = 'F' AS hot, row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY o_orderkey) AS k FROM orders) SELECT o_orderkey, hot FROM r WHERE k <= 25""")
def half_and_half(spark, d):
    """Half of a sample from the interesting rows, half from elsewhere."""
    return sampling.half_and_half(table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("hot")), F.col("hot"), ["o_orderkey"], 50)
