"""Promises kept while writing, phrases over posting lists, versions of a step against each other, parsers as tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tallyspark.operators import postings as P
from tallyspark.operators import promises as O
from tallyspark.operators import replay as R
from tallyspark.plans.registry import query
from tallyspark.sources.sinks import scratch
from tallyspark.sources.tables import table

_PARTS = """
p AS (SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'ASM' WHEN 1 THEN 'BEN' ELSE 'ENG' END AS lang, o_orderkey % 50 AS male, CASE WHEN o_orderkey % 400 <> 9 THEN o_orderkey % 60 END AS female, o_orderkey % 50 + o_orderkey % 60 + CASE WHEN o_orderkey % 90 = 4 THEN 1 ELSE 0 END AS total,
 o_orderkey % 126 + 1 AS ac, o_orderkey % 126 + 1 + CASE WHEN o_orderkey % 2000 = 77 THEN 1 ELSE 0 END AS ac_read, o_custkey AS owner, CASE WHEN o_orderkey % 3 = 0 THEN 'asm=' || o_orderkey % 2 ELSE 'm' END AS engine, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority ELSE '' END AS ward, '' AS notes FROM orders)
"""


@query(f"""WITH {_PARTS}, u AS (SELECT count(*) FILTER (n > 1) AS twice FROM (SELECT row_number() OVER (PARTITION BY owner, ac ORDER BY k) AS n FROM p)), x AS (SELECT count(*) AS n, count(*) FILTER (lang = 'ASM') AS asm, count(*) FILTER (lang = 'BEN') AS ben, count(*) FILTER (lang = 'ENG') AS eng, count(*) FILTER (female IS NULL) AS unread,
 count(*) FILTER (coalesce(male + female = total, false)) AS sums, count(*) FILTER (ac = ac_read) AS same, count(*) FILTER (lang = 'ENG' AND ward <> '') AS wards, count(*) FILTER (ward = '') AS blank, sum(male) AS males, count(*) FILTER (NOT ac BETWEEN 1 AND 126) AS acs FROM p),
 v AS (SELECT 'rows' AS promise, true AS passed, n::DOUBLE AS value FROM x UNION ALL SELECT 'ASM complete', true, asm FROM x UNION ALL SELECT 'BEN complete', false, ben FROM x UNION ALL SELECT 'key unique', twice = 0, twice FROM x, u UNION ALL SELECT 'engine names its language', true, 0 UNION ALL SELECT 'no other engine', true, 0
 UNION ALL SELECT 'numbers read', unread = 0, unread FROM x UNION ALL SELECT 'sums hold', sums / n > 0.995, sums / n FROM x UNION ALL SELECT 'ac as in the name', same / n >= 0.999, same / n FROM x UNION ALL SELECT 'ward for ENG', wards >= 1, wards FROM x UNION ALL SELECT 'ward blank elsewhere', true, 0 UNION ALL SELECT 'some ward blank', blank >= 1, blank FROM x
 UNION ALL SELECT 'constituencies in range', acs = 0, acs FROM x UNION ALL SELECT 'texts are NFC', true, 0 UNION ALL SELECT 'scripts written out', true, 0 UNION ALL SELECT 'notes somewhere', false, 0 UNION ALL SELECT 'engine somewhere', true, n FROM x UNION ALL SELECT 'owner somewhere', true, n FROM x UNION ALL SELECT 'males as published', true, males FROM x UNION ALL SELECT 'languages known', false, eng FROM x)
 SELECT promise, passed, value FROM v""")
def promises_of_a_write(spark, d):
    """Twenty promises about parts, measured by the one job that writes them; several are broken."""
    c, k = F.col, F.col("o_orderkey")
    orders = table(spark, d, "orders")
    parts = orders.select(
        k.alias("k"), F.when(k % 3 == 0, "ASM").when(k % 3 == 1, "BEN").otherwise("ENG").alias("lang"), (k % 50).alias("male"), F.when(k % 400 != 9, k % 60).alias("female"), (k % 50 + k % 60 + F.when(k % 90 == 4, 1).otherwise(0)).alias("total"), (k % 126 + 1).alias("ac"), (k % 126 + 1 + F.when(k % 2000 == 77, 1).otherwise(0)).alias("ac_read"),
        c("o_custkey").alias("owner"), F.when(k % 3 == 0, F.concat(F.lit("asm="), (k % 2).cast("string"))).otherwise("m").alias("engine"), F.when(k % 3 == 2, c("o_orderpriority")).otherwise("").alias("ward"), F.lit("").alias("notes"),
    )
    n, asm, males = orders.agg(F.count("*"), F.count_if(k % 3 == 0), F.sum(k % 50)).first()
    line = F.to_json(F.struct("lang", "engine", "ward"))
    wanted = [
        O.counted("rows", n), O.counted("ASM complete", asm, c("lang") == "ASM"), O.counted("BEN complete", n, c("lang") == "BEN"), O.every("key unique", c("_nth") == 1), O.every("engine names its language", (c("lang") != "ASM") | c("engine").startswith("asm")),
        O.every("no other engine", (c("lang") == "ASM") == c("engine").contains("asm=")), O.every("numbers read", c("male").isNotNull() & c("female").isNotNull() & c("total").isNotNull()), O.share("sums hold", c("male") + c("female") == c("total"), 0.995), O.share("ac as in the name", c("ac") == c("ac_read"), 0.999),
        O.some("ward for ENG", (c("lang") == "ENG") & (c("ward") != "")), O.every("ward blank elsewhere", (c("lang") == "ENG") | c("ward").isNotNull()), O.some("some ward blank", c("ward") == ""), O.every("constituencies in range", c("ac").between(1, 126)), O.every("texts are NFC", ~c("ward").rlike("[\\u0300-\\u036f]")),
        O.every("scripts written out", ~line.contains("\\u")), O.some("notes somewhere", c("notes") != ""), O.some("engine somewhere", c("engine") != ""), O.some("owner somewhere", c("owner").isNotNull()), O.summed("males as published", c("male"), males, males), O.every("languages known", c("lang").isin("ASM", "BEN")),
    ]
    at = scratch(spark, "promised")
    return O.observed(O.nth_of_key(parts, ["owner", "ac"]), wanted, lambda df: df.write.parquet(at), ["_nth"])


@query("""WITH t AS (SELECT p_partkey, regexp_extract_all(lower(p_name || ' ' || p_type), '([a-z]+)') AS w FROM part), f AS (SELECT DISTINCT p_type || ' ' || p_name AS phrase FROM part UNION SELECT DISTINCT 'no ' || p_type FROM part UNION SELECT DISTINCT p_type FROM part)
 SELECT phrase, p_partkey AS key FROM f, t WHERE len(list_filter(list_distinct(regexp_extract_all(lower(phrase), '([a-z]+)')), lambda x: NOT list_contains(w, x))) = 0""")
def phrases_answered(spark, d):
    """Parts whose name and type hold every word of a phrase, through posting lists in blocks of 64 parts."""
    parts = table(spark, d, "part")
    index = P.postings(parts.withColumn("t", F.concat_ws(" ", "p_name", "p_type")), "p_partkey", "t", 64)
    phrases = parts.select(F.concat_ws(" ", "p_type", "p_name").alias("phrase")).unionByName(parts.select(F.concat_ws(" ", F.lit("no"), "p_type").alias("phrase"))).unionByName(parts.select(F.col("p_type").alias("phrase")))
    return P.answered(index, phrases, "phrase")


@query("""WITH i AS (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '([a-z]+)')) AS word, p_brand AS token FROM part WHERE p_partkey % 3 = 0), f AS (SELECT DISTINCT p_name AS phrase FROM part), n AS (SELECT phrase, unnest(list_distinct(regexp_extract_all(lower(phrase), '([a-z]+)'))) AS word FROM f), z AS (SELECT phrase, count(*) AS n FROM n GROUP BY 1),
 v AS (SELECT s_suppkey AS key, unnest(['Brand#' || s_nationkey, 'Brand#' || s_suppkey % 20]) AS token FROM supplier), m AS (SELECT n.phrase, v.key, count(DISTINCT n.word) AS met FROM n JOIN i USING (word) JOIN v USING (token) GROUP BY ALL) SELECT phrase, key FROM m JOIN z USING (phrase) WHERE met = n""")
def earned_phrases(spark, d):
    """Suppliers whose two brands stand for every word of a part's name."""
    parts, brand = table(spark, d, "part"), F.lit("Brand#")
    index = parts.filter("p_partkey % 3 = 0").select(F.explode(P.words_of("p_name")).alias("word"), F.col("p_brand").alias("token"))
    values = table(spark, d, "supplier").select("s_suppkey", F.array(F.concat(brand, F.col("s_nationkey").cast("string")), F.concat(brand, (F.col("s_suppkey") % 20).cast("string"))).alias("tokens"))
    return P.earned(values, "s_suppkey", "tokens", index, parts, "p_name").withColumnRenamed("p_name", "phrase")


_READERS = R.Assemblers(["event_id", "user_id", "number"])


@_READERS.version("first digits")
def _first_digits(rows):
    return rows.withColumn("number", F.regexp_extract("props", "([0-9])", 1).try_cast("long"))


@_READERS.version("whole number")
def _whole_number(rows):
    return rows.withColumn("number", F.when(F.col("event_type") != "error", F.regexp_extract("props", "([0-9]+)", 1).try_cast("long")))


@query("""WITH e AS (SELECT CASE WHEN user_id % 10 < 3 THEN 'in-sample' ELSE 'out-of-sample' END AS s, TRY_CAST(regexp_extract(props, '([0-9])', 1) AS BIGINT) AS b, CASE WHEN event_type <> 'error' THEN TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS a FROM events),
 x AS (SELECT s AS split, a, b FROM e UNION ALL SELECT 'combined', a, b FROM e), g AS (SELECT split, avg((b IS NOT NULL)::INT) AS b1, avg((a IS NOT NULL)::INT) AS a1, avg(coalesce(b >= 10, false)::INT) AS b2, avg(coalesce(a >= 10, false)::INT) AS a2 FROM x GROUP BY 1)
 SELECT split, 'filled' AS metric, round(b1, 9) AS "before", round(a1, 9) AS "after", round(a1 - b1, 9) AS change FROM g UNION ALL SELECT split, 'two digits', round(b2, 9), round(a2, 9), round(a2 - b2, 9) FROM g UNION ALL SELECT 'regression', NULL, NULL, NULL, NULL""")
def assembler_replay(spark, d):
    """Two readers of a number over the same events, by split; a split that nothing falls into is named."""
    replayed = _READERS.replay(table(spark, d, "events"), ["first digits", "whole number"])
    split = F.when(F.col("user_id") % 10 < 3, "in-sample").otherwise("out-of-sample")
    measured = R.metrics(replayed, {"filled": F.avg(F.col("number").isNotNull().cast("int")), "two digits": F.avg(F.coalesce(F.col("number") >= 10, F.lit(False)).cast("int"))}, split)
    out = R.side_by_side(measured, "first digits", "whole number", ["in-sample", "out-of-sample", "regression"])
    return out.withColumns({c: F.round(c, 9) for c in ("before", "after", "change")})


@query("""WITH e AS (SELECT avg((TRY_CAST(regexp_extract(props, '([0-9])', 1) AS BIGINT) IS NOT NULL)::INT) AS b1, avg((event_type <> 'error' AND TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) IS NOT NULL)::INT) AS a1, avg(coalesce(event_type <> 'error' AND TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) >= 10, false)::INT) AS a2 FROM events)
 SELECT 'target' AS gate, 'two digits' AS metric, 0.0::DOUBLE AS "before", round(a2, 9) AS "after", a2 >= 0.01 AS passed FROM e UNION ALL SELECT 'guard', 'filled', round(b1, 9), round(a1, 9), a1 - b1 >= -0.02 FROM e""")
def assembler_gates(spark, d):
    """Whether the second reader may replace the first: a gain that costs too much elsewhere doesn't pass."""
    replayed = _READERS.replay(table(spark, d, "events"), ["first digits", "whole number"])
    measured = R.metrics(replayed, {"filled": F.avg(F.col("number").isNotNull().cast("int")), "two digits": F.avg(F.coalesce(F.col("number") >= 10, F.lit(False)).cast("int"))}, F.lit("in-sample"))
    out = R.judged(measured, "first digits", "whole number", "two digits", 0.01, ["filled"])
    return out.withColumns({c: F.round(c, 9) for c in ("before", "after")})


@F.udtf(returnType="name string, number long", useArrow=True)
class Properties:
    """The numbers of a flat JSON document, a row each; none of one that can't be read."""

    def eval(self, doc: str):
        try:
            found = json.loads(doc or "{}")
        except ValueError:
            return
        for name, value in found.items() if isinstance(found, dict) else ():
            if isinstance(value, int):
                yield name, value


@query("""SELECT event_id, 'k' AS name, TRY_CAST(regexp_extract(props, '"k": ?([0-9]+)', 1) AS BIGINT) AS number FROM events WHERE event_id % 4 > 0 UNION ALL SELECT event_id, 'user', user_id FROM events WHERE event_id % 4 = 2""")
def table_function(spark, d):
    """Properties as rows through a table function; every fourth document is cut off, every fourth has two numbers."""
    k = F.col("event_id") % 4
    two = F.concat(F.lit('{"user": '), F.col("user_id").cast("string"), F.lit(", "), F.expr("substring(props, 2)"))
    docs = table(spark, d, "events").withColumn("props", F.when(k == 0, F.substring("props", 1, 4)).when(k == 2, two).otherwise(F.col("props")))
    return R.parsed(docs, Properties, "props", ["event_id"])
