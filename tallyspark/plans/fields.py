"""Fields of readings, lexicon runs, integrity of dimensions, and the geometry of pages."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.functions import text as T
from tallyspark.functions import tokens as K
from tallyspark.operators import grid, match, parts, spatial
from tallyspark.operators import predicates as P
from tallyspark.plans.registry import query
from tallyspark.sources.tables import json_schema, table

_ANSWER = "concat('<p>পিতাৰ নাম: ', c_name, '</p>নাম: N', CAST(c_custkey AS STRING), '<br/>বয়স: ', CAST(c_custkey % 140 AS STRING), '|ঘৰ নং: ', CAST(c_custkey % 30 AS STRING), ' | লিঙ্গ: ', CASE c_custkey % 4 WHEN 0 THEN 'Female' WHEN 1 THEN 'male' WHEN 2 THEN 'তৃতীয়' ELSE '?' END)"


@query("""SELECT c_custkey, 'N' || c_custkey AS name, CASE WHEN c_custkey % 140 BETWEEN 18 AND 120 THEN (c_custkey % 140)::INTEGER END AS age, (c_custkey % 30)::VARCHAR AS house, CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'T' END AS sex FROM customer""")
def second_reading_fields(spark, d):
    """Name, age, house and sex out of answers in mixed HTML and bars; the relation's name is not the name."""
    return table(spark, d, "customer").select("c_custkey", T.reading_fields(F.expr(_ANSWER)).alias("f")).select("c_custkey", "f.*")


@query("""WITH r AS (SELECT c_custkey, unnest(['house', 'name']) AS field, unnest(['12 / ' || (c_custkey % 9), CASE WHEN c_custkey % 5 = 0 THEN ' Unknown' ELSE c_name END]) AS v FROM customer)
 SELECT c_custkey, field, CASE field WHEN 'house' THEN replace(v, ' ', '') ELSE CASE WHEN lower(trim(v)) = 'unknown' THEN '' ELSE trim(v) END END AS value FROM r""")
def comparable_fields(spark, d):
    k = F.col("c_custkey")
    each = F.array(*(F.struct(F.lit(f).alias("field"), v.alias("v")) for f, v in (("house", F.concat(F.lit("12 / "), (k % 9).cast("string"))), ("name", F.when(k % 5 == 0, " Unknown").otherwise(F.col("c_name"))))))
    return table(spark, d, "customer").select("c_custkey", F.inline(each)).select("c_custkey", "field", T.comparable(F.col("field"), "v").alias("value"))


@query("""SELECT n_nationkey, 'ৰাম' || n_nationkey AS folded, n_nationkey % 2 = 0 AS native, CASE n_regionkey WHEN 0 THEN 'school' WHEN 1 THEN 'office' ELSE 'other' END AS kind, CASE WHEN n_nationkey % 3 = 0 THEN n_name ELSE 'main' END AS section FROM nation""")
def small_normalisers(spark, d):
    """Folded letters, native digits, mapped kinds and default sections."""
    n = F.col("n_nationkey")
    kind = F.when(F.col("n_regionkey") == 0, " L.P.  School ").when(F.col("n_regionkey") == 1, "OFFICE").otherwise("?")
    return table(spark, d, "nation").select(
        "n_nationkey", T.fold_ra(F.concat(F.lit("র া ম"), n.cast("string"))).alias("folded"), T.has_native_digit(F.when(n % 2 == 0, "৪").otherwise("4")).alias("native"),
        T.mapped(kind, {"l.p. school": "school", "office": "office"}, "other").alias("kind"), T.section_or_main(F.when(n % 3 == 0, F.col("n_name")).when(n % 3 == 1, "  ")).alias("section"),
    )


@query("""WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part), l AS (SELECT p_type AS word, upper(p_type) AS roman FROM part UNION SELECT 'cold', 'KALT' UNION SELECT 'widget', 'DING' ),
 x AS (SELECT p_partkey, unnest(range(1, len(w) + 1)) AS k, w FROM w) SELECT p_partkey, string_agg(coalesce(roman, w[k]), ' ' ORDER BY k) AS roman, count(roman)::BIGINT AS known FROM x LEFT JOIN l ON l.word = w[k] GROUP BY 1""")
def lexicon_runs(spark, d):
    """Words by a merged lexicon, in which later entries win; unknown runs stay."""
    types = table(spark, d, "part").select(F.col("p_type").alias("word"), F.upper("p_type").alias("roman")).distinct()
    base = spark.sql("SELECT * FROM VALUES ('cold', 'old'), ('widget', 'DING') AS t(word, roman)")
    later = spark.sql("SELECT * FROM VALUES ('cold', 'KALT') AS t(word, roman)")
    lexicon = K.merged_lexicon([types, base, later])
    return K.by_lexicon(table(spark, d, "part").select("p_partkey", "p_name"), ["p_partkey"], "p_name", lexicon, "[A-Za-z]+")


@query("""SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def checked_dimension(spark, d):
    """Nations with their region; a nation whose region is unknown would fail the query."""
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("code"), "r_name")
    return P.with_dimension(table(spark, d, "nation").withColumnRenamed("n_regionkey", "code"), regions, "code").select("n_nationkey", "n_name", "r_name")


@query("""SELECT n_nationkey, '{"name":"' || n_name || '","mark":"ৰ é"}' AS line FROM nation""")
def unescaped_json(spark, d):
    return table(spark, d, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.lit("ৰ é").alias("mark"))).alias("line"))


@query("""WITH w AS (SELECT p_partkey AS id, p_partkey % 20 AS img, (p_size * 2)::DOUBLE AS "left", (p_size * 2 + 10)::DOUBLE AS "right", (p_partkey % 90)::DOUBLE AS top, (p_partkey % 90 + 5)::DOUBLE AS bottom FROM part), r AS (SELECT s_suppkey AS rect, s_suppkey % 20 AS img, (s_suppkey % 30)::DOUBLE AS rl, (s_suppkey % 30 + 60)::DOUBLE AS rr, (s_suppkey % 50)::DOUBLE AS rt, (s_suppkey % 50 + 40)::DOUBLE AS rb FROM supplier)
 SELECT id, rect FROM w JOIN r USING (img) WHERE "left" >= rl - 2 AND "right" <= rr + 2 AND (top + bottom) / 2 >= rt AND (top + bottom) / 2 < rb""")
def words_within(spark, d):
    p, s = F.col("p_partkey"), F.col("s_suppkey")
    num = lambda x: x.cast("double")
    words = table(spark, d, "part").select(p.alias("id"), (p % 20).alias("img"), num(F.col("p_size") * 2).alias("left"), num(F.col("p_size") * 2 + 10).alias("right"), num(p % 90).alias("top"), num(p % 90 + 5).alias("bottom"))
    rects = table(spark, d, "supplier").select(s.alias("rect"), (s % 20).alias("img"), num(s % 30).alias("rect_left"), num(s % 30 + 60).alias("rect_right"), num(s % 50).alias("rect_top"), num(s % 50 + 40).alias("rect_bottom"))
    return spatial.words_within(words, rects, ["img"]).select("id", "rect")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 3 WHEN s_suppkey % 4 = 1 THEN 1 WHEN s_suppkey % 4 = 2 THEN 0 ELSE 2 END AS n FROM supplier""")
def columns_drawn(spark, d):
    """How many of three established columns a page draws; only a prefix counts."""
    k = F.col("s_suppkey")
    columns = F.array(*(F.struct(F.lit(a).alias("left"), F.lit((a + b) / 2).alias("divider"), F.lit(b).alias("right")) for a, b in ((78.0, 1054.0), (1107.0, 2082.0), (2137.0, 3112.0))))
    full = [80.0, 1054.0, 1107.0, 2082.0, 2137.0, 3112.0]
    lists = [full, [78.0, 1080.0, 2137.0, 3112.0], [1107.0, 2082.0, 2137.0, 3112.0], [70.0, 1095.0, 1100.0, 2130.0]]
    rules = F.when(k % 4 == 0, F.array(*map(F.lit, lists[0])))
    for j in (1, 2, 3):
        rules = rules.when(k % 4 == j, F.array(*map(F.lit, lists[j])))
    pages = table(spark, d, "supplier").select("s_suppkey", columns.alias("established"), rules.alias("rules"))
    return grid.columns_present(pages, "rules", "established").select("s_suppkey", F.size("present").alias("n"))


@query("""SELECT s_suppkey, unnest(range(0, (2 + s_suppkey % 4)::BIGINT))::INTEGER AS row, 500.0 + 440 * unnest(range(0, (2 + s_suppkey % 4)::BIGINT)) AS top, 915.0 + 440 * unnest(range(0, (2 + s_suppkey % 4)::BIGINT)) AS bottom FROM supplier""")
def row_pitch(spark, d):
    """Rows of 415 with gutters of 25, of which all but the first have an inner rule too; a header's rule stands above."""
    rows = F.flatten(F.transform(F.sequence(F.lit(0), (1 + F.col("s_suppkey") % 4).cast("int")), lambda i: F.filter(F.array(500.0 + 440 * i, F.when(i > 0, 654.0 + 440 * i), 915.0 + 440 * i), lambda x: x.isNotNull())))
    pages = table(spark, d, "supplier").select("s_suppkey", F.concat(F.array(F.lit(410.0)), rows).alias("rules"))
    return grid.row_bands(pages, ["s_suppkey"], "rules")


@query("""WITH c AS (SELECT *, c_custkey % 140 AS age FROM customer WHERE c_custkey % 6 > 1) SELECT 'second' AS arm, c_custkey::INTEGER AS part, (c_custkey % 7)::INTEGER AS page, (c_custkey % 10)::INTEGER AS row, (c_custkey % 3)::INTEGER AS col, 'N' || c_custkey AS name, CASE WHEN age BETWEEN 18 AND 120 THEN age::INTEGER END AS age, (c_custkey % 30)::VARCHAR AS house, CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'T' ELSE '' END AS sex FROM c""")
def second_reading_arm(spark, d):
    """Answers by crop as an arm to compare; names that are no crop's, and those of bands, are left out."""
    k = F.col("c_custkey")
    crop = T.crop_key(k, k % 7, k % 10, k % 3)
    name = F.when(k % 6 == 0, F.concat(F.lit("x"), crop)).when(k % 6 == 1, F.concat(crop, F.lit("_b2"))).otherwise(crop)
    return match.readings_arm(table(spark, d, "customer").select(name.alias("name"), F.expr(_ANSWER).alias("answer")), "name", "answer", "second")


@query("""SELECT doc_id FROM documents WHERE doc_id % 3 = 0 OR (CASE WHEN doc_id % 4 = 0 THEN '' ELSE source END) = '' OR source IS NULL OR doc_id % 5 = 0""")
def wanted_again(spark, d):
    """Records that a second reading can help: no age, or a blank house or sex."""
    k = F.col("doc_id")
    age, house, sex = F.when(k % 3 != 0, k % 90), F.when(k % 4 == 0, "").otherwise(F.col("source")), F.when(k % 5 != 0, F.lit("F"))
    return table(spark, d, "documents").filter(match.needs_second_pass(age, house, sex)).select("doc_id")


@query("""WITH c AS (SELECT o_custkey AS k, count(*) AS extracted, count(*) FILTER (o_orderstatus = 'F') AS male, count(*) FILTER (o_orderstatus = 'O') AS female, CASE WHEN o_custkey % 4 > 0 THEN 5 END AS expected, o_custkey % 3 AS em, CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 2 END AS ef FROM orders GROUP BY o_custkey)
 SELECT k, extracted - expected AS shortfall, CASE WHEN male + female <> 0 THEN male / (male + female) END AS male_share, CASE WHEN em + ef <> 0 THEN em / (em + ef) END AS expected_male_share FROM c""")
def part_shares(spark, d):
    c, k = F.col, F.col("k")
    counts = table(spark, d, "orders").groupBy(c("o_custkey").alias("k")).agg(F.count("*").alias("extracted"), F.count_if(c("o_orderstatus") == "F").alias("male"), F.count_if(c("o_orderstatus") == "O").alias("female"))
    counts = counts.withColumns({"expected": F.when(k % 4 > 0, 5), "em": k % 3, "ef": F.when(k % 5 > 0, k % 2)})
    return parts.part_shares(counts, "extracted", "expected", "male", "female", "em", "ef").select("k", "shortfall", "male_share", "expected_male_share")


@query("""WITH l AS (SELECT c_mktsegment AS field, c_name AS native, c_custkey, c_custkey % 9 AS frequency FROM customer WHERE c_custkey % 4 = 0) SELECT field, native, frequency, row_number() OVER (PARTITION BY field ORDER BY frequency DESC, c_custkey)::INTEGER AS place FROM l""")
def review_queue(spark, d):
    """What still needs a spelling, by field: the most frequent first, equals as they came."""
    k = F.col("c_custkey")
    lookup = table(spark, d, "customer").select(F.col("c_mktsegment").alias("field"), F.col("c_name").alias("native"), (k % 9).alias("frequency"), F.when(k % 4 == 0, F.when(k % 8 == 0, " ")).otherwise("r").alias("roman"), "c_custkey")
    place = F.row_number().over(W.partitionBy("field").orderBy(F.desc("frequency"), "c_custkey"))
    return match.review_queue(lookup, "c_custkey").withColumn("place", place).select("field", "native", "frequency", "place")


@query("SELECT c_custkey, c_name, c_acctbal, c_nationkey, upper(c_mktsegment) AS segment FROM customer")
def columns_in_order(spark, d):
    """Groups of columns in order, each once, without one and with its derived form at the end."""
    rows = table(spark, d, "customer").withColumn("segment", F.upper("c_mktsegment"))
    return rows.select(*P.ordered_columns(["c_custkey", "c_name"], ["c_acctbal", "c_name", "c_nationkey"], rows.columns, without=["c_mktsegment"]))


@query("""SELECT t AS "table", column_name AS "column", CASE WHEN column_type IN ('BIGINT', 'INTEGER') THEN 'integer' WHEN column_type = 'DOUBLE' THEN 'number' ELSE 'string' END AS kind, true AS nullable, true AS required FROM (SELECT 'orders' AS t, * FROM (DESCRIBE orders) UNION ALL SELECT 'customer', * FROM (DESCRIBE customer))""")
def schemas_emitted(spark, d):
    """The closed JSON Schemas of two tables, property by property."""
    out = None
    for name in ("orders", "customer"):
        rows = table(spark, d, name)
        told = json_schema(rows.schema)
        each = [F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.lit(p["anyOf"][0]["type"]).alias("kind"), F.lit({"type": "null"} in p["anyOf"]).alias("nullable"), F.lit(c in told["required"]).alias("required")) for c, p in told["properties"].items()]
        one = rows.limit(1).select(F.inline(F.array(*each)))
        out = one if out is None else out.unionByName(one)
    return out
