"""Canonical values, vocabularies and scoped matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import canonical, match
from tallyspark.plans.registry import query
from tallyspark.sources.tables import table


def _noisy(spark, d):
    c = F.col
    value = F.when(c("p_partkey") % 7 == 0, F.concat(F.substring("p_type", 1, 4), F.lit("x"), F.expr("substring(p_type, 6)"))).otherwise(c("p_type"))
    return table(spark, d, "part").select("p_partkey", "p_brand", F.lit("type").alias("field"), F.concat_ws(" ", value, "p_brand", F.lit("stock")).alias("value"))


@query()
def canonical_clusters(spark, d):
    """Types with a damaged letter merge with the sound ones of their brand."""
    return canonical.clusters(_noisy(spark, d), "field", "p_brand", "value")


@query()
def canonical_applied(spark, d):
    """Each part with the value that its cluster settled on."""
    rows = _noisy(spark, d)
    mapping = canonical.dominant(canonical.clusters(rows, "field", "p_brand", "value"), [])
    return canonical.apply_mapping(rows, mapping, "field", "p_brand", "value").select("p_partkey", "value", "canonical")


@query()
def contested_constants(spark, d):
    """One value for a brand where its largest cluster leads twofold, and no change where it doesn't."""
    return canonical.dominant(canonical.clusters(_noisy(spark, d), "field", "p_brand", "value"), ["type"])


@query("""WITH f AS (SELECT lang, unnest(['source', 'lead']) AS field, unnest([source, regexp_extract(text, '[^ \t\r\n]+', 0)]) AS native FROM documents), g AS (SELECT field, native, lang, count(*) AS n FROM f WHERE trim(native) <> '' GROUP BY ALL)
 SELECT field, native, sum(n)::BIGINT AS frequency, first(lang ORDER BY n DESC, lang) AS lang FROM g GROUP BY ALL""")
def vocabulary(spark, d):
    return canonical.vocabulary(table(spark, d, "documents").withColumn("lead", F.regexp_extract("text", "[^ \\t\\r\\n]+", 0)), ["source", "lead"], "lang", "en")


@query("""WITH f AS (SELECT unnest(['source', 'lead']) AS field, unnest([source, regexp_extract(text, '[^ \t\r\n]+', 0)]) AS native FROM documents) SELECT field, count(DISTINCT native) AS values, count(*) AS rows FROM f WHERE trim(native) <> '' GROUP BY 1""")
def vocabulary_summary(spark, d):
    v = canonical.vocabulary(table(spark, d, "documents").withColumn("lead", F.regexp_extract("text", "[^ \\t\\r\\n]+", 0)), ["source", "lead"], "lang", "en")
    return v.groupBy("field").agg(F.count("*").alias("values"), F.sum("frequency").alias("rows"))


@query()
def scoped_match(spark, d):
    """Each part's name against the names of the other parts of its brand. Parts of one brand and name share their match;
    their name is a candidate too unless a single part has it."""
    part = table(spark, d, "part")
    target = F.concat("p_name", F.lit("s")).alias("target")
    names = part.groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    targets = names.select("p_brand", target, F.when(F.col("n") == 1, F.col("p_name")).alias("own"))
    best = match.scoped_best(targets, names.select("p_brand", F.col("p_name").alias("candidate")), ["p_brand"], own="own")
    return part.select("p_partkey", "p_brand", target).join(best, ["p_brand", "target"]).withColumns({"score": F.round("score", 9), "runner_up": F.round("runner_up", 9)})


@query("SELECT n_name AS native, list(DISTINCT c_mktsegment ORDER BY c_mktsegment) AS s FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1".replace("list(DISTINCT c_mktsegment ORDER BY c_mktsegment) AS s", "array_to_string(list(DISTINCT c_mktsegment ORDER BY c_mktsegment), ',') AS spellings"))
def inconsistent_spellings(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("native"), F.col("c_mktsegment").alias("roman"))
    return match.inconsistent(rows).withColumn("spellings", F.array_join("spellings", ","))


@query("""WITH l AS (SELECT c_mktsegment AS field, n_name AS native, count(*) AS frequency, min(c_name) AS roman, CASE WHEN min(c_custkey) % 2 = 0 THEN 'official' ELSE 'machine' END AS authority FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
 b AS (SELECT native, first(roman ORDER BY frequency DESC, roman) AS r FROM l WHERE authority = 'official' GROUP BY 1) SELECT field, native, frequency, coalesce(r, roman) AS roman, authority FROM l LEFT JOIN b USING (native)""")
def propagated_spellings(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    lookup = rows.groupBy(F.col("c_mktsegment").alias("field"), F.col("n_name").alias("native")).agg(F.count("*").alias("frequency"), F.min("c_name").alias("roman"), F.when(F.min("c_custkey") % 2 == 0, "official").otherwise("machine").alias("authority"))
    return match.propagate(lookup).select("field", "native", "frequency", "roman", "authority")
