"""The life cycle of a lookup table: written, read, scoped, matched, confirmed, applied, guarded."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import match
from tallyspark.plans.registry import query
from tallyspark.sources import sinks as S
from tallyspark.sources.tables import table

_LOOKUP = """l AS (SELECT c_mktsegment AS field, n_name AS native, count(*) AS frequency, lower(min(c_name)) AS roman, CASE WHEN min(c_custkey) % 2 = 0 THEN 'official' ELSE 'machine' END AS source FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)"""


def _lookup(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    out = rows.groupBy(F.col("c_mktsegment").alias("field"), F.col("n_name").alias("native")).agg(F.count("*").alias("frequency"), F.lower(F.min("c_name")).alias("roman"), F.when(F.min("c_custkey") % 2 == 0, "official").otherwise("machine").alias("source"))
    return out.withColumns({"variant": F.lit(""), "authority": F.col("source"), "note": F.lit("")})


@query(f"WITH {_LOOKUP} SELECT field, native, CASE WHEN frequency = 1 THEN 0 ELSE frequency END AS frequency, roman, source, '' AS variant, source AS authority, '' AS note FROM l")
def lookup_round_trip(spark, d):
    """Through gzipped CSV in the lookup's order; a blank frequency comes back as 0."""
    at = S.scratch(spark, "lookup")
    S.write_lookup(_lookup(spark, d).withColumn("frequency", F.when(F.col("frequency") > 1, F.col("frequency"))), at)
    return S.read_lookup(spark, at)


@query(f"WITH {_LOOKUP} SELECT field, native, frequency, CASE WHEN frequency > 3 THEN 'manual' ELSE source END AS authority, roman FROM l")
def confirmed_rows(spark, d):
    rows = _lookup(spark, d)
    return match.confirm(rows, rows.filter("frequency > 3"), ["field", "native"]).select("field", "native", "frequency", "authority", "roman")


@query(f"WITH {_LOOKUP} SELECT field, native, frequency FROM l")
def guarded_write(spark, d):
    """Written only as no row lacks its spelling."""
    rows, at = _lookup(spark, d).select("field", "native", "frequency", "roman"), S.scratch(spark, "guarded")
    S.write_if_sound(rows.drop("roman"), rows.filter("roman IS NULL OR roman = ''"), at)
    return spark.read.parquet(at)


@query("""SELECT DISTINCT c_mktsegment AS value, s_name AS candidate FROM customer JOIN supplier ON s_nationkey = c_nationkey WHERE c_mktsegment <> '' AND c_acctbal > 9000""")
def candidate_scopes(spark, d):
    """Suppliers of any nation that a segment's richest customers live in."""
    rows = table(spark, d, "customer").filter("c_acctbal > 9000").select(F.col("c_mktsegment").alias("value"), F.col("c_nationkey").alias("key"))
    places = table(spark, d, "supplier").select(F.col("s_nationkey").alias("key"), "s_name")
    return match.candidate_scopes(rows, places, "value", "key", "s_name")


@query("""SELECT p_brand AS native, first(p_name ORDER BY p_size % 3, -p_retailprice, p_name) AS roman FROM part GROUP BY 1""")
def best_per_native(spark, d):
    found = table(spark, d, "part").select(F.col("p_brand").alias("native"), (F.col("p_size") % 3).alias("rank"), F.col("p_retailprice").alias("score"), F.col("p_name").alias("roman"))
    return match.best_per_native(found, "native", "rank", "score", "roman")


@query("""WITH t AS (SELECT p_partkey, p_name, p_brand, string_split(p_name, ' ') AS w FROM part),
 k AS (SELECT *, list_filter(range(1, len(w) + 1), lambda i: w[i] NOT IN ('widget', 'bolt')) AS core FROM t)
 SELECT p_partkey, array_to_string(list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE w[i] WHEN 'widget' THEN 'Wdg' WHEN 'bolt' THEN 'Blt' ELSE CASE WHEN i = core[1] THEN p_brand END END), lambda x: x IS NOT NULL), ' ') || ' (' || p_partkey || '-2)' AS applied FROM k""")
def official_applied(spark, d):
    """A part's brand in place of its name's core words; generic words are translated, numbers stay."""
    native = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_partkey").cast("string"), F.lit("-2)"))
    return table(spark, d, "part").select("p_partkey", match.apply_official(native, F.col("p_brand"), {"widget": "Wdg", "bolt": "Blt"}, "[A-Za-z]+").alias("applied"))
