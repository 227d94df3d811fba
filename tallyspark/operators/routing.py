"""Which rows need another look, and why: families of reasons, readability, first-match rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.operators.modes import filled


def doubts(flags: Column, known: Sequence[str], separator: str = ",") -> Column:
    """Those of the known flags that a delimited list has, in the order of `known`."""
    return F.array_intersect(F.array(*map(F.lit, known)), F.split(F.coalesce(flags, F.lit("")), separator))


def missing_core(fields: Sequence[str], least: int = 2) -> Column:
    """no_x for each field that isn't filled (truthy), if at least `least` aren't."""
    absent = F.filter(F.array(*(F.when(~F.coalesce(filled(f, "truthy"), F.lit(False)), F.lit(f"no_{f}")) for f in fields)), lambda x: x.isNotNull())
    return F.when(F.size(absent) >= least, absent).otherwise(F.array().cast("array<string>"))


def value_without_label(value: str, label: str, reason: str) -> Column:
    """[reason] where a value stands without its label."""
    hit = filled(value, "truthy") & ~F.coalesce(filled(label, "truthy"), F.lit(False))
    return F.when(hit, F.array(F.lit(reason))).otherwise(F.array().cast("array<string>"))


def reasons(*families: Column) -> Column:
    return F.concat(*(F.coalesce(f, F.array().cast("array<string>")) for f in families))


def top_reasons(df: DataFrame, column: str, k: int) -> DataFrame:
    return df.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(k)


def readable(parts: DataFrame, images: DataFrame, key: Sequence[str], exists: Column, words: Column) -> DataFrame:
    """key..., readable: every image of a part is there or has cached words; a part without images isn't."""
    ok = images.groupBy(*key).agg(F.bool_and(F.coalesce(exists, F.lit(False)) | F.coalesce(words > 0, F.lit(False))).alias("_ok"))
    return parts.join(ok, list(key), "left").select(*key, F.coalesce("_ok", F.lit(False)).alias("readable"))


def all_conditions(df: DataFrame, key: Sequence[str], *others: DataFrame) -> DataFrame:
    """Rows of df whose key every other table has."""
    for o in others:
        df = df.join(o.select(*key).distinct(), list(key), "left_semi")
    return df


def underfull(df: DataFrame, by: Sequence[str], least: int) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") < least)


def first_rules(found: DataFrame, rules: Sequence[tuple[str, str]], order: Sequence[str]) -> DataFrame:
    """failure, feature, rule for each association and each rule (feature, failure or *) at most once.

    Associations take their first unused rule in order. As every association of a feature that a star rule serves would
    take the same one, the greedy choice comes down to two ranks: an exact rule goes to its first association, and the
    star rule to the first association that got no exact one.
    """
    spark = found.sparkSession
    r = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(k).alias("rule"), F.lit(f).alias("feature"), F.lit(x).alias("for")) for k, (f, x) in enumerate(rules)))))
    hits = found.join(F.broadcast(r), "feature").filter((F.col("for") == "*") | (F.col("for") == F.col("failure")))
    same = list(dict.fromkeys(("failure", "feature", *order)))
    exact = hits.filter("for <> '*'").withColumn("_k", F.row_number().over(W.partitionBy("rule").orderBy(*order))).filter("_k = 1").select(*same, "rule")
    rest = hits.filter("for = '*'").join(exact.select(*same), same, "left_anti")
    star = rest.withColumn("_k", F.row_number().over(W.partitionBy("rule").orderBy(*order))).filter("_k = 1")
    return exact.select("failure", "feature", "rule").unionByName(star.select("failure", "feature", "rule"))
