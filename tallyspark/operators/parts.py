"""Part-level tables: checks against two sources of totals, field reports, listings, failures kept beside results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def part_checks(rows: DataFrame, totals: DataFrame, closing: DataFrame, key: Sequence[str], counts: dict[str, Column], total: str, second: str) -> DataFrame:
    """key..., the counts, both totals, gap = extracted - total and matches (null where no total was measured).

    counts must hold 'extracted'; the second total stands in where the first is null.
    """
    out = rows.groupBy(*key).agg(*(F.count_if(c).alias(n) for n, c in counts.items()))
    out = out.join(totals.select(*key, total), list(key), "left").join(closing.select(*key, second), list(key), "left")
    t = F.coalesce(total, second)
    return out.withColumns({"gap": F.col("extracted") - t, "matches": F.when(t.isNotNull(), F.col("extracted") == t)})


def part_shares(checks: DataFrame, extracted: str, expected: str, male: str, female: str, expected_male: str, expected_female: str) -> DataFrame:
    """checks with shortfall, male_share and expected_male_share: null where what they are taken of wasn't measured, or is 0."""
    def part(a: str, b: str) -> Column:
        return F.when(F.col(a) + F.col(b) != 0, F.col(a) / (F.col(a) + F.col(b)))

    return checks.withColumns({"shortfall": F.col(extracted) - F.col(expected), "male_share": part(male, female), "expected_male_share": part(expected_male, expected_female)})


def field_report(df: DataFrame, ratios: dict[str, Column], identity: str) -> DataFrame:
    """metric, value: the share of rows that meet each condition, and distinct over non-empty values of the identity."""
    known = F.coalesce(F.trim(F.col(identity).cast("string")), F.lit("")) != ""
    one = df.agg(*(F.avg(F.coalesce(c, F.lit(False)).cast("int")).alias(n) for n, c in ratios.items()), (F.count_distinct(F.when(known, F.col(identity))) / F.greatest(F.count_if(known), F.lit(1))).alias("distinct_ids"))
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("metric"), F.coalesce(F.col(n), F.lit(0.0)).alias("value")) for n in (*ratios, "distinct_ids")))))


def listing(lines: DataFrame, column: str, pattern: str = r"^\s*([0-9]+)\s+(\S+)\s+(\S+)$") -> DataFrame:
    """size, stamp, url of an object store's listing; other lines are left out."""
    hit = lines.filter(F.col(column).rlike(pattern))
    return hit.select(F.regexp_extract(column, pattern, 1).cast("long").alias("size"), F.regexp_extract(column, pattern, 2).alias("stamp"), F.regexp_extract(column, pattern, 3).alias("url"))


def with_failures(done: DataFrame, wanted: DataFrame, key: Sequence[str], reason: str) -> DataFrame:
    """done and a flagged row of nulls for each wanted key that has none: failures are kept, never dropped."""
    lost = wanted.select(*key).distinct().join(done.select(*key).distinct(), list(key), "left_anti").withColumn("flags", F.lit(reason))
    return done.withColumn("flags", F.lit("")).unionByName(lost, allowMissingColumns=True)


def zip_join(left: DataFrame, right: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of the same place in order within a group, side by side; left's columns as they are, right's with r_."""
    w = W.partitionBy(*by).orderBy(*order)
    r = right.withColumn("_n", F.row_number().over(w))
    r = r.select(*by, "_n", *(F.col(c).alias(f"r_{c}") for c in right.columns if c not in by))
    return left.withColumn("_n", F.row_number().over(w)).join(r, [*by, "_n"]).drop("_n")


def modal_label(df: DataFrame, by: Sequence[str], label: str, offset: str) -> DataFrame:
    """by..., label, share, middle: the commonest label (ties to the smaller), its share and the median of its offsets, cut to an int."""
    counts = df.groupBy(*by, label).agg(F.count("*").alias("_n"), F.median(offset).alias("_m"))
    best = counts.groupBy(*by).agg(F.sum("_n").alias("_t"), F.min(F.struct((-F.col("_n")).alias("n"), F.col(label).alias("v"), F.col("_m").alias("m"))).alias("b"))
    return best.select(*by, F.col("b.v").alias(label), (-F.col("b.n") / F.col("_t")).alias("share"), F.col("b.m").cast("int").alias("middle"))


def grouped_lists(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """by... and the sorted distinct values of each column."""
    return df.groupBy(*by).agg(*(F.array_sort(F.collect_set(v)).alias(v) for v in values))
