"""Rows against independent totals: residuals, verdicts, set comparisons, release invariants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def against_totals(rows: DataFrame, totals: DataFrame, key: Sequence[str], found: str, printed: str) -> DataFrame:
    """key..., found, printed, status, diff from a full join of per-key counts and totals.

    status: exact, off, phantom (rows without a total) or missing (a total without rows); a null total is unmeasured.
    """
    both = rows.join(totals.withColumn("_t", F.lit(True)), list(key), "full")
    have, n = F.coalesce(found, F.lit(0)), F.col(printed)
    status = F.when(F.col("_t").isNull(), "phantom").when(n.isNull(), "unmeasured").when(F.col(found).isNull(), "missing").when(have == n, "exact").otherwise("off")
    return both.select(*key, have.alias(found), printed, status.alias("status"), (have - n).alias("diff"))


def residuals(compared: DataFrame, key: Sequence[str], printed: str) -> DataFrame:
    """The keys that differ, the largest first."""
    return compared.filter("diff <> 0").orderBy(F.desc(F.abs("diff")), *key)


def shortfall(compared: DataFrame, found: str, printed: str, worst: float = 0.25, total: float = 0.002) -> DataFrame:
    """measured, matching, short, worst_fraction, main_rows, verdict.

    No evidence fails; then one key off by more than `worst` of its total; then a summed difference over `total` of all
    rows.
    """
    m = F.col(printed).isNotNull() & (F.col("status") != "phantom")
    out = compared.agg(
        F.count_if(m).alias("measured"), F.count_if(m & (F.col("diff") == 0)).alias("matching"), F.coalesce(F.sum(F.when(m, F.abs("diff"))), F.lit(0)).alias("short"),
        F.coalesce(F.max(F.when(m & (F.col(printed) != 0), F.abs("diff") / F.col(printed))), F.lit(0.0)).alias("worst_fraction"), F.coalesce(F.sum(found), F.lit(0)).alias("main_rows"),
    )
    verdict = F.when(F.col("measured") == 0, "no evidence").when(F.col("worst_fraction") > worst, "one part off").when(F.col("short") > total * F.col("main_rows"), "short overall").otherwise("publish")
    return out.withColumn("verdict", verdict)


def implied_against_detected(rows: DataFrame, published: DataFrame, key: Sequence[str], main: Column, added: Column, removed: Column, net: str) -> DataFrame:
    """key..., main, added, detected, net, implied = main + added - net; keys without a net are left out."""
    counts = rows.groupBy(*key).agg(F.count_if(main).alias("main"), F.count_if(added).alias("added"), F.count_if(removed).alias("detected"))
    return counts.join(published.filter(F.col(net).isNotNull()), list(key)).withColumn("implied", F.col("main") + F.col("added") - F.col(net)).select(*key, "main", "added", "detected", net, "implied")


def outliers(df: DataFrame, value: str, sigmas: float = 3.0) -> DataFrame:
    """df with mean, sd (population) and outlier: strictly beyond `sigmas`, never where sd is 0."""
    stats = df.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    return df.crossJoin(F.broadcast(stats)).withColumn("outlier", (F.col("sd") > 0) & (F.abs(F.col(value) - F.col("mean")) > sigmas * F.col("sd")))


def verdict(checks: DataFrame, by: Sequence[str], passed: str = "passed", external: str = "external") -> DataFrame:
    """by..., external_checks, ok: all external checks pass and there is at least one."""
    out = checks.groupBy(*by).agg(F.count_if(external).alias("external_checks"), F.count_if(F.col(external) & ~F.coalesce(passed, F.lit(False))).alias("_bad"))
    return out.select(*by, "external_checks", ((F.col("external_checks") > 0) & (F.col("_bad") == 0)).alias("ok"))


def set_difference(left: DataFrame, right: DataFrame, names: tuple[str, str] = ("missing", "unexpected")) -> DataFrame:
    """side, and the columns of left: rows that only one side has."""
    one, two = left.subtract(right), right.subtract(left)
    return one.select(F.lit(names[0]).alias("side"), "*").unionByName(two.select(F.lit(names[1]).alias("side"), "*"))


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of two bags that don't pair up, with the side that has them too often."""
    return left.exceptAll(right).select(F.lit("left").alias("side"), "*").unionByName(right.exceptAll(left).select(F.lit("right").alias("side"), "*"))


def pages_as_ranges(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """by..., ranges such as '1-3, 7, 9-10' over the distinct numbers of each group."""
    d = df.select(*by, number).distinct()
    d = d.withColumn("_i", F.col(number) - F.row_number().over(W.partitionBy(*by).orderBy(number)))
    runs = d.groupBy(*by, "_i").agg(F.min(number).alias("a"), F.max(number).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    return runs.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", text.alias("t")))), lambda x: x["t"]), ", ").alias("ranges"))


def violations(df: DataFrame, key: Column, invariants: Sequence[tuple[str, Column]]) -> DataFrame:
    """(invariant, key) for each row that breaks a row-level invariant; null conditions count as broken. Empty means pass."""
    each = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in invariants))
    return df.select(F.explode(F.filter(each, lambda x: x.isNotNull())).alias("invariant"), key.cast("string").alias("key"))


def not_unique(df: DataFrame, cols: Sequence[str], invariant: str) -> DataFrame:
    """(invariant, key) for each repeated combination."""
    return df.groupBy(*cols).count().filter("count > 1").select(F.lit(invariant).alias("invariant"), F.concat_ws("/", *cols).alias("key"))


def shared_across(df: DataFrame, value: str, owner: str, invariant: str) -> DataFrame:
    """(invariant, key) for each value that more than one owner has."""
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count_distinct(owner).alias("n")).filter("n > 1").select(F.lit(invariant).alias("invariant"), F.col(value).cast("string").alias("key"))


def outside(df: DataFrame, column: str, domain: Sequence, invariant: str) -> DataFrame:
    """(invariant, key) for each value that isn't in a domain."""
    return df.select(column).distinct().filter(~F.coalesce(F.col(column).isin(*domain), F.lit(False))).select(F.lit(invariant).alias("invariant"), F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("key"))


def mixed_within(df: DataFrame, group: Sequence[str], column: str, invariant: str) -> DataFrame:
    """(invariant, key) for each group with more than one value."""
    return df.groupBy(*group).agg(F.count_distinct(column).alias("n")).filter("n > 1").select(F.lit(invariant).alias("invariant"), F.concat_ws("/", *group).alias("key"))


def not_one_to_one(df: DataFrame, one: str, other: str, invariant: str) -> DataFrame:
    """(invariant, key) for each value of either column that goes with several of the other."""
    pairs = df.select(F.col(one).cast("string").alias("a"), F.col(other).cast("string").alias("b")).distinct()
    both = pairs.groupBy("a").count().select(F.col("a").alias("key"), "count").unionByName(pairs.groupBy("b").count().select(F.col("b").alias("key"), "count"))
    return both.filter("count > 1").select(F.lit(invariant).alias("invariant"), "key")


def broken_sequence(df: DataFrame, group: Sequence[str], number: str, invariant: str) -> DataFrame:
    """(invariant, key) for each group whose numbers aren't 1 to n, each once."""
    out = df.groupBy(*group).agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.count("*").alias("n"), F.count_distinct(number).alias("d"))
    return out.filter("lo <> 1 OR hi <> n OR d <> n").select(F.lit(invariant).alias("invariant"), F.concat_ws("/", *group).alias("key"))


def below_floor(df: DataFrame, group: Sequence[str], column: str, floor: float, invariant: str) -> DataFrame:
    """(invariant, key) for each group in which fewer rows than the floor have a value."""
    rate = F.avg(F.when(F.coalesce(F.col(column).cast("string"), F.lit("")) != "", 1.0).otherwise(0.0))
    return df.groupBy(*group).agg(rate.alias("r")).filter(F.col("r") < floor).select(F.lit(invariant).alias("invariant"), F.concat_ws("/", *group).alias("key"))


def by_group(df: DataFrame, group: Sequence[str], rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """(invariant, key, n) for each group in which a rule's aggregate counts n findings, n over 0: any number of rules in one
    grouped pass. A row rule is F.count_if(~ok), a rule of the group F.when(broken, 1)."""
    out = df.groupBy(*group).agg(*(F.coalesce(c.cast("long"), F.lit(0)).alias(f"_r{k}") for k, (_, c) in enumerate(rules)))
    found = F.array(*(F.when(F.col(f"_r{k}") > 0, F.struct(F.lit(n).alias("invariant"), F.col(f"_r{k}").alias("n"))) for k, (n, _) in enumerate(rules)))
    return out.select(F.concat_ws("/", *group).alias("key"), F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select("x.invariant", "key", "x.n")


def counts_differ(rows: DataFrame, entries: DataFrame, key: Sequence[str], claimed: str, invariant: str) -> DataFrame:
    """(invariant, key) for each entry whose claimed number of rows isn't the number there is; no rows are 0."""
    have = rows.groupBy(*key).agg(F.count("*").alias("n"))
    out = entries.join(have, list(key), "full").filter(~F.coalesce("n", F.lit(0)).eqNullSafe(F.col(claimed)))
    return out.select(F.lit(invariant).alias("invariant"), F.concat_ws("/", *key).alias("key"))


def not_covered(left: DataFrame, right: DataFrame, key: Sequence[str], invariant: str) -> DataFrame:
    """(invariant, key) for each key that only one side has."""
    return set_difference(left.select(*key).distinct(), right.select(*key).distinct()).select(F.lit(invariant).alias("invariant"), F.concat_ws("/", *key).alias("key"))
