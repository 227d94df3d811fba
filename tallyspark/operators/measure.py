"""Agreement, accuracy, association, routing, gates, intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.modes import filled


def long_form(df: DataFrame, keys: Sequence[str], fields: Sequence[str], value: str = "value") -> DataFrame:
    return df.select(*keys, F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(value)) for f in fields))))


def agreement(left: DataFrame, right: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """field, n, exact, both_blank, rate over the keys that both have; blanks agree with blanks."""
    both = long_form(left, key, fields, "a").join(long_form(right, key, fields, "b"), [*key, "field"])
    a, b = F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))
    out = both.groupBy("field").agg(F.count("*").alias("n"), F.count_if(a == b).alias("exact"), F.count_if((a == "") & (b == "")).alias("both_blank"))
    return out.withColumn("rate", F.col("exact") / F.greatest("n", F.lit(1)))


def common_keys(arms: DataFrame, key: Sequence[str], arm: str, n_arms: int) -> DataFrame:
    """The keys that every arm returned."""
    return arms.groupBy(*key).agg(F.count_distinct(arm).alias("_n")).filter(F.col("_n") == n_arms).select(*key)


def unanimous(arms: DataFrame, key: Sequence[str], arm: str, fields: Sequence[str], n_arms: int) -> DataFrame:
    """field, n, unanimous, share over the keys common to all arms; a null is a value like any other."""
    rows = long_form(arms.join(common_keys(arms, key, arm, n_arms), list(key), "left_semi"), [*key, arm], fields)
    per = rows.groupBy(*key, "field").agg(F.count_distinct(F.coalesce("value", F.lit("\0"))).alias("_values"))
    out = per.groupBy("field").agg(F.count("*").alias("n"), F.count_if(F.col("_values") == 1).alias("unanimous"))
    return out.withColumn("share", F.col("unanimous") / F.col("n"))


def blank_rates(arms: DataFrame, key: Sequence[str], arm: str, fields: Sequence[str], n_arms: int) -> DataFrame:
    """arm, field, blank, n, rate over the common keys."""
    rows = long_form(arms.join(common_keys(arms, key, arm, n_arms), list(key), "left_semi"), [*key, arm], fields)
    out = rows.groupBy(arm, "field").agg(F.count_if(~filled("value")).alias("blank"), F.count("*").alias("n"))
    return out.withColumn("rate", F.col("blank") / F.col("n"))


def associations(df: DataFrame, failures: Sequence[tuple[str, Column]], features: Sequence[str], least_support: int = 30, least_lift: float = 1.5, circular: Sequence[tuple[str, str]] = (), most_base: float = 0.9) -> DataFrame:
    """failure, feature, value, support, failed, rate, base, lift: where failures gather.

    A failure with base 0 or over most_base says nothing, and neither does a pair whose feature defines its failure.
    """
    bad = F.array(*(F.coalesce(c, F.lit(False)).cast("int") for _, c in failures))
    seen = F.array(*(F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value")) for f in features))
    rows = df.select(bad.alias("_b"), F.inline(seen)).groupBy("feature", "value").agg(F.count("*").alias("support"), *(F.sum(F.get(F.col("_b"), F.lit(k))).alias(f"_f{k}") for k in range(len(failures))))
    rows = rows.select("feature", "value", "support", F.inline(F.array(*(F.struct(F.lit(n).alias("failure"), F.col(f"_f{k}").cast("long").alias("failed")) for k, (n, _) in enumerate(failures)))))
    one = features[0]
    base = rows.filter(F.col("feature") == one).groupBy("failure").agg((F.sum("failed") / F.sum("support")).alias("base"))
    out = rows.join(F.broadcast(base), "failure").filter((F.col("base") > 0) & (F.col("base") <= most_base) & (F.col("support") >= least_support))
    for failure, feature in circular:
        out = out.filter(~((F.col("failure") == failure) & (F.col("feature") == feature)))
    out = out.withColumn("rate", F.col("failed") / F.col("support")).withColumn("lift", F.col("rate") / F.col("base"))
    return out.filter(F.col("lift") >= least_lift).select("failure", "feature", "value", "support", "failed", "rate", "base", "lift")


def priorities(df: DataFrame, failures: Sequence[tuple[str, Column]], features: Sequence[str], tractable: float = 1.5, **kw) -> DataFrame:
    """failure, affected, share, best_lift (1 without an association), tractable; the most affected first."""
    best = associations(df, failures, features, least_lift=1.0, **kw).groupBy("failure").agg(F.max("lift").alias("_l"))
    each = F.array(*(F.struct(F.lit(n).alias("failure"), F.coalesce(c, F.lit(False)).alias("bad")) for n, c in failures))
    out = df.select(F.inline(each)).groupBy("failure").agg(F.count_if("bad").alias("affected"), F.count("*").alias("_n"))
    lift = F.coalesce("_l", F.lit(1.0))
    out = out.join(best, "failure", "left").select("failure", "affected", (F.col("affected") / F.col("_n")).alias("share"), lift.alias("best_lift"), (lift >= tractable).alias("tractable"))
    return out.orderBy(F.desc("affected"), "failure")


def routing(df: DataFrame, families: Sequence[tuple[str, Column]]) -> DataFrame:
    """family, n, only: rows that each family sends on, and those that no other family does; 'any' is the union."""
    flags = {n: F.coalesce(c, F.lit(False)) for n, c in families}
    total = sum((f.cast("int") for f in flags.values()), F.lit(0))
    each = [F.struct(F.lit(n).alias("family"), f.alias("hit"), (f & (total == 1)).alias("only")) for n, f in flags.items()]
    each.append(F.struct(F.lit("any").alias("family"), (total > 0).alias("hit"), (total == 1).alias("only")))
    return df.select(F.inline(F.array(*each))).groupBy("family").agg(F.count_if("hit").alias("n"), F.count_if("only").alias("only"))


def separation(df: DataFrame, flag: Column, implausible: Column) -> DataFrame:
    """flagged_n, flagged_rate, base_n, base_rate, ratio: 1 when both rates are 0, infinity when only the base is."""
    f, bad = F.coalesce(flag, F.lit(False)), F.coalesce(implausible, F.lit(False))
    out = df.agg(F.count_if(f).alias("flagged_n"), F.count_if(f & bad).alias("_a"), F.count_if(~f).alias("base_n"), F.count_if(~f & bad).alias("_b"))
    rate = [F.when(F.col(n) > 0, F.col(x) / F.col(n)).otherwise(0.0) for n, x in (("flagged_n", "_a"), ("base_n", "_b"))]
    out = out.withColumns({"flagged_rate": rate[0], "base_rate": rate[1]})
    ratio = F.when(F.col("base_rate") > 0, F.col("flagged_rate") / F.col("base_rate")).when(F.col("flagged_rate") > 0, F.lit(float("inf"))).otherwise(1.0)
    return out.select("flagged_n", "flagged_rate", "base_n", "base_rate", ratio.alias("ratio"))


def accuracy(truth: DataFrame, read: DataFrame, key: Sequence[str], field: str, by: Sequence[str] = ()) -> DataFrame:
    """by..., n, right, blank, wrong, accuracy of read.field against truth.field on the keys of the truth."""
    both = truth.select(*key, F.col(field).alias("_t")).join(read.select(*key, *by, F.col(field).alias("_r")), list(key))
    ok, blank = F.col("_t").eqNullSafe(F.col("_r")), ~filled("_r")
    out = both.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(ok).alias("right"), F.count_if(~ok & blank).alias("blank"), F.count_if(~ok & ~blank).alias("wrong"))
    return out.withColumn("accuracy", F.col("right") / F.greatest("n", F.lit(1)))


def wilson(right: Column, total: Column, z: float = 1.96) -> Column:
    """struct(low, high) of the Wilson score interval, within [0, 1]; zeros for no trial."""
    n, p = F.greatest(total, F.lit(1)).cast("double"), right / F.greatest(total, F.lit(1))
    mid, half = (p + z * z / (2 * n)) / (1 + z * z / n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return F.struct(F.when(total > 0, F.greatest(F.lit(0.0), mid - half)).otherwise(0.0).alias("low"), F.when(total > 0, F.least(F.lit(1.0), mid + half)).otherwise(0.0).alias("high"))


def gates(before: DataFrame, after: DataFrame, target: str, least_gain: float, guarded: Sequence[str], most_loss: float = 0.02, cost: str | None = None, most_cost: float = 0.1, lower_is_better: Sequence[str] = ()) -> DataFrame:
    """gate, metric, before, after, passed over metric tables (metric, value); a metric missing on a side fails its gate."""
    b, a = before.select("metric", F.col("value").alias("before")), after.select("metric", F.col("value").alias("after"))
    both = b.join(a, "metric", "full")
    sign = F.when(F.col("metric").isin(*lower_is_better), -1.0).otherwise(1.0)
    gain = (F.col("after") - F.col("before")) * sign
    wanted = [(target, "target")] + [(g, "guard") for g in guarded] + ([(cost, "cost")] if cost else [])
    names = F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(g).alias("gate")) for m, g in wanted))
    asked = before.sparkSession.range(1).select(F.inline(names))
    rows = asked.join(both, "metric", "left")
    ok = F.when(F.col("gate") == "target", gain >= least_gain).when(F.col("gate") == "guard", gain >= -most_loss).otherwise(F.col("after") <= F.col("before") * (1 + most_cost))
    return rows.select("gate", "metric", "before", "after", F.coalesce(ok, F.lit(False)).alias("passed"))


def vote(readings: DataFrame, key: Sequence[str], value: str, preference: str) -> DataFrame:
    """key..., value, votes: the value with most votes, ties to the reader with the lowest preference number."""
    counts = readings.groupBy(*key, value).agg(F.count("*").alias("votes"), F.min(preference).alias("_p"))
    best = counts.groupBy(*key).agg(F.max(F.struct("votes", (-F.col("_p")).alias("_q"), value)).alias("_m"))
    return best.select(*key, F.col(f"_m.{value}").alias(value), F.col("_m.votes").alias("votes"))
