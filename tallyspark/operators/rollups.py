"""Roll-ups of runs: shares by part, statuses, summaries, costs, published totals, second readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.modes import filled
from tallyspark.operators.quality import fill_rates


def corpus_summary(parts: DataFrame, found: str, total: str, share: Column, sigmas: float = 3.0) -> DataFrame:
    """parts, measured, matches, rows, printed, mean_share (each part counts alike), mean_gap, sd_gap (population) and
    outliers (strictly beyond `sigmas`; none where sd is 0)."""
    rows = parts.withColumns({"_gap": F.when(F.col(total).isNotNull(), F.col(found) - F.col(total)), "_share": share})
    stats = rows.agg(F.count("*").alias("parts"), F.count(total).alias("measured"), F.count_if(F.col("_gap") == 0).alias("matches"), F.sum(found).alias("rows"), F.sum(total).alias("printed"), F.avg("_share").alias("mean_share"), F.avg("_gap").alias("mean_gap"), F.stddev_pop("_gap").alias("sd_gap"))
    beyond = rows.join(F.broadcast(stats.select("mean_gap", "sd_gap"))).filter((F.col("sd_gap") > 0) & (F.abs(F.col("_gap") - F.col("mean_gap")) > sigmas * F.col("sd_gap"))).agg(F.count("*").alias("outliers"))
    return stats.join(F.broadcast(beyond))


def quality_report(rows: DataFrame, fields: Sequence[str], problems: Column, external: DataFrame) -> DataFrame:
    """metric, value: rows, the fill of each field, the share without a problem, the rate of each problem, and the external
    measures as they come."""
    fills = fill_rates(rows, fields, "nonblank").select(F.concat(F.lit("filled "), "field").alias("metric"), F.col("rate").cast("double").alias("value"))
    marked = rows.select(problems.alias("_p"))
    whole = marked.agg(F.count("*").cast("double").alias("rows"), F.avg((F.size("_p") == 0).cast("int")).alias("sound"))
    whole_rows = whole.select(F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("rows", "sound")))))
    each = marked.select(F.explode("_p").alias("_n")).groupBy("_n").agg(F.count("*").alias("_c")).join(F.broadcast(whole.select("rows")))
    each = each.select(F.concat(F.lit("problem "), "_n").alias("metric"), (F.col("_c") / F.col("rows")).alias("value"))
    return whole_rows.unionByName(fills).unionByName(each).unionByName(external)


def agreement_by_flag(cheap: DataFrame, dear: DataFrame, key: Sequence[str], flagged: Column, fields: Sequence[str]) -> DataFrame:
    """field, flagged_rows, unflagged_rows, flagged_rate, unflagged_rate, ratio: how often two passes agree where either has
    a value, by whether the first was flagged."""
    pairs = cheap.select(*key, flagged.alias("_f"), *(F.col(f).cast("string").alias(f"a_{f}") for f in fields)).join(dear.select(*key, *(F.col(f).cast("string").alias(f"b_{f}") for f in fields)), list(key))
    each = pairs.select("_f", F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("a"), F.col(f"b_{f}").alias("b")) for f in fields))))
    each = each.filter(filled("a", "truthy") | filled("b", "truthy"))
    same = F.col("a").eqNullSafe(F.col("b"))
    out = each.groupBy("field").agg(F.count_if("_f").alias("flagged_rows"), F.count_if(~F.col("_f")).alias("unflagged_rows"), F.count_if(F.col("_f") & same).alias("_x"), F.count_if(~F.col("_f") & same).alias("_y"))
    out = out.withColumns({"flagged_rate": F.try_divide("_x", "flagged_rows"), "unflagged_rate": F.try_divide("_y", "unflagged_rows")})
    return out.select("field", "flagged_rows", "unflagged_rows", "flagged_rate", "unflagged_rate", F.try_divide("flagged_rate", "unflagged_rate").alias("ratio"))


def second_pass_summary(before: DataFrame, after: DataFrame, key: Sequence[str], fields: Sequence[str], flags: str = "flags") -> DataFrame:
    """field, before, after, recovered, disagreed, overruled over the rows of both passes."""
    both = before.select(*key, *(F.col(f).alias(f"a_{f}") for f in fields)).join(after.select(*key, flags, *(F.col(f).alias(f"b_{f}") for f in fields)), list(key))
    has = lambda name: F.coalesce(F.array_contains(F.split(flags, ","), name), F.lit(False))
    each = both.select(F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(filled(f"a_{f}"), F.lit(False)).alias("a"), F.coalesce(filled(f"b_{f}"), F.lit(False)).alias("b"), has(f"disagreed_{f}").alias("d"), has(f"overruled_{f}").alias("o")) for f in fields))))
    return each.groupBy("field").agg(F.count_if("a").alias("before"), F.count_if("b").alias("after"), F.count_if(~F.col("a") & F.col("b")).alias("recovered"), F.count_if("d").alias("disagreed"), F.count_if("o").alias("overruled"))


def status_rollup(parts: DataFrame, by: Sequence[str], done: Column, rows: Column, total: Column, tolerance: float = 0.002) -> DataFrame:
    """by..., parts, done, rows, printed, verdict: 'empty', 'partial', 'off' (rows differ from the printed total by more than
    the tolerance) or 'done'."""
    out = parts.groupBy(*by).agg(F.count("*").alias("parts"), F.count_if(done).alias("done"), F.coalesce(F.sum(rows), F.lit(0)).alias("rows"), F.coalesce(F.sum(total), F.lit(0)).alias("printed"))
    off = F.abs(F.col("rows") - F.col("printed")) > tolerance * F.col("printed")
    return out.withColumn("verdict", F.when(F.col("done") == 0, "empty").when(F.col("done") < F.col("parts"), "partial").when(off, "off").otherwise("done"))


def run_summary(parts: DataFrame, failed: Column, rows: str, pages: str, images: Column, price: float) -> DataFrame:
    """parts, failed, rows, pages, billed and dollars of a run."""
    out = parts.agg(F.count("*").alias("parts"), F.count_if(failed).alias("failed"), F.sum(rows).alias("rows"), F.sum(pages).alias("pages"), F.sum(images).alias("billed"))
    return out.withColumn("dollars", F.col("billed") * price)


def usage_cost(calls: DataFrame, by: Sequence[str], spent: dict[str, float], per: int = 1_000_000) -> DataFrame:
    """by..., calls and cost: token counts by kind, each at its price for `per` tokens."""
    cost = sum((F.sum(c) * (price / per) for c, price in spent.items()), F.lit(0.0))
    return calls.groupBy(*by).agg(F.count("*").alias("calls"), cost.alias("cost"))


def published_totals(totals: DataFrame, key: Sequence[str], by: Sequence[str], value: str) -> DataFrame:
    """by..., parts, measured, total: published counts by group; a key that comes twice fails the query (see keyed())."""
    from tallyspark.sources.sinks import keyed

    return keyed(totals, key).groupBy(*by).agg(F.count("*").alias("parts"), F.count(value).alias("measured"), F.sum(value).alias("total"))


def fleet_summary(states: DataFrame, claims: DataFrame, uploaded: DataFrame, key: str) -> DataFrame:
    """metric, value: keys in each state, distinct machines, keys claimed by more than one, keys done but not uploaded."""
    by_state = states.groupBy("state").agg(F.count("*").alias("value")).select(F.concat(F.lit("state "), "state").alias("metric"), "value")
    hosts = claims.agg(F.count_distinct("host").alias("value")).select(F.lit("machines").alias("metric"), "value")
    twice = claims.groupBy(key).agg(F.count_distinct("host").alias("n")).agg(F.count_if(F.col("n") > 1).alias("value")).select(F.lit("claimed twice").alias("metric"), "value")
    left = states.filter("state = 'done'").join(uploaded.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("value")).select(F.lit("not uploaded").alias("metric"), "value")
    return by_state.unionByName(hosts).unionByName(twice).unionByName(left)


def fuzzy_agreement(pairs: DataFrame, field: str, a: str, b: str) -> DataFrame:
    """field, n, exact, skeleton, similarity (mean), both_blank, and a row 'all' with the means of the fields' rates.

    Skeletons and similarities are taken of distinct pairs.
    """
    from tallyspark.functions.fuzzy import seq_ratio, skeleton

    seen = pairs.select(F.coalesce(a, F.lit("")).alias("_a"), F.coalesce(b, F.lit("")).alias("_b"), field)
    distinct = seen.select("_a", "_b").distinct()
    scored = distinct.withColumns({"_k": skeleton("_a") == skeleton("_b"), "_s": seq_ratio("_a", "_b")})
    rows = seen.join(scored, ["_a", "_b"])
    blank = (F.col("_a") == "") & (F.col("_b") == "")
    per = rows.groupBy(field).agg(F.count("*").alias("n"), F.count_if(F.col("_a") == F.col("_b")).alias("exact"), F.count_if("_k").alias("skeleton"), F.avg(F.when(blank, 1.0).otherwise(F.col("_s"))).alias("similarity"), F.count_if(blank).alias("both_blank"))
    rates = per.select(field, "n", *((F.col(c) / F.col("n")).alias(c) for c in ("exact", "skeleton")), "similarity", (F.col("both_blank") / F.col("n")).alias("both_blank"))
    return rates.unionByName(rates.agg(F.lit("all").alias(field), F.sum("n").alias("n"), *(F.avg(c).alias(c) for c in ("exact", "skeleton", "similarity", "both_blank"))))
