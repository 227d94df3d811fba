"""Aggregates of the reports: parts, fields, costs, fleets, promises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.modes import filled


def flag_rates(df: DataFrame, flags: Column, watched: Sequence[str]) -> DataFrame:
    """flag, n, rate for every flag seen and every watched one; the rate is over all rows, at least one."""
    # each row counts once under '', which is no flag, so that one pass has the total too
    counts = df.select(F.explode(F.array_distinct(F.concat(F.array(F.lit("")), F.array(F.lit("")), flags))).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
    total = counts.agg(F.greatest(F.coalesce(F.sum(F.when(F.col("flag") == "", F.col("n"))), F.lit(0)), F.lit(1)).alias("total"))
    wanted = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, watched))).alias("flag"))
    both = counts.filter("flag <> ''").join(wanted, "flag", "full").join(F.broadcast(total))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return both.select("flag", n.alias("n"), (n / F.col("total")).alias("rate"))


def shapes(df: DataFrame, value: str, short: int, k: int) -> DataFrame:
    """shape (empty, short, garbled), n and the commonest k values of each kind by count, then value."""
    s = F.trim(F.coalesce(F.col(value), F.lit("")))
    kind = F.when(s == "", "empty").when(F.length(s) < short, "short").otherwise("garbled")
    return df.select(kind.alias("shape"), s.alias("value")).groupBy("shape", "value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "shape", "value").limit(k)


def population_share(df: DataFrame, male: Column, female: Column, published: float, tolerance: float = 0.02) -> DataFrame:
    """male, female, share, passed: the ratio of the sums against a published share; no data fails."""
    out = df.agg(F.coalesce(F.sum(male.cast("long")), F.lit(0)).alias("male"), F.coalesce(F.sum(female.cast("long")), F.lit(0)).alias("female"))
    share = F.when(F.col("male") + F.col("female") > 0, F.col("male") / (F.col("male") + F.col("female")))
    return out.withColumn("share", share).withColumn("passed", F.coalesce(F.abs(F.col("share") - published) <= tolerance, F.lit(False)))


def populated(df: DataFrame, by: Sequence[str], fields: Sequence[str], floor: float = 0.5) -> DataFrame:
    """by..., lowest, passed: the lowest fill of the fields in each group against the floor."""
    rates = [F.avg(F.coalesce(filled(f, "nonblank_nonzero"), F.lit(False)).cast("int")) for f in fields]
    lowest = F.least(*rates) if len(rates) > 1 else rates[0]
    return df.groupBy(*by).agg(lowest.alias("lowest")).withColumn("passed", F.col("lowest") >= floor)


def extrapolated_cost(df: DataFrame, by: Sequence[str], pages: Column, per_call: int, price: float, all_pages: int) -> DataFrame:
    """by..., pages, calls (pages in fixed-size calls), cost, and projected = round(all pages / pages per call) * price."""
    out = df.groupBy(*by).agg(F.sum(pages).alias("pages"), F.sum(F.ceil(pages / per_call)).alias("calls"))
    return out.withColumns({"cost": F.col("calls") * price, "projected": F.bround(F.lit(float(all_pages)) / (F.col("pages") / F.greatest("calls", F.lit(1)))) * price})


def fleet(work: DataFrame, archives: DataFrame, claims: DataFrame, key: str, now: Column, stale: int = 1800) -> DataFrame:
    """key, state: done, stale or running (by the last beat of a claim), waiting (archive alone), or unknown."""
    last = claims.groupBy(key).agg(F.max("beat").alias("beat"), F.count_distinct("host").alias("hosts"))
    done = work.select(key).distinct().withColumn("_done", F.lit(True))
    have = archives.select(key).distinct().withColumn("_have", F.lit(True))
    rows = have.join(done, key, "full").join(last, key, "full")
    age = F.unix_timestamp(now) - F.unix_timestamp("beat")
    state = F.when(F.col("_done"), "done").when(F.col("beat").isNotNull() & (age > stale), "stale").when(F.col("beat").isNotNull(), "running").when(F.col("_have"), "waiting").otherwise("unknown")
    return rows.select(key, state.alias("state"), F.coalesce("hosts", F.lit(0)).alias("hosts"))


def promises(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """check, passed, failing: dataset-level promises from one pass; a promise is a row condition that holds everywhere."""
    out = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(f"_{k}") for k, (_, c) in enumerate(checks)))
    return out.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), (F.col(f"_{k}") == 0).alias("passed"), F.col(f"_{k}").alias("failing")) for k, (n, _) in enumerate(checks)))))


def inverted_index(df: DataFrame, token: str, text: str, pattern: str = "([a-z]+)") -> DataFrame:
    """word, tokens (sorted): the tokens whose text holds each word."""
    words = df.select(F.col(token).alias("token"), F.explode(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))).alias("word"))
    return words.groupBy("word").agg(F.array_sort(F.collect_set("token")).alias("tokens"))


def timings(df: DataFrame, by: Sequence[str], seconds: str) -> DataFrame:
    return df.groupBy(*by).agg(F.median(seconds).alias("median"), F.avg(seconds).alias("mean"), F.min(seconds).alias("least"), F.max(seconds).alias("most"), F.count("*").alias("n"))


def sorted_set(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.array_sort(F.collect_set(value)).alias(name))


def repaired_total(rows: DataFrame, parts: Sequence[str], total: str, again: Sequence[dict[str, str]]) -> DataFrame:
    """rows with the first reading whose parts sum to its total, then parts of one reading with the same total of another.

    `again` maps the fields to the columns of further readings. taken names the reading ('0' the first, 'mixed', '').
    """
    readings = [{f: f for f in (*parts, total)}, *again]
    balances = [sum((F.col(r[p]) for p in parts), F.lit(0)) == F.col(r[total]) for r in readings]
    taken = None
    for k, ok in enumerate(balances):
        taken = F.when(ok, str(k)) if taken is None else taken.when(ok, str(k))
    sums = [sum((F.col(r[p]) for p in parts), F.lit(0)) for r in readings]
    mixed = F.coalesce(*(F.when(F.array_contains(F.array(*(F.col(x[total]) for x in readings)), s), s) for s in sums))
    return rows.withColumn("taken", taken.otherwise(F.when(mixed.isNotNull(), "mixed").otherwise(""))).withColumn("settled", F.coalesce(*(F.when(ok, F.col(r[total])) for ok, r in zip(balances, readings, strict=True)), mixed))
