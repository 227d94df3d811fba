"""Row-level floors, fill and sound rates, distributions, duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.operators.modes import filled


@dataclass(frozen=True)
class Detector:
    """condemned counts rows that are certainly wrong; `applies` says which rows it looks at."""

    name: str
    condemned: Column
    applies: Column
    example: Column


def floor_scan(df: DataFrame, detectors: Sequence[Detector], by: Sequence[str] = (), examples: int = 4) -> DataFrame:
    """by..., detector, condemned, total, rate, examples (the first few in order), one row for each detector and group."""
    each = F.array(*(F.struct(F.lit(d.name).alias("detector"), F.coalesce(d.condemned & d.applies, F.lit(False)).alias("hit"), F.coalesce(d.applies, F.lit(False)).alias("seen"), d.example.cast("string").alias("example")) for d in detectors))
    rows = df.select(*by, F.inline(each))
    out = rows.groupBy(*by, "detector").agg(F.count_if("hit").alias("condemned"), F.count_if("seen").alias("total"))
    top = rows.filter("hit AND example IS NOT NULL").select(*by, "detector", "example").distinct()
    w = W.partitionBy(*by, "detector").orderBy("example")
    first = top.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= examples).groupBy(*by, "detector").agg(F.array_sort(F.collect_list("example")).alias("examples"))
    keys = [*by, "detector"]
    return out.join(first, keys, "left").select(*keys, "condemned", "total", F.when(F.col("total") > 0, F.col("condemned") / F.col("total")).otherwise(0.0).alias("rate"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def combine_floors(parts: DataFrame, keys: Sequence[str] = ("detector",)) -> DataFrame:
    """Shard results merged by detector; rates follow from the sums."""
    out = parts.groupBy(*keys).agg(F.sum("condemned").alias("condemned"), F.sum("total").alias("total"))
    return out.withColumn("rate", F.when(F.col("total") > 0, F.col("condemned") / F.col("total")).otherwise(0.0))


def duplicates(df: DataFrame, key: str, well_formed: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """by..., surplus (sum of n - 1), rows_in_repeats (sum of n over repeats), repeated (values that repeat), non_empty.

    With a pattern only well-formed values count as repeats. The four variants of a duplicate count are among these
    with and without it.
    """
    rows = df.filter(filled(key, "nonblank"))
    if well_formed:
        rows = rows.filter(F.col(key).rlike(well_formed))
    n = rows.groupBy(*by, key).agg(F.count("*").alias("n"))
    return n.groupBy(*by).agg(F.sum(F.col("n") - 1).alias("surplus"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_in_repeats"), F.count_if(F.col("n") > 1).alias("repeated"), F.sum("n").alias("non_empty"))


def fill_rates(df: DataFrame, fields: Sequence[str], mode: str, by: Sequence[str] = ()) -> DataFrame:
    """by..., field, filled, n, rate in long form; an empty group has rate 0."""
    each = F.array(*(F.struct(F.lit(f).alias("field"), filled(f, mode).cast("int").alias("x")) for f in fields))
    out = df.select(*by, F.inline(each)).groupBy(*by, "field").agg(F.sum("x").cast("long").alias("filled"), F.count("*").alias("n"))
    return out.withColumn("rate", F.col("filled") / F.greatest("n", F.lit(1)))


def sound_rates(df: DataFrame, fields: Sequence[str], problems: str = "problems", mode: str = "truthy") -> DataFrame:
    """field, sound, n, rate: filled and no problem whose name contains the field's first word."""
    def clear(f: str) -> Column:
        return ~F.exists(problems, lambda p: p.contains(f.split("_")[0]))

    each = F.array(*(F.struct(F.lit(f).alias("field"), (filled(f, mode) & clear(f)).cast("int").alias("x")) for f in fields))
    out = df.select(F.inline(each)).groupBy("field").agg(F.sum("x").cast("long").alias("sound"), F.count("*").alias("n"))
    return out.withColumn("rate", F.col("sound") / F.col("n"))


def single_occupants(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """groups, single, share: how many groups hold exactly one row."""
    sizes = df.groupBy(*group).count()
    return sizes.agg(F.count("*").alias("groups"), F.count_if(F.col("count") == 1).alias("single")).withColumn("share", F.col("single") / F.greatest("groups", F.lit(1)))


def histogram(df: DataFrame, bin_: Column, name: str = "bin") -> DataFrame:
    return df.filter(bin_.isNotNull()).groupBy(bin_.alias(name)).agg(F.count("*").alias("n"))


def digit_spread(df: DataFrame, value: Column) -> DataFrame:
    """n and (largest - smallest count of a last digit) / n over the digits 0 to 9, absent ones counting 0."""
    digit = F.pmod(value.cast("long"), F.lit(10)).cast("int")
    rows = df.filter(value.isNotNull())
    one = rows.agg(*(F.count_if(digit == d).alias(f"_{d}") for d in range(10)), F.count("*").alias("n"))
    cols = [F.col(f"_{d}") for d in range(10)]
    return one.select("n", ((F.greatest(*cols) - F.least(*cols)) / F.greatest("n", F.lit(1))).alias("spread"))
