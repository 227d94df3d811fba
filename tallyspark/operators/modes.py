"""Most common values with a stated tie rule, and the three medians."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def filled(c: Column | str, mode: str = "nonblank") -> Column:
    """The three meanings of a filled field: 'truthy' (not null, blank, zero or false), 'nonblank', 'nonblank_nonzero'."""
    c = F.col(c) if isinstance(c, str) else c
    s = c.cast("string")
    has = c.isNotNull() & (s != "")
    if mode == "nonblank":
        return has
    zero = s.rlike(r"^[+-]?0+(\.0*)?$")
    return has & ~zero & (s != "false") if mode == "truthy" else has & ~zero


def modal(df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (), name: str = "mode") -> DataFrame:
    """by..., mode, n, share: the most common filled value of each group; of equals, the one that comes first by `order`."""
    rows = df.filter(filled(value, "nonblank"))
    counts = rows.groupBy(*by, F.col(value).alias(name)).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("_first"))
    total = F.sum("n").over(W.partitionBy(*(by or [F.lit(0)])))
    if not by:
        best = counts.orderBy(F.desc("n"), "_first").limit(1)
        return best.crossJoin(counts.agg(F.sum("n").alias("_all"))).select(name, "n", (F.col("n") / F.col("_all")).alias("share"))
    w = W.partitionBy(*by).orderBy(F.desc("n"), "_first")
    return counts.withColumn("share", F.col("n") / total).withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*by, name, "n", "share")


def modal_table(df: DataFrame, fields: Mapping[str, str | None], order: Sequence[str]) -> DataFrame:
    """field, scope, mode, n: the commonest filled value of each field as a string, within each value of its scope column (''
    for a field without one), from one scan; of equals, the one that comes first by `order`."""
    each = [F.struct(F.lit(f).alias("field"), (F.col(s).cast("string") if s else F.lit("")).alias("scope"), F.when(filled(f), F.col(f).cast("string")).alias("mode")) for f, s in fields.items()]
    rows = df.select(F.struct(*order).alias("_o"), F.inline(F.array(*each))).filter(F.col("mode").isNotNull())
    counts = rows.groupBy("field", "scope", "mode").agg(F.count("*").alias("n"), F.min("_o").alias("_first"))
    best = counts.groupBy("field", "scope").agg(F.min(F.struct((-F.col("n")).alias("m"), "_first", "mode")).alias("b"))
    return best.select("field", "scope", F.col("b.mode").alias("mode"), (-F.col("b.m")).alias("n"))


def upper_medians(df: DataFrame, by: Sequence[str], value: str, name: str = "upper_median") -> DataFrame:
    """by..., n, and sorted(x)[n // 2] of each group's values that aren't null; groups without any are left out.

    Equal values are counted first; what a group sorts is its distinct values, and none are gathered in an array.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    g = W.partitionBy(*by)
    ranked = counted.withColumns({"_upto": F.sum("_c").over(g.orderBy(value).rowsBetween(W.unboundedPreceding, 0)), "n": F.sum("_c").over(g)})
    middle = F.floor(F.col("n") / 2)
    return ranked.filter((F.col("_upto") > middle) & (F.col("_upto") - F.col("_c") <= middle)).select(*by, "n", F.col(value).alias(name))


def tolerance_mode(df: DataFrame, value: str, by: Sequence[str], tolerance: float, order: str) -> DataFrame:
    """by..., mode, neighbours: the value with the most values within the tolerance; the first by `order` of equals.

    Counts come from a RANGE window, so that no value meets every other.
    """
    keys = ", ".join(f"`{c}`" for c in by)
    near = F.expr(f"count(*) OVER (PARTITION BY {keys} ORDER BY CAST(`{value}` AS DOUBLE) RANGE BETWEEN {float(tolerance)}D PRECEDING AND {float(tolerance)}D FOLLOWING)")
    w = W.partitionBy(*by).orderBy(F.desc("neighbours"), order)
    out = df.filter(F.col(value).isNotNull()).withColumn("neighbours", near).withColumn("_r", F.row_number().over(w))
    return out.filter("_r = 1").select(*by, F.col(value).alias("mode"), "neighbours")
