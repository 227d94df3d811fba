"""Samples that any run repeats: order comes from a key, never from a generator's state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def seeded_sample(df: DataFrame, key: Sequence[str], seed: int, n: int) -> DataFrame:
    """n rows without replacement, in the order of a keyed md5."""
    return df.withColumn("_h", F.md5(F.concat_ws(":", *(F.col(k).cast("string") for k in key), F.lit(str(seed))))).orderBy("_h", *key).limit(n).drop("_h")


def cluster_sample(df: DataFrame, cluster: str, order: Sequence[str], clusters: int, rows: int) -> DataFrame:
    """rows // clusters rows of each of the first `clusters` clusters."""
    picked = df.select(cluster).distinct().orderBy(cluster).limit(clusters)
    w = W.partitionBy(cluster).orderBy(*order)
    return df.join(picked, cluster, "left_semi").withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= rows // clusters).drop("_r")


def systematic_sample(df: DataFrame, stratum: str, order: Sequence[str], step: int, most: int) -> DataFrame:
    """Every step-th row of each stratum, and at most `most` of them."""
    w = W.partitionBy(stratum).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w) - 1).filter((F.col("_r") % step == 0) & (F.col("_r") < step * most)).drop("_r")


def half_and_half(df: DataFrame, interesting: Column, order: Sequence[str], n: int) -> DataFrame:
    """n/2 rows that are interesting and n/2 that aren't, the first of each by order."""
    hit = F.coalesce(interesting, F.lit(False))
    return df.filter(hit).orderBy(*order).limit(n // 2).unionByName(df.filter(~hit).orderBy(*order).limit(n - n // 2))
