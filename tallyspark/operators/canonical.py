"""Canonical values: greedy clusters within a scope, dominance, application and audit."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.fuzzy import seq_ratio
from tallyspark.functions.text import digit_signature


def shared_grams(length: Column, other: Column, threshold: float) -> Column:
    """The fewest pairs of neighbouring characters that strings of two lengths share at a similarity of `threshold`.

    At 2 M / L of matched to all characters the matched ones lie in at most L - 2 M + 1 blocks, each of which has one pair
    fewer than characters: M - (L - 2 M + 1) pairs, for M = threshold * L / 2.
    """
    return F.ceil((length + other) * (1.5 * threshold - 1) - 1 - 1e-9)


def rare_grams(values: DataFrame, block: Sequence[str], value: str, threshold: float) -> DataFrame:
    """block..., value, _gram: the rarest pairs of neighbouring characters of each value, as many as two values of a block need
    to have one in common if they are alike; and '' for values so short that they may share none.

    The k-th occurrence of a pair in a value is a pair of its own. Rarity is counted over all values of a field.
    """
    size = F.length(value)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: F.substring(value, i, F.lit(2)))
    numbered = F.transform(pairs, lambda g, i: F.concat(g, F.size(F.filter(F.slice(pairs, F.lit(1), i + 1), lambda x: x == g)).cast("string")))
    each = values.filter(size > 1).select(*block, value, F.explode(numbered).alias("_g"))
    often = each.groupBy(block[0], "_g").agg(F.count("*").alias("_often"))
    ranked = each.join(often, [block[0], "_g"]).groupBy(*block, value).agg(F.array_sort(F.collect_list(F.struct("_often", "_g"))).alias("_r"))
    least = shared_grams(size, F.ceil(size * threshold / (2 - threshold) - 1e-9), threshold)
    first = F.greatest(size - F.greatest(least, F.lit(0)), F.lit(1)).cast("int")
    rare = ranked.select(*block, value, F.explode(F.slice("_r", F.lit(1), first)).alias("_x")).select(*block, value, F.col("_x._g").alias("_gram"))
    reach = 1.5 * threshold - 1
    short = values if reach <= 0 else values.filter(size <= 1 / reach)
    return rare.unionByName(short.select(*block, value, F.lit("").alias("_gram")))


def clusters(df: DataFrame, field: str, scope: str, value: str, threshold: float = 0.89) -> DataFrame:
    """field, scope, variant, canonical, n: values by count, each to the first cluster whose head it resembles.

    Only values with the same digits can merge, so the digits join field and scope as a block; within a block values go
    by falling count, then by value; the similarity is taken of (new value, head), in that order. Values meet where they
    share one of their rarest pairs of characters, which all that are alike do, and are scored wherever they lie; the fold
    that depends on order sees the pairs that pass as they stream by in that order, and holds the values that have joined
    a head. A value without a pair is a cluster's head.
    """
    counts = df.filter(F.coalesce(F.trim(F.col(value)), F.lit("")) != "").groupBy(F.col(field).alias("field"), F.col(scope).cast("string").alias("scope"), F.col(value).alias("variant")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("digits", digit_signature("variant"))
    block = ["field", "scope", "digits"]
    rare = rare_grams(counts, block, "variant", threshold).join(counts, [*block, "variant"])
    heads = rare.select(*block, "_gram", F.col("variant").alias("head"), F.col("n").alias("head_n"))
    size, other = F.length("variant"), F.length("head")
    earlier = (F.col("head_n") > F.col("n")) | ((F.col("head_n") == F.col("n")) & (F.col("head") < F.col("variant")))
    met = rare.join(heads, [*block, "_gram"]).filter(earlier & (2 * F.least(size, other) >= threshold * (size + other)))
    pairs = met.select(*block, "variant", "n", "head", "head_n").distinct()
    alike = pairs.withColumn("score", seq_ratio("variant", "head")).filter(F.col("score") >= threshold)

    def fold(batches):
        at, joined = None, set()
        for pdf in batches:
            rows = []
            for *b, v, h in pdf[[*block, "variant", "head"]].itertuples(index=False, name=None):
                if b != at:
                    at, joined = b, set()
                if v not in joined and h not in joined:
                    joined.add(v)
                    rows.append((*b[:2], v, h))
            yield pd.DataFrame(rows, columns=["field", "scope", "variant", "canonical"])

    ordered = alike.repartition(*block).sortWithinPartitions(*block, F.desc("n"), "variant", F.desc("head_n"), "head")
    found = ordered.mapInPandas(fold, "field string, scope string, variant string, canonical string")
    rows = counts.join(found, ["field", "scope", "variant"], "left")
    return rows.select("field", "scope", "variant", F.coalesce("canonical", "variant").alias("canonical"), "n")


def dominant(found: DataFrame, constant_fields: Sequence[str], margin: float = 2.0) -> DataFrame:
    """field, scope, variant, target, n, contested.

    A constant field has one value in a scope: the largest cluster wins if it holds `margin` times the next one's rows,
    and otherwise the scope is contested and nothing changes. Other fields keep each cluster's own head.
    """
    totals = found.groupBy("field", "scope", "canonical").agg(F.sum("n").alias("t"))
    ranked = totals.groupBy("field", "scope").agg(F.reverse(F.array_sort(F.collect_list(F.struct("t", "canonical")))).alias("r"))
    first, second = F.get("r", F.lit(0)), F.coalesce(F.get("r", F.lit(1))["t"], F.lit(0))
    ranked = ranked.select("field", "scope", first["canonical"].alias("winner"), (first["t"] < margin * second).alias("close"))
    constant = F.col("field").isin(*constant_fields)
    out = found.join(ranked, ["field", "scope"])
    target = F.when(constant & F.col("close"), F.col("variant")).when(constant, F.col("winner")).otherwise(F.col("canonical"))
    return out.select("field", "scope", "variant", target.alias("target"), "n", (constant & F.col("close")).alias("contested"))


def apply_mapping(df: DataFrame, mapping: DataFrame, field: str, scope: str, value: str, name: str = "canonical") -> DataFrame:
    """df with the mapped value, itself where the mapping has none. Spark broadcasts the mapping if it is small enough."""
    m = mapping.select(F.col("field").alias("_f"), F.col("scope").alias("_s"), F.col("variant").alias("_v"), F.col("target").alias("_t"))
    on = (df[field] == m["_f"]) & (df[scope].cast("string") == m["_s"]) & (df[value] == m["_v"])
    return df.join(m, on, "left").withColumn(name, F.coalesce("_t", value)).drop("_f", "_s", "_v", "_t")


def substitutions(mapping: DataFrame) -> DataFrame:
    return mapping.filter("target <> variant").select("field", "scope", "variant", "target", "n").orderBy(F.desc("n"), "field", "scope", "variant")


def vocabulary(df: DataFrame, fields: Sequence[str], lang: str, default: str) -> DataFrame:
    """field, native, frequency, lang: distinct values with their most common language (null counts as the default)."""
    rows = df.select(F.coalesce(lang, F.lit(default)).alias("lang"), F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("native")) for f in fields))))
    rows = rows.filter(F.coalesce(F.trim("native"), F.lit("")) != "")
    per = rows.groupBy("field", "native", "lang").agg(F.count("*").alias("n"))
    best = per.groupBy("field", "native").agg(F.sum("n").alias("frequency"), F.min(F.struct((-F.col("n")).alias("m"), "lang")).alias("b"))
    return best.select("field", "native", "frequency", F.col("b.lang").alias("lang")).orderBy("field", F.desc("frequency"), "native")
