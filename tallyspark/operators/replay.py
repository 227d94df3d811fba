"""Named versions of a step, replayed over the same rows and judged against each other; parsers as table functions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.measure import gates

Assembler = Callable[[DataFrame], DataFrame]


class Assemblers:
    """Versions of an assembling step by name. Every version takes the same rows and gives the same columns."""

    def __init__(self, columns: Sequence[str]):
        self.columns, self.versions = list(columns), {}

    def version(self, name: str) -> Callable[[Assembler], Assembler]:
        def register(f: Assembler) -> Assembler:
            if name in self.versions:
                raise ValueError(f"version {name} is there already")
            self.versions[name] = f
            return f

        return register

    def run(self, name: str, rows: DataFrame) -> DataFrame:
        """The named version's rows, which must have the agreed columns."""
        if name not in self.versions:
            raise ValueError(f"no version {name}; there are {sorted(self.versions)}")
        out = self.versions[name](rows)
        missing = [c for c in self.columns if c not in out.columns]
        if missing:
            raise ValueError(f"version {name} gives no {missing}")
        return out.select(*self.columns)

    def replay(self, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        """version, and the columns: each named version's rows. With versions of columns alone the source is scanned once for
        each; give rows that were written before where reading them anew is dear."""
        out = None
        for name in names:
            one = self.run(name, rows).select(F.lit(name).alias("version"), "*")
            out = one if out is None else out.unionByName(one)
        return out


def metrics(replayed: DataFrame, measures: Mapping[str, Column], split: Column) -> DataFrame:
    """version, split, metric, value: aggregates of each version in each split, and in `combined`, from one pass."""
    each = replayed.withColumn("_split", F.explode(F.array_distinct(F.array(F.lit("combined"), split))))
    got = each.groupBy("version", F.col("_split").alias("split")).agg(*(m.cast("double").alias(n) for n, m in measures.items()))
    return got.select("version", "split", F.inline(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in measures))))


def side_by_side(measured: DataFrame, before: str, after: str, splits: Sequence[str]) -> DataFrame:
    """split, metric, before, after, change; a split that holds nothing is named, with nulls."""
    got = measured.groupBy("split", "metric").agg(*(F.max(F.when(F.col("version") == v, F.col("value"))).alias(side) for v, side in ((before, "before"), (after, "after"))))
    wanted = measured.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, [*splits, "combined"]))).alias("split"))
    return wanted.join(got, "split", "left").select("split", "metric", "before", "after", (F.col("after") - F.col("before")).alias("change"))


def judged(measured: DataFrame, before: str, after: str, target: str, least_gain: float, guarded: Sequence[str], **kw) -> DataFrame:
    """gates() over the combined figures of two versions."""
    of = lambda v: measured.filter((F.col("version") == v) & (F.col("split") == "combined")).select("metric", "value")
    return gates(of(before), of(after), target, least_gain, guarded, **kw)


def parsed(df: DataFrame, parser, column: str, keep: Sequence[str]) -> DataFrame:
    """keep..., and the fields of each row that a table function makes of a column; a row of which it makes none goes."""
    return df.lateralJoin(parser(F.col(column).outer())).select(*keep, *parser.returnType.names)
