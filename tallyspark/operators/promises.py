"""Promises of a dataset, measured by the job that writes it: no second scan, whatever their number."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Promise:
    """A named aggregate that must lie between two bounds; a null value keeps no promise."""

    name: str
    measure: Column
    low: float | None = None
    high: float | None = None

    def kept(self, value) -> bool:
        return value is not None and (self.low is None or value >= self.low) and (self.high is None or value <= self.high)


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def every(name: str, condition: Column) -> Promise:
    """All rows satisfy a condition; its value is the number of those that don't. Null is no."""
    return Promise(name, F.count_if(~_true(condition)), high=0)


def some(name: str, condition: Column, least: int = 1) -> Promise:
    """At least so many rows satisfy a condition."""
    return Promise(name, F.count_if(_true(condition)), low=least)


def share(name: str, condition: Column, least: float) -> Promise:
    """At least this share of all rows satisfies a condition; no rows satisfy none."""
    return Promise(name, F.avg(_true(condition).cast("double")), low=least)


def counted(name: str, n: int, condition: Column | None = None) -> Promise:
    """Exactly n rows, or rows with a condition."""
    return Promise(name, F.count("*") if condition is None else F.count_if(_true(condition)), n, n)


def summed(name: str, value: Column, low: float | None = None, high: float | None = None) -> Promise:
    """A sum within bounds; no rows sum to 0."""
    return Promise(name, F.coalesce(F.sum(value), F.lit(0)), low, high)


def nth_of_key(df: DataFrame, key: Sequence[str], name: str = "_nth") -> DataFrame:
    """df with the place of each row among those of its key, from 1: every(..., _nth == 1) promises a unique key. A key that
    many rows repeat is sorted in one task; without repeats nothing is."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*key).orderBy(F.lit(0))))


def observed(df: DataFrame, promises: Sequence[Promise], write: Callable[[DataFrame], None], drop: Sequence[str] = ()) -> DataFrame:
    """Run write(df without the columns of drop) and return promise, passed, value as that job has measured them.

    The measures ride on the rows as they are written; aggregates over distinct values or windows can't, so such columns are
    made beforehand. What reaches the driver is one row of one value for each promise.
    """
    seen = Observation()
    write(df.observe(seen, *(p.measure.cast("double").alias(f"p{k}") for k, p in enumerate(promises))).drop(*drop))
    got = seen.get
    rows = [(p.name, p.kept(got[f"p{k}"]), got[f"p{k}"]) for k, p in enumerate(promises)]
    return df.sparkSession.createDataFrame(rows, "promise string, passed boolean, value double")
