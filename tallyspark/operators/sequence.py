"""Order-dependent operators as windows; folds only where an assignment depends on the one before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.operators.modes import upper_medians


def _micros(stamp: Column | str) -> Column:
    """Microseconds of a stamp with or without a zone."""
    return F.unix_micros((F.col(stamp) if isinstance(stamp, str) else stamp).cast("timestamp"))


def positional_serial(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "serial") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("long"))


def sequence_breaks(df: DataFrame, by: Sequence[str], order: Sequence[str], serial: str) -> DataFrame:
    """Rows whose serial isn't the running count in order."""
    return positional_serial(df, by, order, "expected").filter(~F.col(serial).eqNullSafe(F.col("expected")))


def order_breaks(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Sequence[str]) -> DataFrame:
    """Rows whose value tuple is below the one before them."""
    before = F.lag(F.struct(*value)).over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("_b", before).filter(F.col("_b") > F.struct(*value)).drop("_b")


def carry_section(df: DataFrame, by: Sequence[str], order: Sequence[str], found: str, sticky: str = "addition", plain: str = "main", name: str = "section") -> DataFrame:
    """df with the section after carry: a plain page after a sticky one stays sticky until another kind comes."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col(found) != plain, F.col(found)), ignorenulls=True).over(w)
    return df.withColumn(name, F.when((F.col(found) == plain) & (last == sticky), sticky).otherwise(F.col(found)))


def position_features(df: DataFrame, part: Sequence[str], page: str, row: str) -> DataFrame:
    """df with page_position (first, middle or last; a single page is first) and in_last_row of its page."""
    p, g = W.partitionBy(*part), W.partitionBy(*part, page)
    pos = F.when(F.col(page) == F.min(page).over(p), "first").when(F.col(page) == F.max(page).over(p), "last").otherwise("middle")
    return df.withColumns({"page_position": pos, "in_last_row": F.col(row) == F.max(row).over(g)})


def last_k_rate(df: DataFrame, by: Sequence[str], stamp: str, order: Sequence[str], k: int = 5) -> DataFrame:
    """by..., n, per_hour: (n - 1) over the hours that the newest k stamps span; 0 for fewer than two or no span."""
    w = W.partitionBy(*by).orderBy(F.desc(stamp), *(F.desc(c) for c in order))
    newest = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    s = _micros(stamp)
    out = newest.groupBy(*by).agg(F.count("*").alias("n"), ((F.max(s) - F.min(s)) / 3.6e9).alias("_h"))
    return out.select(*by, "n", F.when((F.col("n") < 2) | (F.col("_h") <= 0), 0.0).otherwise((F.col("n") - 1) / F.col("_h")).alias("per_hour"))


def paired_hours(df: DataFrame, by: Sequence[str], stamp: str, order: Sequence[str], starts: Column, stops: Column, now: Column) -> DataFrame:
    """by..., intervals, hours from each start to the next stop; a later start resets an open one, an open one runs to now."""
    w = W.partitionBy(*by).orderBy(stamp, *order)
    kind = F.when(starts, "start").when(stops, "stop")
    rows = df.withColumn("_k", kind).filter("_k IS NOT NULL").withColumns({"_n": F.lead("_k").over(w), "_t": F.lead(stamp).over(w)})
    open_ = rows.filter("_k = 'start' AND (_n IS NULL OR _n = 'stop')")
    hours = (_micros(F.coalesce("_t", now)) - _micros(stamp)) / 3.6e9
    return open_.groupBy(*by).agg(F.count("*").alias("intervals"), F.sum(hours).alias("hours"))


def islands(df: DataFrame, by: Sequence[str], index: str, gap: int = 1) -> DataFrame:
    """by..., island, first, last, n, middle: runs of distinct indices at most `gap` apart; middle is their floored mean."""
    d = df.filter(F.col(index).isNotNull()).select(*by, index).distinct()
    w = W.partitionBy(*by).orderBy(index)
    new = F.when(F.col(index) - F.lag(index).over(w) <= gap, 0).otherwise(1)
    d = d.withColumn("_new", new).withColumn("island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return d.groupBy(*by, "island").agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count("*").alias("n"), F.floor(F.sum(index) / F.count("*")).alias("middle"))


def runs_above(df: DataFrame, by: Sequence[str], index: str, value: str, threshold: float, least: int) -> DataFrame:
    """by..., first, last (exclusive), length of the runs of consecutive indices with value over the threshold."""
    up = df.filter(F.col(value) > threshold)
    up = up.withColumn("_i", F.col(index) - F.row_number().over(W.partitionBy(*by).orderBy(index)))
    out = up.groupBy(*by, "_i").agg(F.min(index).alias("first"), (F.max(index) + 1).alias("last"), F.count("*").alias("length"))
    return out.filter(F.col("length") >= least).drop("_i")


def restore_short(bands: DataFrame, by: Sequence[str], first: str = "first", last: str = "last", share: float = 0.6, least: int = 3) -> DataFrame:
    """bands with grown first and last: a band under `share` of the upper median height takes half the lack on each side.

    It never passes its neighbours' original ends; groups of fewer than `least` bands stay as they are.
    """
    height = F.col(last) - F.col(first)
    sizes = upper_medians(bands.withColumn("_h", height), by, "_h", "_m").withColumnRenamed("n", "_n")
    w = W.partitionBy(*by).orderBy(first)
    rows = bands.join(sizes, list(by)).withColumns({"_p": F.coalesce(F.lag(last).over(w), F.lit(0)), "_q": F.lead(first).over(w)})
    pad = F.floor((F.col("_m") - height) / 2)
    grow = (F.col("_n") >= least) & (height < share * F.col("_m"))
    return rows.select(*by, first, last, F.when(grow, F.greatest("_p", F.col(first) - pad)).otherwise(F.col(first)).alias("grown_first"), F.when(grow, F.least(F.coalesce("_q", F.col(first) + F.col("_m")), F.col(last) + pad)).otherwise(F.col(last)).alias("grown_last"))


def fixed_chunks(df: DataFrame, by: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    return df.withColumn("chunk", F.floor((F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1) / size))


def pack_in_order(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str, budget: float) -> DataFrame:
    """df with batch: in order, a row that would push its batch over the budget begins the next one.

    A batch's start depends on the one before, so the sorted rows are folded as they stream by; no group is held in
    memory, and a batch holds at least one row.
    """
    out = type(df.schema)([*df.schema.fields]).add("batch", "long")

    def fold(batches):
        last, now, total = None, 0, None
        for pdf in batches:
            numbers = []
            for key, x in zip(pdf[list(by)].itertuples(index=False, name=None), pdf[weight], strict=True):
                if key != last:
                    last, now, total = key, 0, None
                if total is not None and total + x > budget:
                    now, total = now + 1, 0
                total = (total or 0) + x
                numbers.append(now)
            yield pdf.assign(batch=numbers)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInPandas(fold, out)


def running_offsets(df: DataFrame, by: Sequence[str], order: Sequence[str], size: str) -> DataFrame:
    """df with offset: the summed sizes of the rows before."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(size).over(w), F.lit(0)))


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")


def eta_seconds(done: Column, total: Column, elapsed: Column, workers: int) -> Column:
    """elapsed / done * left; null until each worker has finished one."""
    return F.when(done >= workers, elapsed / done * (total - done))


def header_and_body(lines: Column, native: str) -> Column:
    """struct(header, body): the lines before the first with native script, and the rest."""
    at = F.array_position(F.transform(lines, lambda x: x.rlike(native)), True)
    n = F.when(at == 0, F.size(lines)).otherwise(at.cast("int") - 1)
    return F.struct(F.slice(lines, F.lit(1), n).alias("header"), F.slice(lines, n + 1, F.size(lines)).alias("body"))
