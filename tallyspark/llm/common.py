"""Helpers that the training-data operators share: shared-folder tables, hot-key joins, id filters, components."""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; where it is unset, one of our own in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tallyspark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df as Parquet in the shared folder and read it again, which cuts its lineage.

    Unlike checkpoint() it runs the plan once, and the files outlive any executor.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[str] = []


def mark() -> int:
    """How many tables cut() has written so far; see discard()."""
    return len(_written)


def discard(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Delete what cut() wrote after mark() gave `since`, but for the last `keep` tables. Only where no plan that reads them
    will run again."""
    end = len(_written) - keep
    for path in _written[since:end]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    if end > since:
        del _written[since:end]


def lean_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Hold Arrow batches to 8 MB: rows are whole texts, and the default of 64 MB for each side of each worker adds up."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = (spark.conf.get(key, None) or "").lower().removesuffix("b")
    if not (now.isdigit() and 0 < int(now) <= most):
        spark.conf.set(key, str(most))


def salted_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, salt_by: str, share: int = 256, salts: int = 64) -> DataFrame:
    """left join right on key, where `weight` of right holds how many left rows have its key.

    Keys with over total/share rows are at most `share` many, so that their list can be broadcast; their rows are
    dealt over `salts` copies of the right rows. All other keys join as they are.
    """
    most = max(64, total // share)
    hot = right.filter(F.col(weight) > most).select(F.col(key).alias("_hot")).distinct()
    dealt = left.join(F.broadcast(hot), left[key].eqNullSafe(F.col("_hot")), "left")
    dealt = dealt.withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(salt_by), F.lit(salts))).otherwise(F.lit(0).cast("long"))).drop("_hot")
    copies = F.when(F.col(weight) > most, F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return dealt.join(right.withColumn("_salt", F.explode(copies)), [key, "_salt"], "left").drop("_salt")


#: Least and most bits of an id filter, as powers of two: 128 KB to 16 MB.
FILTER_BITS = 20, 27


def _slot(x: np.ndarray, wide: int) -> np.ndarray:
    return ((x.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - wide)).astype(np.int64)


class IdFilter:
    """Tells for each id whether it may be in a set; true for all that are, and for few others."""

    def __init__(self, sent, wide: int):
        self.sent, self.wide = sent, wide

    def holds(self, ids: np.ndarray) -> np.ndarray:
        bits, s = np.frombuffer(self.sent.value, np.uint8), _slot(ids, self.wide)
        return ((bits[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1).astype(bool)

    def __call__(self, col: str) -> Column:
        holds = self.holds

        @F.pandas_udf("boolean")
        def may_hold(x: pd.Series) -> pd.Series:
            return pd.Series(holds(x.fillna(-1).to_numpy()))

        return may_hold(col)


def id_filter(ids: DataFrame, col: str) -> IdFilter:
    """An IdFilter for ids[col].

    The filter is a bit array of eight bits or more for each row, up to 2**27 bits, gathered as 128 slices. Beyond some
    16 million ids it lets ever more rows through to the join that follows it; no result depends on it.
    """
    wide = min(FILTER_BITS[1], max(FILTER_BITS[0], (8 * ids.count()).bit_length()))
    slices = 128
    per = (1 << wide) // slices

    @F.pandas_udf("long")
    def slot(x: pd.Series) -> pd.Series:
        return pd.Series(_slot(x.to_numpy(), wide))

    def pack(key, t):
        bits = np.zeros(per, bool)
        bits[t.column("slot").to_numpy() % per] = True
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    found = ids.filter(F.col(col).isNotNull()).select(slot(col).alias("slot")).distinct()
    rows = found.withColumn("slice", F.floor(F.col("slot") / per)).groupBy("slice").applyInArrow(pack, "slice long, bits binary").collect()
    packed = np.zeros((1 << wide) // 8, np.uint8)
    for r in rows:
        packed[r["slice"] * per // 8 : (r["slice"] + 1) * per // 8] = np.frombuffer(r["bits"], np.uint8)
    return IdFilter(ids.sparkSession.sparkContext.broadcast(packed.tobytes()), wide)


#: Rows of a table that one task handles sooner than a shuffle.
SMALL_TABLE = 1 << 17


def tight(df: DataFrame, rows: int) -> DataFrame:
    """df in one partition if it has few rows: grouping and joining it with its like then take no shuffle. Larger tables stay
    as they are dealt."""
    return df.coalesce(1) if rows <= SMALL_TABLE else df


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from each node of edges(a, b); distributed large-star, small-star.

    Edges stay in DataFrames; each round ends in a written table, so lost executors cost one round at most. The centre
    of a large star is dealt over salted copies of its one row. Rounds go on until all is stars; their number grows
    with the logarithm of the nodes. A few edges are one partition, and their rounds take no shuffle.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        n = e.count()
        e = tight(e, n)
        both = e.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        large = salted_join(both.filter("v > u"), low, "u", "n", 2 * n, "v").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = tight(cut(large, "edges"), n)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = salted_join(large, least, "u", "n", n, "v").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = tight(cut(tight(small, n).filter("u <> v").distinct(), "edges"), n)
        # Stars are reached when no node is a leaf of two centres and no centre is a leaf.
        heads = e.select(F.col("v").alias("u")).distinct()
        if e.join(heads, "u", "left_semi").isEmpty() and e.groupBy("u").count().filter("count > 1").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))


def take(docs: DataFrame, **cols: str) -> DataFrame:
    """docs[cols] under new names, by the exact name: columns that differ in case alone, or repeat another's name, don't clash."""
    names = docs.columns
    plain = docs.toDF(*(f"c{k}" for k in range(len(names))))
    return plain.select(*(F.col(f"c{names.index(old)}").alias(new) for new, old in cols.items()))


def packed(docs: DataFrame, **cols: str) -> DataFrame:
    """docs with each row's columns in one, `body`, beside take(docs, **cols): an operator's own names can't meet theirs."""
    names = docs.columns
    plain = docs.toDF(*(f"c{k}" for k in range(len(names))))
    return plain.select(F.struct(*plain.columns).alias("body"), *(F.col(f"c{names.index(old)}").alias(new) for new, old in cols.items()))


def unpacked(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns that packed() has put away, as they were."""
    return rows.select(*(F.col(f"body.c{k}").alias(n) for k, n in enumerate(names)))


def crc_fold(id_col: str, folds: int = 3) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)).cast("int")


def ceil_log(n: int, base: int) -> int:
    return max(1, math.ceil(math.log(max(2, n), base) - 1e-9))
