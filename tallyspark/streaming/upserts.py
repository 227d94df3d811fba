"""Late and re-issued rows: a stream into a keyed dataset that may be stopped anywhere, replayed, and compacted.

Every micro-batch writes one folder named by its number, over whatever an attempt before it left there, so that a batch
that was written but not committed by the stream is written again and not twice. Which row of a key counts is decided by
its stamp and content alone, a choice that neither order nor repetition changes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.sources.releases import committed, delete, publish


def latest(rows: DataFrame, key: Sequence[str], stamp: str) -> DataFrame:
    """One row of each key: that with the largest stamp, on a tie that with the larger hash of its content. A null stamp is
    the smallest. It is combined before it is shuffled, so a key with many issues is no burden."""
    content = sorted(c for c in rows.columns if c not in key)
    order = F.struct(F.col(stamp).isNotNull(), stamp, F.xxhash64(*content))
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in key)), order).alias("_row"))
    return best.select(*(F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in rows.columns))


def write_batch(at: str, key: Sequence[str], stamp: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that stores a batch's latest row of each key as the folder of its number."""

    def write(batch: DataFrame, number: int) -> None:
        latest(batch, key, stamp).write.mode("overwrite").parquet(f"{at}/batches/v={number}")

    return write


def upserted(stream: DataFrame, at: str, key: Sequence[str], stamp: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start storing a stream at a path; current() reads it. Restarted with the same checkpoint it goes on where it stood."""
    return stream.writeStream.foreachBatch(write_batch(at, key, stamp)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _parts(spark: SparkSession, at: str) -> tuple[list[str], int]:
    """The folders that make up the dataset now, and the first batch that the last compaction doesn't hold."""
    bases = committed(spark, f"{at}/base")
    since = bases[-1] if bases else 0
    return [f"{at}/base/v={since}"] * bool(bases) + [f"{at}/batches/v={n}" for n in committed(spark, f"{at}/batches") if n >= since], since


def current(spark: SparkSession, at: str, key: Sequence[str], stamp: str) -> DataFrame:
    """The latest row of each key in what was stored so far."""
    paths, _ = _parts(spark, at)
    if not paths:
        raise ValueError(f"nothing is stored at {at}")
    return latest(spark.read.parquet(*paths), key, stamp)


def compact(spark: SparkSession, at: str, key: Sequence[str], stamp: str) -> int:
    """Put all committed batches into one base that takes their place at once, and return how many there were.

    The last batch stays as it is, as its stream may yet write it again; what a base holds counts from it alone.
    """
    _, since = _parts(spark, at)
    done = [n for n in committed(spark, f"{at}/batches") if n >= since][:-1]
    if done:
        paths = [f"{at}/base/v={since}"] * bool(committed(spark, f"{at}/base")) + [f"{at}/batches/v={n}" for n in done]
        publish(latest(spark.read.parquet(*paths), key, stamp), f"{at}/base", done[-1] + 1)
    return len(done)


def sweep(spark: SparkSession, at: str) -> None:
    """Delete the batches and bases that the last base has replaced; no plan that reads them may run again."""
    _, since = _parts(spark, at)
    for folder in ("base", "batches"):
        for n in committed(spark, f"{at}/{folder}"):
            if n < since:
                delete(spark, f"{at}/{folder}/v={n}")
