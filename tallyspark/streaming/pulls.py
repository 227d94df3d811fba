"""Streams: files pulled once each, heartbeats with takeover, late data in windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def pull_once(spark: SparkSession, folder: str, schema: StructType, key: list[str], event_time: str, late: str = "1 hour") -> DataFrame:
    """A stream of a folder's Parquet rows, each key and content once within the watermark."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return rows.withWatermark(event_time, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(events: DataFrame, event_time: str, by: str, size: str = "1 day", late: str = "1 day") -> DataFrame:
    """window_start, by, n of a stream; windows close once the watermark has passed them."""
    rows = events.withWatermark(event_time, late).groupBy(F.window(event_time, size), by).agg(F.count("*").alias("n"))
    return rows.select(F.col("window.start").alias("window_start"), by, "n")


def sessions(events: DataFrame, event_time: str, by: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    rows = events.withWatermark(event_time, late).groupBy(F.session_window(event_time, gap), by).agg(F.count("*").alias("n"))
    return rows.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), by, "n")


def heartbeat_owners(beats: DataFrame, key: str, host: str, stamp: str, takeover: int = 1800) -> DataFrame:
    """key, owner, since, takeovers: a host owns a key until another beats more than `takeover` seconds after its last beat.

    State holds the owner and its last beat, whatever the number of beats.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        owner, since, last, taken = state.get if state.exists else (None, None, None, 0)
        for pdf in batches:
            for r in pdf.sort_values([stamp, host]).itertuples():
                at = getattr(r, stamp).timestamp()
                who = str(getattr(r, host))
                if owner is None or (who != owner and at - last > takeover):
                    taken += owner is not None
                    owner, since = who, at
                if who == owner:
                    last = at
        state.update((owner, since, last, taken))
        yield pd.DataFrame({key: [k[0]], "owner": [owner], "since": [since], "takeovers": [taken]})

    kinds = {f.name: f.dataType.simpleString() for f in beats.schema}
    return beats.groupBy(key).applyInPandasWithState(step, f"{key} {kinds[key]}, owner string, since double, takeovers long", "owner string, since double, last double, takeovers long", "update", GroupStateTimeout.NoTimeout)


def landed(stream: DataFrame, at: str) -> DataFrame:
    """What an append-mode stream gives for all input that is there now, through Parquet files below a path; run again, it
    adds what has come since."""
    q = stream.writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/rows")


def run_available(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """What a stream gives for all input that is there now; for tests and small results, as it lands in memory."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
