"""Exact dedup: tree-merge of sorted digest runs.

Each partition sorts its digests into runs, one for each range of digests; a run is a packed array, sorted and without
repeats. In rounds, `fan_in` neighbouring runs of a range meet in one task and are merged by a multiway merge, which keeps
the smallest id of equal digests, until one run of each range is left.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import cut, packed, salted_join, take, unpacked
from tallyspark.llm.kernels import release

SPACES = r"[\x20\x09-\x0D]+"
#: Rows of a run: what tells a text, whether the id is missing, the smallest id, and how many rows it stands for.
RUN = np.dtype([("digest", "S32"), ("bytes", "<i8"), ("second", "<i8"), ("nameless", "<i8"), ("id", "<i8"), ("n", "<i8")])
RUNS = "range long, run long, body binary"
#: Rows of the input for each range: what a task holds of the last merge at most.
RANGE = 1 << 17


def normal(text: Column) -> Column:
    """Text as it is compared: each run of ASCII white space one space, null empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def merge_runs(runs: Iterable[Iterable[tuple]]) -> Iterator[tuple]:
    """The rows of several sorted runs in one order, equal texts as one row with the smallest id and all their rows.

    Texts are equal if SHA-256, length and a second hash are; a digest alone joins nothing at any level. Ids sort
    before missing ones.
    """
    for key, rows in groupby(heapq.merge(*runs), key=lambda row: row[:3]):
        first = next(rows)
        yield *key, *first[3:5], first[5] + sum(row[5] for row in rows)


def _packed(rows: Iterable[tuple]) -> bytes:
    return np.fromiter(rows, RUN).tobytes()


def _make_runs(batches):
    """A run for each range from rows (range, run, digest, bytes, second, nameless, id) in that order."""
    held: list[tuple] = []
    at = None

    def close():
        return pa.RecordBatch.from_pydict({"range": pa.array([at[0]], pa.int64()), "run": pa.array([at[1]], pa.int64()), "body": pa.array([_packed(merge_runs([held]))], pa.binary())})

    for batch in batches:
        for range_, run, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (range_, run) != at:
                if held:
                    yield close()
                held, at = [], (range_, run)
            held.append((*row, 1))
    if held:
        yield close()
    release()


def _merge(key, t):
    """One round: the runs of a range that meet become one."""
    runs = [np.frombuffer(body.as_buffer(), RUN).tolist() for body in t.column("body").combine_chunks()]
    return pa.table({"range": pa.array([key[0].as_py()], pa.int64()), "run": pa.array([key[1].as_py()], pa.int64()), "body": pa.array([_packed(merge_runs(runs))], pa.binary())})


def _unpack(batches):
    for batch in batches:
        for body in batch.column("body"):
            x = np.frombuffer(body.as_buffer(), RUN)
            digest = pa.Array.from_buffers(pa.binary(32), len(x), [None, pa.py_buffer(np.ascontiguousarray(x["digest"]).tobytes())]).cast(pa.binary())
            keep = pa.array(x["id"], pa.int64(), mask=x["nameless"] == 1)
            yield pa.RecordBatch.from_arrays([digest, pa.array(x["bytes"]), pa.array(x["second"]), keep, pa.array(x["n"])], names=["digest", "bytes", "second", "keep_id", "group_size"])


def digest_runs(signed: DataFrame, total: int) -> DataFrame:
    """(range, run, body): the sorted runs of signed(doc_id, digest, bytes, second), one for each partition and range.

    Digests are uniform, and a run holds each once, so that ranges are even however many copies a text has.
    """
    ranges = max(1, total // RANGE)
    prefix = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    order = ["range", "run", "digest", "bytes", "second", "nameless", "id"]
    rows = signed.select(F.shiftright(prefix * ranges, 32).alias("range"), F.spark_partition_id().cast("long").alias("run"), "digest", "bytes", "second", F.col("doc_id").isNull().cast("long").alias("nameless"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"))
    return rows.sortWithinPartitions(*order).mapInArrow(_make_runs, RUNS)


def merged_runs(runs: DataFrame, fan_in: int) -> DataFrame:
    """One run for each range, after as many rounds of merging as the runs need."""
    left = runs.agg(F.coalesce(F.max("run"), F.lit(0)) + 1).first()[0]
    while left > 1:
        runs = runs.groupBy("range", F.floor(F.col("run") / fan_in).alias("meet")).applyInArrow(_merge, RUNS)
        left = -(-left // fan_in)
    return runs


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs, ids as longs.

    Texts compare after each run of ASCII white space becomes one space; null counts as empty. Texts are told apart by
    SHA-256, byte length and a second 64-bit hash, at every level of the merge; the texts themselves aren't compared
    again. Rows that repeat an id each give a row; a null id never stays where the group has another. Texts of any
    length are read whole. An empty table gives an empty result. Other columns of docs are not read.
    """
    signed = take(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), normal(F.col("text")).alias("t"))
    signed = cut(signed.select("doc_id", F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").cast("long").alias("bytes"), F.xxhash64("t").alias("second")), "digests")
    total = signed.count()
    merged = merged_runs(cut(digest_runs(signed, total), "runs"), fan_in).mapInArrow(_unpack, "digest binary, bytes long, second long, keep_id long, group_size long")
    key = F.struct("digest", "bytes", "second").alias("k")
    out = salted_join(signed.select("doc_id", key), merged.select(key, "keep_id", "group_size"), "k", "group_size", total, "doc_id")
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("k.digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """docs without the rows that exact_dedup() drops; all columns stay.

    A row goes by its id and its text, so that another text under the same id stays. Rows with a null id, and rows that
    repeat both id and text, can't be told apart and stay.
    """
    lost = exact_dedup(docs, id_col, text_col, **kw).filter("NOT kept AND doc_id IS NOT NULL").select("doc_id", F.col("text_sha256").alias("digest")).distinct()
    rows = packed(docs, doc_id=id_col, text=text_col).select("body", F.col("doc_id").cast("long").alias("doc_id"), F.sha2(normal(F.col("text")), 256).alias("digest"))
    return unpacked(rows.join(lost, ["doc_id", "digest"], "left_anti"), docs.columns)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM t
"""
