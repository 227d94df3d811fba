"""Datasets as they are released: written in key order and read back, entries of their files, versions swapped in whole.

What a footer, a file name or a row's place in its file says is read as a table, so that order, sizes and hashes are
checked by joins and windows like any other column.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Where a written file stands: its task, and its number among the task's files.
TASK, PIECE = r"part-(\d+)[^/]*$", r"-c(\d+)[^/-]*$"


def write_ordered(df: DataFrame, key: Sequence[str], path: str, rows_per_file: int = 0) -> None:
    """df as one Parquet dataset whose files, by name, and rows follow key.

    Ranges are cut by a sample of the whole key, so that a common first column is spread over files where the rest of the
    key tells its rows apart. Only adjacent ranges are ever merged, which keeps the order.
    """
    df.repartitionByRange(*key).sortWithinPartitions(*key).write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def file_order(path: Column | str) -> Column:
    """struct(task, piece) out of a file's path: its place among the files of a dataset."""
    return F.struct(*(F.coalesce(F.regexp_extract(path, p, 1).try_cast("long"), F.lit(0).cast("long")).alias(n) for p, n in ((TASK, "task"), (PIECE, "piece"))))


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """path, modificationTime, length, content of the Parquet files under a path; only what is selected is read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^(\w+):/(?!/)", r"\1:///", uri))


def footers(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """file, row_group, rows, bytes, and c_low, c_high for each of columns, of every row group under a path.

    Only footers are read where pyarrow knows the file system; else Spark hands over the files whole. A file without a
    readable footer has one row with a null row_group.
    """
    shape = spark.read.option("ignoreCorruptFiles", True).parquet(path).schema if columns else None
    files, ranged = files_of(spark, path), True
    try:
        _opened(path)
    except pa.ArrowException:
        ranged = False

    def told(batches):
        for batch in batches:
            rows = []
            for uri, *content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    if ranged:
                        fs, at = _opened(uri)
                        meta = pq.read_metadata(at, filesystem=fs)
                    else:
                        meta = pq.read_metadata(pa.BufferReader(content[0]))
                except pa.ArrowInvalid:
                    rows.append((uri, None, None, None, [], []))
                    continue
                where = {meta.schema.column(k).path: k for k in range(meta.num_columns)}
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    stats = [group.column(where[c]).statistics for c in columns]
                    low, high = ([str(getattr(s, side)) if s is not None and s.has_min_max else None for s in stats] for side in ("min", "max"))
                    rows.append((uri, g, group.num_rows, group.total_byte_size, low, high))
            strings = pa.list_(pa.string())
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), strings, strings]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["file", "row_group", "rows", "bytes", "low", "high"])

    out = files.select("path", *([] if ranged else ["content"])).mapInArrow(told, "file string, row_group int, rows long, bytes long, low array<string>, high array<string>")
    ends = [F.get(side, F.lit(k)).cast(shape[c].dataType).alias(f"{c}_{side}") for k, c in enumerate(columns) for side in ("low", "high")]
    return out.select("file", "row_group", "rows", "bytes", *ends)


def groups_out_of_order(foot: DataFrame, column: str) -> DataFrame:
    """The row groups that begin below where an earlier one, by file and place, has ended. One row for each row group is
    sorted, not the data."""
    before = W.orderBy(file_order("file"), "row_group").rowsBetween(W.unboundedPreceding, -1)
    return foot.withColumn("before", F.max(f"{column}_high").over(before)).filter(F.col(f"{column}_low") < F.col("before"))


def bag_by_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """key..., rows and two sums of row hashes: bags of rows are told apart by them, whatever the order of rows."""
    cols = sorted(df.columns)
    total = lambda *x: F.sum(F.xxhash64(*x).cast("decimal(38,0)"))
    return df.groupBy(*key).agg(F.count("*").alias("rows"), total(*cols).alias("one"), total(F.lit("second"), *cols).alias("two"))


def survived(written: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """key..., rows, source_rows, same: whether each key's rows are, as a bag, what the source has; one aggregate a side."""
    a, b = bag_by_key(written, key), bag_by_key(source.select(written.columns), key)
    on = F.lit(True)
    for k in key:
        on = on & a[k].eqNullSafe(b[k])
    same = a["rows"].eqNullSafe(b["rows"]) & a["one"].eqNullSafe(b["one"]) & a["two"].eqNullSafe(b["two"])
    zero = F.lit(0).cast("long")
    return a.join(b, on, "full").select(*(F.coalesce(a[k], b[k]).alias(k) for k in key), F.coalesce(a["rows"], zero).alias("rows"), F.coalesce(b["rows"], zero).alias("source_rows"), same.alias("same"))


def placed(spark: SparkSession, path: str) -> DataFrame:
    """The rows under a path with `_file` (see file_order) and `_row`, their place in it, as the files themselves have them."""
    return spark.read.parquet(path).select("*", file_order("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def with_previous(rows: DataFrame, columns: Sequence[str], run: int = 1 << 20) -> DataFrame:
    """placed() rows with `_before`: the struct of columns of the row before, over the ends of files too.

    Windows hold `run` rows of a file; a run's last row goes along to the next. Of files, one row each is sorted.
    """
    now = F.struct(*columns)
    at = F.floor(F.col("_row") / run)
    runs = rows.withColumn("_now", now).withColumn("_run", F.explode(F.when((F.col("_row") + 1) % run == 0, F.array(at, at + 1)).otherwise(F.array(at))))
    runs = runs.withColumn("_before", F.lag("_now").over(W.partitionBy("_file", "_run").orderBy("_row"))).filter(F.col("_run") == at)
    ends = rows.groupBy("_file").agg(F.max_by(now, "_row").alias("_end"))
    ends = ends.select("_file", F.lag("_end").over(W.orderBy("_file")).alias("_end"))
    return runs.join(ends, "_file").withColumn("_before", F.when(F.col("_row") == 0, F.col("_end")).otherwise(F.col("_before"))).drop("_now", "_run", "_end")


def out_of_place(rows: DataFrame, key: Sequence[str], run: int = 1 << 20) -> DataFrame:
    """The placed() rows whose key is below that of the row before them in file order, with that row's as _before."""
    return with_previous(rows, key, run).filter(F.col("_before") > F.struct(*key))


def serial_breaks(rows: DataFrame, group: Sequence[str], serial: str, run: int = 1 << 20) -> DataFrame:
    """The placed() rows whose serial isn't one more than that of the row before them, or 1 where their group begins."""
    same = F.lit(True)
    for g in group:
        same = same & F.col(f"_before.{g}").eqNullSafe(F.col(g))
    due = F.when(F.col("_before").isNotNull() & same, F.col(f"_before.{serial}") + 1).otherwise(1)
    return with_previous(rows, [*group, serial], run).withColumn("due", due).filter(~F.col(serial).eqNullSafe(F.col("due")))


def below(path: Column | str, base: str) -> Column:
    """A file's path below base, whatever the scheme that either is written with."""
    return F.regexp_replace(path, "^.*" + re.escape(re.sub(r"^\w+:(//[^/]*)?", "", base).rstrip("/")) + "/", "")


def entries_of(spark: SparkSession, path: str) -> DataFrame:
    """file (below path), bytes, rows, sha256, sound of the Parquet files under a path, as they lie there.

    Hashes are taken of what was committed, not of what was meant. A file that doesn't begin and end as Parquet does isn't
    sound, and has null rows. Spark hands over whole files, of up to spark.sql.sources.binaryFile.maxLength.
    """
    magic = F.lit("PAR1").cast("binary")
    sound = (F.substring("content", 1, 4) == magic) & (F.expr("substring(content, -4)") == magic)
    whole = files_of(spark, path).select(below("path", path).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), sound.alias("sound"))
    per_file = footers(spark, path, []).groupBy(below("file", path).alias("file")).agg(F.sum("rows").alias("rows"))
    return whole.join(per_file, "file", "left").select("file", "bytes", "rows", "sha256", "sound")


def audit(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """(invariant, key, detail) of files entries_of() found against a manifest of the same columns; no rows is a pass."""
    a, b = found.alias("a"), manifest.alias("b")
    both = a.join(b, F.col("a.file") == F.col("b.file"), "full")
    gone, odd = F.col("a.file").isNull(), F.col("b.file").isNull()
    finding = lambda name, detail: F.struct(F.lit(name).alias("invariant"), detail.alias("detail"))
    rules = [F.when(gone, finding("missing file", F.lit(""))), F.when(odd, finding("unexpected file", F.lit(""))), F.when(~gone & ~F.col("a.sound"), finding("half-written file", F.concat(F.col("a.bytes").cast("string"), F.lit(" bytes"))))]
    for c in ("bytes", "rows", "sha256"):
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        text = F.concat_ws(" for ", F.coalesce(x.cast("string"), F.lit("none")), F.coalesce(y.cast("string"), F.lit("none")))
        rules.append(F.when(~gone & ~odd & ~x.eqNullSafe(y), finding(f"{c} differ", text)))
    rows = both.select(F.coalesce("a.file", "b.file").alias("key"), F.explode(F.filter(F.array(*rules), lambda r: r.isNotNull())).alias("r"))
    return rows.select("r.invariant", "key", "r.detail")


def committed(spark: SparkSession, at: str) -> list[int]:
    """The numbers of the whole versions at a path: those whose write was committed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(at).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(at)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(at))]
    return sorted(int(n[2:]) for n in names if re.fullmatch(r"v=\d+", n) and fs.exists(path(f"{at}/{n}/_SUCCESS")))


def publish(df: DataFrame, at: str, version: int | None = None) -> int:
    """Write df as the next version at a path, or as the one named, and return its number. Readers see it whole or not at
    all: a version counts once its write is committed, and none that counts is ever changed."""
    found = committed(df.sparkSession, at)
    version = version or max(found, default=0) + 1
    if version in found:
        raise ValueError(f"version {version} is there already")
    df.write.mode("overwrite").parquet(f"{at}/v={version}")
    return version


def published(spark: SparkSession, at: str, version: int | None = None) -> DataFrame:
    """The last whole version at a path, or the one asked for."""
    found = committed(spark, at)
    if not found or (version or found[-1]) not in found:
        raise ValueError(f"no whole version at {at}")
    return spark.read.parquet(f"{at}/v={version or found[-1]}")


def retire(spark: SparkSession, at: str, keep: int = 2) -> list[int]:
    """Delete all whole versions but the last `keep`; no plan that reads them may run again."""
    old = committed(spark, at)[: -keep or None]
    for n in old:
        delete(spark, f"{at}/v={n}")
    return old


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
