"""Sources and sinks with their conventions for missing values, nesting and keys."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType, TimestampType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def zip_members(spark: SparkSession, glob: str, pattern: str | None = None) -> DataFrame:
    """members_of() the archives under a glob."""
    return members_of(spark.read.format("binaryFile").load(glob).select("path", "content"), pattern)


def members_of(archives: DataFrame, pattern: str | None = None, bodies: bool = False) -> DataFrame:
    """archive, member, size, sha256, matched[, body] for each entry of archives(path, content).

    Members are read in 1 MiB steps and never extracted; without bodies none is held whole. An archive is one row: what
    doesn't fit a row is read by range instead, as the training-data package does.
    """
    import hashlib

    def walk(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                rows = []
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        h, held = hashlib.sha256(), []
                        with z.open(info) as f:
                            while step := f.read(1 << 20):
                                h.update(step)
                                if bodies:
                                    held.append(step)
                        rows.append((path, info.filename, info.file_size, h.hexdigest(), b"".join(held) if bodies else None))
                yield pd.DataFrame(rows, columns=["archive", "member", "size", "sha256", "body"])

    out = archives.select("path", "content").mapInPandas(walk, "archive string, member string, size long, sha256 string, body binary")
    return (out if bodies else out.drop("body")).withColumn("matched", F.col("member").rlike(pattern) if pattern else F.lit(True))


def jsonl(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt lines) of JSON lines, plain or gzipped; blank lines are skipped."""
    shape = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    text = spark.read.text(path).filter(F.trim("value") != "")
    parsed = text.withColumn("r", F.from_json("value", StructType([*shape.fields]).add("_corrupt", "string"), {"columnNameOfCorruptRecord": "_corrupt"}))
    good = parsed.filter("r._corrupt IS NULL").select("r.*").drop("_corrupt")
    return good, parsed.filter("r._corrupt IS NOT NULL").select(F.col("value").alias("line"))


def csv_value(x: Column, kind: DataType) -> Column:
    """A value as the CSV convention writes it: NA for null, true and false."""
    if isinstance(kind, BooleanType):
        x = F.when(x, "true").when(~x, "false")
    return F.coalesce(x.cast("string"), F.lit("NA"))


def csv_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df as strings under the CSV convention, columns in the order asked for."""
    return df.select(*(csv_value(F.col(c), df.schema[c].dataType).alias(c) for c in columns))


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mark: bool = False) -> None:
    """df under the CSV convention with a head in each file, which begins with a byte order mark if asked for."""
    text = csv_text(df, columns)
    if mark:
        text = text.withColumnRenamed(columns[0], "\ufeff" + columns[0])
    text.write.option("header", True).option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of write_csv(): NA becomes null, an empty field stays ''."""
    shape = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    strings = StructType.fromDDL(", ".join(f"`{f.name}` string" for f in shape.fields))
    raw = spark.read.option("header", True).option("nullValue", "\0").schema(strings).csv(path)
    return raw.select(*(F.nullif(F.coalesce(f.name, F.lit("")), F.lit("NA")).try_cast(f.dataType).alias(f.name) for f in shape.fields))


def nest(parents: DataFrame, children: DataFrame, key: Sequence[str], columns: Sequence[str], name: str, order: Sequence[str] = ()) -> DataFrame:
    """parents with their children as an array of structs in `order`; an empty array where there are none."""
    c = children.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, *(x for x in columns if x not in order)))).alias(name))
    out = parents.join(c, list(key), "left")
    empty = F.array().cast(c.schema[name].dataType)
    return out.withColumn(name, F.coalesce(name, empty))


def flatten(nested: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """key... and the fields of each nested child; parents without children give no row."""
    return nested.select(*key, F.inline(name))


def numbered_children(nested: DataFrame, key: Sequence[str], name: str, number: str) -> DataFrame:
    """flatten() where a child's missing or zero number becomes its place, counted from 1."""
    rows = nested.select(*key, F.posexplode(name).alias("_p", "_c"))
    n = F.col(f"_c.{number}")
    fields = [f.name for f in nested.schema[name].dataType.elementType.fields if f.name != number]
    return rows.select(*key, F.when(n.isNull() | (n == 0), F.col("_p") + 1).otherwise(n).alias(number), *(F.col(f"_c.{f}").alias(f) for f in fields))


WORDS = "array<struct<blocks:array<struct<paragraphs:array<struct<words:array<struct<symbols:array<struct<text:string>>,box:array<struct<x:int,y:int>>>>>>>>>>"


def words_of(responses: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """key..., page, text, left, top, right, bottom from pages of blocks of paragraphs of words; blank words go.

    A vertex without a coordinate has it at 0.
    """
    pages = responses.select(*key, F.posexplode(F.from_json(column, WORDS)).alias("page", "p"))
    words = pages.select(*key, "page", F.explode("p.blocks").alias("b")).select(*key, "page", F.explode("b.paragraphs").alias("g")).select(*key, "page", F.explode("g.words").alias("w"))
    text = F.array_join(F.transform("w.symbols", lambda s: s["text"]), "")
    xs, ys = (F.transform(F.col(f"w.box.{k}"), lambda v: F.coalesce(v, F.lit(0))) for k in ("x", "y"))
    return words.select(*key, "page", text.alias("text"), F.array_min(xs).alias("left"), F.array_min(ys).alias("top"), F.array_max(xs).alias("right"), F.array_max(ys).alias("bottom")).filter(F.trim("text") != "")


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """old with the records of new in place of those with the same key."""
    return old.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new)


def stale(wanted: DataFrame, cached: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The wanted rows that no cached row with the same key and version columns covers."""
    return wanted.join(cached.select(*key, *version).distinct(), [*key, *version], "left_anti")


def json_schema(struct: StructType) -> dict:
    """A closed JSON Schema with nullable properties, all of them required."""

    def one(t) -> dict:
        if isinstance(t, StructType):
            return json_schema(t)
        if isinstance(t, ArrayType):
            return {"type": "array", "items": one(t.elementType)}
        if isinstance(t, (IntegerType, LongType, ShortType)):
            return {"type": "integer"}
        if isinstance(t, (DoubleType, FloatType, DecimalType)):
            return {"type": "number"}
        if isinstance(t, (DateType, TimestampType)):
            return {"type": "string", "format": "date" if isinstance(t, DateType) else "date-time"}
        return {"type": "boolean" if isinstance(t, BooleanType) else "string"}

    props = {f.name: {"anyOf": [one(f.dataType), {"type": "null"}]} if f.nullable and not isinstance(f.dataType, (StructType, ArrayType)) else one(f.dataType) for f in struct.fields}
    return {"type": "object", "properties": props, "required": [f.name for f in struct.fields], "additionalProperties": False}
