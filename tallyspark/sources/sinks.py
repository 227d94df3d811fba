"""Sinks with rules, and the scans that read them back."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tallyspark.session import shared_folder
from tallyspark.sources.tables import csv_value


_scratched: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; see sweep()."""
    _scratched.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _scratched[-1]


def sweep(spark: SparkSession) -> int:
    """Delete what was written under all paths of scratch() so far, once no plan that reads it will run again."""
    n = len(_scratched)
    while _scratched:
        at = spark._jvm.org.apache.hadoop.fs.Path(_scratched.pop() + "*")
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in fs.globStatus(at) or ():
            fs.delete(found.getPath(), True)
    return n


LOOKUP = "field string, native string, frequency long, roman string, source string, variant string, authority string, note string"


def write_lookup(rows: DataFrame, path: str) -> None:
    """The lookup as gzipped CSV in its order: field, falling frequency, native."""
    names = StructType.fromDDL(LOOKUP).names
    rows.select(*names).orderBy("field", F.desc("frequency"), "native").write.option("header", True).option("emptyValue", "").option("compression", "gzip").csv(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Rows of write_lookup(); a blank frequency is 0, other blanks are ''."""
    names = StructType.fromDDL(LOOKUP).names
    raw = spark.read.option("header", True).schema(", ".join(f"{n} string" for n in names)).csv(path)
    return raw.select(*(F.coalesce(F.col(n).try_cast("long"), F.lit(0).cast("long")).alias(n) if n == "frequency" else F.coalesce(n, F.lit("")).alias(n) for n in names))


def write_if_sound(df: DataFrame, problems: DataFrame, path: str) -> None:
    """Write df as Parquet, or raise and write nothing if there is any problem."""
    first = problems.limit(5).collect()
    if first:
        raise ValueError(f"refused to write: {[tuple(r) for r in first]}")
    df.write.parquet(path)


def keyed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """df, which fails as it runs if a key comes twice."""
    twice = df.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1")
    first = twice.agg(F.first(F.concat_ws("/", *key)).alias("_twice"))
    ok = F.when(F.col("_twice").isNotNull(), F.raise_error(F.concat(F.lit("duplicate key "), F.col("_twice"))).cast("boolean")).otherwise(True)
    return df.join(F.broadcast(first.select(ok.alias("_ok"))), F.col("_ok")).drop("_ok")


def write_entries(df: DataFrame, key: str, path: str) -> None:
    """One folder of JSON lines for each key, named by it."""
    df.withColumn("entry", F.col(key)).write.partitionBy("entry").json(path)


def merged_entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All entries under a path with the integer key that their folder's name holds, in its order."""
    rows = spark.read.schema(schema).json(f"{path}/entry=*")
    return rows.withColumn("entry", F.regexp_extract(F.col("_metadata.file_path"), "entry=([0-9]+)", 1).cast("long")).orderBy("entry")


#: A byte order mark, which spreadsheet programs look for at the head of a CSV file.
MARK = "\ufeff"


def dataset_lines(parts: DataFrame, sections: DataFrame, key: Sequence[str], mark: bool = True) -> DataFrame:
    """output, place, value: the lines of three outputs of one dataset, from one scan of either source.

    nested: a JSON line for each part with its sections; parts and sections: CSV lines, with a head (place 0, after a byte
    order mark if asked for) in each partition. A section without its part is a line of sections alone.
    """
    inner = [c for c in sections.columns if c not in key]
    children = sections.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*inner))).alias("_children"))
    empty = F.array().cast(children.schema["_children"].dataType)
    both = parts.withColumn("_part", F.lit(True)).join(children, list(key), "full").withColumn("_children", F.coalesce("_children", empty))

    def as_csv(kinds: dict[str, DataType], at) -> Column:
        return F.to_csv(F.struct(*(csv_value(at(c), t).alias(c) for c, t in kinds.items())), {"emptyValue": ""})

    types = {f.name: f.dataType for f in parts.schema.fields}
    child = {f.name: f.dataType for f in sections.schema.fields}
    line = lambda name, value: F.struct(F.lit(name).alias("output"), F.lit(1).alias("place"), value.alias("value"))
    whole = F.to_json(F.struct(*parts.columns, F.col("_children").alias("sections")), {"ignoreNullFields": "false"})
    own = F.when(F.col("_part"), F.array(line("nested", whole), line("parts", as_csv(types, F.col)))).otherwise(F.array().cast("array<struct<output:string,place:int,value:string>>"))
    below = F.transform("_children", lambda s: line("sections", as_csv(child, lambda c: F.col(c) if c in key else s[c])))
    lines = both.select(F.inline(F.concat(own, below)))
    head = (MARK if mark else "")
    heads = [("parts", 0, head + ",".join(parts.columns)), ("sections", 0, head + ",".join(sections.columns))]

    def with_heads(batches):
        columns = zip(*heads, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string()), strict=True)], names=["output", "place", "value"])
        yield from batches

    return lines.mapInArrow(with_heads, "output string, place int, value string")


def write_dataset(parts: DataFrame, sections: DataFrame, key: Sequence[str], path: str, mark: bool = True) -> None:
    """Three outputs of one dataset by one job: nested (JSON lines), parts and sections (CSV), each a folder output=name.

    The rows carry the name of their output, and the sort that the writer needs for its folders puts heads first.
    """
    dataset_lines(parts, sections, key, mark).sortWithinPartitions("output", "place").select("output", "value").write.partitionBy("output").text(path)


def write_shard(df: DataFrame, path: str, schema: str) -> None:
    """Zstandard Parquet with an explicit schema; a missing column fails, the committer makes the write whole or none."""
    shape = StructType.fromDDL(schema)
    df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in shape.fields)).write.option("compression", "zstd").parquet(path)


def checksum_line(body: Column, name: Column) -> Column:
    """'digest  name', as checksum tools print and read it."""
    return F.concat_ws("  ", F.sha2(body.cast("binary"), 256), name)


def tuple_key(*parts: Column | str) -> Column:
    return F.concat_ws(",", *(F.col(p).cast("string") if isinstance(p, str) else p for p in parts))


def parse_tuple_key(c: Column | str, names: Sequence[str]) -> Column:
    """struct of longs out of tuple_key()."""
    parts = F.split(F.col(c) if isinstance(c, str) else c, ",")
    return F.struct(*(F.get(parts, F.lit(k)).try_cast("long").alias(n) for k, n in enumerate(names)))


def with_totals(entries: DataFrame, key: Sequence[str], totals: Sequence[str], rows: str) -> DataFrame:
    """key..., kind, the totals and the fields of each row: cached entries as rows and their totals, from one scan.

    kind 'total' has the totals, kind 'row' a row's fields.
    """
    fields = entries.schema[rows].dataType.elementType.fields
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    total = F.struct(F.lit("total").alias("kind"), *(F.col(t).alias(t) for t in totals), *blank)
    none = [F.lit(None).cast(entries.schema[t].dataType).alias(t) for t in totals]
    each = F.transform(rows, lambda r: F.struct(F.lit("row").alias("kind"), *none, *(r[f.name].alias(f.name) for f in fields)))
    return entries.select(*key, F.inline(F.concat(F.array(total), each)))


def responses(df: DataFrame, column: str, schema: str, error: Column) -> DataFrame:
    """df with the fields of a JSON response, strings cleaned and blanks null, and flags and needs_review of failed ones."""
    shape = StructType.fromDDL(schema)
    parsed = df.withColumn("_r", F.from_json(column, shape))
    out = parsed
    for f in shape.fields:
        v = F.col(f"_r.{f.name}")
        if f.dataType.simpleString() == "string":
            v = F.nullif(F.trim(F.regexp_replace(v, r"\s+", " ")), F.lit(""))
        out = out.withColumn(f.name, F.when(~error, v))
    return out.drop("_r").withColumns({"flags": F.when(error, "api_error").otherwise(""), "needs_review": error})


def capped(df: DataFrame, order: Sequence[str], limit: int = 200) -> DataFrame:
    """The first rows by order, as a sample to look at."""
    return df.orderBy(*order).limit(limit)
